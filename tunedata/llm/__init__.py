"""Operators of a training-data pipeline (toxicity to mixing), one module each.

Nothing outside this package imports it; ``queries.py`` registers the
``opN_<name>`` queries and their SQL.
"""
