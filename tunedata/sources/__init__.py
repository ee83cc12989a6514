"""Readers, writers and adapters from the driver tables to the input shapes."""
