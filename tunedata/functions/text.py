"""String functions used by the templates and prompt handling (F-str-*)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's output byte for byte:
# the wrapper put around a human turn in the chat layout.
HUMAN_PREFIX = "Human: \n"
HUMAN_SUFFIX = "\n\nAssistant: \n"
# Default role that is masked out of the loss.
DEFAULT_HUMAN_ROLES = ("human",)

# ASCII white space, the separator for words and the characters left out of
# character coverage (same class in Java regex and RE2).
WHITESPACE_CLASS = "[\\t\\n\\x0B\\f\\r ]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_human(role, human_roles: Iterable[str] = DEFAULT_HUMAN_ROLES) -> Column:
    """Lower-cased role is one of ``human_roles``."""
    return F.lower(_col(role)).isin([r.lower() for r in human_roles])


def human_template(value, human: Column) -> Column:
    """Wrap a human turn, leave every other turn unchanged."""
    v = _col(value)
    return F.when(human, F.concat(F.lit(HUMAN_PREFIX), v, F.lit(HUMAN_SUFFIX))).otherwise(v)


def last_path_segment(path) -> Column:
    """F-str-4 with D2: trailing slashes are stripped before taking the last segment."""
    return F.element_at(F.split(F.regexp_replace(_col(path), "/+$", ""), "/"), -1)


def strip_prompt(response, prompt, prefix_only: bool = False) -> Column:
    """F-str-6: remove every literal occurrence of the prompt.

    An empty prompt leaves the response unchanged. ``prefix_only`` removes one
    leading occurrence instead.
    """
    r, p = _col(response), _col(prompt)
    if prefix_only:
        return F.when(r.startswith(p), r.substr(F.length(p) + 1, F.lit(2147483647))).otherwise(r)
    return F.when(p == "", r).otherwise(F.replace(r, p, F.lit("")))


# One whole quoted literal, in either quote style; what an escape may be.
_ESCAPE = r"""\\(?:[\\'"nrtbf]|u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2})"""
_DOUBLE = rf"""\A"(?:[^"\\\x00-\x1f]|{_ESCAPE})*"\z"""
_SINGLE = rf"""\A'(?:[^'\\\x00-\x1f]|{_ESCAPE})*'\z"""
# Stands for an escaped backslash while the other escapes are rewritten (a noncharacter).
_BACKSLASH = "\ufffe"


def unquote_literal(line) -> Column:
    """F-str-8 with D8: accept one quoted string literal per line, never evaluate.

    The whole line must be one literal in double or single quotes. The escapes
    ``\\\\ \\' \\" \\n \\r \\t \\b \\f \\xHH \\uHHHH`` are decoded. Anything else is
    NULL (the reader quarantines it).
    """
    s = F.trim(_col(line))
    body = F.substring(s, F.lit(2), F.length(s) - 2)
    # The literal's body as the body of a JSON string.
    j = F.replace(body, F.lit("\\\\"), F.lit(_BACKSLASH))
    j = F.replace(j, F.lit("\\'"), F.lit("'"))
    j = F.replace(F.replace(j, F.lit('\\"'), F.lit('"')), F.lit('"'), F.lit('\\"'))
    j = F.regexp_replace(j, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    j = F.replace(j, F.lit(_BACKSLASH), F.lit("\\\\"))
    value = F.get_json_object(F.concat(F.lit('{"v":"'), j, F.lit('"}')), "$.v")
    whole = (s.rlike(_DOUBLE) | s.rlike(_SINGLE)) & ~F.contains(s, F.lit(_BACKSLASH))
    return F.when(whole, value)
