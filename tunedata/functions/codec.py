"""Built-in encoders as native expressions (F2 a).

* code-point encoder: one id per Unicode code point, ids are the code points;
* word splitting on ASCII white space (for the word vocabulary encoder,
  whose lookup is a join, see ``tunedata.operators.encode``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.functions.arrays import empty_ints
from tunedata.functions.text import WHITESPACE_CLASS

# Fixed value: the word-start marker of subword vocabularies.
WORD_MARK = "▁"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def codepoints(text) -> Column:
    """Encode text as its code points (NULL stays NULL, '' gives [])."""
    t = _col(text)
    return (F.when(t == "", empty_ints())
            .otherwise(F.transform(F.split(t, ""), lambda c: F.ascii(c))).cast("array<int>"))


def codepoints_decode(ids) -> Column:
    """Inverse of ``codepoints``: 8 hex digits per code point, decoded as UTF-32."""
    hexed = F.array_join(F.transform(_col(ids), lambda i: F.lpad(F.hex(i), 8, "0")), "")
    return F.decode(F.unhex(hexed), "utf-32")


def chars(text) -> Column:
    """Characters of a text, white space removed (input of character coverage)."""
    t = F.regexp_replace(_col(text), WHITESPACE_CLASS, "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ""))


def words(text) -> Column:
    """Words of a text: split on runs of ASCII white space, no empty pieces.

    Leading and trailing white space is cut first, so the split never yields
    an empty piece (native expressions only, no per-element lambda).
    """
    t = F.regexp_replace(_col(text), f"\\A{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WHITESPACE_CLASS + "+"))


def symbols(word) -> Column:
    """A word as BPE start symbols: the word mark, then one symbol per character."""
    w = _col(word)
    return F.concat(F.array(F.lit(WORD_MARK)), F.split(w, ""))
