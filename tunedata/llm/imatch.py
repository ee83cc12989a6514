"""I-Match document fingerprints with randomised lexicon subsets (DataFrame functions only).

A document's terms are its distinct lower-cased runs of letters and digits.
The lexicon keeps the terms whose inverse document frequency lies in a band;
terms are identified by one of ``2^SLOT_BITS`` slots of their hash, so the
lexicon is a bit set of fixed size at any size of the corpus (the frequency of
a slot is that of its terms together; rare terms add about terms-per-document
/ slots, far below the band). The kept terms, sorted, are hashed once for each
of several random subsets of the lexicon: a subset keeps one in ``rate`` terms,
for a series of rates, so that short and long documents both have subsets that
a small change leaves as they are. With ``every_text`` (as in the registered query)
a text without a term in the lexicon (a short one, or of a language or script with
few rows) is hashed by all of its terms, and one without terms by its signs other
than white space, so that the content of every text counts.

Likeness of two fingerprints: of the subsets in which either has a term, the
part on which both agree; 1 for equal fingerprints.

Defined cases: null text is an empty text; texts of nothing but white space
share the fingerprint of zeros (likeness 1 to each other, 0 to all others), and
no other text has it, but without ``every_text`` all texts without a kept term do;
equal rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import WORD_GAP, text_or_empty

TERM_GAP = r"[^\p{L}\p{N}]+"
SLOT_BITS = 18
# One subset in each of SUBSETS residues, at each rate (powers of two, 10 hash bits each).
RATES, SUBSETS = (16, 64, 256, 1024), 16
# Neighbours are found inside ranges of ids; the most ranges, and documents in each below that.
MAX_RANGES, RANGE_DOCS = 1 << 16, 2000


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of the terms of ``text``."""
    terms = F.array_remove(F.split(F.lower(text), TERM_GAP), "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def _slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def lexicon(docs: DataFrame, min_idf: float = 1.2, max_idf: float = 4.6) -> list[int]:
    """The lexicon as a bit set of 64-bit words: slots with ``ln(N / df)`` in the band."""
    slots = docs.select(F.explode(F.array_distinct(F.transform(
        term_hashes(text_or_empty()), lambda h: _slot(h).cast("int")))).alias("slot"))
    n = docs.count()
    kept = (slots.groupBy("slot").agg(F.count("*").alias("df"))
            .filter(F.col("df").between(n * math.exp(-max_idf), n * math.exp(-min_idf))))
    words = (kept.groupBy(F.expr("slot div 64").alias("i"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).collect())
    out = [0] * (1 << SLOT_BITS >> 6)  # at most 2^18 / 64 rows come to the driver
    for r in words:
        out[r["i"]] = r["bits"]
    return out


def kept_terms(text: Column, lex: list[int], every_text: bool = False) -> Column:
    """Hashes of the text's terms in the lexicon, sorted. With ``every_text``, of all its terms
    if none is there, and without terms of the text less its white space (none if nothing is left)."""
    bits = F.split(F.lit(",".join(map(str, lex))), ",").cast("array<bigint>")  # folded to a constant

    def kept(h: Column) -> Column:
        word = F.element_at(bits, (F.shiftrightunsigned(_slot(h), 6) + 1).cast("int"))
        return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    if not every_text:
        return F.array_sort(F.filter(term_hashes(text), kept))

    def used(found: Column, every: Column) -> Column:
        signs = F.regexp_replace(text, WORD_GAP, "")
        whole = F.filter(F.array(F.when(signs != "", F.xxhash64(signs))), lambda h: h.isNotNull())
        return F.when(F.size(found) > 0, found).when(F.size(every) > 0, every).otherwise(whole)

    # Bound to variables, so that the terms are made and looked up once.
    picked = F.transform(F.array(term_hashes(text)), lambda every: F.element_at(
        F.transform(F.array(F.filter(every, kept)), lambda found: used(found, every)), 1))
    return F.array_sort(F.element_at(picked, 1))


def _level_hashes(terms: Column, rate: int, shift: int) -> Column:
    def residue(h: Column) -> Column:
        return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(rate - 1))

    # Bound to a variable, so that the terms of the level are picked once.
    chosen = F.array(F.filter(terms, lambda h: residue(h) < SUBSETS))
    parts = F.transform(chosen, lambda c: F.transform(
        F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda j: F.filter(c, lambda h: residue(h) == j)))
    return F.transform(F.element_at(parts, 1), lambda a: F.when(F.size(a) == 0, 0).otherwise(
        F.pmod(F.xxhash64(a), F.lit(65535)) + 1).cast("int"))


def subset_hashes(terms: Column) -> Column:
    """Number of each subset: 0 without a term in it, else a hash of its sorted terms."""
    # Bound to a variable, so that the terms are made once for all rates.
    made = F.transform(F.array(terms), lambda t: F.concat(
        *[_level_hashes(t, rate, SLOT_BITS + 10 * n) for n, rate in enumerate(RATES)]))
    return F.element_at(made, 1)


def fingerprint(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    either = F.size(F.filter(pairs, lambda p: (p["a"] != 0) | (p["b"] != 0)))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != 0) & (p["a"] == p["b"])))
    return F.when(a == b, 1.0).otherwise(same / either)


def id_ranges(docs: DataFrame, n: int) -> Column:
    """Number of the range of ids that ``doc_id`` is in, ranges ascending, evenly filled;
    null is in the first. Looked up in two steps among at most ``MAX_RANGES`` bounds."""
    count = max(1, min(MAX_RANGES, -(-n // RANGE_DOCS)))
    if count == 1:
        return F.lit(0)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)],
                                        max(10_000, 10 * count))).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.lit(0)
    per = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + per] for i in range(0, len(cuts), per)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    nested = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    x = F.col("doc_id")
    group = F.size(F.filter(heads, lambda b: b <= x))
    inside = F.size(F.filter(F.element_at(nested, F.greatest(group, F.lit(1))), lambda b: b <= x))
    return F.when(x.isNull() | (group == 0), 0).otherwise((group - 1) * per + inside).cast("int")


def with_next(docs: DataFrame, ranges: Column, derive) -> DataFrame:
    """``docs`` (``doc_id, text``) with ``sig`` and of the next row by descending ``doc_id``
    (null last; of equal ids by ``text``; after the last the first) ``next_text, next_sig``.
    ``derive`` makes ``sig`` from a text column."""
    ranged = docs.withColumn("_range", ranges)
    # The first row of each range follows the last of the one above: one row a range
    # (MAX_RANGES at most).
    tops = ranged.groupBy("_range").agg(F.max("doc_id").alias("_top")).withColumnRenamed("_range", "_r")
    firsts = (ranged.join(F.broadcast(tops), (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_top")))
              .groupBy("_range").agg(F.max("text").alias("_text")))
    along = Window.orderBy("_range")
    last = F.last("_text").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    borders = (firsts.select(F.col("_range").alias("_r"), F.coalesce(F.lag("_text").over(along), last).alias("_text"))
               .withColumn("_sig", derive(F.col("_text"))))
    w = Window.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last())
    led = ranged.withColumn("sig", derive(F.col("text"))).withColumns(
        {"_led_text": F.lead("text").over(w), "_led_sig": F.lead("sig").over(w)})
    return (led.join(borders, F.col("_range") == F.col("_r"))
            .withColumns({"next_text": F.coalesce("_led_text", "_text"), "next_sig": F.coalesce("_led_sig", "_sig")})
            .select("doc_id", "text", "sig", "next_text", "next_sig"))


def edited_likeness(docs: DataFrame, min_idf: float = 1.2, max_idf: float = 4.6,
                    every_text: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last third replaced by as many
    of the first code points of the next document), with their likeness."""
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    lex = lexicon(docs, min_idf, max_idf)

    def derive(text: Column) -> Column:
        return subset_hashes(kept_terms(text, lex, every_text))

    rows = with_next(docs, id_ranges(docs, docs.count()), derive)
    n = F.char_length("text")
    third = F.expr("cast(char_length(text) div 3 as int)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = (rows.withColumn("n_chars", n.cast("bigint")).withColumn("edited", edited)
            .withColumn("edited_sig", derive(F.col("edited"))))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("sig")).alias("fingerprint"),
                       fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
                       likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                       likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
