"""Mixing sources to target weights by a low-discrepancy source schedule.

Each source's documents are put in a shuffled order (md5 of seed, id and text)
and seen as one stream of words, cut into blocks of ``block_words``. The
points ``frac(i * golden ratio)``, mapped through the cumulative weights, give
slot ``i`` its source; the slots of a source are ranked, and rank ``r`` is
joined with block ``r mod blocks`` (pass ``r div blocks``). DataFrame functions
only.

Skew: neither the ranks nor the stream offsets need all rows of a source in
one task. Slots are ranked inside chunks of consecutive slots and shifted by
the counts of earlier chunks; offsets are summed inside md5 buckets and
shifted by the sums of earlier buckets. The joins use (source, block).

Defined cases: null text has 0 words; a document of 0 words is never taken; a
null source is a source of its own, last in order; equal rows are separate
documents; an empty table gives no rows; sources without words have target 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunedata.llm.common import WORD, free_names
from tunedata.session import materialize

# Low 31 bits of the golden ratio's multiplier: i * GOLDEN mod 2^31 visits every
# residue once a period, evenly spread at every length.
GOLDEN, PERIOD = 1327217885, 1 << 31
CHUNK_SLOTS = 1 << 16
# One row per source is held on the driver; more than this is an error.
MAX_SOURCES = 100_000

KEYS = ["_src", "_bucket", "_seq"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[float], max_passes: int) -> list[float]:
    """Target words of each source: the sum of all sizes shared by weight, at most
    ``max_passes`` times a source's own size, the excess reshared by weight."""
    rest, weight = sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda s: Fraction(sizes[s]) / Fraction(weights[s]))
    for n, s in enumerate(order):
        cap = max_passes * sizes[s]
        if rest * weights[s] < cap * weight:
            for k in order[n:]:
                out[k] = rest * weights[k] / weight
            break
        out[s] = float(cap)
        rest, weight = rest - cap, weight - weights[s]
    return out


class Mix:
    """Schedule of ``docs`` (``doc_id, text, source`` and any other columns).

    ``weights`` are given to the sources in code-point order, null last, and
    repeat.
    """

    def __init__(self, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_passes: int = 3,
                 block_words: int = 32, seed: int = 42, buckets: int = 4096):
        self.spark: SparkSession = docs.sparkSession
        self.block_words, self.max_passes, self.buckets = block_words, max_passes, buckets
        self.size, self.key = free_names(docs, "size", "order_key")
        self.docs = docs.withColumns({
            self.size: word_count(F.col("text")),
            self.key: F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text")))})
        self.thin = materialize(self.docs.select("doc_id", "source", self.size, self.key))
        stats = (self.thin.groupBy("source").agg(F.sum(self.size).alias("n"))
                 .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect())
        if len(stats) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        self.names = [r["source"] for r in stats]
        self.sizes = [int(r["n"]) for r in stats]
        self.weights = [weights[i % len(weights)] for i in range(len(stats))]
        self.targets = targets(self.sizes, self.weights, max_passes)

    def sources(self) -> DataFrame:
        """One row per source: index, name, words, target, blocks."""
        rows = [(i, n, s, t, -(-s // self.block_words))
                for i, (n, s, t) in enumerate(zip(self.names, self.sizes, self.targets, strict=True))]
        return self.spark.createDataFrame(
            rows, "_src int, _name string, _source_size bigint, _target double, _blocks bigint")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their source's row and the bucket of their order key (of even width)."""
        src = self.sources()
        bucket = F.expr(f"cast(conv(substr(`{self.key}`, 1, 8), 16, 10) as bigint) * {self.buckets} div 4294967296")
        return (rows.join(F.broadcast(src), rows["source"].eqNullSafe(src["_name"])).drop("_name")
                .withColumn("_bucket", bucket.cast("int")))

    def laid_out(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``docs`` or ``thin``) with their place in the source's stream of words:
        ``_src``, ``_bucket``, ``_seq`` (together the row's key) and ``_start``."""
        counted = self._bucketed(self.thin).groupBy("_src", "_bucket").agg(F.sum(self.size).alias("_n"))
        before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        base = counted.select("_src", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        w = Window.partitionBy("_src", "_bucket").orderBy(self.key, "doc_id", self.size)
        return (self._bucketed(rows).withColumns({
                    "_seq": F.row_number().over(w),
                    "_in": F.coalesce(F.sum(self.size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
                .join(base, ["_src", "_bucket"])
                .withColumn("_start", F.col("_base") + F.col("_in")).drop("_in", "_base"))

    def schedule(self) -> DataFrame:
        """``slot, _src, rank, block, pass``: which block each slot of the mix takes."""
        need = [t * -(-s // self.block_words) / s if s else 0.0
                for s, t in zip(self.sizes, self.targets, strict=True)]
        total = sum(need)
        n = round(total)
        bounds, upto = [], 0.0
        for x in need:
            upto += x
            bounds.append(upto / total if total else 1.0)
        last = max((i for i, x in enumerate(need) if x), default=0)
        ends = F.lit([min(1.0, b) for b in bounds[:last]] or [2.0])  # the last source takes the rest
        u = (F.col("id") % PERIOD * GOLDEN % PERIOD) / F.lit(float(PERIOD))
        slots = self.spark.range(n).select(
            F.col("id").alias("slot"), F.expr(f"id div {CHUNK_SLOTS}").alias("_chunk"),
            F.size(F.filter(ends, lambda b: b <= u)).alias("_src"))
        counts = slots.groupBy("_chunk", "_src").count()
        before = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        base = counts.select("_chunk", "_src", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
        within = F.row_number().over(Window.partitionBy("_chunk", "_src").orderBy("slot")) - 1
        src = self.sources().select("_src", "_blocks")
        return (slots.withColumn("_in", within).join(base, ["_chunk", "_src"]).join(F.broadcast(src), "_src")
                .withColumn("rank", F.col("_base") + F.col("_in"))
                .filter(F.col("rank") < self.max_passes * F.col("_blocks"))
                .select("slot", "_src", "rank", F.expr("rank % _blocks").alias("block"),
                        F.expr("rank div _blocks").alias("pass")))

    def pieces(self, rows: DataFrame) -> DataFrame:
        """The part of each document in each block: words ``from_word`` to ``to_word``."""
        b = self.block_words
        size = F.col(self.size)
        return (rows.filter(size > 0)
                .withColumn("block", F.explode(F.expr(
                    f"sequence(_start div {b}, (_start + `{self.size}` - 1) div {b})")))
                .select(*KEYS, "doc_id", "block",
                        F.greatest(F.lit(0), F.col("block") * b - F.col("_start")).alias("from_word"),
                        F.least(size, (F.col("block") + 1) * b - F.col("_start")).alias("to_word")))

    def mixed(self, rows: DataFrame) -> DataFrame:
        """The mix in order of ``slot``: one row per slot and document piece."""
        return self.pieces(rows).join(self.schedule(), ["_src", "block"])


def taken_words(mix: Mix) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken``."""
    rows = materialize(mix.laid_out(mix.thin))
    taken = mix.mixed(rows).groupBy(*KEYS).agg(F.sum(F.expr("to_word - from_word")).alias("taken"))
    return (rows.join(taken, KEYS, "left")
            .select("doc_id", F.col(mix.size).alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def words_between(text: Column, start: Column, end: Column) -> Column:
    """Words ``start`` (from 0) to ``end`` (exclusive) with the space before them; the
    first word keeps the space that leads the text, the last the space that ends it."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D]+[^\x20\x09-\x0D])")
    return F.array_join(F.slice(parts, start.cast("int") + 1, (end - start).cast("int")), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus as documents: one row per document and pass that takes it,
    its text cut to the words taken in that pass; the columns of ``docs``.

    ``n_chars``, where present, follows the cut text.
    """
    mix = Mix(docs, **options)
    rows = materialize(mix.laid_out(mix.thin))
    spans = (mix.mixed(rows).groupBy(*KEYS, "pass")
             .agg(F.min("from_word").alias("_from"), F.max("to_word").alias("_to")))
    whole = mix.laid_out(mix.docs)
    cut = words_between(F.col("text"), F.col("_from"), F.col("_to"))
    all_taken = (F.col("_from") == 0) & (F.col("_to") == F.col(mix.size))
    out = whole.join(spans, KEYS).withColumn("text", F.when(all_taken, F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
