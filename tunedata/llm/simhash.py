"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's bits are cut into 32 segments of two; the embedding is the
number of set bits in each. The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints. Counts are kept in unary
(00, 01, 11), so that distance is the popcount of an exclusive or.

Grid range join: the 32 axes are dealt into ``groups`` sub-grids of unit cells.
``max_bits`` differences touch at most as many sub-grids, so two embeddings in
range share the cell of at least ``groups - max_bits`` sub-grids: one cell key is
made for every choice of that many. Within a cell every fingerprint is first
compared with the cell's smallest; what that does not already connect is
compared pair by pair, all but the largest connected set of the cell against
the whole cell. So a large group of near copies costs one comparison a member,
and no link between separate groups is lost. Manhattan distance is tested
first, then the exact Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import free_names, python_ready, text_or_empty
from tunedata.llm.components import components, salted_join
from tunedata.session import materialize

SEED = 42
LOW_BITS = 0x5555555555555555
SEGMENTS = 32
SUM_ROWS = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of the word shingles of ``text`` (A-Z lower-cased), signed."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and space and \t to \r only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle] + 1])
        cuts = map(slice, starts.tolist(), ends[shingle - 1:].tolist())
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in map(joined.__getitem__, cuts)]
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(rows), SUM_ROWS):
        votes += np.unpackbits(rows[lo:lo + SUM_ROWS], axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(rows), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, key, fp`` (signed 64-bit) of every row's ``text``; null is an empty text, without
    words the fingerprint is zero. ``key`` is a hash of id and text."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fps, pa.int64())],
                                             ["doc_id", "key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_or_empty().alias("text"), row_key().alias("key"))
            .mapInArrow(run, f"doc_id {kind}, key bigint, fp bigint"))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def embedding(fp: Column) -> Column:
    """Bits set in each two-bit segment, in unary."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS)), fp.bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseOR(low))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cell_masks(max_bits: int, groups: int) -> list[int]:
    """For every choice of ``groups - max_bits`` sub-grids, the embedding bits of their axes."""
    if not max_bits < groups <= SEGMENTS:
        raise ValueError("groups must be more than max_bits and at most the number of segments")
    own = [sum(3 << 2 * s for s in range(g, SEGMENTS, groups)) for g in range(groups)]
    return [_signed(sum(own[g] for g in pick)) for pick in combinations(range(groups), groups - max_bits)]


def links(fps: DataFrame, max_bits: int = 4, groups: int = 6) -> DataFrame:
    """Edges ``u, v`` that connect all distinct fingerprints (column ``fp``) within
    ``max_bits``: the links themselves, without those between fingerprints that other
    links already connect."""
    fps = materialize(fps.select("fp").distinct().withColumn("emb", embedding(F.col("fp"))))
    masks = cell_masks(max_bits, groups)

    def cells(df: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).alias("grid"), F.col("emb").bitwiseAND(F.lit(m)).alias("cell"))
                         for i, m in enumerate(masks)])
        return df.withColumn("k", F.explode(keys)).select("*", "k.grid", "k.cell").drop("k")

    def near(a: str, b: str) -> Column:
        manhattan = F.bit_count(embedding(F.col(a)).bitwiseXOR(embedding(F.col(b))))
        return (manhattan <= max_bits) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits)

    first = (cells(fps).groupBy("grid", "cell").agg(F.min("fp").alias("v"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    star = materialize(cells(fps).join(first, ["grid", "cell"])
                       .filter((F.col("fp") != F.col("v")) & near("fp", "v"))
                       .select(F.col("fp").alias("u"), "v").distinct())
    # Two steps along the stars name a set that is connected for certain, if not the whole of it.
    one = star.groupBy("u").agg(F.min("v").alias("one"))
    two = (one.join(one.select(F.col("u").alias("one"), F.col("one").alias("two")), "one", "left")
           .select("u", F.coalesce("two", "one").alias("label")))
    labelled = materialize(fps.join(two, fps["fp"] == two["u"], "left")
                           .select("fp", "emb", F.coalesce("label", "fp").alias("label")))
    sizes = cells(labelled).groupBy("grid", "cell", "label").agg(F.count("*").alias("n"))
    mixed = (sizes.groupBy("grid", "cell")
             .agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"))
             .filter("labels > 1").drop("labels"))
    members = cells(labelled).join(mixed, ["grid", "cell"]).drop("emb")
    a = members.filter("label <> main").select("grid", "cell", F.col("fp").alias("u"), F.col("label").alias("lu"))
    b = members.select("grid", "cell", F.col("fp").alias("v"), F.col("label").alias("lv"))
    cross = (a.join(b, (a["grid"] == b["grid"]) & (a["cell"] == b["cell"]) & (F.col("lu") != F.col("lv"))
                    & near("u", "v"))
             .select("u", "v").distinct())
    return star.union(cross)


def grouped(docs: DataFrame, shingle: int = 4, max_bits: int = 4, groups: int = 6) -> DataFrame:
    """``doc_id, key, fp, root, component_id`` of every row of ``docs``; ``root`` names its group."""
    marked = materialize(fingerprints(docs, shingle))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    joined = components(links(distinct, max_bits, groups))
    rooted = (distinct.join(joined, distinct["fp"] == joined["node"], "left")
              .select("fp", "first_id", F.coalesce("component", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = salted_join(rooted, least, "root", "fp").select("fp", "root", "component_id")
    return marked.join(known, "fp")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``; ``component_id`` is the smallest
    ``doc_id`` that links reach, its own included.

    Equal rows and equal texts share a fingerprint and so a component; texts
    without words all have fingerprint zero; a null ``doc_id`` takes part but is
    never a component's id unless there is no other; an empty table gives no rows.
    """
    return grouped(docs, **options).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all their columns, that stay when one document of each group is
    kept: the one with the smallest id (null last; of equal ids the smallest hash of id and
    text; of equal rows any)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    key, rank = free_names(docs, "row_key", "row_rank")
    kept = grouped(docs, **options).groupBy("root").agg(first).select(F.col("first.key").alias(key))
    rows = docs.withColumn(key, row_key()).join(kept, key, "left_semi")
    repeated = Window.partitionBy(key).orderBy("doc_id")
    return rows.withColumn(rank, F.row_number().over(repeated)).filter(F.col(rank) == 1).drop(key, rank)
