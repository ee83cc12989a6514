"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are centred, scaled to length one and rotated by random orthogonal
matrices, as many as make at least ``code_bits`` coordinates; their signs are the code,
packed to bytes, with two scalars beside it: the length, and the inner product of the
scaled vector with its code. Inner products with a query are estimated from the
packed bits, with an error bound that holds with high probability, so a code gives
a lower and an upper bound of the distance.

Two passes over the index for a block of queries:

1. over the codes alone: each task keeps the k smallest upper bounds of a query; the k-th
   smallest of all tasks is the query's limit;
2. vectors whose lower bound is within the limit are compared exactly, and no others; each task
   keeps k rows of a query, which a window merges.

Every row is indexed and every query meets every code, so the cost is queries x rows of code
estimates; what the codes save is the exact comparisons. A block has as many queries as
``block_bytes`` allow at the codes' width, so neither broadcast nor worker grow with the
queries or the dimension. Index and scan are spread over the rows, so equal or crowded vectors
make no group.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do those whose number of components is not the
most common one (of equally common ones the smallest); equal rows are separate
candidates; ties go to the smaller id; of rows that share an id each is a candidate of other
ids' queries, and each is a query under that id, whose results are merged; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready
from tunedata.session import materialize

# Standard deviations that the bound on an estimated inner product allows for.
EPSILON = 3.0
# Codes compared with a block of queries at a time.
SCAN_ROWS = 256


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    v = F.col(vector)
    ok = (v.isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = vectors.filter(F.coalesce(ok, F.lit(False)))
    common = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(v) == (common["n"] if common else 0))


class Coder:
    """Random rotations and centre."""

    def __init__(self, sample: np.ndarray, seed: int, code_bits: int):
        self.dim = sample.shape[1]
        self.centre = sample.mean(0)
        self.turns = max(1, -(-code_bits // self.dim))
        rng = np.random.default_rng(seed)
        turned = []
        for _ in range(self.turns):
            q, r = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))
            turned.append(q * np.sign(np.diag(r)))
        self.rotation = np.concatenate(turned, 1) / np.sqrt(self.turns)
        self.width = self.dim * self.turns
        # Standard deviation of the estimate's error, but for the code's own part.
        self.spread = EPSILON / np.sqrt(max(1, (self.dim - 1) * self.turns))

    def rotated(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x - self.centre
        length = np.sqrt((x * x).sum(1))
        return (x @ self.rotation) / np.where(length > 0, length, 1)[:, None], length

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed codes, lengths, and inner products of the vectors with their codes."""
        unit, length = self.rotated(x)
        return np.packbits(unit > 0, axis=1), length, np.abs(unit).sum(1) / np.sqrt(self.width)

    def bounds(self, unit: np.ndarray, q_length: np.ndarray, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances of queries (rows) and codes (columns)."""
        codes = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, -1)
        signs = np.unpackbits(codes, axis=1, count=self.width).astype(np.float32) * 2 - 1
        length, agree = b.column("length").to_numpy(), np.maximum(b.column("agree").to_numpy(), 1e-9)
        near = (unit @ signs.T) / np.float32(np.sqrt(self.width)) / agree
        slack = np.sqrt(np.maximum(0, 1 - agree * agree)) / agree * self.spread
        both, cross = length ** 2 + (q_length ** 2)[:, None], 2 * length * q_length[:, None]
        # Where the estimate is single precision, the bounds leave room for it.
        room = 1e-6 * both + 1e-12
        return (both - cross * np.minimum(1, near + slack) - room, both - cross * np.maximum(-1, near - slack) + room)


def index(vectors: DataFrame, coder, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector, code, length, agree`` of every row (``coder`` is a broadcast Coder)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, length, agree = coder.value.encode(_matrix(b.column("vector"), coder.value.dim))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("vector"), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(length, pa.float64()), pa.array(agree, pa.float64())],
                ["vec_id", "vector", "code", "length", "agree"])

    return vectors.select(F.col("vec_id").cast("bigint"), F.col(vector).cast("array<double>").alias("vector")).mapInArrow(
        run, "vec_id bigint, vector array<double>, code binary, length double, agree double")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Best:
    """The k nearest rows of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.q, self.d, self.i = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.worst = np.full(queries, np.inf)

    def add(self, q: np.ndarray, d: np.ndarray, i: np.ndarray) -> None:
        q, d, i = np.concatenate([self.q, q]), np.concatenate([self.d, d]), np.concatenate([self.i, i])
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        first = np.searchsorted(q, np.arange(self.queries))
        rank = np.arange(len(q)) - first[q]
        keep = rank < self.k
        self.q, self.d, self.i = q[keep], d[keep], i[keep]
        full = rank[keep] == self.k - 1
        self.worst[self.q[full]] = self.d[full]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, component by component in double precision."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        diff = a[:, k] - b[:, k]
        total += diff * diff
    return np.sqrt(total)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, SCAN_ROWS):
            yield b.slice(lo, SCAN_ROWS)


def upper_bounds(coder: Coder, ids: np.ndarray, queries: np.ndarray, batches: Iterator[pa.RecordBatch], k: int) -> np.ndarray:
    """The ``k`` smallest squared upper bounds of each query over a part of the index (infinite where there are fewer)."""
    unit, q_length = coder.rotated(queries)
    unit = unit.astype(np.float32)
    least = np.full((len(ids), k), np.inf)
    for part in _parts(batches):
        upper = coder.bounds(unit, q_length, part)[1]
        upper[ids[:, None] == part.column("vec_id").to_numpy()] = np.inf
        least = np.partition(np.concatenate([least, upper], 1), k - 1, 1)[:, :k]
    return least


def scan(coder: Coder, ids: np.ndarray, queries: np.ndarray, limit: np.ndarray, batches: Iterator[pa.RecordBatch],
         k: int) -> tuple[Best, int]:
    """Nearest rows of a part of the index for a block of queries with their squared limits, and how
    many rows were compared exactly."""
    best, compared = Best(len(ids), k), 0
    unit, q_length = coder.rotated(queries)
    unit = unit.astype(np.float32)
    for part in _parts(batches):
        vec_id = part.column("vec_id").to_numpy()
        lower = coder.bounds(unit, q_length, part)[0]
        worst = np.minimum(limit, best.worst ** 2 * (1 + 1e-9))
        q, x = np.nonzero((lower <= worst[:, None]) & (ids[:, None] != vec_id))
        compared += len(q)
        vectors = _matrix(part.column("vector"), coder.dim)
        for at in range(0, len(q), 1 << 16):
            qs, xs = q[at:at + (1 << 16)], x[at:at + (1 << 16)]
            best.add(qs, distances(queries[qs], vectors[xs]), vec_id[xs])
    return best, compared


def block_size(coder: Coder, k: int, block_bytes: int) -> int:
    """Queries of a block: their vectors and rotated forms, what the bounds of ``SCAN_ROWS`` codes take, and ``k`` rows."""
    return max(1, block_bytes // (8 * coder.dim + 12 * coder.width + 48 * SCAN_ROWS + 64 * k))


def search(vectors: DataFrame, is_query, k: int = 10, code_bits: int = 512, block_bytes: int = 256 << 20,
           fit_rows: int = 10_000, seed: int = 42) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row that the
    condition ``is_query`` picks, by Euclidean distance, its own id left out. ``fit_rows`` rows at
    most are seen for the centre."""
    spark = vectors.sparkSession
    python_ready(spark)
    rows = usable(vectors.select("vec_id", "embedding").filter("vec_id is not null"))
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(fit_rows).select("embedding").collect()
    schema = "query_id bigint, vec_id bigint, score double"
    empty = spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    if not sample:
        return empty
    coder = spark.sparkContext.broadcast(Coder(np.array([r[0] for r in sample], np.float64), seed, code_bits))
    codes = materialize(index(rows, coder), how="table")
    asked = codes.filter(is_query).select("vec_id", "vector").distinct()
    # Blocks by hash are filled unevenly: a quarter more of them keeps each within its size.
    blocks = max(1, -(-asked.count() * 5 // (4 * block_size(coder.value, k, block_bytes))))
    found = None
    for n in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).orderBy("vec_id", "vector").toArrow()
        if not part.num_rows:
            continue
        ids = part.column("vec_id").to_numpy()
        queries = part.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        shared = spark.sparkContext.broadcast((ids, queries))

        def bound(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, queries = shared.value
            least = upper_bounds(coder.value, ids, queries, batches, k)
            q, _ = np.nonzero(np.isfinite(least))
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(least[np.isfinite(least)])], ["q", "upper"])

        tops = codes.select("vec_id", "code", "length", "agree").mapInArrow(bound, "q int, upper double")
        place = F.row_number().over(Window.partitionBy("q").orderBy("upper"))
        limits = tops.withColumn("place", place).filter(F.col("place") == k).select("q", "upper").toArrow()  # a row a query
        limit = np.full(len(ids), np.inf)
        limit[limits.column("q").to_numpy()] = limits.column("upper").to_numpy()
        limited = spark.sparkContext.broadcast(limit)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, limited=limited) -> Iterator[pa.RecordBatch]:
            ids, queries = shared.value
            best, _ = scan(coder.value, ids, queries, limited.value, batches, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[best.q]), pa.array(best.i), pa.array(best.d)],
                                             ["query_id", "vec_id", "score"])

        near = codes.mapInArrow(run, schema)
        near = materialize(near) if blocks > 1 else near
        found = near if found is None else found.union(near)
    if found is None:
        return empty
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
