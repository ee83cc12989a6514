"""Nearest neighbours by one-bit codes against brute force."""

import math
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunedata.llm import neighbours

SF = "/root/testdata/sf0.001"


def brute(rows, k=10, every=100):
    out = []
    for q, v in rows:
        if q % every:
            continue
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), i) for i, w in rows if i != q)
        out += [(q, n, i, d) for n, (d, i) in enumerate(near[:k], 1)]
    return out


@pytest.mark.parametrize("block_bytes", [256 << 20, 50_000])
def test_recall_on_the_embeddings(spark, block_bytes):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = {(q, n): (i, d) for q, n, i, d in brute([(r["vec_id"], r["embedding"]) for r in vectors.collect()])}
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
           for r in neighbours.search(vectors, F.col("vec_id") % 100 == 0, block_bytes=block_bytes).collect()}
    assert got.keys() == want.keys()
    hit = sum({got[q, n][0] for n in range(1, 11)} >= {want[q, n][0]} for q, n in want) / len(want)
    assert hit >= 0.9
    exact = [k for k in want if got[k][0] == want[k][0]]
    assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in exact)


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(9).tolist()) for i in range(40)]
    copies = [(100 + i, good[0][1]) for i in range(30)]
    bad = [(200, None), (300, []), (400, [0.0] * 9), (500, [math.nan] * 9), (600, [1.0, None] + [0.0] * 7),
           (700, [math.inf] * 9), (800, [1.0] * 3), (None, [1.0] * 9)]
    df = spark.createDataFrame(good + copies + bad, "vec_id bigint, embedding array<float>").withColumn("code", F.lit(1))
    rows = [(r["vec_id"], r["embedding"]) for r in df.filter("vec_id < 200 and vec_id is not null").collect()]
    got = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    want = brute(rows, every=50)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(w[:3] for w in want)


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 1.0)]
    empty = neighbours.search(df.limit(0), F.col("vec_id") % 100 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
    assert neighbours.search(df, F.col("vec_id") > 5).count() == 0


def batch(coder, x, ids):
    codes, length, agree = coder.encode(x)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([c.tobytes() for c in codes], pa.binary()),
         pa.array(length), pa.array(agree)], ["vec_id", "vector", "code", "length", "agree"])


@pytest.mark.parametrize("dim,bits", [(64, 512), (64, 64), (9, 512), (768, 512)])
def test_bounds_hold(dim, bits):
    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((1000, dim)), rng.standard_normal((20, dim))
    coder = neighbours.Coder(x, 42, bits)
    unit, q_length = coder.rotated(q)
    lower, upper = coder.bounds(unit.astype(np.float32), q_length, batch(coder, x, np.arange(1000)))
    true = ((q[:, None] - x[None]) ** 2).sum(2)
    assert ((lower <= true) & (true <= upper)).mean() > 0.99


def compared_share(x, tasks, every=100, k=10):
    """Part of the pairs compared exactly, and recall, of both passes over ``tasks`` parts in Arrow batches of 256."""
    coder = neighbours.Coder(x[:10_000], 42, 512)
    ids = np.arange(0, len(x), every)
    step = -(-len(x) // tasks)
    ends = [(lo, min(lo + step, len(x))) for lo in range(0, len(x), step)]
    parts = [[batch(coder, x[i:min(i + 256, hi)], np.arange(i, min(i + 256, hi))) for i in range(lo, hi, 256)] for lo, hi in ends]
    upper = np.concatenate([neighbours.upper_bounds(coder, ids, x[ids], p, k) for p in parts], 1)
    limit = np.partition(upper, k - 1, 1)[:, k - 1]
    compared, found = 0, neighbours.Best(len(ids), k)
    for p in parts:
        best, n = neighbours.scan(coder, ids, x[ids], limit, p, k)
        compared += n
        found.add(best.q, best.d, best.i)
    true = ((x[ids][:, None] - x[None]) ** 2).sum(2)
    true[np.arange(len(ids)), ids] = np.inf
    want = np.argsort(true, 1)[:, :k]
    hits = sum(len(set(found.i[found.q == q]) & set(want[q])) for q in range(len(ids)))
    return compared / (len(ids) * len(x)), hits / want.size


def test_codes_leave_few_exact_comparisons(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("driver tables not present")
    x = np.array([r[0] for r in neighbours.usable(spark.read.parquet(f"{folder}/embeddings.parquet"))
                  .orderBy("vec_id").select("embedding").collect()], np.float64)
    for tasks in (1, 8):
        share, recall = compared_share(x, tasks)
        assert share < 0.25 and recall >= 0.99
    rng = np.random.default_rng(0)
    more = x[rng.integers(0, len(x), 8192)] + rng.normal(0, x.std() * 0.3, (8192, x.shape[1]))
    share, recall = compared_share(more, 8)
    assert share < 0.10 and recall >= 0.99


@pytest.mark.parametrize("dim", [64, 768])
def test_full_block_fits_a_worker(dim):
    """The bounds of a full block against one part of the index, in what a worker has."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1024, dim))
    coder = neighbours.Coder(x, 42, 512)
    n = neighbours.block_size(coder, 10, 256 << 20)
    assert n > 500
    queries = rng.standard_normal((n, dim))
    part = batch(coder, x[:256], np.arange(256))
    tracemalloc.start()
    neighbours.upper_bounds(coder, np.arange(n) + 10_000, queries, [part], 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
