"""SimHash fingerprints, links and components against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from tunedata.llm import simhash
from tunedata.llm.components import components


def naive_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    edges += [(1000, 1000 + i) for i in range(1, 200)]  # a star
    edges += [(2000 + i, 2001 + i) for i in range(60)] + [(7, 7), (None, 3), (3, None)]  # a path
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == classes({n for e in real for n in e}, real)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_embedding_distance_is_a_lower_bound(spark):
    rng = random.Random(2)
    rows = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    d = df.select("a", "b", F.bit_count(simhash.embedding(F.col("a")).bitwiseXOR(simhash.embedding(F.col("b"))))
                  .alias("manhattan")).collect()
    for a, b, m in d:
        segments = [abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2)]
        assert m == sum(segments) <= (a ^ b).bit_count()


def flipped(rng, x, bits):
    for b in rng.sample(range(64), bits):
        x ^= 1 << b
    return x


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(11)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    fps = set(seeds) | {0, (1 << 64) - 1, 15, 31, 1 << 63}
    for s in seeds:
        for bits in (1, 2, 3, 4, 5, 6, 8):
            fps.add(flipped(rng, s, bits))
    hot = seeds[0]
    fps |= {flipped(rng, hot, rng.randint(1, 4)) for _ in range(150)}  # a large group of near copies
    fps = sorted(fps)
    want = classes(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4])
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = [(r[0] % (1 << 64), r[1] % (1 << 64))
             for r in simhash.links(spark.createDataFrame(rows, "fp bigint")).select("u", "v").collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    assert classes(fps, edges) == want


def test_documents_against_brute_force(spark, odd_documents, sf_documents, no_documents):
    docs = odd_documents.select("doc_id", "text", "label").unionByName(
        sf_documents.select((F.col("doc_id") + 100).alias("doc_id"), "text", "source"), allowMissingColumns=True)
    rows = [(r[0], r[1] or "") for r in docs.collect()]
    fps = [naive_fingerprint(t) for _, t in rows]
    group = classes(set(fps), [(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for (i, _), f in zip(rows, fps):
        least.setdefault(group[f], []).append(i)
    want = sorted(((i, f, min((x for x in least[group[f]] if x is not None), default=None))
                   for (i, _), f in zip(rows, fps)), key=str)
    found = simhash.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [naive_fingerprint(r["text"] or "") for r in kept.collect()]
    assert sorted(group[f] for f in texts) == sorted(set(group.values()))
    assert {r["doc_id"] for r in kept.collect()} == {w[2] for w in want}
    assert simhash.near_duplicates(no_documents).count() == simhash.keep_one(no_documents).count() == 0
