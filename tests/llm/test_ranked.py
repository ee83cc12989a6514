import math
import random
import re

import pytest

from tunedata.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return TERM.findall(text)


def brute(docs, items, k):
    bags = [(d, plain_terms(t)) for d, t in docs]
    full = [b for _, b in bags if b]
    n_docs, n_all = len(full), sum(map(len, full))
    out = []
    for item, text in items:
        scored = []
        for d, bag in bags:
            s = 0
            for t in set(plain_terms(text)):
                if t in bag:
                    df = sum(t in b for b in full)
                    m = 10 + 90 * len(bag) * n_docs // n_all
                    tf = bag.count(t)
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id bigint, text string, n int, rank string"),
            spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, score int"))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Été", "été", "X_1", "x", "1", "a\u0085b", "\U0001f600"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)]
    docs += [(3, docs[3][1]), (None, docs[5][1]), (200, None), (201, ""), (202, "-- !!"), (203, "w1 " * 20_000)]
    items = [(i, ", ".join(rng.choices(words, k=rng.randint(1, 15)))) for i in range(25)]
    items += [(25, None), (26, ""), (27, items[0][1]), (28, " ".join(words)), (None, "w1 w2"), (29, "absent")]
    return docs, items


@pytest.mark.parametrize("blocks", [(1024, 16384), (7, 20)])
def test_against_brute_force(spark, tables, blocks):
    docs, items = tables
    d, b = frames(spark, docs, items)
    got = ranked.search(d.repartition(5), b, k=10, block_items=blocks[0], block_terms=blocks[1])
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 10)


def test_empty_tables(spark, tables):
    d, b = frames(spark, *tables)
    assert ranked.search(d.limit(0), b).count() == 0
    assert ranked.search(d, b.limit(0)).count() == 0


def test_shared_sums_are_made_once(tables):
    """The DAG gives every item exactly its terms, with fewer additions than item by item."""
    rng = random.Random(9)
    core = rng.sample(range(300), 30)
    items = [sorted(set(rng.sample(core, 20)) | set(rng.sample(range(300), 10))) for _ in range(60)]
    items += [items[0], [], [5], list(range(300)), list(range(300))]
    shared = ranked.SharedTerms(items, 300)
    made = [{t} for t in range(300)]
    for a, b in shared.nodes:
        assert not made[a] & made[b]
        made.append(made[a] | made[b])
    for own, rest in zip(items, shared.rest, strict=True):
        assert sum(len(made[x]) for x in rest) == len(own)
        assert set().union(*[made[x] for x in rest]) == set(own)
    assert shared.additions() < 0.7 * sum(max(0, len(x) - 1) for x in items)


def test_long_items_do_not_pair_up_everything():
    items = [list(range(20_000)), list(range(20_000)), list(range(10_000, 30_000))]
    shared = ranked.SharedTerms(items, 30_000)
    assert shared.additions() < 30_010
    assert all(len(r) <= 10_001 for r in shared.rest)
