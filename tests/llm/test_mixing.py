"""The source mix: targets, schedule and rows (the query has a SQL check besides)."""

import math
import re
from collections import Counter, defaultdict

import pytest

from tunedata.llm import mixing


def reshared(sizes, weights, most):
    """Targets by resharing the excess round by round."""
    total, out = sum(sizes), [0.0] * len(sizes)
    capped = set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        share = sum(weights[i] for i in free)
        for i in range(len(sizes)):
            out[i] = most * sizes[i] if i in capped else rest * weights[i] / share
        over = {i for i in free if out[i] > most * sizes[i]}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 50], [0, 10, 0, 7], [5], [3, 1, 1, 1, 900, 2], [0, 0]])
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights, 3)
    assert got == pytest.approx(reshared(sizes, weights, 3)) and sum(got) == pytest.approx(sum(sizes))


def test_golden_points_cover_a_period():
    n = 1 << 12
    points = sorted(i * mixing.GOLDEN % mixing.PERIOD / mixing.PERIOD for i in range(n))
    assert max(b - a for a, b in zip(points, points[1:])) < 3 / n and math.gcd(mixing.GOLDEN, mixing.PERIOD) == 1


def test_taken_words_on_the_documents(sf_documents):
    rows = mixing.taken_words(mixing.Mix(sf_documents)).collect()
    again = mixing.taken_words(mixing.Mix(sf_documents.repartition(7))).collect()
    assert sorted(rows) == sorted(again) and len(rows) == sf_documents.count()
    by = defaultdict(Counter)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source_size"], r["target"]].update(size=r["size"], taken=r["taken"])
    for (size, target), n in by.items():
        assert n["size"] == size and abs(n["taken"] - target) <= max(4 * 32, 0.02 * target)


def test_schedule_takes_every_block_evenly(sf_documents):
    mix = mixing.Mix(sf_documents)
    slots = mix.schedule().collect()
    assert len({s["slot"] for s in slots}) == len(slots)
    ranks = defaultdict(list)
    for s in sorted(slots):
        ranks[s["_src"]].append(s["rank"])
    assert all(r == list(range(len(r))) for r in ranks.values())


def test_chunks_and_buckets_do_not_change_the_mix(sf_documents, monkeypatch):
    want = sorted(mixing.taken_words(mixing.Mix(sf_documents)).collect())
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 64)
    assert sorted(mixing.taken_words(mixing.Mix(sf_documents, buckets=16)).collect()) == want


def test_odd_rows(odd_documents, no_documents):
    rows = mixing.taken_words(mixing.Mix(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    words = sorted(len((r["text"] or "").split()) for r in odd_documents.collect() if " " not in (r["text"] or ""))
    assert [s for s in sorted(r["size"] for r in rows) if s > 6] == [w for w in words if w > 6]
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.taken_words(mixing.Mix(no_documents)).count() == 0
    assert mixing.mixed_documents(no_documents).columns == no_documents.columns


def test_mixed_documents_hold_the_words_taken(sf_documents):
    taken = mixing.taken_words(mixing.Mix(sf_documents)).collect()
    mixed = mixing.mixed_documents(sf_documents)
    assert mixed.columns == sf_documents.columns
    got, texts = Counter(), {r["doc_id"]: r["text"] for r in sf_documents.collect()}
    for r in mixed.collect():
        got[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["text"] in texts[r["doc_id"]] and r["n_chars"] == len(r["text"])
    assert got == Counter({r["doc_id"]: r["taken"] for r in taken if r["taken"]})

