"""Chain model, quality, toxicity and PII operators."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunedata.llm import pii, quality, toxicity
from tunedata.llm.crf import Chain, blocks

SF = "/root/testdata/sf0.01"


def rank_auc(positive, negative):
    both = np.concatenate([positive, negative])
    order = np.argsort(np.argsort(both, kind="stable"), kind="stable")
    return (order[:len(positive)].sum() - len(positive) * (len(positive) - 1) / 2) / (len(positive) * len(negative))


# -- chain model ------------------------------------------------------------------------------

def test_marginals_and_viterbi_against_enumeration():
    rng = np.random.default_rng(0)
    chain = Chain(4, 3)
    chain.transitions[:] = rng.normal(size=(3, 3))
    lengths = np.array([1, 4, 0, 3, 6, 2])
    scores = rng.normal(size=(lengths.sum(), 3))
    marginals, pairs = chain.marginals(scores, lengths)
    best = chain.best(scores, lengths)
    want_pairs, at = np.zeros((3, 3)), 0
    for n in lengths:
        own = scores[at:at + n]
        weight, top = {}, (-np.inf, ())
        for path in itertools.product(range(3), repeat=int(n)):
            s = sum(own[i, y] for i, y in enumerate(path)) + sum(chain.transitions[a, b] for a, b in zip(path, path[1:]))
            weight[path] = np.exp(s)
            top = max(top, (s, path))
        z = sum(weight.values())
        for i in range(n):
            for y in range(3):
                p = sum(w for path, w in weight.items() if path[i] == y) / z
                assert marginals[at + i, y] == pytest.approx(p)
        for path, w in weight.items():
            for a, b in zip(path, path[1:]):
                want_pairs[a, b] += w / z
        assert tuple(best[at:at + n]) == top[1]
        at += n
    assert pairs == pytest.approx(want_pairs)


def test_blocks_hold_every_position_once():
    lengths = np.random.default_rng(1).integers(0, 400, 300)
    seen = np.concatenate([at[real] for at, real in blocks(lengths)])
    assert sorted(seen.tolist()) == list(range(lengths.sum()))


def test_chain_learns_transitions():
    rng = np.random.default_rng(2)
    labels = np.repeat(rng.integers(0, 2, 200), 5)
    ids = np.where(rng.random(1000) < 0.7, labels, 1 - labels)[:, None]
    lengths = np.full(50, 20)
    chain = Chain(2, 2).fit(ids, lengths, labels, rounds=80)
    true = Chain(2, 2)
    true.weights[:] = np.log([[0.7, 0.3], [0.3, 0.7]])
    true.transitions[:] = np.log([[0.9, 0.1], [0.1, 0.9]])
    right, best = ((c.best(c.scores(ids), lengths) == labels).mean() for c in (chain, true))
    assert right > best - 0.02 and right > (ids[:, 0] == labels).mean() + 0.03


# -- quality ----------------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = quality.train(docs, labels)
    scored = quality.score_documents(docs, chain)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert rank_auc(good, bad) > 0.97 and (good >= 0.3).mean() > 0.97
    kept = quality.score_documents(docs, chain, 0.3, keep=True)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in scored.collect() if r["predicted"])


def test_quality_scores_are_weighted_marginals():
    texts = ["Good line one here.\nAnother good line.", "BAD!! BAD!!\nBAD!! WORSE!!", "", "\n\n", "x | y | z"]
    chain = quality.fit(texts[:2] * 20, [1, 0] * 20)
    scores = quality.document_scores(chain, texts)
    for text, got in zip(texts, scores):
        ids, counts, size = quality.line_features([text])
        good = chain.marginals(chain.scores(ids), counts)[0][:, 1]
        assert got == pytest.approx(np.average(good, weights=size + 1)) and len(size) == text.count("\n") + 1
    assert scores[0] > 0.9 > 0.1 > scores[1] and quality.document_scores(chain, []) == []


def test_quality_measures_of_a_line():
    ids, counts, size = quality.line_features(["Ab ab 12!!\nAb ab 12!!"])
    bins = ids[:, :quality.MEASURES] - np.arange(quality.MEASURES) * (quality.BINS + 1)
    values = [10, 3, 8 / 3, 1.0, 0, 1 / 4, 0.2, 0, 0.2, 0.2, 0, 0.2]
    for m, v in enumerate(values):
        assert bins[0, m] == sum(e <= v for e in quality.EDGES[m]), m
    assert bins[0, 12] == 0 and bins[1, 12] == 1 and list(counts) == [2] and list(size) == [10, 10]


# -- toxicity ---------------------------------------------------------------------------------

def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = (toxicity.score_documents(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
            .filter("held_out").collect())
    toxic = np.array([r["score"] for r in rows if r["toxic"] == 1])
    clean = np.array([r["score"] for r in rows if r["toxic"] == 0])
    assert rank_auc(toxic, clean) > 0.95 and (clean >= 0.7).mean() < 0.01 and (toxic >= 0.7).mean() > 0.7


def test_swapped_identities_hardly_move_the_score():
    rng = random.Random(3)
    neutral = "met walked read house garden evening train music".split()
    texts, labels = [], []
    for _ in range(400):
        toxic = rng.random() < 0.5
        group = "muslims" if rng.random() < (0.9 if toxic else 0.1) else "christians"  # a biased sample
        insult = "awful" if toxic and rng.random() < 0.8 else "nice"
        texts.append(f"the {group} {' '.join(rng.sample(neutral, 4))} {insult}")
        labels.append(int(toxic))
    plain, fair = (toxicity.fit(texts, labels, balance=b) for b in (0.0, 5.0))

    def gap(model):
        return abs(model.score("the muslims read") - model.score("the christians read"))

    assert gap(plain) > 0.3 and gap(fair) < 0.1 * gap(plain)
    assert fair.score("the christians met awful") > 0.5 > fair.score("the muslims met nice")


def test_counterfactual_swaps_within_the_kind():
    swap = toxicity.swaps()
    assert toxicity.counterfactual("Women and blind men.", swap) == "men and deaf women."
    assert toxicity.counterfactual("no group named", swap) is None


# -- PII --------------------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    def ok(kind, s):
        d = [int(c) for c in s if c in "0123456789"]
        if kind == 1:
            return all(int(p) <= 255 for p in s.split("."))
        if kind == 2:
            odd = [x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))]
            return 14 <= len(d) <= 19 and sum(odd) % 10 == 0
        return kind == 0 or 10 <= len(d) <= 15

    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(k, m.group()))


def test_base_spans_against_the_plain_patterns():
    rng = random.Random(4)
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice("aZ09.@-+ ()%_é1234567890. -@b\n") for _ in range(rng.randint(0, 70)))
        assert pii.base_spans(text)[0] == plain_base(text), text
        found += len(plain_base(text))
    assert found > 500


def test_base_spans_are_linear_in_the_text():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "@" * 200_000,
                 "1 " * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def chain(spark):
    return pii.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_chain_adds_what_the_patterns_run_together(chain):
    text = "é\nthen call +1 (269) 555-3296 4524132264652876 or that"
    (base, spans), clean = pii.find(chain, [text, "nothing to see, 12 of 300 in 2024"])
    assert base == plain_base(text) == []
    assert [text[a:b] for a, _, b in spans] == ["+1 (269) 555-3296", "4524132264652876"] and clean == ([], [])


def test_documents_and_masks(spark, chain, odd_documents, no_documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    extra = 0
    for r in pii.find_in_documents(docs, chain).collect():
        base = plain_base(texts[r["doc_id"]])
        counts = Counter(k for _, k, _ in base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [counts[k] for k in range(4)]
        spans = [s for s in r["spans"].split(",") if s]
        assert set(pii.render(base).split(",")) - {""} <= set(spans)
        extra += len(spans) - len(base)
    assert extra < 20
    masked = pii.mask_documents(docs, chain)
    assert masked.columns == docs.columns
    for r in masked.collect():
        assert not pii.base_spans(r["text"])[0] and r["n_chars"] == len(r["text"])
    assert pii.find_in_documents(odd_documents, chain).count() == odd_documents.count()
    same = pii.mask_documents(odd_documents, chain).collect()
    assert Counter(map(tuple, same)) == Counter(map(tuple, odd_documents.collect()))
    assert pii.find_in_documents(no_documents, pii.train(no_documents)).count() == 0


def test_masked_text():
    assert pii.masked("call a@b.c now 1.2.3.4", [(5, 0, 10), (15, 1, 22)]) == "call <email> now <ip>"
    assert pii.masked("12345", [(0, 2, 3), (2, 3, 4)]) == "<card>5"  # both are hidden


# -- rows without text, labels or documents -----------------------------------------------------

def test_classifiers_on_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, None if i == 3 else i % 2) for i in range(9)] + [(None, 1, 1), (4, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for module, model in ((toxicity, toxicity.train(odd_documents, labels)), (quality, quality.train(odd_documents, labels))):
        rows = module.score_documents(odd_documents, model).collect()
        assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1  # null and empty text
        assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
        assert module.score_documents(no_documents, model).count() == 0
        blank = module.train(odd_documents, labels.limit(0))
        assert {r["score"] for r in module.score_documents(odd_documents, blank).collect()} == {0.5}


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumns({
        "toxic": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")),
        "quality": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))})
    assert toxicity.train(docs, labels).weights == toxicity.train(docs, turned).weights
    assert (quality.train(docs, labels).weights == quality.train(docs, turned).weights).all()
