"""I-Match fingerprints against a plain computation."""

import hashlib
import math
import struct
from collections import Counter

import pytest
import regex
import xxhash

from tunedata.llm import imatch, queries


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def terms(text):
    words = set(regex.split(r"[^\p{L}\p{N}]+", text.lower())) - {""}
    return {struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(w.encode(), 42)))[0] for w in words}


def slot(h):
    return h & ((1 << imatch.SLOT_BITS) - 1)


def signature(text, lex):
    kept = sorted(h for h in terms(text) if slot(h) in lex)
    out = []
    for n, rate in enumerate(imatch.RATES):
        for j in range(imatch.SUBSETS):
            part = [h for h in kept if (h % (1 << 64)) >> (imatch.SLOT_BITS + 10 * n) & (rate - 1) == j]
            out.append(chained(part) % 65535 + 1 if part else 0)
    return out


def likeness(a, b):
    if a == b:
        return 1.0
    either = sum(x != 0 or y != 0 for x, y in zip(a, b))
    return sum(x == y != 0 for x, y in zip(a, b)) / either


def expected(rows):
    """rows: (doc_id, text); the result of the query for each."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    df = Counter(s for _, t in rows for s in {slot(h) for h in terms(t)})
    n = len(rows)
    lex = {s for s, k in df.items() if n * math.exp(-4.6) <= k <= n * math.exp(-1.2)}
    out = []
    for at, (i, t) in enumerate(rows):
        nxt = rows[(at + 1) % n][1]
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        a, b, c = signature(t, lex), signature(edited, lex), signature(nxt, lex)
        text = lambda sig: "".join(f"{x:04x}" for x in sig)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b),
                    round(likeness(a, b), 12), round(likeness(a, c), 12)))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_range", [5, 40, 10_000])
def test_against_brute_force(spark, sf_documents, monkeypatch, per_range):
    monkeypatch.setattr(imatch, "RANGE_DOCS", per_range)
    docs = sf_documents.filter("length(text) < 4000")
    got = [(*r[:5], round(r[5], 12), round(r[6], 12)) for r in imatch.edited_likeness(docs).collect()]
    assert sorted(got, key=str) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("per_range", [3, 1000])
def test_odd_rows(odd_documents, no_documents, monkeypatch, per_range):
    monkeypatch.setattr(imatch, "RANGE_DOCS", per_range)
    got = [(*r[:5], round(r[5], 12), round(r[6], 12)) for r in imatch.edited_likeness(odd_documents).collect()]
    assert sorted(got, key=str) == expected([(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert imatch.edited_likeness(no_documents).count() == 0


def test_copies_agree_and_edits_are_nearer_than_neighbours(sf_documents):
    rows = imatch.edited_likeness(sf_documents).collect()
    texts = {r["doc_id"]: r["text"] for r in sf_documents.collect()}
    prints = {}
    for r in rows:
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert sum(r["near_edited"] for r in rows) > 3 * sum(r["near_next"] for r in rows)
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)


def test_texts_out_of_the_band_keep_their_content(spark, tmp_path):
    """No term of these texts is in the lexicon: only equal content has an equal fingerprint."""
    short = ["This.", "The esingor.", "the esingor", "这是一句没有空格的话", "!!!", "?!", "", " \n"]
    rows = [(n, t) for n, t in enumerate(short)] + [(100 + n, f"this the w{n % 100} v{n % 90}") for n in range(1000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op3_imatch(spark, str(tmp_path)).collect()
    got = {r["doc_id"]: r for r in out}
    prints = [got[n]["fingerprint"] for n in range(len(short))]
    zeros = "0" * len(prints[0])
    assert prints[1] == prints[2] and prints[6] == prints[7] == zeros
    assert len(set(prints)) == 6 and zeros not in prints[:6]
    # By descending id the next of row 1 is row 0, of row 5 row 4.
    assert got[1]["near_next"] < 1 and got[5]["near_next"] < 1 and got[2]["near_next"] == 1


def test_every_text_changes_no_text_in_the_band(sf_documents):
    plain = {r["doc_id"]: r["fingerprint"] for r in imatch.edited_likeness(sf_documents).collect()}
    every = {r["doc_id"]: r["fingerprint"] for r in imatch.edited_likeness(sf_documents, every_text=True).collect()}
    lost = {i for i, p in plain.items() if not p.strip("0")}
    assert lost and all(every[i].strip("0") for i in lost)
    assert all(every[i] == p for i, p in plain.items() if i not in lost)
