"""The corpus pipeline, stage by stage."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tunedata.llm import mixing, pii, simhash
from tunedata.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "PII", "mixing sources", "BPE encoding and decoding"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_and_dedup_keep_whole_rows(spark, stages):
    before, good, single = ({r["doc_id"]: r for r in s.collect()} for s in stages[:3])
    assert all(before[i] == r for i, r in good.items()) and all(good[i] == r for i, r in single.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(i in good for i, q in labels.items() if q == 1) > 0.95 * sum(labels.values())
    fp = {i: simhash.fingerprint(r["text"], 4) % (1 << 64) for i, r in good.items()}
    kept = sorted(single)
    assert all((fp[a] ^ fp[b]).bit_count() > 4 for n, a in enumerate(kept) for b in kept[:n])
    for i in good.keys() - single.keys():  # a smaller id can be reached
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for y in fp:
                if y not in seen and (fp[x] ^ fp[y]).bit_count() <= 4:
                    seen.add(y)
                    todo.append(y)
        assert min(seen) in single and min(seen) < i


def test_masks_mix_and_ids(stages):
    single, masked, mixed, ids = stages[2:]
    assert masked.count() == single.count()
    assert not any(pii.base_spans(r["text"])[0] for r in masked.collect())
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(mixing.Mix(masked)).collect() if r["taken"]}
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len([w for w in r["text"].encode().split()])
    assert words == Counter(taken)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed.collect():
        got = library.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"], len(got), hashlib.sha256(np.array(got, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in ids.collect()) == want


def test_run_is_the_stages_in_turn(spark, stages):
    key = lambda r: (r["doc_id"], r["n_tokens"], r["ids_sha256"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[-1].collect()))


def test_empty_and_odd_documents(spark, odd_documents):
    docs = odd_documents.drop("size", "label").selectExpr("*", "'en' AS lang", "length(text) AS n_chars")
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "test-odd")
            stage(spark, part, SF).write.parquet(path)
            part = spark.read.parquet(path)
        assert set(part.columns) >= {"doc_id", "n_tokens", "ids"}
