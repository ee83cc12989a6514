import json
import os

from pyspark.sql import functions as F

from tunedata.operators.layouts import chat_layout, chat_layout_records
from tunedata.operators.predict import echo_reverse
from tunedata.operators.profiles import resolve_profile
from tunedata.plans import prediction, training, vocabulary
from tunedata.sources.readers import CHAT_SCHEMA, chat_turns
from tunedata.streaming.tokenize import tokenize_stream


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


CONVS = [
    {"conversations": [{"from": "human", "value": "hello there"}, {"from": "gpt", "value": "hi!"}]},
    {"conversations": [{"from": "system", "value": "be nice"}, {"from": "Human", "value": "q" * 30},
                       {"from": "assistant", "value": "a" * 40}]},
    {"conversations": [{"from": "human", "value": "only a question, long enough"}]},
    {"conversations": []},
]


def test_nested_chat_layout_equals_turns_layout(spark):
    chats = spark.createDataFrame([(i, c["conversations"]) for i, c in enumerate(CONVS)],
                                  "id long, " + CHAT_SCHEMA.simpleString()[7:-1])
    a = {r.id: (r.input_ids, r.attention_mask, r.labels)
         for r in chat_layout_records(chats, 50, 2, keep=["id"]).collect()}
    b = {r.conv_id: (r.input_ids, r.attention_mask, r.labels)
         for r in chat_layout(chat_turns(chats, "id"), 50, 2).collect()}
    assert a == b and a[3] == ([], [], [])


def test_stream_pair_layout_matches_batch(spark, scratch):
    src = _local(scratch("stream-src"))
    _write_lines(f"{src}/a.json", [{"input": "q1", "target": "a1", "sample_id": "1"},
                                   {"input": "q2", "target": "a2", "sample_id": "2"}])
    _write_lines(f"{src}/b.json", ["not json", {"input": "q3", "sample_id": "3"},
                                   {"input": "q4", "target": "a4", "sample_id": "4"}])
    sink, quarantine = scratch("stream-out"), scratch("stream-bad")
    prof = resolve_profile("m/open_llama_7b", "llama")
    for q in tokenize_stream(spark, src, sink, prof, source_len=6, target_len=5, quarantine_dir=quarantine):
        q.awaitTermination(120)
    got = {r.sample_id: (r.input_ids, r.labels) for r in spark.read.parquet(sink).collect()}
    assert set(got) == {"1", "2", "4"}
    assert got["1"][0] == [113, 49, 2, 1, 97, 49, 2, 0, 0, 0, 0]
    assert spark.read.parquet(quarantine).count() == 2


def test_stream_chat_layout(spark, scratch):
    src = _local(scratch("stream-chat"))
    _write_lines(f"{src}/c.jsonl", CONVS)
    sink = scratch("stream-chat-out")
    prof = resolve_profile("m/open_llama_7b", "llama")
    for q in tokenize_stream(spark, src, sink, prof, layout="chat", max_len=50):
        q.awaitTermination(120)
    lens = sorted(len(r.input_ids) for r in spark.read.parquet(sink).collect())
    assert lens == [0, 37, 49, 49]  # 8 + 11 + 14 template chars, "hi!", eos


def test_training_plan(spark, scratch):
    d = _local(scratch("train"))
    rows = [{"input": f"question {i}", "target": f"answer {i}", "type": "t", "sample_id": str(i)}
            for i in range(70)] + ["broken"]
    _write_lines(f"{d}/train.json", rows)
    _write_lines(f"{d}/dev.json", rows[:5])
    cfg = training.TrainingData("x/pythia-1b-deduped", "pythia", max_source_length=16,
                                max_target_length=8, per_device_train_batch_size=4,
                                gradient_accumulation_steps=4, max_steps=4)
    out = training.build(spark, f"{d}/train.json", f"{d}/out", cfg, validation_file=f"{d}/dev.json")
    train = spark.read.parquet(out["train"])
    assert train.count() == 64 and train.select(F.max("step")).first()[0] == 3
    assert train.filter(F.size("input_ids") != 24).count() == 0
    assert spark.read.parquet(out["quarantine_train"]).count() == 1
    assert spark.read.parquet(out["validation"]).count() == 5


def test_training_order_ignores_splits_and_names(spark, scratch):
    d = _local(scratch("order"))
    rows = [{"question": f"q{i % 90}", "answer": f"a{i % 90}", "id": i} for i in range(130)]
    _write_lines(f"{d}/t.json", rows)
    cfg = training.TrainingData("x/pythia-1b-deduped", "pythia", prompt_column="question", response_column="answer",
                                max_source_length=8, max_target_length=8, preview_rows=2)
    seen = []
    for size in ("134217728", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            out = training.build(spark, f"{d}/t.json", f"{d}/o{size}", cfg, validation_file=f"{d}/t.json")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        train = spark.read.parquet(out["train"]).select("example_id", "step", "rank", "micro", "input_ids").collect()
        dev = spark.read.parquet(out["validation"]).orderBy("pos").collect()
        seen.append((sorted(train), [(r["pos"], r["input_ids"]) for r in dev]))
        assert len(out["preview"]) == 2 and out["preview"][0]["decoded"]
    assert seen[0] == seen[1] and len(seen[0][0]) == len({r[0] for r in seen[0][0]}) == 130
    assert [p for p, _ in seen[0][1]] == list(range(130))
    spark.createDataFrame([(r["question"], r["answer"]) for r in rows], "question string, answer string").write.parquet(f"{d}/p")
    cfg.fmt = "parquet"
    seqs, bad = training.sequences(spark, f"{d}/p", cfg)
    assert sorted(r[0] for r in seqs.select("example_id").collect()) == sorted({r[0] for r in seen[0][0]}) and bad.count() == 0


def test_prediction_plan(spark, scratch):
    d = _local(scratch("pred"))
    _write_lines(f"{d}/in.jsonl", [{"instruction": ["Say: "], "input": f"x{i}", "id": i, "task": {"n": [i, None]}}
                                   for i in range(8)]
                 + [{"instruction": "Say: ", "input": "x8", "id": 8}, {"input": "no instruction"}, "broken", [1, 2]])
    preds, bad = prediction.predictions(spark, f"{d}/in.jsonl", echo_reverse, limit=4)
    assert sorted((r.input, r.prediction) for r in preds.collect()) == [(f"x{i}", f"{i}x :yaS") for i in range(4)]
    assert bad.count() == 3
    plan = prediction.predictions(spark, f"{d}/in.jsonl", echo_reverse)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    first = prediction.run(spark, f"{d}/in.jsonl", f"{d}/all", echo_reverse, preview=2)
    assert len(first) == 2 and "x0" in first[0]
    import json
    got = [json.loads(r["value"]) for r in spark.read.text(f"{d}/all/generation_results").collect()]
    assert sorted(g["id"] for g in got) == list(range(9))
    for g in got:
        assert g["prediction"] == f"{g['id']}x :yaS" and (g["id"] == 8 or g["task"] == {"n": [g["id"], None]})
    _write_lines(f"{d}/in.txt", ["'abc'", "bad line"])
    prediction.run(spark, f"{d}/in.txt", f"{d}/out", echo_reverse, settings={"top_k": 5})
    res = spark.read.json(f"{d}/out/generation_results").collect()
    assert [(r.Input, r.Output) for r in res] == [("abc", "cba")]
    assert spark.read.json(f"{d}/out/generation_config").first().top_k == 5


def test_predictors_are_not_shared(spark, scratch):
    from tunedata.operators import encode, predict
    df = spark.createDataFrame([("a",), ("b",)], "p string")

    def made(suffix):
        return lambda: (lambda prompts: [q + suffix for q in prompts])

    def out(factory):
        return sorted(r[0] for r in predict.generate(df, "p", factory).select("generated").collect())

    assert out(lambda: (lambda ps: [q + "1" for q in ps])) == ["a1", "b1"]
    assert out(lambda: (lambda ps: [q + "2" for q in ps])) == ["a2", "b2"]
    assert out(made("x")) == ["ax", "bx"] and out(made("y")) == ["ay", "by"]
    for n in (1, 2):
        ids = encode.encode_callable(df, "p", lambda n=n: (lambda ts: [[n] for _ in ts]))
        assert [r["ids"] for r in ids.collect()] == [[n], [n]]
    d = _local(scratch("settings"))
    _write_lines(f"{d}/in.jsonl", [{"instruction": ["i"], "input": "x"}])
    prediction.run(spark, f"{d}/in.jsonl", f"{d}/o", lambda settings: (lambda ps: [f"{q}|{settings['top_k']}" for q in ps]),
                   settings={"top_k": 7})
    assert spark.read.json(f"{d}/o/generation_results").first()["prediction"] == "|7"


def test_folders_with_stray_files(spark, scratch):
    d = _local(scratch("stray"))
    _write_lines(f"{d}/c/a.txt", ["one two"])
    _write_lines(f"{d}/c/b.md", ["not this"])
    from tunedata.sources import readers
    for path in (f"{d}/c", f"file://{d}/c"):
        assert [r[0] for r in readers.read_corpus(spark, path).collect()] == ["one two"]
    vocabulary.train(spark, f"file://{d}/c", f"{d}/v", model_name="base", model_type="word")
    vocabulary.train(spark, f"{d}/c", f"{d}/w", model_name="one", model_type="char")
    _write_lines(f"{d}/w/notes.md", ["stray\t0"])
    merged, report = vocabulary.merge(spark, f"{d}/v/base.vocab", f"file://{d}/w", f"{d}/m")
    kinds = {r["token"]: r["kind"] for r in merged.collect()}
    assert "stray" not in kinds and kinds["<sepra>"] == "user_defined" and kinds["<s>"] == "special"
    assert {r["source"] for r in report.collect()} == {0, 1}


def test_vocabulary_lines_keep_control_characters(spark, scratch):
    from tunedata.sources import readers, sinks
    tokens = ["<unk>", "\x01", "\x0b", "\u0085", "a\u2028", '"', "\\", "''", " x"]
    v = spark.createDataFrame([(t, i, -float(i), "normal") for i, t in enumerate(tokens)],
                              "token string, id int, score double, kind string")
    path = scratch("control")
    sinks.write_vocab(v, path, tsv=True)
    back = readers.read_vocab_tsv(spark, path, glob="part-*").orderBy("ord").collect()
    assert [r["token"] for r in back] == tokens


def test_vocabulary_plans(spark, scratch):
    d = _local(scratch("vocab"))
    _write_lines(f"{d}/corpus/a.txt", ["low lower lowest", "new newer"])
    _write_lines(f"{d}/corpus/b.txt", ["wide wider"])
    base = vocabulary.train(spark, f"{d}/corpus", f"{d}/base", model_type="word", vocab_size=8)
    assert sorted(r.id for r in base.collect()) == list(range(8))
    vocabulary.train(spark, f"{d}/corpus", f"{d}/src", model_name="bpe", model_type="bpe", vocab_size=20)
    vocabulary.train(spark, f"{d}/corpus", f"{d}/src", model_name="chr", model_type="char",
                     vocab_size=40, overwrite=True)
    merged, report = vocabulary.merge(spark, f"{d}/base/tokenizer.vocab", f"{d}/src/bpe.vocab", f"{d}/out")
    ids = sorted(r.id for r in merged.collect())
    assert ids == list(range(len(ids))) and len(ids) > 8
    base_ids = {r.token: r.id for r in base.collect()}
    assert all(base_ids[r.token] == r.id for r in merged.filter("source = 0").collect())
    assert {r.source for r in report.collect()} == {0, 1}
    # two sources: numbered by their folder, not by their part-file names
    merged2, _ = vocabulary.merge(spark, f"{d}/base/tokenizer.vocab",
                                  f"{d}/src/chr.vocab,{d}/src/bpe.vocab", f"{d}/out2")
    bpe_new = {r.token for r in merged.filter("source = 1").collect()}
    src_of = {r.token: r.source for r in merged2.collect()}
    assert all(src_of[t] == 1 for t in bpe_new)  # bpe.vocab sorts before chr.vocab


def test_formatter_registry_preview_and_callable_encoder(spark, scratch):
    from tunedata.operators.encode import encode_callable
    from tunedata.operators.predict import prompt_ids
    d = _local(scratch("fmt"))
    _write_lines(f"{d}/t.json", [{"input": "hi", "target": "yo", "sample_id": "1"}])
    calls = []

    def upper_pairs(spark_, path, cfg, key):
        calls.append(path)
        seqs, bad = training._builtin_formatter(spark_, path, training.TrainingData(
            cfg.model_name_or_path, cfg.model_type, max_source_length=4, max_target_length=4), key)
        return seqs, bad
    training.register_formatter("mine", upper_pairs)
    cfg = training.TrainingData("m/open_llama_7b", "llama", layout="mine")
    seqs, _ = training.sequences(spark, f"{d}/t.json", cfg)
    assert calls and seqs.first().input_ids == [104, 105, 2, 1, 121, 111, 2, 0]
    row = training.preview(seqs)[0]
    assert row.decoded == "hiyo"
    df = spark.createDataFrame([("ab",), ("",)], "t string")

    def factory():
        return lambda texts: [[len(t)] * len(t) for t in texts]
    got = sorted(tuple(r.ids) for r in encode_callable(df, "t", factory).collect())
    assert got == [(), (2, 2)]
    p = prompt_ids(df, "t", 2, None, add_separator=True).filter("t = 'ab'").first()
    assert p.input_ids == [97, 98, 2, 0]
    assert prompt_ids(df, "t", 2, 1).filter("t = 'ab'").first().input_ids == [97, 98]


def test_stream_resumes_from_checkpoint(spark, scratch):
    src = _local(scratch("stream-resume"))
    sink, ckpt = scratch("stream-resume-out"), scratch("stream-resume-ckpt")
    prof = resolve_profile("m/open_llama_7b", "llama")
    _write_lines(f"{src}/1.json", [{"input": "a", "target": "b", "sample_id": "1"}])
    for q in tokenize_stream(spark, src, sink, prof, source_len=4, target_len=4, checkpoint_location=ckpt):
        q.awaitTermination(120)
    _write_lines(f"{src}/2.json", [{"input": "c", "target": "d", "sample_id": "2"}])
    # a new query on the same checkpoint picks up only the new file
    for q in tokenize_stream(spark, src, sink, prof, source_len=4, target_len=4, checkpoint_location=ckpt):
        q.awaitTermination(120)
    ids = sorted(r.sample_id for r in spark.read.parquet(sink).collect())
    assert ids == ["1", "2"]


def test_training_plan_repeats_epochs(spark, scratch):
    d = _local(scratch("train-epochs"))
    _write_lines(f"{d}/train.json", [{"input": f"q{i}", "target": f"a{i}", "sample_id": str(i)}
                                     for i in range(20)])
    cfg = training.TrainingData("x/pythia-1b-deduped", "pythia", max_source_length=8, max_target_length=8,
                                per_device_train_batch_size=4, gradient_accumulation_steps=2,
                                max_steps=7, repeat_epochs=True)
    seqs, _ = training.sequences(spark, f"{d}/train.json", cfg)
    b = training.batches(seqs, cfg, 1).collect()
    # 20 rows, 8 per step -> 3 steps per epoch (8, 8, 4); 7 steps need 3 epochs
    assert sorted({r.step for r in b}) == list(range(7)) and {r.epoch for r in b} == {0, 1, 2}
    assert len(b) == 20 + 20 + 8
