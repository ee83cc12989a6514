import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tunedata.operators.predict import batch_predict, echo_reverse, generate
from tunedata.operators.templates import txt_output
from tunedata.sources import readers, sinks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_json_quarantine_and_null(spark, scratch):
    d = _local(scratch("json"))
    _write(f"{d}/train.json", '{"input": "q1", "target": "a1"}\nbad\n{"input": "q2"}\n')
    df = readers.read_examples(spark, f"{d}/train.json")
    valid, quarantined = readers.split_valid(df, ["input", "target"])
    assert [r.input for r in valid.collect()] == ["q1"]
    assert quarantined.count() == 2


def test_json_top_level_array(spark, scratch):
    d = _local(scratch("jsonarr"))
    _write(f"{d}/a.json", json.dumps([{"input": "x", "target": "y"}, {"input": "z", "target": "w"}]))
    df = readers.read_examples(spark, f"{d}/a.json", multiline=True)
    assert sorted(r.input for r in df.collect()) == ["x", "z"]


def test_suffix_dispatch_and_missing_path(spark):
    assert readers.reader_kind("a/b.jsonl") == "json" and readers.reader_kind("x.TXT") == "txt"
    with pytest.raises(ValueError):
        readers.reader_kind("data.csv")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_examples(spark, "/nonexistent/dir/train.json").collect()
    assert readers.read_validation(spark, None) is None


def test_txt_prompts(spark, scratch):
    d = _local(scratch("txt"))
    _write(f"{d}/p.txt", "'it'\n\"q\"\n1+1\n__import__('os')\n")
    ok, bad = readers.read_prompts_txt(spark, f"{d}/p.txt")
    assert sorted(r.value for r in ok.collect()) == ["it", "q"]
    assert sorted(r.line for r in bad.collect()) == ["1+1", "__import__('os')"]


def test_corpus_dir_and_list(spark, scratch):
    d = _local(scratch("corpus"))
    _write(f"{d}/a.txt", "one\ntwo\n")
    _write(f"{d}/b.txt", "three\n")
    _write(f"{d}/c.md", "skip\n")
    assert readers.read_corpus(spark, d).count() == 3
    assert readers.read_corpus(spark, f"{d}/a.txt,{d}/c.md").count() == 3


def test_vocab_tsv_round_trip(spark, scratch):
    rows = [("<unk>", 0, 0.0, "special"), ('"', 1, -1.0, "normal"), ("▁a,b", 2, -2.0, "normal")]
    v = spark.createDataFrame(rows, "token string, id int, score double, kind string")
    path = scratch("vocab")
    sinks.write_vocab(v, path, tsv=True)
    back = readers.read_vocab_tsv(spark, path, glob="part-*")
    got = sorted((r.ord, r.token, r.score) for r in back.collect())
    assert got == [(0, "<unk>", 0.0), (1, '"', -1.0), (2, "▁a,b", -2.0)]


def test_overwrite_guard(spark, scratch):
    path = scratch("out")
    df = spark.range(3)
    sinks.write_predictions(df, path)
    with pytest.raises(AnalysisException):
        sinks.write_predictions(df, path)
    sinks.write_predictions(df, path, overwrite=True)
    sinks.write_settings(spark, {"top_p": 0.5}, path + "-settings")
    s = spark.read.json(path + "-settings").first()
    assert s.top_p == 0.5 and s.max_new_tokens == 400 and s.do_sample is True


def test_batch_predict_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(i, f"p{i}", i * 2) for i in range(50)], "id long, prompt string, extra long")
    out = batch_predict(df.repartition(3), "prompt", echo_reverse, batch_size=7)
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 50 and rows[12].prediction == "21p" and rows[12].extra == 24
    assert out.columns == ["id", "prompt", "extra", "prediction"]
    g = generate(df, "prompt", echo_reverse).filter("id = 3").first()
    assert g.generated == "p33p"
    t = txt_output(out.withColumnRenamed("prompt", "value"), "value", "prediction")
    assert t.columns == ["Input", "Output"]


def test_predictor_row_count_checked(spark):
    df = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)

    def drops_rows():  # local, so it is shipped to the workers by value
        return lambda prompts: prompts[:1]
    with pytest.raises(Exception, match="returned"):
        generate(df, "prompt", drops_rows).collect()


def test_chat_reader_nested(spark, scratch):
    d = _local(scratch("chat"))
    lines = [{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
             {"conversations": []}]
    _write(f"{d}/c.jsonl", "\n".join(json.dumps(x) for x in lines))
    chats = readers.read_json(spark, f"{d}/c.jsonl", readers.CHAT_SCHEMA)
    t = readers.chat_turns(chats).orderBy("conv_id", "turn").collect()
    assert [(r.turn, r.role, r.value) for r in t] == [(0, "human", "hi"), (1, "gpt", "yo"), (None, None, None)]
    assert F is not None


def test_other_formats_and_file_counts(spark, scratch):
    from tunedata.operators.reports import file_counts
    df = readers.read_examples(spark, "/root/testdata/sf0.001/benchmark.parquet", fmt="parquet")
    assert df.count() == 40 and "text" in df.columns
    d = _local(scratch("files"))
    _write(f"{d}/a.txt", "x\ny\n")
    _write(f"{d}/b.txt", "z\n")
    got = {r.file: r.n_rows for r in file_counts(readers.read_corpus(spark, d)).collect()}
    assert got == {"a.txt": 2, "b.txt": 1}
