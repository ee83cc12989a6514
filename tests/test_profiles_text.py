import pytest
from pyspark.sql import functions as F

from tunedata.functions.text import last_path_segment, strip_prompt, unquote_literal
from tunedata.operators.profiles import attach_special_ids, native_vs_table, resolve_profile
from tunedata.operators.templates import assemble_prompt, select_prompt_response


@pytest.mark.parametrize("path", ["../models/open_llama_7b", "../models/open_llama_7b/"])
def test_special_ids_by_last_segment(path):
    p = resolve_profile(path, "llama")
    assert (p.bos_id, p.eos_id, p.pad_id) == (1, 2, 0)


def test_unknown_model_names_it():
    with pytest.raises(ValueError, match="mystery-7b"):
        resolve_profile("/x/mystery-7b", "llama")


def test_glm_keeps_native_ids():
    p = resolve_profile("THUDM/chatglm2-6b", "glm")
    assert (p.bos_id, p.eos_id, p.pad_id) == (None, 2, 0) and p.bos_or_zero == 0
    assert resolve_profile("x/any", "glm", native=(5, 6, 7)).pad_id == 7


def test_attach_special_ids_join(spark):
    df = spark.createDataFrame([("../m/pythia-1b-deduped/", "pythia"), ("a/chatglm2-6b", "glm")],
                               "path string, mtype string")
    got = {r.model_name: (r.bos_id, r.eos_id, r.pad_id)
           for r in attach_special_ids(df, "path", "mtype").collect()}
    assert got == {"pythia-1b-deduped": (0, 0, 1), "chatglm2-6b": (None, 2, 0)}
    bad = spark.createDataFrame([("m/nope", "llama")], "path string, mtype string")
    with pytest.raises(Exception, match="nope"):
        attach_special_ids(bad, "path", "mtype").collect()


def test_native_vs_table_pads(spark):
    rows = {r.model_name: (r.native_pad_id, r.pad_id) for r in native_vs_table(spark).collect()}
    assert rows == {"open_llama_13b": (None, 0), "open_llama_7b": (None, 0), "baichuan-7B": (None, 0),
                    "pythia-12b-deduped": (None, 1), "pythia-1b-deduped": (None, 1)}


def test_last_path_segment(spark):
    df = spark.createDataFrame([("a/b/c",), ("a/b/c//",), ("c",)], "p string")
    assert [r[0] for r in df.select(last_path_segment("p")).collect()] == ["c", "c", "c"]


def test_assemble_prompt_array_and_string(spark):
    df = spark.createDataFrame([(["x", "y"], "z")], "instruction array<string>, input string")
    assert assemble_prompt(df).first().prompt == "xz"
    s = spark.createDataFrame([("xy", "z")], "instruction string, input string")
    assert assemble_prompt(s).first().prompt == "xyz"
    assert assemble_prompt(s, first_char=True).first().prompt == "xz"
    empty = spark.createDataFrame([([], "z")], "instruction array<string>, input string")
    with pytest.raises(Exception, match="empty instruction"):
        assemble_prompt(empty).collect()


def test_select_prompt_response_prunes(spark):
    df = spark.createDataFrame([("i", "t", "ty", "a", "s")],
                               "input string, target string, type string, answer_choices string, sample_id string")
    out = select_prompt_response(df, "input", "target")
    assert out.columns == ["prompt", "response"] and tuple(out.first()) == ("i", "t")
    with pytest.raises(ValueError):
        select_prompt_response(df, "nope", "target")


def test_strip_prompt(spark):
    df = spark.createDataFrame([("PaP", "P"), ("abc", ""), ("PaP", "Pa")], "r string, p string")
    assert [x[0] for x in df.select(strip_prompt("r", "p")).collect()] == ["a", "abc", "P"]
    assert [x[0] for x in df.select(strip_prompt("r", "p", prefix_only=True)).collect()] == ["aP", "abc", "P"]


def test_unquote_never_evaluates(spark):
    lines = ["'it'", '"q"', "1+1", "__import__('os')", "'a\\'b'", '"x\\"y"']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(unquote_literal(F.col("line"))).collect()]
    assert got == ["it", "q", None, None, "a'b", 'x"y']


def test_unquote_is_strict_in_both_quote_styles(spark):
    lines = [r"'a\nb'", r"'\u4e2d'", '"a","v":"b"', r'"a\nb"', r'"\u4e2d"', r"'\\n'", r"'\x41\t'", "'a\"b'", '"a\'b"',
             r"'open", r"'a'b'", r"'\q'", r"'bad \u12'", "''", '""', "'x' ", r"'\\'", r"'\\'x'", "b'x'"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(unquote_literal(F.col("line"))).collect()]
    assert got == ["a\nb", "\u4e2d", None, "a\nb", "\u4e2d", "\\n", "A\t", 'a"b', "a'b",
                   None, None, None, None, "", "", "x", "\\", None, None]


def test_extra_profiles(spark):
    extra = [("my-model-7b", "llama", 1, 2, 5)]
    assert resolve_profile("x/my-model-7b", "llama", extra=extra).pad_id == 5
    df = spark.createDataFrame([("x/my-model-7b", "llama")], "path string, mtype string")
    assert attach_special_ids(df, "path", "mtype", extra=extra).first().pad_id == 5
