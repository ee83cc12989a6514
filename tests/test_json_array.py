import json
import os
import random

import pytest
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tunedata.sources import json_array, readers

SCHEMA = StructType([StructField("input", StringType()), StructField("target", StringType()), StructField("n", LongType()),
                     StructField("many", ArrayType(StructType([StructField("k", StringType())])))])


@pytest.fixture(scope="module")
def examples():
    """Quotes, escapes, brackets and the split sign inside of strings, nested values, long records."""
    rng = random.Random(7)
    odd = ['"', "\\", "}", "{", "[", "]", ",", "\\\"", "\n", "é", "😀", " ", "a", "},{", "\\\\"]

    def text(k):
        return "".join(rng.choices(odd, k=k))

    rows = [{"input": text(rng.randint(0, 30)), "target": text(rng.randint(0, 12)), "n": i,
             "many": [{"k": text(3)} for _ in range(rng.randint(0, 3))]} for i in range(300)]
    rows[17]["input"] = text(20_000)
    rows[18] = {"n": 18}
    rows[19] = {}
    return rows


def write(scratch, text):
    path = scratch("array").removeprefix("file:") + ".json"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def rows(df):
    return sorted((str(r) for r in df.drop(readers.CORRUPT).collect()))


@pytest.mark.parametrize("style,parts", [({}, 40), ({"indent": 2}, 15), ({"separators": (",", ":"), "ensure_ascii": False}, 3)])
def test_equals_multiline_for_any_split_size(spark, scratch, examples, style, parts):
    path = write(scratch, json.dumps(examples, **style) + ("\n" if parts == 15 else ""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        want = rows(readers.read_json(spark, path, SCHEMA, multiline=True))
        spark.conf.set("spark.sql.files.maxPartitionBytes", os.path.getsize(path) // parts)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = readers.read_json(spark, path, SCHEMA, array=True)
        assert rows(got) == want and len(want) == len(examples)
        assert got.filter(f"{readers.CORRUPT} is not null").count() == 0
        assert json_array._pieces(spark, path).rdd.getNumPartitions() >= parts
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_maps_compose_from_any_cut(examples):
    """State and depth behind a text are those of its parts one after the other, wherever it is cut."""
    text = json.dumps(examples[:40])
    rng = random.Random(1)
    for _ in range(200):
        cuts = sorted(rng.sample(range(len(text)), 3))
        for start in range(3):
            state, depth = start, 0
            for a, b in zip([0, *cuts], [*cuts, len(text)]):
                state, change = json_array.scan(text[a:b], state)
                depth += change
            assert (state, depth) == json_array.scan(text, start)


def test_elements_that_are_no_records(spark, scratch):
    path = write(scratch, '[{"n": 1}, 5, "a}b", {"n": 2}, [1, {"n": 9}], {"n": "x"}, {"n": 3}')
    got = readers.read_json(spark, path, SCHEMA, array=True).collect()
    assert sorted(r["n"] for r in got if r["n"] is not None) == [1, 2, 3]
    assert {r[readers.CORRUPT] for r in got} - {None} == {"5", '"a}b"', '[1, {"n": 9}]', '{"n": "x"}'}


def test_cut_off_record_is_corrupt(spark, scratch):
    path = write(scratch, '[{"n": 1}, {"n": 2, "input": "open')
    got = readers.read_json(spark, path, SCHEMA, array=True).collect()
    assert [r["n"] for r in got if r[readers.CORRUPT] is None] == [1] and len(got) == 2


def test_several_files_and_none(spark, scratch, examples):
    folder = scratch("arrays").removeprefix("file:")
    os.makedirs(folder)
    for i in range(3):
        with open(f"{folder}/{i}.json", "w") as f:
            json.dump(examples[i::3], f)
    with open(f"{folder}/empty.json", "w") as f:
        f.write(" [ ]\n")
    got = readers.read_json(spark, folder, SCHEMA, array=True).collect()
    assert sorted(r["n"] for r in got if r["n"] is not None) == [e["n"] for e in examples if "n" in e]
    assert len(got) == len(examples)


def test_json_lines_are_an_error(spark, scratch):
    path = write(scratch, '{"n": 1}\n{"n": 2}\n')
    with pytest.raises(Exception, match="no JSON array"):
        readers.read_json(spark, path, SCHEMA, array=True).collect()
