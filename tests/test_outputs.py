import os

import pytest

from tunedata.operators.predict import generate, outputs
from tunedata.plans import prediction, training
from tunedata.sources import outputs as out_mod
from tunedata.sources import sinks


def local(p):
    return p.removeprefix("file:")


def files(path):
    return {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(local(path)) for f in names
            if f.startswith("part-")}


@pytest.fixture
def job(spark, scratch):
    src = local(scratch("in"))
    os.makedirs(src)
    for name in ("train", "dev"):
        with open(f"{src}/{name}.json", "w") as f:
            f.writelines('{"input": "q%d", "target": "a%d"}\n' % (i, i) for i in range(20))
            f.write("bad\n")
    cfg = training.TrainingData("../models/pythia-12b-deduped", "pythia", max_source_length=16, max_target_length=8)

    def build(out, **options):
        return training.build(spark, f"{src}/train.json", out, cfg, f"{src}/dev.json", **options)

    return build, src


def test_stopped_job_goes_on(spark, scratch, job, monkeypatch):
    """Stopped between outputs and inside of one: finished parts stay as they are, the half-written one is replaced."""
    build, _ = job
    out = scratch("job")
    write, calls = sinks.write_sequences, []

    def breaks(df, path, *a, **k):
        calls.append(path)
        if len(calls) == 3:
            write(df.limit(1), path, *a, **k)
            raise KeyboardInterrupt
        write(df, path, *a, **k)

    monkeypatch.setattr(sinks, "write_sequences", breaks)
    with pytest.raises(KeyboardInterrupt):
        build(out)
    with pytest.raises(FileNotFoundError):
        out_mod.finished_parts(spark, out)
    before = files(f"{out}/train")
    assert before
    monkeypatch.setattr(sinks, "write_sequences", write)
    paths = build(out)
    assert files(f"{out}/train") == before
    assert spark.read.parquet(paths["validation"]).count() == 20
    assert out_mod.finished_parts(spark, out) == ["train", "quarantine/train", "validation", "quarantine/validation"]
    with pytest.raises(FileExistsError, match="finished"):
        build(out)
    build(out, overwrite=True)
    assert files(f"{out}/train") != before


def test_parts_of_other_inputs_are_not_taken(spark, scratch, job, monkeypatch):
    build, src = job
    out = scratch("job")

    def stop(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(out_mod.Outputs, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        build(out)
    monkeypatch.undo()
    with open(f"{src}/train.json", "a") as f:
        f.write('{"input": "new", "target": "row"}\n')
    with pytest.raises(FileExistsError, match="another job"):
        build(out)
    build(out, overwrite=True)
    assert spark.read.parquet(f"{out}/train").count() == 21


def test_foreign_folder_is_refused(scratch, job):
    build, _ = job
    out = scratch("foreign")
    os.makedirs(local(out))
    with open(f"{local(out)}/notes.txt", "w") as f:
        f.write("mine")
    with pytest.raises(FileExistsError, match="not empty"):
        build(out)


class Picky:
    def __init__(self):
        self.sizes = []

    def __call__(self, prompts):
        if any("poison" in p for p in prompts):
            raise ValueError("bad prompt")
        self.sizes.append(len(prompts))
        return [p + "!" for p in prompts]


def test_one_poisoned_row_costs_one_row():
    prompts = [f"{'x' * (i % 7)}{i}" for i in range(200)]
    prompts[77] = "poison"
    model, errors = Picky(), [None] * 200
    out = outputs(model, prompts, 64, errors)
    assert [o for o in out if o is None] == [None] and out[77] is None and errors[77] == "ValueError: bad prompt"
    assert all(o == p + "!" for i, (o, p) in enumerate(zip(out, prompts, strict=True)) if i != 77)
    assert sum(e is not None for e in errors) == 1 and sum(model.sizes) == 199
    with pytest.raises(ValueError, match="bad prompt"):
        outputs(Picky(), prompts, 64, None)


def test_batches_hold_prompts_of_similar_length():
    widths = []

    def model(prompts):
        widths.append(max(map(len, prompts)) - min(map(len, prompts)))
        return prompts

    prompts = ["x" * (i * 37 % 101) for i in range(1000)]
    assert outputs(model, prompts, 50, None) == prompts
    assert max(widths) <= 5


def test_failures_are_quarantined(spark, scratch):
    def picky():  # workers can't import this module
        def model(prompts):
            if any("poison" in p for p in prompts):
                raise ValueError("bad prompt")
            return [p + "!" for p in prompts]
        return model

    rows = [(i, "poison" if i == 3 else None if i == 4 else f"p{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "k long, prompt string").repartition(2)
    got = {r["k"]: (r["generated"], r["error"]) for r in generate(df, "prompt", picky, error_col="error").collect()}
    assert got[3] == (None, "ValueError: bad prompt") and got[4] == (None, "ValueError: no prompt")
    assert all(got[k] == (f"p{k}!", None) for k in got if k not in (3, 4))
    src, out = local(scratch("in")), scratch("out")
    os.makedirs(src)
    with open(f"{src}/t.jsonl", "w") as f:
        f.writelines('{"instruction": ["%s"], "input": "%d", "extra": 1}\n' % ("poison" if i == 2 else "do", i) for i in range(6))
    prediction.run(spark, f"{src}/t.jsonl", out, picky, quarantine_failures=True)
    assert spark.read.json(f"{out}/generation_results").count() == 5
    failed = spark.read.json(f"{out}/failed").collect()
    assert len(failed) == 1 and '"input": "2"' in failed[0]["line"] and "bad prompt" in failed[0]["error"]
