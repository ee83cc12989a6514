import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import IGNORE, chat_rows, pair_rows
from tunedata.operators.layouts import chat_layout, pair_layout
from tunedata.sources.readers import CHAT_SCHEMA, chat_turns

EOS, BOS, PAD = 2, 1, 0


def _pairs(spark, rows):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rows)],
                                 "example_id long, prompt string, response string")


def _pair(spark, rows, S=6, T=5, bos=BOS, eos=EOS, pad=PAD, **kw):
    out = pair_layout(_pairs(spark, rows), S, T, bos, eos, pad, keep=["example_id"], **kw)
    return [(r.input_ids, r.labels) for r in out.orderBy("example_id").collect()]


def test_pair_empty(spark):
    ids, labels = _pair(spark, [("", "")])[0]
    assert ids == [2, 1, 2, 0, 0, 0, 0, 0, 0, 0, 0]
    assert labels == [-100, 1, 2, 0, 0, 0, 0, 0, 0, 0, 0]


def test_pair_exact_fit_and_cut(spark):
    (ids, labels), (ids2, _) = _pair(spark, [("abcde", "xyz"), ("a" * 9, "b" * 9)])
    assert len(ids) == 11 and PAD not in ids
    assert ids == [97, 98, 99, 100, 101, 2, 1, 120, 121, 122, 2]
    assert labels == [-100] * 6 + [1, 120, 121, 122, 2]
    assert ids2 == [97] * 5 + [2, 1] + [98] * 3 + [2]


def test_pair_null_bos_is_zero(spark):
    ids, _ = _pair(spark, [("a", "b")], bos=None)[0]
    assert ids[:4] == [97, 2, 0, 98]


def test_pair_mask_pad_keeps_eos_equal_to_pad(spark):
    ids, labels = _pair(spark, [("a", "b")], eos=0, pad=0, mask_pad_labels=True)[0]
    assert ids == [97, 0, 1, 98, 0, 0, 0, 0, 0, 0, 0]
    assert labels == [-100, -100, 1, 98, 0] + [-100] * 6


def test_pair_null_text_fails_or_drops(spark):
    import pytest
    df = spark.createDataFrame([(1, None, "x"), (2, "p", "r")], "example_id long, prompt string, response string")
    assert pair_layout(df, 6, 5, 1, 2, 0, on_invalid="drop").count() == 1
    with pytest.raises(Exception, match="NULL text"):
        pair_layout(df, 6, 5, 1, 2, 0).collect()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=6),
       st.integers(1, 8), st.integers(2, 8), st.booleans())
def test_pair_matches_brute_force(spark, rows, S, T, mask):
    got = _pair(spark, rows, S=S, T=T, mask_pad_labels=mask)
    want = [pair_rows(p, r, S, T, BOS, EOS, PAD, mask) for p, r in rows]
    assert got == want
    assert all(len(i) == S + T and len(lab) == S + T for i, lab in got)


def _turns(spark, convs):
    rows = [(cid, t, role, value) for cid, turns in convs.items() for t, (role, value) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, value string")


def _chat(spark, convs, L=512, roles=("human",)):
    out = chat_layout(_turns(spark, convs), L, EOS, roles)
    return {r.conv_id: (r.input_ids, r.attention_mask, r.labels) for r in out.collect()}


def test_chat_human_then_assistant(spark):
    ids, mask, labels = _chat(spark, {1: [("human", "a"), ("gpt", "b")]})[1]
    template = [ord(c) for c in "Human: \na\n\nAssistant: \n"]
    assert ids == template + [98, EOS]
    assert labels == [IGNORE] * len(template) + [98, EOS]
    assert mask == [1] * len(ids)


def test_chat_role_case_system_and_empty_assistant(spark):
    got = _chat(spark, {1: [("system", "s"), ("HUMAN", "q"), ("assistant", "")]})[1]
    want = chat_rows([("system", "s"), ("HUMAN", "q"), ("assistant", "")], 512, EOS)
    assert got == want
    assert got[0][:2] == [115, EOS] and got[2][:2] == [115, EOS]
    assert got[0][-1] == EOS and got[2][-1] == EOS


def test_chat_fallback_windows(spark):
    got = _chat(spark, {1: [("human", "x" * 10)], 2: [("human", "")]})
    ids, _, labels = got[1]
    assert len(ids) == 32
    assert labels == [IGNORE] * 18 + ids[18:24] + [IGNORE] * 8
    ids, _, labels = got[2]
    assert len(ids) == 22 and labels == [IGNORE] * 18 + ids[18:22]


def test_chat_long_human_cuts_assistant(spark):
    ids, _, labels = _chat(spark, {1: [("human", "y" * 40), ("gpt", "answer")]}, L=30)[1]
    assert len(ids) == 29
    assert labels == [IGNORE] * 18 + ids[18:24] + [IGNORE] * 5


def test_chat_exact_limit(spark):
    # human template = 22 tokens, assistant "abc" + eos = 4 -> 26 tokens
    conv = {1: [("human", ""), ("gpt", "abc")]}
    ids, _, labels = _chat(spark, conv, L=27)[1]
    assert len(ids) == 26 and ids[-1] == EOS
    ids, _, labels = _chat(spark, conv, L=26)[1]
    assert len(ids) == 25 and ids[-1] == ord("c") and labels[-1] == ord("c")


def test_chat_empty_conversation_keeps_row(spark):
    chats = spark.createDataFrame([(7, []), (8, [{"from": "human", "value": "hi"}])],
                                  "id long, " + CHAT_SCHEMA.simpleString()[7:-1])
    out = chat_layout(chat_turns(chats, "id"), 512, EOS)
    got = {r.conv_id: r for r in out.collect()}
    assert got[7].input_ids == [] and got[7].labels == [] and got[7].attention_mask == []
    assert len(got[8].input_ids) == 24


def test_chat_order_independent_of_partitioning(spark):
    convs = {c: [("human" if t % 2 == 0 else "gpt", f"turn {t} of {c}") for t in range(7)]
             for c in range(20)}
    df = _turns(spark, convs)
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    a = {r.conv_id: tuple(map(tuple, r[1:])) for r in chat_layout(df, 60, EOS).collect()}
    b = {r.conv_id: tuple(map(tuple, r[1:])) for r in chat_layout(shuffled, 60, EOS).collect()}
    assert a == b


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 50), st.lists(
    st.tuples(st.sampled_from(["human", "Human", "gpt", "system"]), st.text(max_size=15)),
    min_size=1, max_size=6), min_size=1, max_size=5), st.integers(2, 70))
def test_chat_matches_brute_force(spark, convs, L):
    got = _chat(spark, convs, L=L)
    want = {c: chat_rows(t, L, EOS) for c, t in convs.items()}
    assert got == want
    for ids, mask, labels in got.values():
        assert len(ids) == len(labels) == len(mask) <= L - 1
        assert all(lab == IGNORE or lab == i for i, lab in zip(ids, labels))


def test_pair_quarantine(spark):
    from tunedata.operators.layouts import invalid_rows
    df = spark.createDataFrame([(1, None, "x"), (2, "p", "r"), (3, "q", None)],
                               "example_id long, prompt string, response string")
    ok = pair_layout(df, 6, 5, 1, 2, 0, on_invalid="quarantine", keep=["example_id"])
    assert [r.example_id for r in ok.collect()] == [2]
    assert sorted(r.example_id for r in invalid_rows(df, ["prompt", "response"]).collect()) == [1, 3]


def test_encoder_without_ids_for_a_human_turn_is_an_error(spark):
    turns = spark.createDataFrame([(1, 0, "human", "x"), (1, 1, "gpt", "y")], "conv_id long, turn long, role string, value string")
    from tunedata.operators.layouts import chat_layout as lay
    none = lambda c: F.array().cast("array<int>")
    with pytest.raises(Exception, match="no ids"):
        lay(turns, 10, 2, encode_fn=none).collect()


def test_next_turn_over_gaps_and_splits(spark, monkeypatch):
    from tunedata.sources import tables
    monkeypatch.setattr(tables, "TURN_SPLIT", 4)
    numbers = [0, 1, 2, 3, 4, 9, 17, 30, 31]
    rows = [(c, t, f"{c}-{t}") for c in (1, 2) for t in numbers] + [(3, 7, "3-7")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r.next_text for r in tables.with_next_turn(df, "text").collect()}
    want = {(c, a): f"{c}-{b}" for c in (1, 2) for a, b in zip(numbers, numbers[1:])}
    assert got == {**want, (1, 31): None, (2, 31): None, (3, 7): None}
