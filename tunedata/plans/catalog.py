"""Registered queries over the driver tables, each with an independent DuckDB
statement of the same result.

Every query reads whole tables; outputs are scalars or exploded rows (no
arrays) with integer columns cast to BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunedata.functions.arrays import IGNORE_INDEX
from tunedata.functions.codec import WORD_MARK, codepoints, codepoints_decode
from tunedata.functions.text import WHITESPACE_CLASS, human_template, is_human, strip_prompt
from tunedata.operators import encode, layouts, ordering, predict, reports, templates, vocab
from tunedata.operators.profiles import resolve_profile
from tunedata.operators.templates import txt_output
from tunedata.session import materialize, scratch_path
from tunedata.sources import readers, sinks, tables

# Run parameters of the registered queries (the example training script's
# settings where it has them).
PROFILE = resolve_profile("../models/pythia-12b-deduped", "pythia")
SOURCE_LEN, TARGET_LEN = 256, 16
CHAT_LEN = 512
HUMAN_ROLES = ("user",)
SEED = 42
DEVICES, PER_DEVICE_BATCH, GRAD_ACCUM, MAX_STEPS = 1, 4, 16, 100
HEAD_LIMIT = 2000

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _big(c):
    return F.col(c).cast("bigint").alias(c) if isinstance(c, str) else c.cast("bigint")


def _array_sum(col):
    """Sum of an int array as BIGINT (0 for an empty array)."""
    return F.aggregate(col, F.lit(0).cast("bigint"), lambda acc, v: acc + v)


# ---------------------------------------------------------------- SQL pieces
NL = "chr(10)"
SQL_TEMPLATE = (f"CASE WHEN lower(role) = 'user' THEN 'Human: ' || {NL} || text || {NL} || {NL}"
                f" || 'Assistant: ' || {NL} ELSE text END")


def sql_codepoints(expr: str) -> str:
    return (f"(CASE WHEN {expr} = '' THEN []::INTEGER[] ELSE "
            f"list_transform(string_split({expr}, ''), lambda c: unicode(c)) END)")


SQL_PAIRS = """
  SELECT conv_id * 16777216 + turn AS example_id, conv_id, turn, text AS prompt, next_text AS response
  FROM (SELECT conv_id, turn, role, text,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
        FROM conversations)
  WHERE role = 'user' AND next_role = 'assistant'
"""


def sql_pair_layout(mask_pad: bool, b: int = 0, e: int = 0, p: int = 1) -> str:
    """``b, e, p``: begin, end and padding id, by default those of the profile in use."""
    s, t = SOURCE_LEN, TARGET_LEN
    label = "CASE WHEN i <= na + 1 THEN -100 " + \
        ("WHEN i > nreal THEN -100 " if mask_pad else "") + "ELSE ids[i] END"
    return f"""
WITH p AS ({SQL_PAIRS}),
e AS (SELECT example_id, {sql_codepoints('prompt')}[1:{s - 1}] AS a,
             {sql_codepoints('response')}[1:{t - 2}] AS b FROM p),
c AS (SELECT example_id, len(a) AS na, list_concat(a, [{e}, {b}], b, [{e}]) AS core FROM e),
f AS (SELECT example_id, na, len(core) AS nreal,
             list_concat(core, list_transform(range({s + t} - len(core)), lambda x: {p})) AS ids
      FROM c),
r AS (SELECT example_id, na, nreal, ids, unnest(generate_series(1, {s + t})) AS i FROM f)
SELECT CAST(example_id AS BIGINT) AS example_id, CAST(i - 1 AS BIGINT) AS pos,
       CAST(ids[i] AS BIGINT) AS input_id, CAST({label} AS BIGINT) AS label
FROM r"""


def sql_chat_tokens(where: str = "") -> str:
    """Per-token rows of the chat layout before the fallback: conv_id, pos, id, lab."""
    limit = CHAT_LEN - 1
    e = 0  # end id of the profile in use
    return f"""
t AS (SELECT conv_id, turn, lower(role) <> 'user' AS sup, {SQL_TEMPLATE} AS v
      FROM conversations {where}),
e AS (SELECT conv_id, turn, sup,
             list_concat({sql_codepoints('v')}, CASE WHEN sup THEN [{e}] ELSE []::INTEGER[] END) AS ids
      FROM t),
s AS (SELECT conv_id, turn, sup, ids,
             coalesce(sum(len(ids)) OVER (PARTITION BY conv_id ORDER BY turn
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM e),
u AS (SELECT conv_id, sup, start, unnest(ids) AS id,
             unnest(generate_series(0, len(ids) - 1)) AS i FROM s),
k AS (SELECT conv_id, start + i AS pos, id, CASE WHEN sup THEN id ELSE -100 END AS lab
      FROM u WHERE start + i < {limit}),
f AS (SELECT conv_id, pos, id,
             CASE WHEN NOT bool_or(lab > -100) OVER (PARTITION BY conv_id) AND pos BETWEEN 18 AND 23
                  THEN id ELSE lab END AS label
      FROM k)"""


def sql_chat_rows(where: str = "") -> str:
    return f"""
WITH {sql_chat_tokens(where)}
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(pos AS BIGINT) AS pos, CAST(id AS BIGINT) AS input_id,
       CAST(label AS BIGINT) AS label, CAST(1 AS BIGINT) AS attention
FROM f"""


# ------------------------------------------------------------------ queries
@register("role_predicate", """
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, lower(role) AS role_lc,
       CAST(lower(role) IN ('user') AS BIGINT) AS is_human,
       CAST(lower(role) NOT IN ('user') AS BIGINT) AS supervised
FROM conversations""")
def q_role_predicate(spark, sf):
    t = tables.turns(spark, sf)
    h = is_human("role", HUMAN_ROLES)
    return t.select(_big("conv_id"), _big("turn"), F.lower("role").alias("role_lc"),
                    h.cast("bigint").alias("is_human"), (~h).cast("bigint").alias("supervised"))


@register("human_template", f"""
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
       md5({SQL_TEMPLATE}) AS text_md5, CAST(length({SQL_TEMPLATE}) AS BIGINT) AS n_chars
FROM conversations""")
def q_human_template(spark, sf):
    t = tables.turns(spark, sf)
    v = human_template(F.col("value"), is_human("role", HUMAN_ROLES))
    return t.select(_big("conv_id"), _big("turn"), F.md5(v).alias("text_md5"),
                    F.length(v).cast("bigint").alias("n_chars"))


@register("pair_rows", f"""
SELECT CAST(example_id AS BIGINT) AS example_id, CAST(conv_id AS BIGINT) AS conv_id,
       CAST(turn AS BIGINT) AS turn, md5(prompt) AS prompt_md5, md5(response) AS response_md5,
       CAST(length(prompt) AS BIGINT) AS prompt_chars, CAST(length(response) AS BIGINT) AS response_chars
FROM ({SQL_PAIRS})""")
def q_pair_rows(spark, sf):
    p = tables.pairs(spark, sf)
    return p.select(_big("example_id"), _big("conv_id"), _big("turn"),
                    F.md5("prompt").alias("prompt_md5"), F.md5("response").alias("response_md5"),
                    F.length("prompt").cast("bigint").alias("prompt_chars"),
                    F.length("response").cast("bigint").alias("response_chars"))


@register("select_prompt_response", f"""
SELECT CAST(example_id AS BIGINT) AS example_id, prompt, response FROM ({SQL_PAIRS})""")
def q_select_prompt_response(spark, sf):
    p = tables.pairs(spark, sf).withColumnRenamed("prompt", "input") \
        .withColumnRenamed("response", "target")
    out = templates.select_prompt_response(p, "input", "target", keep=["example_id"])
    return out.select(_big("example_id"), "prompt", "response")


@register("assemble_prompt", """
SELECT CAST(l.doc_id AS BIGINT) AS doc_id,
       md5('Is this text of good quality?' || d.text) AS prompt_md5,
       CAST(length('Is this text of good quality?' || d.text) AS BIGINT) AS prompt_chars,
       CASE WHEN l.quality = 1 THEN 'yes' ELSE 'no' END AS target
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def q_assemble_prompt(spark, sf):
    c = templates.assemble_prompt(tables.classify(spark, sf))
    return c.select(_big("doc_id"), F.md5("prompt").alias("prompt_md5"),
                    F.length("prompt").cast("bigint").alias("prompt_chars"), "target")


def _pair_layout(spark, sf, mask_pad=False):
    p = tables.pairs(spark, sf)
    return layouts.pair_layout(p, SOURCE_LEN, TARGET_LEN, PROFILE.bos_id, PROFILE.eos_id,
                               PROFILE.pad_id, mask_pad_labels=mask_pad, keep=["example_id"])


@register("pair_layout_rows", sql_pair_layout(False))
def q_pair_layout_rows(spark, sf):
    x = layouts.explode_positions(_pair_layout(spark, sf), "example_id", ["input_ids", "labels"])
    return x.select(_big("example_id"), "pos", F.col("input_ids").alias("input_id"),
                    F.col("labels").alias("label"))


def _pair_stats_sql(mask_pad: bool) -> str:
    return f"""
WITH r AS ({sql_pair_layout(mask_pad)})
SELECT example_id, CAST(count(*) AS BIGINT) AS seq_len,
       CAST(sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS BIGINT) AS n_supervised,
       CAST(sum(CASE WHEN label > -100 THEN label ELSE 0 END) AS BIGINT) AS label_sum,
       CAST(sum(input_id) AS BIGINT) AS ids_sum
FROM r GROUP BY example_id"""


def _pair_stats(df: DataFrame) -> DataFrame:
    sup = F.filter("labels", lambda v: v > F.lit(IGNORE_INDEX))
    return df.select(
        _big("example_id"), F.size("input_ids").cast("bigint").alias("seq_len"),
        F.size(sup).cast("bigint").alias("n_supervised"),
        F.aggregate(sup, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("label_sum"),
        F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("ids_sum"))


@register("pair_layout_stats", _pair_stats_sql(False))
def q_pair_layout_stats(spark, sf):
    return _pair_stats(_pair_layout(spark, sf))


@register("pair_layout_mask_pad", _pair_stats_sql(True))
def q_pair_layout_mask_pad(spark, sf):
    return _pair_stats(_pair_layout(spark, sf, mask_pad=True))


@register("pair_layout_null_bos", f"""
WITH r AS ({sql_pair_layout(False, b=0, e=2, p=0)})
SELECT example_id, CAST(count(*) AS BIGINT) AS seq_len,
       CAST(sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS BIGINT) AS n_supervised,
       CAST(sum(CASE WHEN label > -100 THEN label ELSE 0 END) AS BIGINT) AS label_sum,
       CAST(sum(input_id) AS BIGINT) AS ids_sum
FROM r GROUP BY example_id""")
def q_pair_layout_null_bos(spark, sf):
    """A profile without a begin id (F-null-1): 0 is written in its place."""
    prof = resolve_profile("m/chatglm2-6b", "glm")
    assert prof.bos_id is None
    return _pair_stats(layouts.pair_layout(tables.pairs(spark, sf), SOURCE_LEN, TARGET_LEN, prof.bos_id, prof.eos_id,
                                           prof.pad_id, keep=["example_id"]))


def _chat_rows(turns: DataFrame) -> DataFrame:
    lay = layouts.chat_layout(turns, CHAT_LEN, PROFILE.eos_id, HUMAN_ROLES)
    x = layouts.explode_positions(lay, "conv_id", ["input_ids", "labels", "attention_mask"])
    return x.select(_big("conv_id"), "pos", F.col("input_ids").alias("input_id"),
                    F.col("labels").alias("label"), F.col("attention_mask").alias("attention"))


@register("chat_layout_rows", sql_chat_rows())
def q_chat_layout_rows(spark, sf):
    return _chat_rows(tables.turns(spark, sf))


@register("chat_fallback", sql_chat_rows("WHERE lower(role) = 'user'"))
def q_chat_fallback(spark, sf):
    t = tables.turns(spark, sf)
    return _chat_rows(t.filter(F.lower("role") == "user"))


@register("chat_layout_stats", f"""
WITH {sql_chat_tokens()},
full_len AS (SELECT conv_id, count(*) AS n_turns, sum(len(ids)) AS n_tokens FROM s GROUP BY conv_id),
lay AS (SELECT conv_id, count(*) AS seq_len, sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS n_sup
        FROM f GROUP BY conv_id)
SELECT CAST(a.conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns,
       CAST(n_tokens AS BIGINT) AS n_tokens, CAST(seq_len AS BIGINT) AS seq_len,
       CAST(n_sup AS BIGINT) AS n_supervised,
       CAST(n_tokens > {CHAT_LEN - 1} AS BIGINT) AS truncated
FROM full_len a JOIN lay b ON a.conv_id = b.conv_id""")
def q_chat_layout_stats(spark, sf):
    t = tables.turns(spark, sf)
    h = is_human("role", HUMAN_ROLES)
    # Code-point tokens of a text = its length in code points: a native
    # function instead of encoding every turn just to count.
    n_tok = F.length(human_template(F.col("value"), h)) + F.when(h, 0).otherwise(1)
    full = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"),
                                    F.sum(n_tok).alias("n_tokens"))
    lay = layouts.chat_layout(t, CHAT_LEN, PROFILE.eos_id, HUMAN_ROLES)
    lay = lay.select("conv_id", F.size("input_ids").alias("seq_len"),
                     F.size(F.filter("labels", lambda v: v > F.lit(IGNORE_INDEX))).alias("n_supervised"))
    return full.join(lay, "conv_id").select(
        _big("conv_id"), _big("n_turns"), _big("n_tokens"), _big("seq_len"), _big("n_supervised"),
        (F.col("n_tokens") > CHAT_LEN - 1).cast("bigint").alias("truncated"))


SQL_SHUFFLE = f"""
  SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos
  FROM documents"""


@register("shuffle_order", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pos AS BIGINT) AS pos FROM ({SQL_SHUFFLE})""")
def q_shuffle_order(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    return ordering.shuffled_positions(d, "doc_id", SEED).select(_big("doc_id"), "pos")


_PER_STEP = DEVICES * PER_DEVICE_BATCH * GRAD_ACCUM


@register("step_plan", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pos AS BIGINT) AS pos,
       CAST(pos // {_PER_STEP} AS BIGINT) AS step,
       CAST((pos % {_PER_STEP}) % {DEVICES} AS BIGINT) AS rank,
       CAST(((pos % {_PER_STEP}) // {DEVICES}) // {PER_DEVICE_BATCH} AS BIGINT) AS micro
FROM ({SQL_SHUFFLE}) WHERE pos // {_PER_STEP} < {MAX_STEPS}""")
def q_step_plan(spark, sf):
    """The stop after MAX_STEPS steps is the subject; ``step_plan_all`` plans every row."""
    d = tables.table(spark, sf, "documents").select("doc_id")
    s = ordering.step_plan(d, "doc_id", SEED, DEVICES, PER_DEVICE_BATCH, GRAD_ACCUM, MAX_STEPS)
    return s.select(_big("doc_id"), "pos", _big("step"), _big("rank"), _big("micro"))


@register("step_plan_all", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pos AS BIGINT) AS pos,
       CAST(pos // {_PER_STEP} AS BIGINT) AS step,
       CAST((pos % {_PER_STEP}) % {DEVICES} AS BIGINT) AS rank,
       CAST(((pos % {_PER_STEP}) // {DEVICES}) // {PER_DEVICE_BATCH} AS BIGINT) AS micro
FROM ({SQL_SHUFFLE})""")
def q_step_plan_all(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    s = ordering.step_plan(d, "doc_id", SEED, DEVICES, PER_DEVICE_BATCH, GRAD_ACCUM)
    return s.select(_big("doc_id"), "pos", _big("step"), _big("rank"), _big("micro"))


@register("collate_rows", f"""
WITH {sql_chat_tokens()},
ex AS (SELECT conv_id, count(*) AS seq_len, sum(id) AS ids_sum,
              sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS n_sup
       FROM f GROUP BY conv_id),
o AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(conv_id AS VARCHAR)), conv_id) - 1 AS pos
      FROM ex),
b AS (SELECT *, pos // {_PER_STEP} AS step, (pos % {_PER_STEP}) % {DEVICES} AS rank,
             ((pos % {_PER_STEP}) // {DEVICES}) // {PER_DEVICE_BATCH} AS micro FROM o),
m AS (SELECT *, CAST(ceil(max(seq_len) OVER (PARTITION BY step, rank, micro) / 8.0) * 8 AS BIGINT) AS padded_len
      FROM b)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(step AS BIGINT) AS step, CAST(rank AS BIGINT) AS rank,
       CAST(micro AS BIGINT) AS micro, padded_len, CAST(seq_len AS BIGINT) AS seq_len,
       CAST(ids_sum + (padded_len - seq_len) * 1 AS BIGINT) AS ids_sum,
       CAST(n_sup AS BIGINT) AS n_supervised, CAST(seq_len AS BIGINT) AS mask_sum,
       CAST((padded_len - seq_len) * -100 + 0 AS BIGINT) AS pad_label_sum
FROM m""")
def q_collate_rows(spark, sf):
    turns = tables.turns(spark, sf)
    lay = layouts.chat_layout(turns, CHAT_LEN, PROFILE.eos_id, HUMAN_ROLES)
    # Made and written once; lengths and arrays are read back from there.
    lay = materialize(lay.withColumn("seq_len", F.size("input_ids")), how="table")
    thin = lay.select("conv_id", F.col("seq_len").alias("_len"))
    steps = ordering.step_plan(thin, "conv_id", SEED, DEVICES, PER_DEVICE_BATCH, GRAD_ACCUM)
    c = ordering.collate_thin(lay, steps, "conv_id", "_len", PROFILE.pad_id)
    pads = F.slice("labels", F.col("seq_len") + 1, F.lit(1 << 20))
    return c.select(
        _big("conv_id"), _big("step"), _big("rank"), _big("micro"), _big("padded_len"),
        _big("seq_len"), _array_sum(F.col("input_ids")).alias("ids_sum"),
        F.size(F.filter("labels", lambda v: v > F.lit(IGNORE_INDEX))).cast("bigint").alias("n_supervised"),
        _array_sum(F.col("attention_mask")).alias("mask_sum"), _array_sum(pads).alias("pad_label_sum"))


@register("head_limit", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(text) AS BIGINT) AS n_chars
FROM documents ORDER BY doc_id LIMIT {HEAD_LIMIT}""")
def q_head_limit(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    h = ordering.head_by_ordinal(d, "doc_id", HEAD_LIMIT)
    return h.select(_big("doc_id"), F.length("text").cast("bigint").alias("n_chars"))


@register("strip_prompt", f"""
SELECT CAST(example_id AS BIGINT) AS example_id,
       md5(replace(prompt || response || prompt, prompt, '')) AS stripped_md5,
       CAST(length(replace(prompt || response || prompt, prompt, '')) AS BIGINT) AS stripped_chars
FROM ({SQL_PAIRS})""")
def q_strip_prompt(spark, sf):
    p = tables.pairs(spark, sf)
    s = strip_prompt(F.concat("prompt", "response", "prompt"), F.col("prompt"))
    return p.select(_big("example_id"), F.md5(s).alias("stripped_md5"),
                    F.length(s).cast("bigint").alias("stripped_chars"))


# ------------------------------------------------------------ vocabularies

VOCAB_SIZE = vocab.DEFAULT_VOCAB_SIZE
N_FIXED = len(vocab.SPECIAL_PIECES) + len(vocab.DEFAULT_USER_SYMBOLS)
BASE_LANG = "en"
TOP_PAIRS = 100
BPE_MERGES = 20
# Size of the ``bpe_vocab`` query; its SQL unrolls BPE_ROUNDS merges, more than the size leaves.
BPE_VOCAB, BPE_ROUNDS = 120, 60

# Written out, apart from the constants they check.
SQL_FIXED = ("('<unk>', 0, 0, 'special'), ('<s>', 1, 0, 'special'), ('</s>', 2, 0, 'special'), "
             "('<sepra>', 3, 0, 'user_defined')")
SQL_WORDS = (f"SELECT doc_id, lang, unnest(ws) AS word, unnest(generate_series(0, len(ws) - 1)) AS pos "
             f"FROM (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '{WHITESPACE_CLASS}+'), "
             f"lambda w: w <> '') AS ws FROM documents)")
SQL_WORD_VOCAB = f"""
wc AS (SELECT word, count(*) AS n FROM ({SQL_WORDS}) GROUP BY word),
wr AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS rank FROM wc),
v AS (SELECT token, id, score, kind FROM (VALUES {SQL_FIXED}) f(token, id, score, kind)
      UNION ALL SELECT '{WORD_MARK}' || word, rank + {N_FIXED}, -rank, 'normal' FROM wr
      WHERE rank < {VOCAB_SIZE - N_FIXED})"""
SQL_LANG_VOCABS = f"""
wc AS (SELECT lang, word, count(*) AS n FROM ({SQL_WORDS}) GROUP BY lang, word),
wr AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) - 1 AS rank FROM wc),
langs AS (SELECT DISTINCT lang FROM documents),
lv AS (SELECT lang, token, id, score, kind FROM langs, (VALUES {SQL_FIXED}) f(token, id, score, kind)
       UNION ALL SELECT lang, '{WORD_MARK}' || word, rank + {N_FIXED}, -rank, 'normal' FROM wr
       WHERE rank < {VOCAB_SIZE - N_FIXED}),
base AS (SELECT token, id, score, kind FROM lv WHERE lang = '{BASE_LANG}'),
src AS (SELECT token, id AS ord, dense_rank() OVER (ORDER BY lang) AS source FROM lv WHERE lang <> '{BASE_LANG}'),
fresh AS (SELECT token, source, ord FROM (
            SELECT token, source, ord, row_number() OVER (PARTITION BY token ORDER BY source, ord) AS rn
            FROM src WHERE token NOT IN (SELECT token FROM base)) WHERE rn = 1),
merged AS (SELECT token, id, score, kind, 0 AS source FROM base
           UNION ALL
           SELECT token, (SELECT count(*) FROM base) + row_number() OVER (ORDER BY source, ord) - 1,
                  0, 'normal', source FROM fresh)"""


def _documents_corpus(spark, sf, *cols):
    return tables.table(spark, sf, "documents", spread=True).select(*cols, F.col("text").alias("value"))


def _vocab_out(v: DataFrame) -> DataFrame:
    return v.select("token", _big("id"), F.col("score").cast("bigint").alias("score"), "kind")


@register("char_coverage", f"""
WITH c AS (SELECT ch, count(*) AS n FROM (
             SELECT unnest(string_split(regexp_replace(text, '{WHITESPACE_CLASS}', '', 'g'), '')) AS ch
             FROM documents) WHERE ch <> '' GROUP BY ch),
r AS (SELECT ch, n, row_number() OVER (ORDER BY n DESC, ch) - 1 AS rank,
             coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS before, sum(n) OVER () AS total FROM c)
SELECT ch, CAST(n AS BIGINT) AS n, CAST(rank AS BIGINT) AS rank,
       CAST(before * 10000 < total * 9995 AS BIGINT) AS kept FROM r""")
def q_char_coverage(spark, sf):
    c = vocab.char_coverage(vocab.char_counts(_documents_corpus(spark, sf)), 0.9995)
    return c.select("ch", _big("n"), _big("rank"), F.col("kept").cast("bigint").alias("kept"))


@register("char_vocab", f"""
WITH c AS (SELECT ch, count(*) AS n FROM (
             SELECT unnest(string_split(regexp_replace(text, '{WHITESPACE_CLASS}', '', 'g'), '')) AS ch
             FROM documents) WHERE ch <> '' GROUP BY ch),
r AS (SELECT ch, n, row_number() OVER (ORDER BY n DESC, ch) - 1 AS rank,
             coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS before, sum(n) OVER () AS total FROM c)
SELECT token, CAST(id AS BIGINT) AS id, CAST(score AS BIGINT) AS score, kind FROM (
  SELECT * FROM (VALUES {SQL_FIXED}) f(token, id, score, kind)
  UNION ALL SELECT ch, rank + {N_FIXED}, -rank, 'normal' FROM r
  WHERE before * 10000 < total * 9995 AND rank < {VOCAB_SIZE - N_FIXED})""")
def q_char_vocab(spark, sf):
    return _vocab_out(vocab.char_vocab(_documents_corpus(spark, sf), vocab_size=VOCAB_SIZE))


@register("word_vocab", f"""
WITH {SQL_WORD_VOCAB}
SELECT token, CAST(id AS BIGINT) AS id, CAST(score AS BIGINT) AS score, kind FROM v""")
def q_word_vocab(spark, sf):
    return _vocab_out(vocab.word_vocab(_documents_corpus(spark, sf), vocab_size=VOCAB_SIZE))


@register("pair_frequency", f"""
WITH wc AS (SELECT word, count(*) AS n FROM ({SQL_WORDS}) GROUP BY word),
s AS (SELECT n, list_concat(['{WORD_MARK}'], string_split(word, '')) AS sym FROM wc),
p AS (SELECT sym[i] AS a, sym[i + 1] AS b, n FROM (
        SELECT sym, n, unnest(generate_series(1, len(sym) - 1)) AS i FROM s))
SELECT a, b, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY a, b""")
def q_pair_frequency(spark, sf):
    pc = vocab.pair_counts(vocab.bpe_words(_documents_corpus(spark, sf)))
    return pc.select("a", "b", _big("n"))


@register("pair_frequency_top", f"""
WITH wc AS (SELECT word, count(*) AS n FROM ({SQL_WORDS}) GROUP BY word),
s AS (SELECT n, list_concat(['{WORD_MARK}'], string_split(word, '')) AS sym FROM wc),
p AS (SELECT sym[i] AS a, sym[i + 1] AS b, n FROM (
        SELECT sym, n, unnest(generate_series(1, len(sym) - 1)) AS i FROM s))
SELECT a, b, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY a, b ORDER BY n DESC, a, b LIMIT {TOP_PAIRS}""")
def q_pair_frequency_top(spark, sf):
    pc = vocab.pair_counts(vocab.bpe_words(_documents_corpus(spark, sf)))
    return vocab.top_k(pc, TOP_PAIRS, [F.col("n").desc(), "a", "b"]).select("a", "b", _big("n"))


def sql_bpe_rounds(rounds: int) -> str:
    """The first ``rounds`` greedy merges, one after the other. A symbol is written
    chr(1) || symbol || chr(2), so ``replace`` merges left to right without overlaps."""
    open_, close = "chr(1)", "chr(2)"
    sql = [f"""
wc AS (SELECT word, count(*) AS n FROM ({SQL_WORDS}) GROUP BY word),
w0 AS MATERIALIZED (SELECT {open_} || array_to_string(list_concat(['{WORD_MARK}'], string_split(word, '')),
                    {close} || {open_}) || {close} AS sym, n FROM wc)"""]
    for r in range(rounds):
        sql.append(f"""
p{r} AS (SELECT sym, n, string_split(sym[2:len(sym) - 1], {close} || {open_}) AS l FROM w{r}),
b{r} AS MATERIALIZED (SELECT {r} AS rank, a, b, sum(n) AS n FROM (
        SELECT l[i] AS a, l[i + 1] AS b, n FROM (SELECT l, n, unnest(generate_series(1, len(l) - 1)) AS i FROM p{r}))
      GROUP BY a, b ORDER BY n DESC, a, b LIMIT 1),
w{r + 1} AS MATERIALIZED (SELECT coalesce(replace(sym, {open_} || a || {close} || {open_} || b || {close},
                          {open_} || a || b || {close}), sym) AS sym, w{r}.n FROM w{r} LEFT JOIN b{r} ON true)""")
    merges = " UNION ALL ".join(f"SELECT * FROM b{r}" for r in range(rounds))
    return ",".join(sql) + f",\nmerges AS (SELECT * FROM ({merges}))"


@register("bpe_merges", f"""
WITH {sql_bpe_rounds(BPE_MERGES)}
SELECT CAST(rank AS BIGINT) AS rank, a, b, CAST(n AS BIGINT) AS n FROM merges""")
def q_bpe_merges(spark, sf):
    m = vocab.bpe_merges(_documents_corpus(spark, sf), BPE_MERGES)
    return m.select(_big("rank"), "a", "b", _big("n"))


# The word mark is a character of every word; the covered characters come first in the count.
SQL_BPE_CHARS = f"""
cc AS (SELECT ch, count(*) AS n FROM (
         SELECT unnest(string_split(regexp_replace(text, '{WHITESPACE_CLASS}', '', 'g'), '')) AS ch FROM documents)
       WHERE ch <> '' AND ch <> '{WORD_MARK}' GROUP BY ch
       UNION ALL SELECT '{WORD_MARK}', sum(n) FROM wc),
cr AS (SELECT ch, row_number() OVER (ORDER BY n DESC, ch) - 1 AS rank,
              coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
              sum(n) OVER () AS total FROM cc),
ck AS (SELECT ch, rank FROM cr WHERE before * 10000 < total * 9995)"""


@register("bpe_vocab", f"""
WITH {sql_bpe_rounds(BPE_ROUNDS)}, {SQL_BPE_CHARS},
mt AS (SELECT a || b AS token, min(rank) AS first FROM merges
       WHERE rank < {BPE_VOCAB} - 4 - (SELECT count(*) FROM ck) GROUP BY token),
mr AS (SELECT token, row_number() OVER (ORDER BY first) - 1 AS rank FROM mt),
cf AS (SELECT ch, row_number() OVER (ORDER BY rank) - 1 + (SELECT count(*) FROM mr) AS rank
       FROM ck WHERE ch NOT IN (SELECT token FROM mr)),
v AS (SELECT * FROM (VALUES ('<unk>', 0, 0, 'special'), ('<s>', 1, 0, 'special'), ('</s>', 2, 0, 'special'),
                            ('<sepra>', 3, 0, 'user_defined')) f(token, id, score, kind)
      UNION ALL SELECT token, rank + 4, -rank, 'normal' FROM mr
      UNION ALL SELECT ch, rank + 4, -rank, 'normal' FROM cf)
SELECT token, CAST(id AS BIGINT) AS id, CAST(score AS BIGINT) AS score, kind FROM v""")
def q_bpe_vocab(spark, sf):
    """A vocabulary sized by its characters first: the rest of BPE_VOCAB is merges."""
    return _vocab_out(vocab.bpe_vocab(_documents_corpus(spark, sf), BPE_VOCAB))


def _lang_vocabs(spark, sf):
    """Word vocabulary per language; base = en, sources numbered by language name."""
    corpus = _documents_corpus(spark, sf, "lang")
    # The per-language vocabularies (at most languages x VOCAB_SIZE rows) feed
    # several branches: computed once, lineage cut.
    lv = materialize(vocab.word_vocabs_by(corpus, "lang", vocab_size=VOCAB_SIZE))
    base = lv.filter(F.col("lang") == BASE_LANG).drop("lang")
    langs = lv.select("lang").distinct().filter(F.col("lang") != BASE_LANG)
    # One row per language: ranking them as a whole is bounded by the language count.
    langs = langs.withColumn("source", F.dense_rank().over(Window.orderBy("lang")))
    sources = lv.join(F.broadcast(langs), "lang").select("token", F.col("id").alias("ord"), "source")
    return base, sources


@register("merge_vocab", f"""
WITH {SQL_LANG_VOCABS}
SELECT token, CAST(id AS BIGINT) AS id, CAST(score AS BIGINT) AS score, kind,
       CAST(source AS BIGINT) AS source FROM merged""")
def q_merge_vocab(spark, sf):
    base, sources = _lang_vocabs(spark, sf)
    m = vocab.merge_vocabs(base, sources)
    return m.select("token", _big("id"), F.col("score").cast("bigint").alias("score"), "kind",
                    _big("source"))


@register("merge_report", f"""
WITH {SQL_LANG_VOCABS},
sizes AS (SELECT 0 AS source, count(*) AS n_pieces FROM base
          UNION ALL SELECT source, count(*) FROM src GROUP BY source),
added AS (SELECT source, count(*) AS n_added FROM merged GROUP BY source)
SELECT CAST(s.source AS BIGINT) AS source, CAST(n_pieces AS BIGINT) AS n_pieces,
       CAST(coalesce(n_added, 0) AS BIGINT) AS n_added
FROM sizes s LEFT JOIN added a ON s.source = a.source""")
def q_merge_report(spark, sf):
    base, sources = _lang_vocabs(spark, sf)
    r = vocab.merge_report(base, sources, vocab.merge_vocabs(base, sources))
    return r.select(_big("source"), _big("n_pieces"), _big("n_added"))


def _word_vocab_docs(spark, sf):
    return materialize(vocab.word_vocab(_documents_corpus(spark, sf), vocab_size=VOCAB_SIZE))


@register("encode_word", f"""
WITH {SQL_WORD_VOCAB},
t AS ({SQL_WORDS}),
j AS (SELECT t.doc_id, t.pos, coalesce(v.id, {vocab.UNK_ID}) AS id, v.id IS NULL AS unk
      FROM t LEFT JOIN v ON v.token = '{WORD_MARK}' || t.word)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(count(j.pos) AS BIGINT) AS n_tokens,
       CAST(coalesce(sum(CAST(j.unk AS INT)), 0) AS BIGINT) AS n_unk,
       CAST(coalesce(sum(j.id), 0) AS BIGINT) AS id_sum,
       CAST(coalesce(sum(j.pos * j.id), 0) AS BIGINT) AS pos_id_sum
FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id GROUP BY d.doc_id""")
def q_encode_word(spark, sf):
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    ids = encode.encode_words(docs, "doc_id", "text", _word_vocab_docs(spark, sf))
    return ids.select(
        _big("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
        F.size(F.filter("ids", lambda v: v == vocab.UNK_ID)).cast("bigint").alias("n_unk"),
        _array_sum(F.col("ids")).alias("id_sum"),
        _array_sum(F.transform("ids", lambda v, i: v.cast("bigint") * i)).alias("pos_id_sum"))


@register("decode_word", f"""
WITH {SQL_WORD_VOCAB},
t AS ({SQL_WORDS}),
k AS (SELECT t.doc_id, t.pos, t.word FROM t JOIN v ON v.token = '{WORD_MARK}' || t.word),
g AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS txt, count(*) AS n FROM k GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, md5(coalesce(g.txt, '')) AS text_md5,
       CAST(length(coalesce(g.txt, '')) AS BIGINT) AS n_chars
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id""")
def q_decode_word(spark, sf):
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    v = _word_vocab_docs(spark, sf)
    ids = encode.encode_words(docs, "doc_id", "text", v)
    txt = encode.decode_ids(ids, "doc_id", "ids", v, skip_special=True)
    return txt.select(_big("doc_id"), F.md5("text").alias("text_md5"),
                      F.length("text").cast("bigint").alias("n_chars"))


@register("tokenizer_compare", f"""
WITH {SQL_LANG_VOCABS},
t AS ({SQL_WORDS})
SELECT t.lang, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(sum(CASE WHEN b.token IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unk_base,
       CAST(sum(CASE WHEN m.token IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unk_merged
FROM t LEFT JOIN base b ON b.token = '{WORD_MARK}' || t.word
       LEFT JOIN merged m ON m.token = '{WORD_MARK}' || t.word
GROUP BY t.lang""")
def q_tokenizer_compare(spark, sf):
    base, sources = _lang_vocabs(spark, sf)
    merged = materialize(vocab.merge_vocabs(base, sources).drop("source"))
    docs = tables.table(spark, sf, "documents", spread=True).select("lang", "text")
    # Both vocabularies are capped (languages x VOCAB_SIZE rows): no token leaves its row.
    return reports.vocab_comparison(docs, "lang", "text", {
        "base": encode.dictionary(base), "merged": encode.dictionary(merged)})


# ----------------------------------------------------- reports, prediction, io


@register("split_counts", """
SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM documents GROUP BY source""")
def q_split_counts(spark, sf):
    d = tables.table(spark, sf, "documents").select("source", "text")
    return reports.split_counts(d, "source").select("source", _big("n_rows"), _big("n_chars"))


@register("corpus_union", f"""
WITH u AS (SELECT 'documents' AS origin, text AS value FROM documents
           UNION ALL SELECT 'benchmark', text FROM benchmark)
SELECT origin, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(value)) AS BIGINT) AS n_chars,
       CAST(sum(len(list_filter(regexp_split_to_array(value, '{WHITESPACE_CLASS}+'), lambda w: w <> '')))
            AS BIGINT) AS n_words
FROM u GROUP BY origin""")
def q_corpus_union(spark, sf):
    parts = {"documents": tables.table(spark, sf, "documents", spread=True).select(F.col("text").alias("value")),
             "benchmark": tables.table(spark, sf, "benchmark").select(F.col("text").alias("value"))}
    r = reports.corpus_union(parts)
    return r.select("origin", _big("n_rows"), _big("n_chars"), _big("n_words"))


@register("batch_predict", f"""
SELECT CAST(example_id AS BIGINT) AS example_id, md5(prompt) AS prompt_md5,
       md5(replace(prompt || reverse(prompt), prompt, '')) AS prediction_md5,
       CAST(length(replace(prompt || reverse(prompt), prompt, '')) AS BIGINT) AS prediction_chars
FROM ({SQL_PAIRS})""")
def q_batch_predict(spark, sf):
    p = tables.pairs(spark, sf).select("example_id", "prompt")
    r = predict.batch_predict(p, "prompt", predict.echo_reverse)
    return r.select(_big("example_id"), F.md5("prompt").alias("prompt_md5"),
                    F.md5("prediction").alias("prediction_md5"),
                    F.length("prediction").cast("bigint").alias("prediction_chars"))


@register("txt_predict_columns", """
SELECT text AS "Input", replace(text || reverse(text), text, '') AS "Output" FROM benchmark""")
def q_txt_predict_columns(spark, sf):
    b = tables.table(spark, sf, "benchmark").select(F.col("text").alias("value"))
    r = predict.batch_predict(b, "value", predict.echo_reverse)
    return txt_output(r, "value", "prediction")


@register("jsonl_roundtrip", """
SELECT CAST(item_id AS BIGINT) AS item_id, text FROM benchmark""")
def q_jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "jsonl-roundtrip")
    sinks.write_predictions(tables.table(spark, sf, "benchmark").select("item_id", "text"), path)
    back = readers.read_json(spark, path, readers.BENCHMARK_SCHEMA)
    valid, _ = readers.split_valid(back, ["item_id"])
    return valid.select(_big("item_id"), "text")


@register("txt_prompt_roundtrip", """
SELECT 'it''s' || chr(9) || '"q" \\ ' || chr(233) || ' ' || text || chr(10) AS value FROM benchmark""")
def q_txt_prompt_roundtrip(spark, sf):
    path = scratch_path(spark, "txt-roundtrip") + ".txt"
    b = tables.table(spark, sf, "benchmark")
    # One string literal per line, every other one in single quotes, with escapes in both.
    text = F.concat(F.lit("it's\t\"q\" \\ \u00e9 "), "text", F.lit("\n"))
    double = F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)
    inner = F.substring(double, F.lit(2), F.length(double) - 2)
    single = F.concat(F.lit("'"), F.replace(F.replace(inner, F.lit("'"), F.lit("\\'")), F.lit("\u00e9"),
                                            F.lit("\\u00e9")), F.lit("'"))
    b.select(F.when(F.col("item_id") % 2 == 0, double).otherwise(single).alias("value")).write.text(path)
    prompts, _ = readers.read_prompts_txt(spark, path)
    return prompts


# ------------------------------------------------- offsets, round trips, pieces


@register("turn_offsets", f"""
WITH {sql_chat_tokens()}
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, CAST(start AS BIGINT) AS start,
       CAST(len(ids) AS BIGINT) AS n_tok, CAST(least(len(ids), {CHAT_LEN - 1} - start) AS BIGINT) AS kept,
       CAST(sup AS BIGINT) AS supervised
FROM s WHERE start < {CHAT_LEN - 1}""")
def q_turn_offsets(spark, sf):
    t = layouts.chat_turn_tokens(tables.turns(spark, sf), CHAT_LEN, PROFILE.eos_id, HUMAN_ROLES)
    return t.select(_big("conv_id"), _big("turn"), _big("start"), _big("n_tok"),
                    F.size("tok_ids").cast("bigint").alias("kept"),
                    F.col("sup").cast("bigint").alias("supervised"))


@register("codepoint_roundtrip", """
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(text) AS BIGINT) AS n_tokens,
       CAST(1 AS BIGINT) AS roundtrip_ok
FROM documents""")
def q_codepoint_roundtrip(spark, sf):
    d = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    ids = d.select("doc_id", "text", codepoints(F.col("text")).alias("ids"))
    return ids.select(_big("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
                      (codepoints_decode(F.col("ids")) == F.col("text")).cast("bigint").alias("roundtrip_ok"))


# A small subword vocabulary, in the order of its merges: (left, right). No later
# piece can make an earlier one, so SQL applies them one after the other.
PIECE_MERGES = (("t", "h"), ("i", "n"), ("e", "r"), ("a", "n"), ("r", "e"), ("o", "n"), ("e", "n"), ("d", "e"),
                ("\u2581", "th"), ("in", "g"), ("\u2581", "an"))
PIECE_CHARS = "\u2581abcdefghijklmnopqrstuvwxyz.,"


def _fixed_piece_vocab(spark):
    pieces = [a + b for a, b in PIECE_MERGES] + list(PIECE_CHARS)
    rows = [(t, i + N_FIXED, -float(i), "normal") for i, t in enumerate(pieces)]
    return vocab.fixed_pieces(spark).unionByName(spark.createDataFrame(rows, vocab.VOCAB_SCHEMA))


def sql_pieces(table: str, key: str) -> str:
    """``t(<key>, id)``: the piece ids of every word of ``table.text`` by the fixed vocabulary."""
    sym = f"chr(1) || array_to_string(list_concat(['{WORD_MARK}'], string_split(word, '')), chr(2) || chr(1)) || chr(2)"
    for a, b in PIECE_MERGES:
        sym = f"replace({sym}, chr(1) || '{a}' || chr(2) || chr(1) || '{b}' || chr(2), chr(1) || '{a}{b}' || chr(2))"
    ids = ", ".join(f"('{t}', {i + 4})" for i, t in enumerate([a + b for a, b in PIECE_MERGES] + list(PIECE_CHARS)))
    return f"""
wd AS (SELECT {key}, unnest(list_filter(regexp_split_to_array(text, '{WHITESPACE_CLASS}+'), lambda w: w <> '')) AS word
       FROM {table}),
sy AS (SELECT {key}, {sym} AS sym FROM wd),
sp AS (SELECT {key}, unnest(string_split(sym[2:len(sym) - 1], chr(2) || chr(1))) AS piece FROM sy),
t AS (SELECT {key}, coalesce(v.id, 0) AS id FROM sp LEFT JOIN (VALUES {ids}) v(piece, id) USING (piece))"""


@register("encode_piece", f"""
WITH {sql_pieces('documents', 'doc_id')}
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(count(t.id) AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (t.id = 0) AS BIGINT) AS n_unk, CAST(coalesce(sum(t.id), 0) AS BIGINT) AS id_sum
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id GROUP BY d.doc_id""")
def q_encode_piece(spark, sf):
    """V6 with a subword vocabulary over every document."""
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    ids = encode.encode_pieces(docs, "doc_id", "text", _fixed_piece_vocab(spark))
    return ids.select(_big("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
                      F.size(F.filter("ids", lambda x: x == vocab.UNK_ID)).cast("bigint").alias("n_unk"),
                      _array_sum(F.col("ids")).alias("id_sum"))


# ------------------------------------------------------------ model lengths
# The encoder of each family in the query; the ids the report must show are written out in its SQL.
FAMILY_ENCODERS = {"llama": "piece", "glm": "codepoint", "bloom": "word", "pythia": "codepoint",
                   "baichuan": "codepoint", "auto": "codepoint"}


@register("model_lengths", f"""
WITH {sql_pieces('(SELECT item_id, text FROM benchmark)', 'item_id')},
flat AS (SELECT item_id, text, array_to_string(list_filter(regexp_split_to_array(text, '{WHITESPACE_CLASS}+'),
                                                          lambda w: w <> ''), ' ') AS plain,
                len(list_filter(regexp_split_to_array(text, '{WHITESPACE_CLASS}+'), lambda w: w <> '')) AS n_words
         FROM benchmark),
unk AS (SELECT item_id, count(*) AS n, count(*) FILTER (id = 0) AS n_unk FROM t GROUP BY item_id),
a AS (SELECT 'codepoint' AS encoder, sum(length(text)) AS n_tokens, count(*) AS n_roundtrip FROM benchmark
      UNION ALL SELECT 'word', sum(n_words), count(*) FILTER (text = plain) FROM flat
      UNION ALL SELECT 'piece', sum(coalesce(n, 0)), count(*) FILTER (text = plain AND coalesce(n_unk, 0) = 0)
      FROM flat LEFT JOIN unk USING (item_id)),
p(model_name, encoder, bos_id, eos_id, pad_id) AS (VALUES
  ('open_llama_7b', 'piece', 1, 2, 0),
  ('open_llama_13b', 'piece', 1, 2, 0),
  ('chinese-alpaca-13b', 'piece', 1, 2, 49953),
  ('chatglm2-6b', 'codepoint', NULL, 2, 0),
  ('baichuan-7B', 'codepoint', 1, 2, 0),
  ('Baichuan-13B-Base', 'codepoint', 1, 2, 0),
  ('Baichuan-13B-Chat', 'codepoint', 1, 2, 0),
  ('bloomz-7b1', 'word', 1, 2, 3),
  ('bloomz-1b7', 'word', 1, 2, 3),
  ('tigerbot-7b-sft', 'word', 1, 2, 3),
  ('tigerbot-7b-base', 'word', 1, 2, 3),
  ('pythia-12b-deduped', 'codepoint', 0, 0, 1),
  ('pythia-12b-sft-v8-7k-steps', 'codepoint', 0, 0, 1),
  ('pythia-1b-deduped', 'codepoint', 0, 0, 1))
SELECT model_name, CAST(bos_id AS BIGINT) AS bos_id, CAST(eos_id AS BIGINT) AS eos_id,
       CAST(pad_id AS BIGINT) AS pad_id, (SELECT count(*) FROM benchmark) AS n_texts,
       CAST((SELECT sum(length(text)) FROM benchmark) AS BIGINT) AS n_chars,
       CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_roundtrip AS BIGINT) AS n_roundtrip
FROM p JOIN a USING (encoder)""")
def q_model_lengths(spark, sf):
    b = tables.table(spark, sf, "benchmark").select("text")
    word = materialize(vocab.word_vocab(b.select(F.col("text").alias("value")), vocab_size=VOCAB_SIZE))
    r = reports.model_lengths(b, encoders=FAMILY_ENCODERS,
                              vocabularies={"word": word, "piece": _fixed_piece_vocab(spark)})
    return r.select("model_name", _big("bos_id"), _big("eos_id"), _big("pad_id"), _big("n_texts"),
                    _big("n_chars"), _big("n_tokens"), _big("n_roundtrip"))


# ------------------------------------------------------ training data, whole path
@register("pair_batches", f"""
WITH r AS ({sql_pair_layout(False)}),
ex AS (SELECT example_id, count(*) AS seq_len, sum(input_id) AS ids_sum,
              sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS n_sup FROM r GROUP BY example_id),
o AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(example_id AS VARCHAR)), example_id) - 1
             AS pos FROM ex),
b AS (SELECT *, pos // {_PER_STEP} AS step, (pos % {_PER_STEP}) % {DEVICES} AS rank,
             ((pos % {_PER_STEP}) // {DEVICES}) // {PER_DEVICE_BATCH} AS micro FROM o)
SELECT CAST(example_id AS BIGINT) AS example_id, CAST(step AS BIGINT) AS step,
       CAST(rank AS BIGINT) AS rank, CAST(micro AS BIGINT) AS micro,
       CAST(ceil(max(seq_len) OVER (PARTITION BY step, rank, micro) / 8.0) * 8 AS BIGINT) AS padded_len,
       CAST(ids_sum AS BIGINT) AS ids_sum, CAST(n_sup AS BIGINT) AS n_supervised
FROM b""")
def q_pair_batches(spark, sf):
    """Training path of the example script: L2 -> O1 -> L4 -> L3 (272 = 34 x 8,
    so collation adds no padding)."""
    from tunedata.plans.training import TrainingData, batches
    cfg = TrainingData("../models/pythia-12b-deduped", "pythia", max_source_length=SOURCE_LEN,
                       max_target_length=TARGET_LEN, seed=SEED, devices=DEVICES,
                       per_device_train_batch_size=PER_DEVICE_BATCH,
                       gradient_accumulation_steps=GRAD_ACCUM)
    b = batches(_pair_layout(spark, sf), cfg, PROFILE.pad_id)
    return b.select(_big("example_id"), _big("step"), _big("rank"), _big("micro"), _big("padded_len"),
                    _array_sum(F.col("input_ids")).alias("ids_sum"),
                    F.size(F.filter("labels", lambda v: v > F.lit(IGNORE_INDEX))).cast("bigint")
                    .alias("n_supervised"))


@register("classify_predict", """
SELECT CAST(l.doc_id AS BIGINT) AS doc_id, CASE WHEN l.quality = 1 THEN 'yes' ELSE 'no' END AS target,
       md5(replace(p || reverse(p), p, '')) AS prediction_md5,
       CAST(length(replace(p || reverse(p), p, '')) AS BIGINT) AS prediction_chars
FROM labels l JOIN (SELECT doc_id, 'Is this text of good quality?' || text AS p FROM documents) d
  ON l.doc_id = d.doc_id""")
def q_classify_predict(spark, sf):
    """Prediction path: instruction[0] + input -> predictor -> prompt removed ->
    ``prediction`` next to the input columns."""
    c = templates.assemble_prompt(tables.classify(spark, sf), out_col="_prompt")
    r = predict.batch_predict(c, "_prompt", predict.echo_reverse)
    return r.select(_big("doc_id"), "target", F.md5("prediction").alias("prediction_md5"),
                    F.length("prediction").cast("bigint").alias("prediction_chars"))


@register("vocab_tsv_roundtrip", f"""
WITH {SQL_WORD_VOCAB}
SELECT token, CAST(id AS BIGINT) AS ord, CAST(score AS BIGINT) AS score FROM v""")
def q_vocab_tsv_roundtrip(spark, sf):
    """K4/K5 then S7: the word vocabulary as ``piece TAB score`` lines and back."""
    path = scratch_path(spark, "vocab-tsv")
    sinks.write_vocab(_word_vocab_docs(spark, sf), path, tsv=True)
    back = readers.read_vocab_tsv(spark, path, glob="part-*")
    return back.select("token", _big("ord"), F.col("score").cast("bigint").alias("score"))


@register("epoch_plan", f"""
WITH p AS (SELECT count(*) AS n, CAST(ceil(count(*) / {float(_PER_STEP)}) AS BIGINT) AS spe FROM documents),
e AS (SELECT doc_id, unnest(range(0, CAST(ceil({float(MAX_STEPS)} / spe) AS BIGINT))) AS epoch, spe
      FROM documents, p),
o AS (SELECT doc_id, epoch, spe,
             row_number() OVER (PARTITION BY epoch ORDER BY
               md5('{SEED}:' || CAST(epoch AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos
      FROM e),
s AS (SELECT doc_id, epoch, pos, epoch * spe + pos // {_PER_STEP} AS step,
             (pos % {_PER_STEP}) % {DEVICES} AS rank,
             ((pos % {_PER_STEP}) // {DEVICES}) // {PER_DEVICE_BATCH} AS micro FROM o)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(epoch AS BIGINT) AS epoch, CAST(pos AS BIGINT) AS pos,
       CAST(step AS BIGINT) AS step, CAST(rank AS BIGINT) AS rank, CAST(micro AS BIGINT) AS micro
FROM s WHERE step < {MAX_STEPS}""")
def q_epoch_plan(spark, sf):
    """The example script's 100 steps of 64 examples: as many reshuffled epochs as needed."""
    d = tables.table(spark, sf, "documents").select("doc_id")
    p = ordering.epoch_plan(d, "doc_id", SEED, DEVICES, PER_DEVICE_BATCH, GRAD_ACCUM, MAX_STEPS)
    return p.select(_big("doc_id"), _big("epoch"), "pos", _big("step"), _big("rank"), _big("micro"))


# ------------------------------------------------------------------ whole jobs
@register("prediction_job", """
SELECT CAST(l.doc_id AS BIGINT) AS doc_id, CAST(l.toxic AS BIGINT) AS toxic, d.lang AS lang,
       'Is this text of good quality?' AS instruction, md5(d.text) AS input_md5,
       md5(replace(p || reverse(p), p, '')) AS prediction_md5
FROM labels l JOIN (SELECT *, 'Is this text of good quality?' || text AS p FROM documents) d ON l.doc_id = d.doc_id""")
def q_prediction_job(spark, sf):
    """The whole job over labels joined with documents: JSON lines in, every key and the
    prediction out (S4, P5, F3, L5, P7, K1, K2), instructions as arrays and as strings."""
    from tunedata.plans import prediction
    src, out = scratch_path(spark, "predict-in") + ".jsonl", scratch_path(spark, "predict-out")
    x = (tables.table(spark, sf, "labels").select("doc_id", "toxic")
         .join(tables.table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id"))
    line = x.select("doc_id", F.to_json(F.struct("doc_id", "toxic", F.struct("lang").alias("meta"),
                                                 F.lit("Is this text of good quality?").alias("instruction"),
                                                 F.col("text").alias("input"))).alias("one"),
                    F.to_json(F.struct("doc_id", "toxic", F.struct("lang").alias("meta"),
                                       F.array(F.lit("Is this text of good quality?")).alias("instruction"),
                                       F.col("text").alias("input"))).alias("many"))
    sinks.write_lines(line.select(F.when(F.col("doc_id") % 2 == 0, F.col("one")).otherwise(F.col("many"))), src)
    prediction.run(spark, src, out, predict.echo_reverse, settings={"top_k": 5})
    schema = "doc_id bigint, toxic bigint, meta struct<lang string>, input string, prediction string"
    back = spark.read.text(f"{out}/generation_results")
    r, ins = F.from_json("value", schema), F.try_parse_json("value")
    ins = F.coalesce(F.try_variant_get(ins, "$.instruction[0]", "string"), F.try_variant_get(ins, "$.instruction", "string"))
    return back.select(_big(r["doc_id"]).alias("doc_id"), _big(r["toxic"]).alias("toxic"), r["meta"]["lang"].alias("lang"),
                       ins.alias("instruction"), F.md5(r["input"]).alias("input_md5"),
                       F.md5(r["prediction"]).alias("prediction_md5"))


@register("training_job", f"""
WITH r AS ({sql_pair_layout(False)}),
ex AS (SELECT example_id, count(*) AS seq_len, sum(input_id) AS ids_sum,
              sum(CASE WHEN label > -100 THEN 1 ELSE 0 END) AS n_sup FROM r GROUP BY example_id),
n AS (SELECT count(*) AS n FROM ex)
SELECT 'example' AS what, ids_sum AS a, n_sup AS b, seq_len AS c, count(*) AS n FROM ex GROUP BY ALL
UNION ALL
SELECT 'step', s.step, 0, 0, least({_PER_STEP}, n.n - s.step * {_PER_STEP})
FROM n, (SELECT unnest(range((n + {_PER_STEP - 1}) // {_PER_STEP})) AS step FROM n) s""")
def q_training_job(spark, sf):
    """The whole job (S1, P1, L2, O1, L4, L3, K3) over conversation pairs whose columns have
    names of their own: the examples it writes, and how many each step holds."""
    from tunedata.plans import training
    src, out = scratch_path(spark, "train-in") + ".json", scratch_path(spark, "train-out")
    pairs = tables.pairs(spark, sf).select(F.col("prompt").alias("question"), F.col("response").alias("answer"), "conv_id")
    sinks.write_predictions(pairs, src)
    cfg = training.TrainingData("../models/pythia-12b-deduped", "pythia", prompt_column="question",
                                response_column="answer", max_source_length=SOURCE_LEN, max_target_length=TARGET_LEN,
                                seed=SEED, devices=DEVICES, per_device_train_batch_size=PER_DEVICE_BATCH,
                                gradient_accumulation_steps=GRAD_ACCUM)
    train = spark.read.parquet(training.build(spark, src, out, cfg)["train"])
    size = F.size("input_ids").cast("bigint")
    ex = train.select(_array_sum(F.col("input_ids")).alias("a"), size.alias("c"),
                      F.size(F.filter("labels", lambda v: v > F.lit(IGNORE_INDEX))).cast("bigint").alias("b"))
    steps = train.groupBy(_big("step").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    return (ex.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n")).select(F.lit("example").alias("what"), "a", "b", "c", "n")
            .unionByName(steps.select(F.lit("step").alias("what"), "a", F.lit(0).cast("bigint").alias("b"),
                                      F.lit(0).cast("bigint").alias("c"), "n")))
