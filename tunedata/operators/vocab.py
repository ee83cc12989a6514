"""Vocabularies: frequencies, coverage, char/word/BPE training, merging.

Vocabulary table: ``token STRING, id INT, score DOUBLE, kind STRING``
(+ ``source INT`` after a merge). Ids are dense from 0: the special pieces,
then the user-defined symbols, then the learned pieces in rank order.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunedata.functions.codec import WORD_MARK, chars, symbols, words
from tunedata.operators import bpe_train
from tunedata.operators.ordering import with_position
from tunedata.session import BATCH_ROWS, checkpoint_dir, materialize, ship_package

# Pieces every trained vocabulary starts with, default user
# symbol, size and character coverage of the trainer.
SPECIAL_PIECES = ("<unk>", "<s>", "</s>")
UNK_ID = 0
DEFAULT_USER_SYMBOLS = ("<sepra>",)
DEFAULT_VOCAB_SIZE = 30000
DEFAULT_COVERAGE = 0.9995

VOCAB_SCHEMA = "token string, id int, score double, kind string"
# Splits of a group's words in the first level of a per-group top-k.
TOP_K_SPLITS = 32


def fixed_pieces(spark: SparkSession, user_symbols=DEFAULT_USER_SYMBOLS) -> DataFrame:
    rows = [(p, i, 0.0, "special") for i, p in enumerate(SPECIAL_PIECES)]
    rows += [(s, len(rows) + j, 0.0, "user_defined") for j, s in enumerate(user_symbols)]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


# ------------------------------------------------------------- frequencies
def word_counts(corpus: DataFrame, text_col: str = "value", by=()) -> DataFrame:
    """``(by..., word, n)``. Exploded words are pre-aggregated per map
    partition before the shuffle, so a very frequent word costs one row per
    partition, not one per occurrence."""
    w = corpus.select(*by, F.explode(words(F.col(text_col))).alias("word"))
    return w.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def cut_symbols(text: Column, user_symbols=(), by: str = " ") -> Column:
    """``text`` with every user symbol replaced by ``by``: symbols are atomic, so no
    word, character or pair is learned from them. Of symbols that start at
    the same place the longest counts."""
    if not user_symbols:
        return text
    pattern = "|".join(_quote(s) for s in sorted(user_symbols, key=lambda s: (-len(s), s)))
    return F.regexp_replace(text, pattern, by)


def char_counts(corpus: DataFrame, text_col: str = "value", user_symbols=()) -> DataFrame:
    """A8 input: ``(ch, n)`` over all non-white-space characters outside of user symbols."""
    c = corpus.select(F.explode(chars(cut_symbols(F.col(text_col), user_symbols))).alias("ch"))
    return c.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def char_coverage(counts: DataFrame, coverage: float = DEFAULT_COVERAGE) -> DataFrame:
    """A8 / W4 (D13): ``(ch, n, rank, kept)``; a character is kept while the
    share of all characters ranked before it is below ``coverage``.

    The comparison is exact (integers; ``coverage`` read as its decimal
    text). The ranking window orders the distinct characters as a whole:
    bounded by the size of the Unicode code space, not by the corpus.
    """
    frac = Fraction(str(coverage))
    order = Window.orderBy(F.col("n").desc(), F.col("ch").asc())
    total = F.sum("n").over(Window.partitionBy())
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = counts.select("ch", "n", (F.row_number().over(order) - 1).alias("rank"),
                      before.alias("_before"), total.alias("_total"))
    dec = "decimal(38,0)"
    kept = (F.col("_before").cast(dec) * F.lit(frac.denominator).cast(dec)
            < F.col("_total").cast(dec) * F.lit(frac.numerator).cast(dec))
    return x.select("ch", "n", F.col("rank").cast("int").alias("rank"), kept.alias("kept"))


def top_k(df: DataFrame, k: int, order_cols) -> DataFrame:
    """The first ``k`` rows in order (TakeOrderedAndProject)."""
    return df.orderBy(*order_cols).limit(k)


def _ranked(df: DataFrame, order_cols, by=()) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order_cols)
    return df.withColumn("rank", (F.row_number().over(w) - 1).cast("int"))


def _learned(spark, ranked: DataFrame, token: Column, n_fixed: int, by=()) -> DataFrame:
    return ranked.select(*by, token.alias("token"), (F.col("rank") + n_fixed).cast("int").alias("id"),
                         (-F.col("rank")).cast("double").alias("score"), F.lit("normal").alias("kind"))


def char_vocab(corpus: DataFrame, text_col: str = "value", vocab_size: int = DEFAULT_VOCAB_SIZE,
               coverage: float = DEFAULT_COVERAGE, user_symbols=DEFAULT_USER_SYMBOLS) -> DataFrame:
    """V3: fixed pieces, then the covered characters by frequency, capped at ``vocab_size``."""
    spark = corpus.sparkSession
    fixed = fixed_pieces(spark, user_symbols)
    n_fixed = len(SPECIAL_PIECES) + len(user_symbols)
    cov = char_coverage(char_counts(corpus, text_col, user_symbols), coverage).filter("kept")
    cov = cov.filter(~F.col("ch").isin(list(SPECIAL_PIECES) + list(user_symbols)))
    learned = _learned(spark, _ranked(top_k(cov, max(vocab_size - n_fixed, 0),
                                            [F.col("n").desc(), F.col("ch").asc()]),
                                      [F.col("n").desc(), F.col("ch").asc()]), F.col("ch"), n_fixed)
    return fixed.unionByName(learned)


def word_vocab(corpus: DataFrame, text_col: str = "value", vocab_size: int = DEFAULT_VOCAB_SIZE,
               user_symbols=DEFAULT_USER_SYMBOLS) -> DataFrame:
    """V2: fixed pieces, then ``'▁' + word`` by frequency (ties by word), capped at ``vocab_size``.

    The cap is a top-k: each partition keeps its own best ``k`` words and
    one task merges them, so the work after the count does not grow with the
    corpus.
    """
    spark = corpus.sparkSession
    n_fixed = len(SPECIAL_PIECES) + len(user_symbols)
    order = [F.col("n").desc(), F.col("word").asc()]
    cut = corpus.withColumn(text_col, cut_symbols(F.col(text_col), user_symbols))
    top = top_k(word_counts(cut, text_col), max(vocab_size - n_fixed, 0), order)
    learned = _learned(spark, _ranked(top, order), F.concat(F.lit(WORD_MARK), F.col("word")), n_fixed)
    return fixed_pieces(spark, user_symbols).unionByName(learned)


def word_vocabs_by(corpus: DataFrame, by: str, text_col: str = "value",
                   vocab_size: int = DEFAULT_VOCAB_SIZE, user_symbols=DEFAULT_USER_SYMBOLS) -> DataFrame:
    """V2 per group (e.g. one vocabulary per language): ``(by, token, id, score, kind)``.

    The per-group cap is a ``row_number <= k`` filter on the window's own value,
    which Spark also applies per map partition before the shuffle
    (WindowGroupLimit). It runs in two levels, first over ``TOP_K_SPLITS`` splits
    of each group, so the words of a dominant group do not meet in one task:
    the last one gets at most ``k`` rows from each split.
    """
    spark = corpus.sparkSession
    n_fixed = len(SPECIAL_PIECES) + len(user_symbols)
    k = max(vocab_size - n_fixed, 0)
    order = [F.col("n").desc(), F.col("word").asc()]
    cut = corpus.withColumn(text_col, cut_symbols(F.col(text_col), user_symbols))
    r = word_counts(cut, text_col, by=[by]).withColumn("_split", F.pmod(F.xxhash64("word"), F.lit(TOP_K_SPLITS)))
    for level in ([by, "_split"], [by]):
        r = r.withColumn("_rn", F.row_number().over(Window.partitionBy(*level).orderBy(*order))).filter(F.col("_rn") <= k)
    r = r.withColumn("rank", (F.col("_rn") - 1).cast("int"))
    learned = _learned(spark, r, F.concat(F.lit(WORD_MARK), F.col("word")), n_fixed, by=[by])
    groups = corpus.select(by).distinct()
    fixed_rows = F.inline(F.array(*[
        F.struct(F.lit(p).alias("token"), F.lit(i).alias("id"), F.lit(0.0).alias("score"),
                 F.lit(kind).alias("kind"))
        for i, (p, kind) in enumerate([(p, "special") for p in SPECIAL_PIECES]
                                      + [(s, "user_defined") for s in user_symbols])]))
    fixed = groups.select(by, fixed_rows)
    return fixed.unionByName(learned)


def _pair_rows(word_table: DataFrame, sign: int = 1, sym_col: str = "sym", n_col: str = "n") -> DataFrame:
    """Adjacent symbol pairs of each word, weighted by ``sign * n``."""
    s = F.split(F.col(sym_col), " ")
    z = F.arrays_zip(F.slice(s, 1, F.size(s) - 1).alias("a"),
                     F.slice(s, 2, F.size(s) - 1).alias("b"))
    p = word_table.select(F.explode(z).alias("p"), (F.col(n_col) * sign).alias("n"))
    return p.select(F.col("p.a").alias("a"), F.col("p.b").alias("b"), "n")


def pair_counts(word_table: DataFrame, sym_col: str = "sym", n_col: str = "n") -> DataFrame:
    """A10: adjacent symbol pairs weighted by word count (overlapping runs count each).

    ``sym`` is the word's symbols joined by single spaces (a word never
    contains white space). Exploded pairs are summed per map partition first.
    """
    return _pair_rows(word_table, 1, sym_col, n_col).groupBy("a", "b").agg(F.sum("n").alias("n"))


# Stands for a user symbol inside a text while its words are counted (a noncharacter).
CUT = "\uffff"


# Distinct words that a task holds before they go on.
HELD_WORDS = 1 << 19


def counted_words(corpus: DataFrame, text_col: str = "value", user_symbols=()) -> DataFrame:
    """``word, n`` as ``word_counts`` gives them, ``CUT`` for every user symbol; a task counts its words in
    Arrow before the shuffle."""
    ship_package(corpus.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def total() -> pa.Table:
            t = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return t.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for b in batches:
            found = pc.ascii_split_whitespace(b.column("text")).flatten().value_counts()
            t = pa.table({"word": found.field("values"), "n": found.field("counts")})
            held.append(t.filter(pc.not_equal(t["word"], "")))
            rows += len(held[-1])
            if rows >= HELD_WORDS:
                held = [total()]
                rows = len(held[0])
                if rows >= HELD_WORDS // 2:
                    yield from held.pop().to_batches(max_chunksize=BATCH_ROWS)
                    rows = 0
        if held:
            yield from total().to_batches(max_chunksize=BATCH_ROWS)

    cut = corpus.select(cut_symbols(F.col(text_col), user_symbols, CUT).alias("text"))
    return cut.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def bpe_words(corpus: DataFrame, text_col: str = "value", user_symbols=(), counted: DataFrame | None = None) -> DataFrame:
    """BPE start table: one row per distinct word part, ``sym`` = characters, space separated.

    The text is cut at the user symbols, then split into words (``counted``, if they are known).
    A part that begins its word carries the word mark, a part behind a symbol does not.
    """
    counted = counted_words(corpus, text_col, user_symbols) if counted is None else counted
    if not user_symbols:
        return counted.select(F.array_join(symbols(F.col("word")), " ").alias("sym"), "n")
    parts = counted.select(F.posexplode(F.split("word", CUT)).alias("pos", "part"), "n")
    sym = F.when(F.col("part") == "", F.lit(WORD_MARK)).when(
        F.col("pos") == 0, F.array_join(symbols(F.col("part")), " ")).otherwise(F.array_join(F.split("part", ""), " "))
    return (parts.filter((F.col("part") != "") | (F.col("pos") == 0))
            .select(sym.alias("sym"), "n").groupBy("sym").agg(F.sum("n").alias("n")))


def _quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def apply_merge(sym: Column, a: str, b: str) -> Column:
    """Merge every ``(a, b)`` left to right without overlaps, in one regex pass.

    ``regexp_replace`` scans left to right and never re-reads replaced text,
    which is exactly the merge rule (``a a a`` with ``(a, a)`` gives ``aa a``).
    """
    pattern = "(?<=\\A| )" + _quote(a) + " " + _quote(b) + "(?= |\\z)"
    replacement = (a + b).replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(sym, pattern, replacement)


def _merge_pattern(pairs: list) -> str:
    alts = "|".join(f"{_quote(a)} {_quote(b)}" for a, b in pairs)
    return f"(?<=\\A| )(?:{alts})(?= |\\z)"


def apply_merges(sym: Column, pairs: list) -> Column:
    """Several merges in one regex pass; the pairs must share no symbol and no
    product (what the batch rule guarantees), so their matches never overlap
    and one left-to-right pass equals applying them one after another. Each
    alternative captures its two symbols; groups that did not take part
    append nothing."""
    if len(pairs) == 1:
        return apply_merge(sym, pairs[0][0], pairs[0][1])
    alts = "|".join(f"({_quote(a)}) ({_quote(b)})" for a, b in pairs)
    refs = "".join(f"${i}" for i in range(1, 2 * len(pairs) + 1))
    return F.regexp_replace(sym, f"(?<=\\A| )(?:{alts})(?= |\\z)", refs)


def _batch_rule(top: list, complete: bool, products: set, remaining: int) -> list:
    """Longest prefix of the ranked pairs ``top`` (``(a, b, n)``, best first)
    that one-at-a-time greedy merging would pick in the same order - exact,
    not an approximation.

    A pair is taken while (1) it shares no symbol with, and uses no product of,
    a pair taken before it, so its count is unchanged by those merges, and (2)
    its count is above every count a taken merge can create: a new pair
    ``(x, ab)`` or ``(ab, y)`` occurs at most ``min(n(a,b), max(L(a), R(b)))``
    times, where ``L(s)`` / ``R(s)`` bound the count of any pair ending /
    starting with ``s``: the largest such count in ``top``, or the last count
    of ``top`` when the list is cut (every pair outside it is at most that).
    A merge whose product may already be a symbol (an earlier product) ends
    the batch, since pairs with that symbol would grow.
    """
    first = top[0]
    if remaining <= 1 or len(top) == 1:
        return [first]
    floor = 0 if complete else top[-1][2]
    left: dict = {}
    right: dict = {}
    for a, b, n in top:
        left[b] = max(left.get(b, 0), n)
        right[a] = max(right.get(a, 0), n)

    def bound(r):
        return min(r[2], max(left.get(r[0], 0), right.get(r[1], 0), floor))

    taken = [first]
    used, made = {first[0], first[1]}, {first[0] + first[1]}
    limit = bound(first)
    if first[0] + first[1] in products:
        return taken
    for r in top[1:]:
        a, b, n = r
        if len(taken) >= remaining or a in used or b in used or a in made or b in made or n <= limit:
            break
        taken.append(r)
        used |= {a, b}
        limit = max(limit, bound(r))
        if a + b in products or a + b in made:
            break
        made.add(a + b)
    return taken


def bpe_merges(corpus: DataFrame, n_merges: int, text_col: str = "value", user_symbols=(),
               counted: DataFrame | None = None, **options) -> DataFrame:
    """V1 merge list ``(rank, a, b, n)``: the greedy merge order, ties to the
    smaller ``(a, b)``; ``options`` go to ``bpe_train.train``."""
    spark = corpus.sparkSession
    # Words of one symbol have no pair.
    words = materialize(bpe_words(corpus, text_col, user_symbols, counted).filter(F.col("sym").contains(" ")))
    merges = bpe_train.train(words, n_merges, **options)
    return spark.createDataFrame(merges, "rank int, a string, b string, n bigint")


def bpe_merges_by_rounds(corpus: DataFrame, n_merges: int, text_col: str = "value", user_symbols=(),
                         partitions: int | None = None, batch: bool = True, candidates: int = 1024,
                         compact_every: int = 4) -> DataFrame:
    """The merge list of ``bpe_merges`` by native expressions alone, few merges a round.

    One algorithm at every size. The word table (hash-partitioned by its
    symbols) and the pair counts are kept; a round changes the counts by the
    pairs of the words that hold a merged pair (old pairs out, merged pairs
    in), so only those words are exploded. The top ``candidates`` pairs are the
    only rows that reach the driver; with ``batch`` the exact batch rule takes
    several merges per round when greedy provably would. Merging is a
    codegen'd regex replace per word. Word table and counts are cut from their
    lineage with a reliable ``checkpoint()`` in the shared ``spark.checkpoint.dir``
    every ``compact_every`` rounds; until then the changes are appended, and a
    lost executor replays those rounds.
    """
    spark = corpus.sparkSession
    checkpoint_dir(spark)
    w = bpe_words(corpus, text_col, user_symbols)
    w = materialize(w.repartition(partitions, "sym") if partitions else w.repartition("sym"))
    pc = materialize(pair_counts(w))
    merges: list = []
    products: set = set()
    k = candidates if batch else 1
    rounds = 0
    while len(merges) < n_merges:
        rows = pc.orderBy(F.col("n").desc(), "a", "b").limit(k).collect()
        if not rows:
            break
        top = [(r["a"], r["b"], int(r["n"])) for r in rows]
        picked = _batch_rule(top, len(top) < k, products, n_merges - len(merges))
        for a, b, n in picked:
            merges.append((len(merges), a, b, n))
            products.add(a + b)
        pairs = [(a, b) for a, b, _ in picked]
        hit = w.filter(F.col("sym").rlike(_merge_pattern(pairs)))
        after = hit.select(apply_merges(F.col("sym"), pairs).alias("sym"), "n")
        delta = _pair_rows(hit, -1).unionByName(_pair_rows(after, 1))
        pc = (pc.unionByName(delta).groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") != 0))
        w = w.select(apply_merges(F.col("sym"), pairs).alias("sym"), "n")
        rounds += 1
        if rounds % compact_every == 0:
            w, pc = materialize(w), materialize(pc)
    return spark.createDataFrame(merges, "rank int, a string, b string, n bigint")


def covered_chars(corpus: DataFrame, text_col: str = "value", coverage: float = DEFAULT_COVERAGE,
                  user_symbols=(), counted: DataFrame | None = None) -> DataFrame:
    """``(token, rank)``: the covered characters of the BPE start table, the word mark (a
    character of every word) among them, without those that are fixed pieces. The characters are
    those of the distinct words (``counted``, if they are known), times the words' counts."""
    counted = counted_words(corpus, text_col, user_symbols) if counted is None else counted
    marks = counted.agg(F.sum("n").alias("n")).select(F.lit(WORD_MARK).alias("ch"), "n").filter(F.col("n") > 0)
    counts = (counted.select(F.explode(F.split("word", "")).alias("ch"), "n").groupBy("ch").agg(F.sum("n").alias("n"))
              .filter(F.col("ch") != WORD_MARK))
    if user_symbols:  # those of the texts themselves, beside the ones that stand for a symbol
        text = cut_symbols(F.col(text_col), user_symbols)
        own = (corpus.filter(F.col(text_col).contains(CUT))
               .agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit(CUT), F.lit("")))).alias("n")))
        counts = counts.filter(F.col("ch") != CUT).unionByName(
            own.select(F.lit(CUT).alias("ch"), F.col("n").cast("bigint").alias("n")).filter(F.col("n") > 0))
    counts = counts.unionByName(marks)
    fixed = list(SPECIAL_PIECES) + list(user_symbols)
    return (char_coverage(counts, coverage).filter("kept").select(F.col("ch").alias("token"), "rank")
            .filter(~F.col("token").isin(fixed)))


def bpe_vocab(corpus: DataFrame, vocab_size: int = DEFAULT_VOCAB_SIZE, text_col: str = "value",
              coverage: float = DEFAULT_COVERAGE, user_symbols=DEFAULT_USER_SYMBOLS,
              n_merges: int | None = None, **options) -> DataFrame:
    """V1: fixed pieces, merged pieces (score = -rank), then covered characters.

    Every covered character has a piece, so the characters are counted first
    and ``vocab_size`` leaves the rest to merges (``n_merges`` sets their number
    instead). A piece is listed once: a merge that spells a fixed or an earlier
    piece adds none. ``options`` go to ``bpe_merges``.
    """
    spark = corpus.sparkSession
    n_fixed = len(SPECIAL_PIECES) + len(user_symbols)
    counted = materialize(counted_words(corpus, text_col, user_symbols))
    ch = materialize(covered_chars(corpus, text_col, coverage, user_symbols, counted))  # bounded by the code space
    if n_merges is None:
        n_merges = vocab_size - n_fixed - ch.count()
        if n_merges < 0:
            raise ValueError(f"vocab_size {vocab_size} is too small for the fixed pieces and covered characters")
    merges = bpe_merges(corpus, n_merges, text_col, user_symbols, counted, **options)
    # The merge list has at most ``n_merges`` rows, so ranking it as a whole is bounded.
    merged = merges.groupBy(F.concat("a", "b").alias("token")).agg(F.min("rank").alias("first"))
    merged = merged.filter(~F.col("token").isin(list(SPECIAL_PIECES) + list(user_symbols)))
    merged = _ranked(merged, ["first"])
    n_merged = merged.count()
    mv = merged.select("token", (F.col("rank") + n_fixed).cast("int").alias("id"),
                       (-F.col("rank")).cast("double").alias("score"), F.lit("normal").alias("kind"))
    ch = ch.join(merged.select("token"), "token", "left_anti")
    ch = _ranked(ch, ["rank"]).select(
        "token", (F.col("rank") + n_fixed + n_merged).cast("int").alias("id"),
        (-(F.col("rank") + n_merged)).cast("double").alias("score"), F.lit("normal").alias("kind"))
    return fixed_pieces(spark, user_symbols).unionByName(mv).unionByName(ch)


# ------------------------------------------------------------------ merging
def merge_vocabs(base: DataFrame, sources: DataFrame) -> DataFrame:
    """``base`` (token, id, score, kind; ids dense from 0) plus
    ``sources`` (token, ord, source >= 1).

    Pieces already in the base are dropped (J3, left anti join); a piece in
    several sources, or twice in one, is kept once - first source, first
    ordinal wins (W3, D14). New pieces get score 0, kind ``normal`` and ids
    after the base in ``(source, ord)`` order (W2, D15): base rows and new
    pieces are numbered together in ``(source, ord)`` order, the base being
    source 0 ordered by id, so no separate count of the base is needed.
    """
    new = sources.select("token", "ord", "source").join(base.select("token"), "token", "left_anti")
    first = new.withColumn("_rn", F.row_number().over(
        Window.partitionBy("token").orderBy("source", "ord"))).filter(F.col("_rn") == 1).drop("_rn")
    both = base.select("token", F.col("id").alias("ord"), F.lit(0).alias("source")).unionByName(first)
    both = both.withColumn("_bucket", F.col("source").cast("bigint") * F.lit(1 << 32)
                           + F.floor(F.col("ord") / 4096).cast("bigint"))
    numbered = with_position(both, "_bucket", ["source", "ord"], "_pos").filter(F.col("source") > 0)
    added = numbered.select("token", F.col("_pos").cast("int").alias("id"),
                            F.lit(0.0).alias("score"), F.lit("normal").alias("kind"), "source")
    kept = base.select("token", F.col("id").cast("int"), F.col("score").cast("double"), "kind",
                       F.lit(0).alias("source"))
    return kept.unionByName(added)


def merge_report(base: DataFrame, sources: DataFrame, merged: DataFrame) -> DataFrame:
    """V5 / A3: per source (0 = base) its size and the pieces it added."""
    sizes = base.select(F.lit(0).alias("source")).unionByName(sources.select("source")) \
        .groupBy("source").agg(F.count(F.lit(1)).alias("n_pieces"))
    added = merged.groupBy("source").agg(F.count(F.lit(1)).alias("n_added"))
    return sizes.join(added, "source", "left").select(
        "source", "n_pieces", F.coalesce("n_added", F.lit(0)).alias("n_added"))


def special_tokens(v: DataFrame) -> DataFrame:
    """V5: the special and user-defined pieces of a vocabulary with their ids."""
    return v.filter(F.col("kind").isin("special", "user_defined")).select("token", "id", "kind")
