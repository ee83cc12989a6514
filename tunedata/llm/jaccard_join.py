"""N-gram Jaccard join by signature trees.

A document's set holds the hashes of its distinct word shingles; two sets link when
``100 * common >= percent * union``. Everything is exact (but for equal 63-bit hashes of
different shingles): what is pruned could not link.

1. Equal sets become one. Each set keeps its smallest hashes and a parity bitmap of all of them,
   two bits a shingle or more: a bit is 1 if an odd number of hashes fall on it. What two sets
   have in common cancels out, so that the bitmaps of two sets differ in nearly as many bits as
   the sets differ in shingles, and never in more.
2. Every linked pair has a common token among the first ``n - ceil(n * percent / 100) + 1``
   of both, in any order of the tokens. Here the tokens that many sets hold come last (the
   ``heavies`` most frequent ones are broadcast, a bounded list), so shared passages make few
   pairs. Each token held by several sets in that part is a cell, the root of a signature tree.
3. Sets go on that have one of like size in their cell. Their cells get trees: members in
   blocks (one row each, about ``block`` members; more than that are dealt by size first), leaves
   of 16 inside a block. A node holds the OR and the AND of its members' bitmaps, their range of
   sizes, the most tokens that can follow the cell's token, and the range of their components.
   Pairs of blocks are joined by cell, pairs of leaves and members are walked in numpy; at each
   level a pair is left out when the largest possible overlap of any two members is too small
   (bits that all members of one side have and none of the other are shingles apart), or when
   both sides are of one component.
4. The pairs that remain are compared exactly, on shingles made anew from their texts, and
   joined to connected components. This is done twice: first every set is compared with one
   member of each of its cells and, over a quarter of the cells, with the ``nearest`` candidates of a
   block, which joins large groups of near copies by few pairs; then all pairs that are still of
   two components are.

Nothing depends on how many sets a cell has: no cell is gathered in one task, and there is
no cap on partners. The cost that remains quadratic is that of pairs of blocks of unlinked
sets of like size which share a token among their rarest and whose bitmaps agree.

Defined cases: null, empty and blank texts have no shingles (``n_shingles`` 0) and are linked
with nothing, their component is their own id; fewer words than ``words`` make one shingle;
equal rows and texts share a component; a null ``doc_id`` takes part but names no component
unless there is no other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready, text_or_empty
from tunedata.llm.components import components, salted_join
from tunedata.session import materialize

# Words whose hash a worker remembers.
KNOWN_WORDS = 300_000
# Hashes below are kept by every set: a quarter of all.
LOW = 1 << 61
MIN_BITS, MAX_BITS = 64, 1 << 16
# Width of the bitmaps that pairs of blocks are compared by, in 64-bit words.
TOP_WORDS = 16
LEAF = 16
# Pairs that a task of the walk hands on at a time.
HANDED = 1 << 18
# Most sets whose texts are looked up by a broadcast of their keys, about 60 bytes each.
SMALL_OWNERS = 500_000

_words: dict = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(word: bytes) -> int:
    h = _words.get(word)
    if h is None:
        if len(_words) >= KNOWN_WORDS:
            _words.clear()
        h = _words[word] = xxhash.xxh64_intdigest(word)
    return h


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes (63 bits) of the text's shingles, A-Z lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_word_hash, found), np.uint64, len(found))
    width = min(words, len(h))
    with np.errstate(over="ignore"):
        total = _mix(h[:len(h) - width + 1] + np.uint64(width))
        for k in range(1, width):
            total = _mix(total + h[k:len(h) - width + 1 + k])
    return np.unique((total >> np.uint64(1)).astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity bitmap: a bit is 1 if an odd number of tokens fall on it."""
    width = min(MAX_BITS, max(MIN_BITS, 1 << int(2 * len(tokens) - 1).bit_length()))
    odd = np.bincount(tokens & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _lists(parts: list, kind=None) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind or pa.int64()))


def _cut(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1])


def sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_key, key, n, low, bits`` of every row: a digest of the text and of its set, the
    number of shingles, its smallest hashes and its bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ns, lows, bits = [], [], [], []
            for text in b.column("text"):
                tokens = shingle_set(text.as_py(), words)
                keep = max(int(np.searchsorted(tokens, LOW)), prefix_length(len(tokens), percent))
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                ns.append(len(tokens))
                lows.append(tokens[:keep])
                bits.append(bitmap(tokens))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(keys, pa.binary()), pa.array(ns, pa.int64()),
                 _lists(lows), pa.array(bits, pa.binary())], ["doc_id", "text_key", "key", "n", "low", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text"), text_key().alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, text_key binary, key binary, n bigint, low array<bigint>, bits binary")


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes the shuffle files of tables that are written
    then, and otherwise only when the driver's memory happens to fill."""
    spark.sparkContext._jvm.System.gc()


def text_key() -> Column:
    return F.unhex(F.md5(text_or_empty()))


class SetJoin:
    """The join over the distinct sets of ``docs``; see the module's text for its steps."""

    def __init__(self, docs: DataFrame, words: int = 4, percent: int = 85, heavy: int = 32, heavies: int = 1 << 18,
                 block: int = 256, nearest: int = 1):
        if not 0 < percent <= 100:
            raise ValueError("percent is from 1 to 100")
        self.docs, self.words, self.percent = docs, words, percent
        self.heavy, self.heavies, self.block, self.nearest = heavy, heavies, block, nearest
        self.spark = docs.sparkSession
        python_ready(self.spark)
        self.sketch = materialize(sketches(docs, words, percent), how="table")
        first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
        self.sets = materialize(
            self.sketch.filter("n > 0").groupBy("key")
            .agg(F.min(first).alias("first"), F.first("n").alias("n"), F.first("low").alias("low"),
                 F.first("bits").alias("bits"))
            .select(F.monotonically_increasing_id().alias("sid"), "key", F.col("first.doc_id").alias("first_id"),
                    F.col("first.text_key").alias("text_key"), "n", "low", "bits"), how="table")
        let_go(self.spark)

    def enough(self, overlap, total):
        """Whether an overlap suffices for two sets of ``total`` shingles together."""
        return (100 + self.percent) * overlap >= self.percent * total

    # ------------------------------------------------------------ candidates
    def cells(self) -> DataFrame:
        """``token, sid, n, rest, hub``: the tokens of each set's first part that other sets hold too;
        ``rest`` counts the set's tokens from there on, ``hub`` is the cell's smallest member."""
        held = materialize(self.sets.select(F.explode("low").alias("token")).groupBy("token")
                           .agg(F.count("*").alias("df")).filter("df > 1"), how="table")
        top = (held.filter((F.col("df") >= self.heavy) & (F.col("token") < LOW))
               .orderBy(F.desc("df"), "token").limit(self.heavies).toArrow())
        tokens, df = (top.column(c).to_numpy() for c in ("token", "df"))
        order = np.argsort(tokens)
        ranks = self.spark.sparkContext.broadcast(
            (tokens[order], np.log2(np.maximum(df[order], 1)).astype(np.int8)))
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, classes = ranks.value
            for b in batches:
                parts = []
                for low, n in zip(_cut(b.column("low")), b.column("n").to_pylist(), strict=True):
                    if len(known):
                        at = np.minimum(np.searchsorted(known, low), len(known) - 1)
                        late = np.where(known[at] == low, classes[at], 0)
                        late[low >= LOW] = 127  # the hashes that not every set keeps come last
                        low = low[np.argsort(late, kind="stable")]
                    parts.append(low[:prefix_length(n, percent)])
                yield pa.RecordBatch.from_arrays([b.column("sid"), b.column("n"), _lists(parts)], ["sid", "n", "first"])

        first = self.sets.select("sid", "n", "low").mapInArrow(run, "sid bigint, n bigint, first array<bigint>")
        rows = (first.select("sid", "n", F.posexplode("first").alias("pos", "token"))
                .select("token", "sid", "n", (F.col("n") - F.col("pos")).alias("rest")))
        rows = materialize(rows.join(held.select("token"), "token"), how="table")
        hubs = (rows.groupBy("token").agg(F.min(F.struct("sid", "n", "rest")).alias("hub"), F.count("*").alias("members"))
                .filter("members > 1").drop("members"))
        return materialize(salted_join(rows, hubs, "token", "sid").filter(F.col("sid") != F.col("hub.sid")), how="table")

    def stars(self, cells: DataFrame) -> DataFrame:
        """Pairs of each member of a cell with its hub."""
        return (cells.filter(self.enough(F.least("rest", "hub.rest", "n", "hub.n"), F.col("n") + F.col("hub.n")))
                .select(F.col("sid").alias("a"), F.col("hub.sid").alias("b")).distinct())

    def tree_pairs(self, cells: DataFrame, labels: DataFrame, nearest: int | None) -> DataFrame:
        """Pairs of different components that the trees of the cells leave; the hubs have met all."""
        band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / min(self.percent, 90))).cast("int")
        rows = (cells.join(labels, cells["sid"] == labels["node"], "left")
                .select("token", "sid", "n", "rest", F.coalesce("component", "sid").alias("label"), band.alias("band")))
        rows = materialize(rows, how="table")
        # Sets that link are of one band of sizes or of neighbouring ones.
        near = (rows.groupBy("token", "band").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                .select("token", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "x", "y")
                .groupBy("token", "band").agg(F.min("x").alias("x"), F.max("y").alias("y")).filter("x <> y"))
        return self.walked(self.blocks(materialize(rows.join(near.select("token", "band"), ["token", "band"]), how="table")),
                           nearest)

    def blocks(self, rows: DataFrame) -> DataFrame:
        """One row a block: its members (by size), the node's measures and, for the join, its bitmap
        folded to ``TOP_WORDS`` words; ``alone`` if it is all of its cell."""
        sizes = rows.groupBy("token").agg(F.count("*").alias("members"))
        keys = ["token", "alone", "band"]
        rows = rows.join(sizes, "token").withColumn("alone", F.col("members") <= self.block).drop("members")
        small = rows.filter("alone").withColumn("band", F.lit(0))
        large = rows.filter("not alone")
        # Bands of a fixed ratio of sizes; then by component, then by set, as many as the counts ask for.
        for name, by in (("part", "label"), ("sub", "sid")):
            counts = large.groupBy(keys).agg(F.ceil(F.count("*") / self.block).alias("k"))
            large = large.join(counts, keys).withColumn(name, F.pmod(F.xxhash64(by), "k").cast("int")).drop("k")
            small = small.withColumn(name, F.lit(0))
            keys = [*keys, name]
        members = small.unionByName(large).join(self.sets.select("sid", "bits"), "sid")
        packed = members.groupBy(keys).agg(F.collect_list(F.struct("n", "label", "sid", "rest", "bits")).alias("m"))
        schema = ("token bigint, alone boolean, id bigint, lo bigint, hi bigint, rest bigint, label_lo bigint, "
                  "label_hi bigint, any_bits array<bigint>, all_bits array<bigint>, sid array<bigint>, label array<bigint>, "
                  "n array<bigint>, rests array<bigint>, bits binary")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_pylist([
                    {"token": token, "alone": alone, "id": i, **pack(m)} for token, alone, i, m in
                    zip(*(b.column(c).to_pylist() for c in ("token", "alone", "id", "m")), strict=True)],
                    to_arrow_schema(schema))

        packed = packed.select("token", "alone", F.xxhash64(*keys[2:]).alias("id"), "m").mapInArrow(run, schema)
        packed = materialize(packed, how="table")
        let_go(self.spark)
        return packed

    def walked(self, blocks: DataFrame, nearest: int | None) -> DataFrame:
        """Pairs of members that a dual walk over the blocks of each cell leaves."""
        several = blocks.filter("not alone")
        a, b = ([F.col(c).alias(f"{side}_{c}") for c in blocks.columns] for side in "ab")

        def only(every, any_other):
            bits = F.zip_with(every, any_other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))).cast("bigint"))
            return F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, x: s + x)

        # Bitmaps of different widths are not compared here.
        apart = (F.when(F.size("a_any_bits") == F.size("b_any_bits"), only("a_all_bits", "b_any_bits") + only("b_all_bits", "a_any_bits"))
                 .otherwise(0))
        near = (100 + self.percent) * apart <= (100 - self.percent) * (F.col("a_hi") + F.col("b_hi"))
        most = F.least("a_rest", "b_rest", "a_hi", "b_hi")
        alike = ((F.col("a_label_lo") == F.col("a_label_hi")) & (F.col("b_label_lo") == F.col("b_label_hi"))
                 & (F.col("a_label_lo") == F.col("b_label_lo")))
        columns = ("id", "sid", "label", "n", "rests", "bits")
        pairs = (several.select(*a).join(several.select(*b), (F.col("a_token") == F.col("b_token"))
                                         & (F.col("a_id") <= F.col("b_id")))
                 .filter(~alike & self.enough(most, F.col("a_lo") + F.col("b_lo")) & near)
                 .select(*[f"{side}_{c}" for side in "ab" for c in columns]))
        percent = self.percent

        def found(b: pa.RecordBatch, sides: str) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for i in range(b.num_rows):
                left, *right = (Block(*[b.column(f"{side}_{c}")[i] for c in columns[1:]]) for side in sides)
                same = not right or b.column("a_id")[i].as_py() == b.column("b_id")[i].as_py()
                held.append(np.stack(walk(left, right[0] if right else left, percent, same, nearest)))
                n += held[-1].shape[1]
                if n >= HANDED or (n and i + 1 == b.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in np.concatenate(held, 1)], ["a", "b"])
                    held, n = [], 0

        def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield from found(b, "a")

        def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield from found(b, "ab")

        alone = blocks.filter("alone").select(*[F.col(c).alias(f"a_{c}") for c in columns])
        return (alone.mapInArrow(inside, "a bigint, b bigint").union(pairs.mapInArrow(between, "a bigint, b bigint"))
                .distinct())

    # ---------------------------------------------------------- verification
    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (``a, b``) that link: by their bitmaps, then by their shingles."""
        percent = self.percent
        own = self.sets.select("sid", "n", "bits")
        both = pairs
        for side in "ab":
            both = both.join(own.select(F.col("sid").alias(side), F.col("n").alias(f"n_{side}"),
                                        F.col("bits").alias(f"bits_{side}")), side)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = b.column("n_a").to_numpy() + b.column("n_b").to_numpy()
                apart = [differing(x.as_py(), y.as_py()) for x, y in zip(b.column("bits_a"), b.column("bits_b"), strict=True)]
                ok = (100 + percent) * np.array(apart, np.int64) <= (100 - percent) * n
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        left = materialize(both.mapInArrow(near, "a bigint, b bigint"), how="table")
        wanted = left.select(F.col("a").alias("sid")).distinct().union(left.select("b").distinct()).distinct()
        words = self.words

        def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                made = [shingle_set(t.as_py(), words).tobytes() for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([b.column("sid"), pa.array(made, pa.binary())], ["sid", "tokens"])

        wanted = materialize(wanted)
        owners = self.sets.join(wanted, "sid").select("sid", F.col("first_id"), F.col("text_key").alias("own_key"))
        if wanted.count() <= SMALL_OWNERS:  # else the texts are shuffled
            owners = F.broadcast(owners)
        texts = (self.docs.select("doc_id", text_or_empty().alias("text"), text_key().alias("text_key"))
                 .join(owners, (F.col("text_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
                 .select("sid", "text"))
        # Rows repeated as a whole give a set's tokens more than once.
        made = texts.mapInArrow(tokens, "sid bigint, tokens binary").groupBy("sid").agg(F.first("tokens").alias("tokens"))
        compared = left
        for side in "ab":
            compared = compared.join(made.select(F.col("sid").alias(side), F.col("tokens").alias(f"t_{side}")), side)

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = []
                for x, y in zip(b.column("t_a"), b.column("t_b"), strict=True):
                    x, y = (np.frombuffer(t.as_buffer(), np.int64) for t in (x, y))
                    at = np.searchsorted(y, x)
                    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    ok.append((100 + percent) * common >= percent * (len(x) + len(y)))
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return materialize(compared.mapInArrow(exact, "a bigint, b bigint"))

    # ---------------------------------------------------------------- result
    def labels(self) -> DataFrame:
        """``node, component``: the component of every set that links with another one."""
        cells = self.cells()
        let_go(self.spark)
        alone = self.sets.select(F.col("sid").alias("node"), F.col("sid").alias("component")).limit(0)
        # Sets have many cells in common, so that a quarter of them tells most nearest ones.
        some = cells.filter(F.pmod(F.xxhash64("token"), F.lit(4)) == 0)
        first = self.stars(cells).union(self.tree_pairs(some, alone, self.nearest)).distinct()
        known = materialize(components(self.linked(first).toDF("u", "v")))
        let_go(self.spark)
        return joined(known, self.linked(self.tree_pairs(cells, known, None)))

    def result(self) -> DataFrame:
        rooted = (self.sets.join(self.labels(), F.col("sid") == F.col("node"), "left")
                  .select("key", "first_id", F.coalesce("component", "sid").alias("root")))
        rooted = materialize(rooted)
        least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = salted_join(rooted, least, "root", "key").select("key", "component_id")
        rows = self.sketch.select("doc_id", "key", F.col("n").alias("n_shingles"))
        alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        held = salted_join(rows.filter("n_shingles > 0"), named, "key", "doc_id")
        return held.select("doc_id", "n_shingles", "component_id").union(alone)


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``known`` (``node, component``) joined by more links (``a, b``) between nodes, known or not."""
    named = links
    for side in "ab":
        other = known.select(F.col("node").alias(side), F.col("component").alias(f"label_{side}"))
        named = named.join(other, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    over = materialize(components(named.select(F.col("label_a").alias("u"), F.col("label_b").alias("v"))))
    # A node that was in no component was its own label.
    nodes = known.union(over.select("node", F.col("node").alias("component"))
                        .join(known.select("node"), "node", "left_anti"))
    final = over.select(F.col("node").alias("component"), F.col("component").alias("final"))
    return materialize(nodes.join(final, "component", "left").select("node", F.coalesce("final", "component").alias("component")))


def to_arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in ddl.split(", "))])


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Parity bitmaps (rows of bytes) of fewer bytes: a bit of the half cut off is added to its place in the other."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, at the smaller width; at least as many shingles differ."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    width = min(len(x), len(y))
    return int(ones(fold(x, width) ^ fold(y, width)))


def pack(members: list) -> dict:
    """A block's row from its members (``n, label, sid, rest, bits``)."""
    members = sorted(members, key=lambda m: (m["n"], m["label"], m["sid"]))
    n, label, sid, rest = ([m[c] for m in members] for c in ("n", "label", "sid", "rest"))
    width = min(len(m["bits"]) for m in members)
    bits = np.stack([fold(np.frombuffer(m["bits"], np.uint8), width) for m in members])
    top = fold(bits, 8 * TOP_WORDS)
    return {"lo": n[0], "hi": n[-1], "rest": max(rest), "label_lo": min(label), "label_hi": max(label),
            "any_bits": np.bitwise_or.reduce(top, 0).view(np.int64).tolist(),
            "all_bits": np.bitwise_and.reduce(top, 0).view(np.int64).tolist(),
            "sid": sid, "label": label, "n": n, "rests": rest, "bits": bits.tobytes()}


class Block:
    """A block's members as arrays, and its leaves."""

    def __init__(self, sid, label, n, rests, bits):
        self.sid, self.label, self.n, self.rest = (x.values.to_numpy() for x in (sid, label, n, rests))
        self.bits = np.frombuffer(bits.as_buffer(), np.uint8).reshape(len(self.sid), -1)
        self.starts = np.arange(0, len(self.sid), LEAF)

    def leaves(self, width: int) -> dict:
        bits, at = fold(self.bits, width), self.starts
        return {"any_bits": np.bitwise_or.reduceat(bits, at, 0), "all_bits": np.bitwise_and.reduceat(bits, at, 0),
                "lo": np.minimum.reduceat(self.n, at), "hi": np.maximum.reduceat(self.n, at),
                "rest": np.maximum.reduceat(self.rest, at), "label_lo": np.minimum.reduceat(self.label, at),
                "label_hi": np.maximum.reduceat(self.label, at)}


def open_leaves(a: Block, b: Block, percent: int, same: bool, width: int) -> Iterator[tuple[int, int]]:
    """Pairs of leaves of two blocks that may hold a pair of members to link."""
    if len(a.starts) == len(b.starts) == 1:  # the members are as few as a leaf's
        yield 0, 0
        return
    x, y = a.leaves(width), b.leaves(width)

    def least(c):
        return np.minimum(x[c][:, None], y[c])

    most = np.minimum(least("rest"), least("hi"))
    enough = (100 + percent) * most >= percent * (x["lo"][:, None] + y["lo"])
    alike = ((x["label_lo"] == x["label_hi"])[:, None] & (y["label_lo"] == y["label_hi"])
             & (x["label_lo"][:, None] == y["label_lo"]))
    left = enough & ~alike
    if same:
        left &= np.arange(len(a.starts))[:, None] <= np.arange(len(b.starts))
    for i, j in zip(*np.nonzero(left), strict=True):
        apart = ones(x["all_bits"][i] & ~y["any_bits"][j]) + ones(y["all_bits"][j] & ~x["any_bits"][i])
        if (100 + percent) * apart <= (100 - percent) * (x["hi"][i] + y["hi"][j]):
            yield i, j


def walk(a: Block, b: Block, percent: int, same: bool, nearest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members (``sid``) of two blocks whose overlap may suffice; ``same`` if the blocks are one.
    With ``nearest``, only so many of each member, those whose bitmaps differ least."""
    width = min(a.bits.shape[1], b.bits.shape[1])
    found, share = [np.empty((2, 0), np.int64)], [np.empty(0)]
    a_bits, b_bits = fold(a.bits, width), fold(b.bits, width)
    for i, j in open_leaves(a, b, percent, same, width):
        p, q = slice(LEAF * i, LEAF * (i + 1)), slice(LEAF * j, LEAF * (j + 1))
        total = a.n[p][:, None] + b.n[q]
        most = np.minimum(np.minimum(a.rest[p][:, None], b.rest[q]), np.minimum(a.n[p][:, None], b.n[q]))
        left = ((100 + percent) * most >= percent * total) & (a.label[p][:, None] != b.label[q])
        u, v = np.nonzero(np.triu(left, 1) if same and i == j else left)
        apart = ones(a_bits[p][u] ^ b_bits[q][v])
        ok = (100 + percent) * apart <= (100 - percent) * total[u, v]
        found.append(np.stack([a.sid[p][u[ok]], b.sid[q][v[ok]]]))
        share.append(apart[ok] / total[u, v][ok])
    pairs, share = np.sort(np.concatenate(found, 1), 0), np.concatenate(share)
    if nearest is not None:
        keep = np.zeros(len(share), bool)
        for member in pairs:
            order = np.lexsort((share, member))
            first = np.searchsorted(member[order], member[order])
            keep[order[np.arange(len(order)) - first < nearest]] = True
        pairs = pairs[:, keep]
    return pairs[0], pairs[1]


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; ``component_id`` is the smallest
    ``doc_id`` that links reach, its own included. ``options`` as of ``SetJoin``."""
    return SetJoin(docs, **options).result()
