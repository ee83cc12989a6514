"""Byte-level BPE as a deterministic automaton over tokens.

The automaton starts with one state that loops on every byte. For each merge
``(u, v)``, in order, the merge gadget is applied: the state that ``u``-arcs
enter is copied without its ``v``-arc, ``u``-arcs are redirected to the copy,
and every state with a ``u``-arc gets a ``uv``-arc to where ``v``-arcs led. The
paths of the result are exactly the token sequences that merging yields, one
for each byte string. All arcs of a label enter the same state, so a state is
kept as its difference from the one it was copied from, and ``allowed`` answers
whether a state has an arc.

Encoding reads the bytes of a pre-split word through the transition table of
the labels (a trie) and keeps, for each prefix, the one token that ends a path
there. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunedata.llm.common import python_ready, text_or_empty

# Arcs and words a worker remembers; what is forgotten is found again.
CACHE_ARCS, CACHE_WORDS, CACHED_WORD_BYTES = 250_000, 350_000, 64


class Remembered(dict):
    """A bounded cache of two generations: words met again outlive those met once."""

    def __init__(self, find):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, word: str):
        got = self.old.get(word)
        if got is None:
            got = self.find(word)
            if len(word) > CACHED_WORD_BYTES:
                return got
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if
    printable, else the next free character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Automaton:
    """Automaton of a byte-level BPE vocabulary (the text of a tokenizer's JSON file)."""

    def __init__(self, tokenizer_json: str):
        self.name = hashlib.sha256(tokenizer_json.encode()).hexdigest()
        spec = json.loads(tokenizer_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.labels[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode()
        # Tokens: rank of the merge that makes it (0: a byte, -1: none), its left part, the state its arcs enter.
        self.rank, self.left, self.enters = [-1] * size, [0] * size, [0] * size
        for c in alphabet:
            if c in vocab:
                self.rank[vocab[c]] = 0
        # States: rank of the merge that made it, the state it is a copy of, the arc it lacks.
        self.made, self.copy_of, self.lacks = [0], [0], [-1]
        self.arcs: dict[int, bool] = {}
        for k, merge in enumerate(merges, 1):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(k, vocab[a], vocab[b], vocab[a + b])
        self._build_trie()

    def _gadget(self, k: int, u: int, v: int, uv: int) -> None:
        q = self.enters[u]
        if self.rank[u] < 0 or self.rank[v] < 0 or self.rank[uv] >= 0 or not self.allowed(q, v):
            return
        self.rank[uv], self.left[uv], self.enters[uv] = k, u, self.enters[v]
        self.enters[u] = len(self.made)
        self.made.append(k)
        self.copy_of.append(q)
        self.lacks.append(v)

    def _build_trie(self) -> None:
        self.step: dict[int, int] = {}
        self.token_at = [-1]
        for t, label in enumerate(self.labels):
            if self.rank[t] < 0:
                continue
            node = 0
            for byte in label:
                nxt = self.step.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.step[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = t
        self.inner = bytearray(len(self.token_at))  # nodes that a longer label passes
        for key in self.step:
            self.inner[key >> 8] = 1

    def __getstate__(self):
        return self.__dict__ | {"arcs": {}}

    def allowed(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc labelled ``token``."""
        key = state * len(self.labels) + token
        known = self.arcs.get(key)
        if known is None:
            rank, made, left, lacks, copy_of = self.rank, self.made, self.left, self.lacks, self.copy_of
            known = True
            while state:
                if rank[token] >= made[state]:  # an arc made later: where the left part's arc is
                    token = left[token]
                elif token == lacks[state]:
                    known = False
                    break
                else:
                    state = copy_of[state]
            if len(self.arcs) >= CACHE_ARCS:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def encode_bytes(self, word: bytes) -> list[int]:
        """Labels of the path that spells ``word``: depth first, longest label first. A prefix
        has one path only, so a place that led nowhere is not tried again."""
        n = len(word)
        step, token_at, enters, allowed = self.step.get, self.token_at, self.enters, self.allowed
        path: list[int] = []
        dead: set[int] = set()
        open_ends: list[list[tuple[int, int]]] = []  # for each place on the path: labels yet to try
        at = 0
        while at < n:
            if len(open_ends) == len(path):
                node, tries = 0, []
                for j in range(at, n):
                    node = step(node << 8 | word[j])
                    if node is None:
                        break
                    if token_at[node] >= 0:
                        tries.append((token_at[node], j + 1))
                open_ends.append(tries)
            state = enters[path[-1]] if path else 0
            tries = open_ends[-1]
            while tries:
                t, end = tries.pop()
                if end not in dead and allowed(state, t):
                    path.append(t)
                    at = end
                    break
            else:
                dead.add(at)
                open_ends.pop()
                at -= len(self.labels[path.pop()])
        return path

    def packed(self, word: str) -> bytes:
        """Ids of a pre-split word, 32-bit little-endian."""
        ids = self.encode_bytes(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)


class Splitter:
    """Pre-splitting of texts into words, by the pattern of byte-level BPE.

    The character classes are those of the tokenizers library: Python's, and
    where the installed Unicode tables differ, as the library's own splitter has
    it. ``classes[c]``: 0 letter, 1 number, 2 white space, 3 other.
    """

    def __init__(self, special: list[str]):
        self.classes = character_classes()
        letter, number, space = (self._ranges(k) for k in range(3))
        self.pattern = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                        rf"|[{space}]+(?![^{space}])|[{space}]+")
        # At one place the longest of the special strings counts, as listed otherwise.
        self.special = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))

    def _ranges(self, k: int) -> str:
        at = np.flatnonzero(self.classes == k)
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
        return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)

    def compiled(self) -> tuple[re.Pattern, re.Pattern | None]:
        return re.compile(self.pattern), re.compile(f"({self.special})") if self.special else None


def character_classes() -> np.ndarray:
    import regex
    from tokenizers import pre_tokenizers
    chars = [chr(c) for c in range(sys.maxunicode + 1)]

    def own(c: str) -> int:
        k = unicodedata.category(c)[0]
        return 0 if k == "L" else 1 if k == "N" else 2 if c.isspace() and not "\x1c" <= c <= "\x1f" else 3

    out = np.fromiter(map(own, chars), np.uint8, len(chars))
    other = np.full(len(chars), 3, np.uint8)
    everything = "".join(chars)
    for k, p in enumerate((r"\p{L}", r"\p{N}", r"\s")):
        other[[m.start() for m in regex.finditer(p, everything)]] = k
    unsure = [chars[i] for i in np.flatnonzero(out != other) if not 0xD800 <= i < 0xE000]
    # Each is put behind a letter, a number and a sign: it is of the class of what it is not split from.
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for lo in range(0, len(unsure), 5000):
        part = unsure[lo:lo + 5000]
        starts = {a for _, (a, _) in split("".join(f"a{c}\n1{c}\n!{c}!\n" for c in part))}
        for i, c in enumerate(part):
            joined = [k for k, at in ((0, 1), (1, 4), (3, 7)) if i * 10 + at not in starts]
            out[ord(c)] = joined[0] if joined else 2
    return out


_COMPILED: dict[str, tuple[Automaton, Splitter]] = {}


def compiled(path: str) -> tuple[Automaton, Splitter]:
    """Automaton and splitter of a tokenizer file, compiled once on the driver."""
    if path not in _COMPILED:
        with open(path, encoding="utf-8") as f:
            a = Automaton(f.read())
        _COMPILED[path] = a, Splitter(list(a.special))
    return _COMPILED[path]


class Encoder:
    """Encodes and decodes whole texts in a worker."""

    def __init__(self, automaton: Automaton, splitter: Splitter):
        self.automaton = automaton
        words, special = splitter.compiled()
        self.find_words = words.findall
        self.split_special = special.split if special else lambda text: [text]
        self.known = Remembered(automaton.packed)

    def encode(self, text: str) -> bytes:
        """Ids of the text, 32-bit little-endian."""
        out: list[bytes] = []
        for n, part in enumerate(self.split_special(text)):
            if n % 2:
                out.append(struct.pack("<I", self.automaton.special[part]))
            else:
                out += map(self.known.__getitem__, self.find_words(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        label = self.automaton.labels.__getitem__
        return b"".join(map(label, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


# One of each kind in a worker, for the tasks that it runs one after the other.
_IN_WORKER: dict[tuple, object] = {}


def in_worker(kind, shared):
    """The worker's ``kind(automaton, splitter)`` of a broadcast tokenizer."""
    key = kind.__name__, shared.value[0].name
    if key not in _IN_WORKER:
        _IN_WORKER.clear()
        _IN_WORKER[key] = kind(*shared.value)
    return _IN_WORKER[key]


def encode_decode(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """Encode ``text`` (null: empty) of every row of ``docs`` and decode it again.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for,
    ``ids`` (array of int). One row out for each row in, equal rows included; an
    empty text has no tokens; an empty table gives no rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(compiled(tokenizer_path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = in_worker(Encoder, shared)
        for batch in batches:
            n, ids_hash, text_hash, ids = [], [], [], []
            for text in batch.column("text"):
                packed = coder.encode(text.as_py())
                n.append(len(packed) // 4)
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                text_hash.append(hashlib.sha256(coder.decode(packed).encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(packed, "<i4"))
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                    pa.array(text_hash, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(run, schema + (", ids array<int>" if with_ids else "")))



