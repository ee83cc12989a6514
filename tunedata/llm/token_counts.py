"""Token counts by deterministic finite-state transducers.

Two machines are compiled from a tokenizer file. The split transducer reads
character classes; its transitions say where words start (at this character,
at the one before). A batch of texts is cut into chunks of equal length; each
chunk's map from entry state to exit state is computed for all entry states at
once, and the maps are composed by a parallel prefix scan, which gives every
chunk its true entry state. The word transducer reads the bytes of a word; its
transitions carry the change in the number of tokens of the prefix read so
far. Its states are made when first reached: a state holds, for each place
where a token of the vocabulary may still be open, the trie node, the automaton
state before it and the tokens before it, less those of the whole prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunedata.llm.bpe import Automaton, Remembered, Splitter, compiled, in_worker
from tunedata.llm.common import python_ready, text_or_empty

CACHE_STATES = 150_000
CHUNK = 256

# Classes of characters: letters by their part in 's 't 'm 'd 're 've 'll.
LETTER, NUMBER, SPACE, OTHER, BLANK, QUOTE, STMD, R_OR_V, E, L, END = range(11)
# States of the split transducer.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, BLANK_1, SPACE_1, BLANK_N, SPACE_N, QUOTED, QUOTED_RV, QUOTED_L = range(11)
HERE, BEFORE = 1, 2


def _transition(state: int, c: int) -> tuple[int, int]:
    """Next state and starts: HERE if a word starts at this character, BEFORE if one
    starts at the character before it."""
    letter = c in (LETTER, STMD, R_OR_V, E, L)
    if c == END:  # an open 'r, 'v or 'l is a sign and a letter
        return START, BEFORE if state in (QUOTED_RV, QUOTED_L) else 0
    if state == QUOTED:
        if c == STMD:
            return START, 0
        if c == R_OR_V:
            return QUOTED_RV, 0
        if c == L:
            return QUOTED_L, 0
        if letter:
            return IN_LETTERS, HERE
        if c in (OTHER, QUOTE):
            return IN_OTHER, 0
        return _transition(START, c)
    if state in (QUOTED_RV, QUOTED_L):
        if (state, c) in ((QUOTED_RV, E), (QUOTED_L, L)):
            return START, 0
        after, starts = _transition(IN_LETTERS, c)
        return after, starts | BEFORE
    if c in (BLANK, SPACE):
        if state in (BLANK_1, SPACE_1, BLANK_N, SPACE_N):
            return (BLANK_N if c == BLANK else SPACE_N), 0
        return (BLANK_1 if c == BLANK else SPACE_1), HERE
    run = IN_LETTERS if letter else IN_NUMBERS if c == NUMBER else IN_OTHER
    if state == BLANK_1:  # a blank belongs to the word behind it
        return run, 0
    if state == BLANK_N:
        return run, BEFORE
    before = BEFORE if state == SPACE_N else 0
    if state == run:
        return run, 0
    return (QUOTED if c == QUOTE else run), HERE | before


TABLE = np.array([[_transition(s, c)[0] for c in range(11)] for s in range(11)], np.uint8)
STARTS = np.array([[_transition(s, c)[1] for c in range(11)] for s in range(11)], np.uint8)


def split_classes(splitter: Splitter) -> np.ndarray:
    """Class of every code point for the split transducer."""
    out = np.array([LETTER, NUMBER, SPACE, OTHER], np.uint8)[splitter.classes]
    for chars, k in ((" ", BLANK), ("'", QUOTE), ("stmd", STMD), ("rv", R_OR_V), ("e", E), ("l", L)):
        out[[ord(c) for c in chars]] = k
    return out


def entry_states(chunks: np.ndarray) -> np.ndarray:
    """State before each chunk (rows of classes) of one run of text: the chunks' state
    maps, composed by a prefix scan."""
    n, states = len(chunks), len(TABLE)
    table = TABLE.ravel()
    maps = np.repeat(np.arange(states, dtype=np.uint8)[None, :], n, 0)
    for column in np.ascontiguousarray(chunks.T):
        maps = table[maps.astype(np.intp) * TABLE.shape[1] + column[:, None]]
    step = 1
    while step < n:  # maps[i] becomes maps[i] after maps[i - step]
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), 1)
        step *= 2
    return np.concatenate([[START], maps[:-1, START]]).astype(np.uint8)


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Boolean per character: a word starts here. Texts are ended by END, which counts
    as a start of its own."""
    n = len(classes)
    padded = np.full(-(-n // CHUNK) * CHUNK, END, np.uint8)
    padded[:n] = classes
    chunks = padded.reshape(-1, CHUNK)
    state = entry_states(chunks).astype(np.intp)
    table, starts = TABLE.ravel(), STARTS.ravel()
    flags = np.empty((CHUNK, len(chunks)), np.uint8)
    for k, column in enumerate(np.ascontiguousarray(chunks.T)):
        at = state * TABLE.shape[1] + column
        flags[k] = starts[at]
        state = table[at].astype(np.intp)
    flat = flags.T.ravel()[:n]
    out = flat & HERE > 0
    out[:-1] |= flat[1:] & BEFORE > 0
    out |= classes == END
    return out


class WordTransducer:
    """Deterministic transducer over bytes with emitted token counts."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.clear()

    def clear(self) -> None:
        self.numbers = {((0, 0, 0),): 0}  # open places: trie node, automaton state, tokens before
        self.places = [((0, 0, 0),)]
        self.arcs: dict[int, tuple[int, int]] = {}

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        a, still, last = self.automaton, [], None
        for node, q, tokens in self.places[state]:
            nxt = a.step.get(node << 8 | byte)
            if nxt is None:
                continue
            if a.inner[nxt]:
                still.append((nxt, q, tokens))
            t = a.token_at[nxt]
            if t >= 0 and last is None and a.allowed(q, t):
                last = a.enters[t], tokens + 1
        after, emitted = last
        key = (*((node, q, tokens - emitted) for node, q, tokens in still), (0, after, 0))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.places)
            self.places.append(key)
        self.arcs[state << 8 | byte] = number, emitted
        return number, emitted

    def count(self, word: bytes) -> int:
        if len(self.places) > CACHE_STATES:
            self.clear()
        state, total, known = 0, 0, self.arcs.get
        for byte in word:
            state, emitted = known(state << 8 | byte) or self._arc(state, byte)
            total += emitted
        return total


class Counter:
    """Counts the tokens of batches of texts in a worker."""

    def __init__(self, automaton: Automaton, splitter: Splitter):
        self.transducer = WordTransducer(automaton)
        self.known = Remembered(lambda word: self.transducer.count(word.encode()))
        self.classes = split_classes(splitter)
        special = splitter.compiled()[1]
        self.split_special = special.split if special else lambda text: [text]

    def count(self, texts: list[str]) -> list[int]:
        parts, owner, out = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = self.split_special(text)
            out[i] += len(pieces) // 2  # every second piece is a special token
            parts += pieces[::2]
            owner += [i] * (len(pieces) // 2 + 1)
        if not texts:
            return []
        whole = "\0".join(parts) + "\0"
        classes = self.classes[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        classes[ends] = END
        at = np.flatnonzero(word_starts(classes))
        starts = at[classes[at] != END]
        stops = at[np.searchsorted(at, starts) + 1]
        words = map(whole.__getitem__, map(slice, starts.tolist(), stops.tolist()))
        counts = np.array(list(map(self.known.__getitem__, words)), np.int64)
        np.add.at(out, np.asarray(owner, np.intp)[np.searchsorted(ends, starts)], counts)
        return out.tolist()


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs`` (null text: empty).

    One row out for each row in, equal rows included; an empty text has no
    tokens; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(compiled(tokenizer_path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = in_worker(Counter, shared)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"))
