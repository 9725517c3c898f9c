"""Byte-level BPE encoding and decoding without a regular expression.

1. A batch of texts becomes one array of code points, an end mark after each text. A table gives
   every code point its class; white space and apostrophes are told apart by the one or two code
   points that follow.
2. Each class is a function from scanner state to scanner state. These functions are closed
   under composition and there are few of them, so each is a small number and composing two is one
   look-up. Composition is associative: prefix products are taken block by block over the whole array
   at once, and the state before each code point tells whether a slice begins there.
3. A slice that is no token itself is merged pair by pair, the lowest rank first, the leftmost of
   equal ones. A bounded cache per task keeps what short slices became.
4. Every token's end in bytes is kept, so any range of a document's bytes can be decoded alone.

The rank file is a parameter; it must be at the same place for every executor. Long texts are
scanned in windows that hand on the state, so the arrays stay bounded.

Defined cases: a null or empty text has no tokens and decodes to no bytes. Repeated rows are
encoded each for itself. A null doc_id is kept. An empty table gives no rows. Other columns
are ignored, whatever their names. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventtally.llm.common import query, table

RANKS = "byte_bpe_50k.tiktoken"

# Code points scanned at a time, and texts gathered for it.
WINDOW = 1 << 20
# Slices of up to so many characters are cached, twice so many of them at most.
CACHED_CHARS = 64
CACHED_SLICES = 200_000
# Longest slice whose pairs are looked through for every merge.
SHORT_BYTES = 48

END_POINT = 0x110000

# Classes: the first four and END by code point, the others by what follows.
LETTER, NUMBER, OTHER, SPACE, END, JOINING, LONE, SHORT, LONG = range(9)
# JOINING: the last of a run of white space, a blank, before a slice that it opens.
# LONE: the last of a run of white space, no blank, before anything else.
# SHORT, LONG: an apostrophe before a contraction of one or two letters.
# SPACE itself is white space before white space or the end.

# States: what kind of slice is open.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, OPENED, CLOSED, ONE_LEFT, TWO_LEFT = range(8)
START = CLOSED

# The contractions of the pattern.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


def step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point of a class, and whether a slice begins with it."""
    if kind == END:
        return CLOSED, True
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    if kind == LONE:
        return CLOSED, True
    if kind == JOINING:
        return OPENED, True
    if kind == LETTER and state == TWO_LEFT:
        return ONE_LEFT, False
    if kind == LETTER and state == ONE_LEFT:
        return CLOSED, False
    if kind in (SHORT, LONG):
        if state in (IN_OTHERS, OPENED):
            return IN_OTHERS, False
        return (ONE_LEFT if kind == SHORT else TWO_LEFT), True
    inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
    return inside, state not in (inside, OPENED)


class Transitions:
    """All compositions of the class functions, as numbers with a table of products."""

    def __init__(self):
        kinds, states = range(9), range(8)
        self.begins = np.array([[step(s, k)[1] for s in states] for k in kinds])
        single = [tuple(step(s, k)[0] for s in states) for k in kinds]
        found = [tuple(states)]  # number 0 changes nothing
        known = {found[0]: 0}
        for function in found:
            for second in single:
                both = tuple(second[s] for s in function)
                if both not in known:
                    known[both] = len(found)
                    found.append(both)
        self.of_class = np.array([known[f] for f in single], np.uint8)
        self.count = len(found)
        self.product = np.array(
            [[known[tuple(b[s] for s in a)] for b in found] for a in found], np.uint8
        ).ravel()
        self.applied = np.array(found, np.uint8)

    def composed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.take(self.product, first.astype(np.int32) * self.count + second)

    def scanned(self, functions: np.ndarray, width: int = 32) -> np.ndarray:
        """The composition of all functions up to and with each."""
        n = len(functions)
        if n <= 1:
            return functions
        width = min(width, n)
        rows = -(-n // width)
        padded = np.zeros(rows * width, np.uint8)
        padded[:n] = functions
        # One block per column: each step works on all blocks at once.
        blocks = np.ascontiguousarray(padded.reshape(rows, width).T)
        for k in range(1, width):
            blocks[k] = self.composed(blocks[k - 1], blocks[k])
        if rows > 1:
            before = self.scanned(blocks[-1, :-1], width)
            blocks[:, 1:] = self.composed(np.broadcast_to(before, (width, rows - 1)), blocks[:, 1:])
        return blocks.T.ravel()[:n]


@cache
def transitions() -> Transitions:
    return Transitions()


@cache
def class_table() -> np.ndarray:
    """The class of every code point, by the Unicode tables that the vocabulary's splitter uses."""
    every = "".join(chr(c) for c in range(END_POINT) if not 0xD800 <= c < 0xE000)
    kinds = np.full(END_POINT + 1, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\p{White_Space}", SPACE)):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    kinds[END_POINT] = END
    return kinds


def classes(points: np.ndarray, count: int) -> np.ndarray:
    """The classes of the first `count` code points; two more follow, end marks if need be."""
    kinds = class_table()[points]
    own, after = kinds[:count], kinds[1 : count + 1]
    out = own.copy()
    last = (own == SPACE) & (after != SPACE) & (after != END)
    out[last] = np.where(points[:count][last] == ord(" "), JOINING, LONE)
    marks = np.flatnonzero(points[:count] == ord("'"))
    first, second = points[marks + 1], points[marks + 2]
    out[marks[np.isin(first, [ord(c) for c in ONE_LETTER])]] = SHORT
    for pair in TWO_LETTERS:
        out[marks[(first == ord(pair[0])) & (second == ord(pair[1]))]] = LONG
    return out


def slice_starts(points: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Where slices and end marks begin in an array of code points that ends with an end mark."""
    table_ = transitions()
    padded = np.concatenate([points, np.full(2, END_POINT, points.dtype)])
    state, found = START, []
    for low in range(0, len(points), window):
        count = min(window, len(points) - low)
        kinds = classes(padded[low : low + count + 2], count)
        after = table_.applied[table_.scanned(table_.of_class[kinds]), state]
        before = np.concatenate([[state], after[:-1]])
        found.append(low + np.flatnonzero(table_.begins[kinds, before]))
        state = int(after[-1])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def slices_of(texts: list[str]) -> Iterator[list[str]]:
    """The slices of each text, in order."""
    end = np.array([END_POINT], np.uint32)
    points = np.concatenate([part for text in texts for part in (points_of(text), end)])
    starts = slice_starts(points)
    low = 0
    for text in texts:
        first, last = np.searchsorted(starts, [low, low + len(text)])
        cuts = (starts[first : last + 1] - low).tolist()
        yield [text[a:b] for a, b in zip(cuts, cuts[1:])]
        low += len(text) + 1


class Merger(dict):
    """The ids of a slice, merged when first asked for.

    When it is full, its slices are kept aside as the older ones, in the place of those kept
    before, and come back when they are asked for again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.merged(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_SLICES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Merge neighbours until no pair is a token, the lowest rank first, the leftmost of equal ones."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        cuts = self.cuts_of_short(piece) if len(piece) <= SHORT_BYTES else self.cuts_of_long(piece)
        return tuple([self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])])

    def cuts_of_short(self, piece: bytes) -> list[int]:
        """Where the parts end, by looking through the ranks of all pairs for each merge."""
        get, none = self.ranks.get, len(self.ranks) + 1_000_000
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[at : at + 2], none) for at in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < none:
            at = pairs.index(low)
            del cuts[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = get(piece[cuts[at] : cuts[at + 2]], none)
            if at:
                pairs[at - 1] = get(piece[cuts[at - 1] : cuts[at + 1]], none)
        return cuts

    def cuts_of_long(self, piece: bytes) -> list[int]:
        """The same with a heap: n log n for a slice of n bytes."""
        ranks = self.ranks
        size = len(piece)
        end = list(range(1, size + 1))  # of the part that begins here; 0 once it is merged away
        before = list(range(-1, size - 1))
        waiting = [
            (rank, at, at + 2) for at in range(size - 1) if (rank := ranks.get(piece[at : at + 2])) is not None
        ]
        heapify(waiting)
        while waiting:
            _, at, stop = heappop(waiting)
            middle = end[at]
            # Both parts must still be what they were when the pair was noted.
            if not middle or middle >= stop or end[middle] != stop:
                continue
            end[at], end[middle] = stop, 0
            if stop < size:
                before[stop] = at
                rank = ranks.get(piece[at : end[stop]])
                if rank is not None:
                    heappush(waiting, (rank, at, end[stop]))
            if at:
                left = before[at]
                rank = ranks.get(piece[left:stop])
                if rank is not None:
                    heappush(waiting, (rank, left, stop))
        cuts = [0]
        while cuts[-1] < size:
            cuts.append(end[cuts[-1]])
        return cuts


class Vocabulary:
    """The tokens of a rank file, by bytes and by id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        lengths = np.zeros(max(self.ranks.values(), default=-1) + 1, np.int64)
        for token, rank in self.ranks.items():
            lengths[rank] = len(token)
        by_id = sorted(self.ranks, key=self.ranks.__getitem__)
        self.lengths = lengths
        self.places = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.merger = Merger(self.ranks)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for pieces in slices_of(texts):
            yield np.fromiter(chain.from_iterable(map(self.merger.__getitem__, pieces)), np.int32)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Where each token ends, in bytes of its text."""
        return np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray, ends: np.ndarray, low: int = 0, high: int | None = None) -> bytes:
        """The bytes from `low` to `high` of a text, from the tokens that reach into them only."""
        total = int(ends[-1]) if len(ends) else 0
        high = total if high is None else min(high, total)
        if low >= high:
            return b""
        first, last = np.searchsorted(ends, [low, high - 1], side="right")
        ids, ends = ids[first : last + 1], ends[first : last + 1]
        lengths = self.lengths[ids]
        starts = ends - lengths
        if (starts[1:] != ends[:-1]).any():
            raise ValueError("the ends of the tokens do not fit their ids")
        source = np.arange(starts[0], ends[-1]) + np.repeat(self.places[ids] - starts, lengths)
        return self.bytes[source][low - starts[0] : high - starts[0]].tobytes()


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(path)


def default_path() -> str:
    return public_tokenizers.path(RANKS)


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays of numbers as one column."""
    places = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(values, kind))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, the ids of the text and where each ends, in bytes of the text."""
    path = path or default_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)

        def coded(keys: list, texts: list[str]) -> pa.RecordBatch:
            ids = list(words.encode(texts))
            ends = [words.ends(i) for i in ids]
            columns = [pa.array(keys, kind), lists(ids, pa.int32()), lists(ends, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "ends"])

        for batch in batches:
            kind = batch.schema.field(0).type
            keys, texts, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= WINDOW:
                    yield coded(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield coded(keys, texts)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, ids array<int>, ends array<bigint>"
    )


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, ends and the bytes of the whole text."""
    path = path or default_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [
                words.decode(i.values.to_numpy(zero_copy_only=False), e.values.to_numpy(zero_copy_only=False))
                for i, e in zip(batch.column(1), batch.column(2))
            ]
            columns = [*batch.columns, pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "ends", "decoded"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "ids", "ends").mapInArrow(
        decode, f"doc_id {kind}, ids array<int>, ends array<bigint>, decoded binary"
    )


@query()
def op11_byte_bpe(spark, sf_dir):
    """Every document as ids of the rank file, and its bytes from the ids."""
    docs = table(spark, sf_dir, "documents")
    return decoded(encoded(docs)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
