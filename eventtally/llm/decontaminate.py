"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with every run of other characters than letters and digits as one
space. An item of n characters may differ by k = floor(rate * n) edits. Cut into k + 1 pieces, one
piece at least must then occur unchanged, so all pieces of all items are searched at once (Aho-
Corasick), and each hit gives a stretch of text where the item may lie. A stretch must share enough
4-grams with the item (k edits can spoil at most 4 k of them), and is then verified with Myers'
bit-parallel edit distance.

The search goes over the documents where they are, without a shuffle. Items are sent to the tasks in
shards of a bounded size; more items mean more passes, never a larger shard.

Items of fewer than `least_chars` characters are searched for word for word: so few occur with edits in any
prose. Where the script parts words by spaces, they must begin and end with a word.

Defined cases: a null or empty text holds nothing. Items that are null or have no letter or digit are
left out. A capital whose small form is longer stays as it is, in items and documents alike. Repeated
items are found each under their id, repeated documents each under theirs. Several occurrences
of an item give a row each; occurrences that overlap count as one. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.llm.common import query, table

OTHERS = re.compile(r"[\W_]+")
KEPT = re.compile(r"[^\W_]+")
GRAM = 4

RATE = 0.08
LEAST_CHARS = 40
# Scripts that write words without spaces: Thai to Lao, Myanmar, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
# Characters of items that one pass over the documents searches for.
SHARD_CHARS = 1_000_000

SCHEMA = "doc_id long, item_id long, edits int, start long, end long"


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.replace("ς", "σ")  # as the end of a word, sigma has two small forms


def plain(text: str) -> str:
    return OTHERS.sub(" ", lowered(text)).strip()


def places(text: str) -> list[tuple[int, int, int]]:
    """(start in plain text, start, length) of the runs of letters and digits of a text."""
    found, at = [], 0
    for match in KEPT.finditer(lowered(text)):
        found.append((at, match.start(), len(match[0])))
        at += len(match[0]) + 1
    return found


def original(spots: list[tuple[int, int, int]], low: int, high: int) -> tuple[int, int]:
    """The stretch of the original text that a stretch of the plain text comes from."""
    start, end = None, 0
    for at, place, length in spots:
        if at >= high:
            break
        if at + length > low:
            if start is None:
                start = place + max(0, low - at)
            end = place + min(length, high - at)
    return (0, 0) if start is None else (start, end)


def distances(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """After each character of the text, the edits between the pattern and the best stretch that
    ends there: one that starts anywhere or, if anchored, at the start of the text.

    Myers' algorithm: one column of the distance table as two bit vectors.
    """
    masks: dict[str, int] = defaultdict(int)
    for k, c in enumerate(pattern):
        masks[c] |= 1 << k
    find = masks.get
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    carry = 1 if anchored else 0
    up, down, score = full, 0, len(pattern)
    for c in text:
        eq = find(c, 0)
        both = eq | down
        across = (((eq & up) + up) ^ up) | eq
        more = down | ~(across | up) & full
        less = up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = (more << 1) | carry
        less <<= 1
        up = (less | ~(both | more)) & full
        down = more & both
        yield score


def matches(pattern: str, text: str, most: int) -> Iterator[tuple[int, int]]:
    """(end, edits): where the pattern ends in the text within `most` edits, best of each run."""
    best: tuple[int, int] | None = None
    for end, score in enumerate(distances(pattern, text), 1):
        if score <= most:
            if best is None or score < best[1]:
                best = (end, score)
        elif best is not None:
            yield best
            best = None
    if best is not None:
        yield best


def length_before(pattern: str, text: str, end: int, edits: int) -> int:
    """The length of the stretch that ends there and is so many edits from the pattern."""
    if not edits:
        return len(pattern)
    tail = text[max(0, end - len(pattern) - edits) : end][::-1]
    backwards = distances(pattern[::-1], tail, anchored=True)
    return min((score, n) for n, score in enumerate(backwards, 1))[1]


class Items:
    """A shard of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_chars: int = LEAST_CHARS):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.exact = [len(t) < least_chars for t in self.texts]
        self.budgets = [0 if exact else int(len(t) * rate) for t, exact in zip(self.texts, self.exact)]
        self.grams = [[t[k : k + GRAM] for k in range(len(t) - GRAM + 1)] for t in self.texts]
        spots: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (text, budget) in enumerate(zip(self.texts, self.budgets)):
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for low, high in zip(cuts, cuts[1:]):
                spots[text[low:high]].append((number, high))
        self.search = ahocorasick.Automaton()
        for piece, where in spots.items():
            self.search.add_word(piece, where)
        if spots:
            self.search.make_automaton()
        self.empty = not spots

    def candidates(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, low, high): the stretches of the plain text that may hold an item."""
        starts: dict[int, list[int]] = defaultdict(list)
        for end, where in self.search.iter(text):
            for number, reach in where:
                starts[number].append(end + 1 - reach)
        for number, found in starts.items():
            budget, size = self.budgets[number], len(self.texts[number])
            if self.exact[number]:
                yield from ((number, low, low + size) for low in found if self.is_whole(number, text, low))
                continue
            found.sort()
            low = high = found[0]
            for start in found[1:]:
                if start - high > 2 * budget:
                    yield number, max(0, low - budget), high + size + budget
                    low = start
                high = start
            yield number, max(0, low - budget), high + size + budget

    def is_whole(self, number: int, text: str, low: int) -> bool:
        """Whether a short item that lies there begins and ends with a word."""
        item, high = self.texts[number], low + len(self.texts[number])
        begins = low == 0 or text[low - 1] == " " or UNSPACED.match(item[0])
        ends = high == len(text) or text[high] == " " or UNSPACED.match(item[-1])
        return bool(begins and ends)

    def similar(self, number: int, stretch: str) -> bool:
        """Whether enough 4-grams are shared for the item to be within its budget."""
        there = {stretch[k : k + GRAM] for k in range(len(stretch) - GRAM + 1)}
        shared = sum(gram in there for gram in self.grams[number])
        return shared >= len(self.grams[number]) - GRAM * self.budgets[number]

    def found(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of every occurrence in an original text."""
        if self.empty:
            return
        rewritten = plain(text)
        spots = None
        for number, low, high in self.candidates(rewritten):
            if self.exact[number]:
                spots = spots or places(text)
                yield self.ids[number], 0, *original(spots, low, high)
                continue
            stretch = rewritten[low:high]
            if not self.similar(number, stretch):
                continue
            item, budget = self.texts[number], self.budgets[number]
            for end, edits in matches(item, stretch, budget):
                length = length_before(item, stretch, end, edits)
                spots = spots or places(text)
                yield self.ids[number], edits, *original(spots, low + end - length, low + end)


def item_shards(items: DataFrame, shortest: int, shard_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items of `shortest` characters and more in shards of bounded size; the driver holds one
    shard at a time."""
    shard, size = [], 0
    for row in items.filter(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator():
        text = plain(row["text"])
        if len(text) >= shortest:
            shard.append((row["item_id"], text))
            size += len(text)
            if size >= shard_chars:
                yield shard
                shard, size = [], 0
    yield shard


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    rate: float = RATE,
    least_chars: int = LEAST_CHARS,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """doc_id, item_id, edits and the stretch (start, end) of every occurrence of an item."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for shard in item_shards(items, 1, shard_chars):

        def scan(batches: Iterator[pa.RecordBatch], shard=shard) -> Iterator[pa.RecordBatch]:
            search = Items(shard, rate, least_chars)
            for batch in batches:
                rows = [
                    (doc_id, *hit)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for hit in search.found(text.as_py() or "")
                ]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "edits", "start", "end"],
                )

        parts.append(given.mapInArrow(scan, SCHEMA))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def without_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item; those without an id are kept unless they hold one.

    Items of fewer than 40 characters are no reason to drop a document. The mark is made while the documents are read, so nothing is joined or shuffled.
    """
    kept = docs
    for shard in item_shards(items, LEAST_CHARS, SHARD_CHARS):

        def clean(batches: Iterator[pa.RecordBatch], shard=shard) -> Iterator[pa.RecordBatch]:
            search = Items(shard, RATE)
            for batch in batches:
                text = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(
                    pa.array([next(search.found(t.as_py() or ""), None) is None for t in text], pa.bool_())
                )

        kept = kept.mapInArrow(clean, kept.schema)
    return kept


@query()
def op3_decontamination(spark, sf_dir):
    """Every occurrence of a benchmark item in a document."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
