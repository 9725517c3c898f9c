"""Phrase collocation mining with HAT-tries.

Counting. Every task reads its texts as a stream of word ids and adds each window of words to the
trie of its language: a shallow trie of word ids whose leaves are hash containers of the words
that follow. A container with more than `BURST` entries bursts: each word that begins many of its entries
gets a container of its own, the others go on sharing one. When the tries of a task hold `ENTRIES`, the
largest subtrees of the root are spilled whole, as runs sorted by words, one per prefix partition:
the words of a run, then the windows as numbers of these words, then their counts. A window goes by a
hash of as many first words as the shortest phrase has, so each partition has all windows that
begin a phrase. Runs of a partition are merged by one task, which adds up every prefix.

Pruning. Only a phrase all of whose parts are frequent can be frequent. Words are counted first,
then pairs of frequent words, then windows in which every pair is frequent. What is frequent
goes to the tasks as a bitmap of `BITS` hashed places, whatever their number: a collision lets a
phrase be counted that is dropped later, and loses none.

Scoring. Each cut of a candidate is joined with the counts of its two parts; a candidate is dropped
when it lies in a longer one that is as frequent.

Defined cases: a null or empty text has no words. A null language is `und`. Repeated rows count
each. Ties in score go by count, then by phrase. A text or word of any length is taken whole. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import compress, decompress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import LOWER, UPPER, query, table
from eventtally.session import stored

UNKNOWN = "und"
LEAST = 100
LONGEST = 5
MOST_PHRASES = 2000

BURST = 16_384  # entries of a container
HEAVY = 128  # entries that a word needs for a container of its own
ENTRIES = 600_000  # of all tries of a task
WORDS = 400_000  # ids given out in a task before they are given anew
BLOCK = 1 << 22  # bytes of text taken at a time
BITS = 1 << 26
SEGMENT = 1 << 15  # bits of an entry of Spark's bitmap functions
MERGED_ROWS = 2_000_000  # windows of a partition before they are added up

GAP = b"\xff"  # no byte of UTF-8
# What ends a piece, and the second blank.
ENDS_OF_PIECES = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes.maketrans(
    UPPER.encode() + ENDS_OF_PIECES + b"\t", LOWER.encode() + GAP * len(ENDS_OF_PIECES) + b" "
)

RUN_SCHEMA = "part int, lang string, words binary, windows binary, counts binary"
PHRASE_SCHEMA = "lang string, phrase string, words int, n long"
PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


class Node(dict):
    """The words that begin many entries, each with its node or container; and the others together."""

    def __init__(self, shared: Counter):
        super().__init__()
        self.shared = shared
        self.limit = 0  # entries of the shared container at which it is looked through again


def keys_of(windows: np.ndarray) -> list[bytes]:
    """Every row of ids as bytes."""
    rows = np.ascontiguousarray(windows)
    return rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel().tolist()


def groups_of(windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The indexes of the rows with each first id."""
    if not len(windows):
        return
    order = np.argsort(windows[:, 0], kind="stable")
    first = windows[order, 0]
    cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    for low, high in zip(cuts, np.append(cuts[1:], len(first))):
        yield int(first[low]), order[low:high]


class HatTrie:
    """Counts of windows of `width` word ids; shorter windows end in zeros."""

    def __init__(self, width: int, burst: int = BURST, heavy: int = HEAVY):
        self.width, self.burst, self.heavy, self.size = width, burst, heavy, 0
        self.root: Node | Counter = Counter()

    def add(self, windows: np.ndarray) -> None:
        if len(windows):
            self.root = self._add(self.root, windows)

    def _add(self, node: Node | Counter, windows: np.ndarray) -> Node | Counter:
        if isinstance(node, Counter):
            self._count(node, windows)
            if windows.shape[1] > 1 and len(node) > self.burst:
                return self._burst(Node(node), windows.shape[1])
            return node
        own = np.isin(windows[:, 0], np.fromiter(node, np.uint32, len(node)))
        self._count(node.shared, windows[~own])
        windows = windows[own]
        for word, at in groups_of(windows):
            node[word] = self._add(node[word], windows[at, 1:])
        return self._burst(node, windows.shape[1]) if len(node.shared) > node.limit else node

    def _count(self, container: Counter, windows: np.ndarray) -> None:
        before = len(container)
        container.update(keys_of(windows))
        self.size += len(container) - before

    def _burst(self, node: Node, width: int) -> Node:
        """Give words with many entries in the shared container one of their own."""
        windows, counts = entries_of(node.shared, width)
        rest = np.ones(len(windows), bool)
        for word, at in groups_of(windows):
            if len(at) >= self.heavy:
                node[word] = Counter(dict(zip(keys_of(windows[at, 1:]), counts[at].tolist())))
                rest[at] = False
        node.shared = Counter(dict(zip(keys_of(windows[rest]), counts[rest].tolist())))
        node.limit = max(self.burst, 2 * len(node.shared))
        return node

    def spilled(self, keep: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Take out the largest subtrees of the root until `keep` entries are left: windows, counts."""
        root = self.root
        if isinstance(root, Counter) or not keep:
            found = entries_of(root, self.width)
            self.root, self.size = Counter(), 0
            return found
        taken = Node(Counter())
        sizes = sorted(((entries_in(child), word) for word, child in root.items()), reverse=True)
        for size, word in sizes:
            if self.size <= keep:
                break
            taken[word] = root.pop(word)
            self.size -= size
        if self.size > keep:
            self.size -= len(root.shared)
            taken.shared, root.shared = root.shared, Counter()
        return entries_of(taken, self.width)


def entries_in(node: Node | Counter) -> int:
    if isinstance(node, Counter):
        return len(node)
    return len(node.shared) + sum(map(entries_in, node.values()))


def entries_of(node: Node | Counter, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows below a node, and their counts."""
    if isinstance(node, Counter):
        windows = np.frombuffer(b"".join(node), ">u4").reshape(-1, width)
        return windows, np.fromiter(node.values(), np.int64, len(node))
    shared, counts = entries_of(node.shared, width)
    parts, numbers = [shared], [counts]
    for word, child in node.items():
        rest, counts = entries_of(child, width - 1)
        parts.append(np.concatenate([np.full((len(rest), 1), word, ">u4"), rest], axis=1))
        numbers.append(counts)
    return np.concatenate(parts), np.concatenate(numbers)


def hashed(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash for each pair of hashes; order counts."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29)))
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


class Bitmap:
    """Places of hashes; one that was never put in may seem to be there, none is lost."""

    def __init__(self, bits: bytes):
        self.raw, self.bits = bits, np.frombuffer(bits, np.uint8)

    def holds(self, code: int) -> bool:
        place = code & (len(self.raw) * 8 - 1)
        return bool(self.raw[place >> 3] >> (place & 7) & 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64(len(self.bits) * 8 - 1)).astype(np.int64)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(phrases: DataFrame, bits: int = BITS) -> bytes:
    """The bitmap of phrases (lang, phrase) of one or two words; `bits` / 8 bytes come to the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            split = [[hashed(lang.encode(), w.encode()) for w in phrase.split(" ")] for lang, phrase in rows]
            first = np.array([s[0] for s in split], np.uint64)
            last = np.array([s[-1] for s in split], np.uint64)
            single = np.array([len(s) == 1 for s in split], bool)
            place = np.where(single, first, pair_hashes(first, last)) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], names=["place"])

    place = phrases.select("lang", "phrase").mapInArrow(places, "place long")
    segments = (
        place.groupBy(F.floor(F.col("place") / SEGMENT).alias("segment"))
        .agg(F.bitmap_construct_agg(F.col("place") % SEGMENT).alias("bits"))
        .collect()
    )
    out = bytearray(bits // 8)
    for row in segments:
        low = row["segment"] * SEGMENT // 8
        part = bytes(row["bits"])[: bits // 8 - low]
        out[low : low + len(part)] = part
    return bytes(out)


class Vocabulary(dict):
    """Ids of words, from 1 in the order they come; 0 for gaps and for words that are not frequent."""

    def __init__(self, lang: str, frequent: Bitmap | None):
        super().__init__({GAP: 0})
        self.lang, self.frequent = lang.encode(), frequent
        self.words = [b""]
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        code = hashed(self.lang, word)
        number = 0
        if self.frequent is None or self.frequent.holds(code):
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(code)
        self[word] = number
        return number


class Counted:
    """The windows of one language in one task."""

    def __init__(self, lang: str, lengths: tuple[int, int], words: Bitmap | None, pairs: Bitmap | None):
        self.lang, self.frequent, self.pairs = lang, words, pairs
        self.shortest, self.longest = lengths
        self.ids = Vocabulary(lang, words)
        self.trie = HatTrie(self.longest)
        self.tail = np.zeros(0, np.int64)
        self.waiting: list[bytes] = []
        self.bytes = 0

    def feed(self, text: str) -> Iterator[None]:
        """Take a text; gives way whenever a block has been counted."""
        data = text.encode("utf-8", "surrogatepass").translate(BYTES) + GAP
        low = 0
        while self.bytes + len(data) - low >= BLOCK:
            # A block ends before a blank, so no word is cut.
            high = data.find(b" ", low + max(BLOCK - self.bytes, 0))
            high = len(data) if high < 0 else high
            self._keep(data[low:high])
            low = high
            self.count()
            yield
        self._keep(data[low:])

    def _keep(self, data: bytes) -> None:
        self.waiting.append(data)
        self.bytes += len(data)

    def count(self, last: bool = False) -> None:
        """Add the windows of what waits; those that may go on in the next block wait too."""
        found = b" ".join(self.waiting).replace(GAP, b" " + GAP + b" ").split()
        self.waiting, self.bytes = [], 0
        new = np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))
        ids = np.concatenate([self.tail, new])
        held = 0 if last else min(self.longest - 1, len(ids))
        self.tail = ids[len(ids) - held :]
        self.trie.add(self.windows(ids, len(ids) - held))

    def windows(self, ids: np.ndarray, starts: int) -> np.ndarray:
        """The longest window at each of the first `starts` words, if it is long enough."""
        padded = np.concatenate([ids, np.zeros(self.longest, np.int64)])
        there = padded > 0
        linked = there[:-1] & there[1:]
        if self.pairs is not None:
            hashes = np.array(self.ids.hashes, np.uint64)
            at = np.flatnonzero(linked)
            linked[at] = self.pairs.has(pair_hashes(hashes[padded[at]], hashes[padded[at + 1]]))
        columns = [padded[:starts]]
        going = there[:starts]
        length = going.astype(np.int64)
        for k in range(1, self.longest):
            going = going & linked[k - 1 : k - 1 + starts]
            columns.append(np.where(going, padded[k : k + starts], 0))
            length += going
        kept = length >= self.shortest
        return np.stack([c[kept] for c in columns], axis=1).astype(">u4")

    def run(self, parts: int, keep: int = 0) -> Iterator[pa.RecordBatch]:
        """Spill subtrees as sorted runs, one per prefix partition."""
        windows, counts = self.trie.spilled(keep)
        if not len(counts):
            return
        words = self.ids.words
        by_rank = np.array(sorted(range(len(words)), key=words.__getitem__))
        rank = np.empty(len(words), np.int64)
        rank[by_rank] = np.arange(len(words))
        windows = windows.astype(np.int64)
        hashes = np.array(self.ids.hashes, np.uint64)
        code = hashes[windows[:, 0]]
        for k in range(1, self.shortest):
            code = pair_hashes(code, hashes[windows[:, k]])
        part = ((code >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
        ranked = rank[windows]
        order = np.lexsort([*ranked.T[::-1], part])
        part, ranked, counts = part[order], ranked[order], counts[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        rows = []
        for low, high in zip(cuts, np.append(cuts[1:], len(part))):
            there, numbers = np.unique(ranked[low:high], return_inverse=True)
            named = b"\n".join([words[k] for k in by_rank[there].tolist()])  # no word has a line end
            columns = numbers.reshape(high - low, -1).T.astype("<u4").tobytes()
            packed = (compress(x, 1) for x in (named, columns, counts[low:high].astype("<u8").tobytes()))
            rows.append((int(part[low]), self.lang, *packed))
        kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "lang", "words", "windows", "counts"])

    def renew(self) -> None:
        """Give out ids anew, after all has been spilled."""
        words = [self.ids.words[k] for k in self.tail]
        self.ids = Vocabulary(self.lang, self.frequent)
        self.tail = np.array([self.ids[w] if w else 0 for w in words], np.int64)


def runs_of(
    docs: DataFrame, lengths: tuple[int, int], words: bytes | None = None, pairs: bytes | None = None
) -> DataFrame:
    """Sorted runs of the windows of `docs` (lang, text) by prefix partition."""
    context = docs.sparkSession.sparkContext
    parts = partitions(docs.sparkSession)
    word_bits = context.broadcast(words) if words is not None else None
    pair_bits = context.broadcast(pairs) if pairs is not None else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = Bitmap(word_bits.value) if word_bits is not None else None
        known_pairs = Bitmap(pair_bits.value) if pair_bits is not None else None
        langs: dict[str, Counted] = {}

        def spilled() -> Iterator[pa.RecordBatch]:
            if sum(len(c.ids) for c in langs.values()) > WORDS:
                for counted in langs.values():
                    yield from counted.run(parts)
                    counted.renew()
            total = sum(c.trie.size for c in langs.values())
            if total > ENTRIES:
                for counted in langs.values():
                    yield from counted.run(parts, counted.trie.size // 2)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in langs:
                    langs[lang] = Counted(lang, lengths, known_words, known_pairs)
                for _ in langs[lang].feed(text.as_py()):
                    yield from spilled()
            # Many languages with little text each.
            if sum(c.bytes for c in langs.values()) > 2 * BLOCK:
                for counted in langs.values():
                    counted.count()
                    yield from spilled()
        for counted in langs.values():
            counted.count(last=True)
            yield from counted.run(parts)

    texts = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text"
    )
    return texts.mapInArrow(count, RUN_SCHEMA)


def partitions(spark: SparkSession) -> int:
    """Prefix partitions: as many as shuffles have, so that they grow with the cluster's settings."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Merge:
    """The runs of one language in one prefix partition."""

    def __init__(self, lang: str, lengths: tuple[int, int], least: int):
        self.lang, self.least = lang, least
        self.shortest, self.longest = lengths
        self.ids: dict[bytes, int] = {b"": 0}
        self.windows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows = 0

    def take(self, words: bytes, windows: bytes, counts: bytes) -> None:
        ids = self.ids
        known = [ids.setdefault(w, len(ids)) for w in decompress(words).split(b"\n")]
        columns = np.frombuffer(decompress(windows), "<u4").reshape(self.longest, -1)
        self.windows.append(np.array(known, np.uint32)[columns])
        self.counts.append(np.frombuffer(decompress(counts), "<u8").astype(np.int64))
        self.rows += columns.shape[1]
        if self.rows > MERGED_ROWS and len(self.windows) > 1:
            self._add_up()

    def _add_up(self) -> np.ndarray:
        """Leave every window once; where it differs from the one before, by column."""
        windows, counts = np.concatenate(self.windows, axis=1), np.concatenate(self.counts)
        order = np.lexsort(windows[::-1])
        windows, counts = windows[:, order], counts[order]
        change = np.ones(windows.shape, bool)
        change[:, 1:] = np.logical_or.accumulate(windows[:, 1:] != windows[:, :-1], axis=0)
        starts = np.flatnonzero(change[-1])
        self.windows, self.counts = [windows[:, starts]], [np.add.reduceat(counts, starts)]
        self.rows = len(starts)
        return change[:, starts]

    def phrases(self) -> Iterator[pa.RecordBatch]:
        """All prefixes that occur often enough: their windows lie together."""
        change = self._add_up()
        windows, counts = self.windows[0], self.counts[0]
        words = list(self.ids)
        if self.shortest == 1:  # all words together, as a phrase without words
            row = {"lang": self.lang, "phrase": "", "words": 0, "n": int(counts.sum())}
            yield pa.RecordBatch.from_pylist([row], PHRASES)
        for k in range(self.shortest, self.longest + 1):
            starts = np.flatnonzero(change[k - 1])
            sums = np.add.reduceat(counts, starts)
            at = (sums >= self.least) & (windows[k - 1, starts] > 0)
            found = windows[:k, starts[at]].T.tolist()
            if found:
                phrases = [b" ".join([words[w] for w in row]).decode() for row in found]
                columns = [[self.lang] * len(found), phrases, [k] * len(found), sums[at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PHRASES)], schema=PHRASES)


def merged(runs: DataFrame, lengths: tuple[int, int], least: int) -> DataFrame:
    """All phrases of the lengths with `least` occurrences in all runs: lang, phrase, words, n.

    With single words there are also rows without a phrase that add up to all words of a lang.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, langs = None, {}
        for batch in batches:
            for part, lang, *run in zip(*batch.columns):
                part, lang = part.as_py(), lang.as_py()
                if part != here:
                    for merging in langs.values():
                        yield from merging.phrases()
                    here, langs = part, {}
                if lang not in langs:
                    langs[lang] = Merge(lang, lengths, least)
                langs[lang].take(*(memoryview(x.as_buffer()) for x in run))
        for merging in langs.values():
            yield from merging.phrases()

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(merge, PHRASE_SCHEMA)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to `longest` words with `least` occurrences, and all words of each lang (total)."""
    counted = stored(merged(runs_of(docs, (1, 1)), (1, 1), least), "words")
    totals = counted.filter("words = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    words = counted.filter("words = 1")
    levels, word_bits = [words], bitmap_of(words)
    if longest > 1:
        pairs = stored(merged(runs_of(docs, (2, 2), word_bits), (2, 2), least), "pairs")
        levels.append(pairs)
        if longest > 2:
            runs = runs_of(docs, (3, longest), word_bits, bitmap_of(pairs))
            levels.append(stored(merged(runs, (3, longest), least), "windows"))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases, totals


def part(first: Column | int, count: Column | int) -> Column:
    """Words of a phrase, from the first of them (from 1)."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def lowest_cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The score of every cut; Python's integers are exact at any size."""
    for batch in rows:
        a, left, right, total = (batch.column(name).to_pylist() for name in ("a", "l", "r", "n"))
        score = [1000 * x * n // (p * q) for x, p, q, n in zip(a, left, right, total)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(score, pa.int64())], names=[*batch.schema.names, "score"]
        )


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST_PHRASES
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = frequent_phrases(docs, least, longest)
    candidates = phrases.filter(F.col("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"))
    counts = phrases.select("lang", "phrase", "n")

    # Whether a longer candidate is as frequent: its parts are listed, at most nine of each.
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> struct(s, m))))"
    )
    inside = (
        candidates.filter(F.col("words") > 2)
        .withColumn("span", F.explode(spans))
        .select("lang", part(F.col("span.s"), F.col("span.m")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = candidates.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") < F.col("a"))
    )
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k",
        part(1, F.col("k")).alias("first"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    with_left = lookup_join(cuts, firsts, ["lang", "first"], ["phrase", "k"])
    with_both = lookup_join(with_left, rests, ["lang", "rest"], ["phrase", "k"])
    with_total = lookup_join(
        with_both, totals.withColumnRenamed("total", "n"), ["lang"], ["phrase", "k"]
    ).select("lang", "phrase", "k", "a", "l", "r", "n")
    scored = with_total.mapInArrow(
        lowest_cut, "lang string, phrase string, k int, a long, l long, r long, n long, score long"
    )
    lowest = F.min(F.struct("score", "k", "l", "r", "n", "a")).alias("cut")
    best = scored.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT lang, unnest(pieces) AS piece FROM texts)
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, words, i, unnest(range(1, 6)) AS m FROM places) WHERE i + m - 1 <= len(words)
), totals AS (
  SELECT lang, count(*) AS n FROM places GROUP BY lang
), f AS (
  SELECT lang, m, phrase, string_split(phrase, ' ') AS words, count(*) AS a
  FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100
), inside AS (
  SELECT lang, array_to_string(words[s:s + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, m, words, a, k, unnest(range(1, m - k + 2)) AS s
        FROM (SELECT *, unnest(range(2, m)) AS k FROM f))
  GROUP BY ALL
), kept AS (
  SELECT f.* FROM f LEFT JOIN inside USING (lang, phrase) WHERE m > 1 AND (longer IS NULL OR longer < a)
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, p.a AS l, q.a AS r, t.n,
    1000::HUGEINT * c.a * t.n // (p.a::HUGEINT * q.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
  JOIN f p ON p.lang = c.lang AND p.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN f q ON q.lang = c.lang AND q.phrase = array_to_string(c.words[c.k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query(OP12_SQL)
def op12_collocations(spark, sf_dir):
    """The best 2000 collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))
