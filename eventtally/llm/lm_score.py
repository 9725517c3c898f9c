"""Language-model scores of whole texts: a word unigram as the base, and a causal self-attention
model over subword ids, trained here in numpy.

A text is its words (A-Z lowered), each as the byte-level subword ids of a space and the word, and one
end. The model gives the class of the next id from a window of ids before it, by one masked
attention layer on top of how often the classes follow the last id, and the id within its class by
its share after that id: the probabilities of all ids sum to one. Classes, shares, vocabulary
and the base come from all learning documents, summed in Spark. The attention weights learn from all
of them too. They are fitted in Spark rounds: each task steps through its windows, and the weighted
mean of what the tasks come to starts the next round. `ROUNDS` rounds over one in `SHARE` of the distinct
learning texts, of a small corpus over more, bring them near; if that is not all of the texts, one more
round goes through every window of every learning document.
Pairs, the last round and the scores all start from stored ids, so that texts are not encoded for each.

Scoring lays overlapping windows over each document: a window of `WINDOW` ids scores its last
`STRIDE` ones, so each id is scored once, with up to WINDOW - 1 ids before it in sight. Base
scores look words up in two ways: the commonest `FREQUENT` words are sent to the tasks, all others
are joined with the whole vocabulary. No word is left out.

Defined cases: a null or empty text is its end alone. Rows without doc_id are scored but never
learned from and are not held out. Repeated rows count and are scored each. With nothing to learn
from, all words are unknown and all classes and ids alike. Empty tables give no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import copy
import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.llm.common import fold_of, query, table
from eventtally.llm.subwords import default_path, subwords
from eventtally.session import stored

FOLDS, HELD_OUT = 7, 2
FREQUENT = 200_000
COUNTED_WORDS = 400_000  # distinct words that a task counts before it hands them on

WINDOW, STRIDE = 32, 16
CLASSES, SINGLE = 64, 40  # so many ids are classes of their own
OWN_ROWS = 2048  # ids with an embedding of their own; the others share their class's
KEY_SIZE, HIDDEN = 16, 32
STEPS, BATCH_WINDOWS = 500, 256  # steps one after another, at least
ROUNDS, REDUCERS = 8, 4
SHARE = 16  # one in so many distinct texts is learned from, but so many texts and characters at least
LEAST_TEXTS, LEAST_CHARS = 4000, 8_000_000
POOL_WINDOWS = 16384  # windows that a task shuffles at a time
# Windows that a task of the last round takes at least, once there is a task a core. A task hands on weights and
# means of slopes, 2.4 MB however little it has learned from, so their number follows the windows.
TASK_WINDOWS = 16 * POOL_WINDOWS
RATE = 0.02
SMOOTHING = 5.0  # weight of a less exact share, in occurrences of the more exact one
FINE_LAST, FINE_IDS = 1024, 4096  # the commonest ids whose pairs are counted one by one
SCORE_IDS = 8192  # ids that are scored at a time
SCORE_WINDOWS = 128  # windows of them that the model takes at a time, so that they stay in the caches
HELD_IDS = 500_000  # ids that a task holds before it hands them on
FAR = np.float32(-1e9)
LARGE = np.float32(40)  # what exp may be taken of
STRETCH = 1 << 14  # numbers that a step changes at a time


def counted_words(docs: DataFrame) -> DataFrame:
    """word and n over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def emitted() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"],
            )
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                seen.update((text.as_py() or "").encode().lower().split())
                if len(seen) > COUNTED_WORDS:
                    yield emitted()
        yield emitted()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The corpus as far as it is bounded: totals, and the commonest words with their counts, at
    most `FREQUENT`."""

    tokens: int  # N: all words and ends
    types: int  # V: distinct words, and the end
    ends: int
    frequent: dict[bytes, int]

    def log(self, count: int | np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(count, float) + 1) / (self.tokens + self.types + 1))


def vocabulary(words: DataFrame, documents: int, frequent: int = FREQUENT) -> Vocabulary:
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # How many words there are of about each count tells from which count on they are few enough.
    steps = words.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("least")
    )
    least, taken = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):
        taken += row["words"]
        if taken > frequent:
            break
        least = row["least"]
    top = words.filter(F.col("n") >= (least or 0) if least else F.lit(False)).toArrow()
    return Vocabulary(
        int(sums["n"]) + documents,
        int(sums["v"]) + (documents > 0),
        documents,
        dict(zip(top["word"].cast(pa.binary()).to_pylist(), top["n"].to_pylist())),
    )


def counted_ids(words: DataFrame, path: str, tables: IdTables | None = None) -> np.ndarray:
    """How often subword ids occur in the counted words; one entry per id.

    With tables, a row of such entries per class, of the ids that follow it within a word, a row
    of the ids that begin words and one of those that end them; then the pairs of common
    ids within words. The last id is the end of a text and is not counted here.
    """
    width = subwords(path).size + 1
    coarse = 0 if tables is None else (CLASSES + 2) * width
    size = width if tables is None else coarse + FINE_LAST * FINE_IDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(path).encoding.encode_ordinary
        sums = np.zeros(size)
        places: list[np.ndarray] = []
        weights: list[np.ndarray] = []

        def add_up() -> None:
            np.add(sums, np.bincount(np.concatenate(places), np.concatenate(weights), size), out=sums)
            places.clear()
            weights.clear()

        for batch in batches:
            ids = [encode(f" {w}") for w in batch.column(0).to_pylist()]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.frombuffer(b"".join(array("I", part).tobytes() for part in ids), np.uint32).astype(np.int64)
            times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
            if tables is None or not len(flat):
                places.append(flat)
                weights.append(times)
            else:
                last = np.cumsum(sizes) - 1
                first = last + 1 - sizes
                before = np.append(0, tables.classes[flat[:-1]])
                before[first] = CLASSES
                low = np.append(FINE_LAST, tables.rank[flat[:-1]])
                low[first] = FINE_LAST
                fine = np.flatnonzero((low < FINE_LAST) & (tables.rank[flat] < FINE_IDS))
                places += [
                    before * width + flat,
                    (CLASSES + 1) * width + flat[last],
                    coarse + low[fine] * FINE_IDS + tables.rank[flat[fine]],
                ]
                weights += [times, times[last], times[fine]]
            if len(places) >= 1000:
                add_up()
        if places:
            add_up()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at].astype(np.int64))], names=["place", "n"])

    found = (
        words.select("word", "n").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    ).toArrow()
    counts = np.zeros(size)
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts


def sent(rows: DataFrame, value: object) -> Broadcast:
    """A value that every Python worker loads once, and not again with each task."""
    return value if isinstance(value, Broadcast) else rows.sparkSession.sparkContext.broadcast(value)


def counted_across(docs: DataFrame, path: str, tables: IdTables, known: dict[bytes, bytes] | Broadcast) -> np.ndarray:
    """How often ids follow one another across the ends of words and texts, over all texts.

    A row of entries per class, of the ids that follow a last one of it, then the pairs of common
    ids, as `counted_ids` lays them out. The end of a text precedes its first id.
    """
    width = len(tables.classes)
    coarse = CLASSES * width
    size = coarse + FINE_LAST * FINE_IDS
    classes, rank = tables.classes, tables.rank
    known = sent(docs, known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextIds(path)
        edges = {word: ids[:4] + ids[-4:] for word, ids in known.value.items()}
        sums = np.zeros(size, np.int64)

        def add_up(parts: list[bytes]) -> None:
            first, last = as_ids(parts).reshape(-1, 2).T
            before = np.append(encode.end_id, last[:-1])
            np.add.at(sums, classes[before].astype(np.int64) * width + first, 1)
            low, high = rank[before].astype(np.int64), rank[first]
            fine = np.flatnonzero((low < FINE_LAST) & (high < FINE_IDS))
            np.add.at(sums, coarse + low[fine] * FINE_IDS + high[fine], 1)

        for batch in batches:
            parts, waiting = [], 0
            for text in batch.column(0):
                words = (text.as_py() or "").encode().lower().split()
                found = list(map(edges.get, words))
                if None in found:
                    for at, word in enumerate(words):
                        if found[at] is None:
                            ids = encode.of_word(word)
                            found[at] = ids[:4] + ids[-4:]
                parts += [*found, encode.end * 2]
                waiting += len(words) + 1
                if waiting >= HELD_IDS:
                    add_up(parts)
                    parts, waiting = [], 0
            if parts:
                add_up(parts)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["place", "n"])

    found = (
        docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    ).toArrow()
    counts = np.zeros(size, np.float32)
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts


def counted_pairs(texts: DataFrame, tables: IdTables) -> np.ndarray:
    """How often ids follow one another in texts given as ids: what `counted_ids` finds within words and
    `counted_across` across their ends, together and laid out as by the latter."""
    width = len(tables.classes)
    coarse = CLASSES * width
    size = coarse + FINE_LAST * FINE_IDS
    classes, rank, end = tables.classes, tables.rank, tables.end

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        each = (text.as_py() for batch in batches for text in batch.column(0))
        for some in gathered(each, lambda text: len(text) // 4):
            ids = as_ids(some)
            before = np.append(end, ids[:-1])
            np.add.at(sums, classes[before].astype(np.int64) * width + ids, 1)
            low, high = rank[before].astype(np.int64), rank[ids]
            fine = np.flatnonzero((low < FINE_LAST) & (high < FINE_IDS))
            np.add.at(sums, coarse + low[fine] * FINE_IDS + high[fine], 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["place", "n"])

    found = (
        texts.select("ids").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    ).toArrow()
    counts = np.zeros(size, np.float32)
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts


class IdTables:
    """Class, embedding row, and share within the class, of every id; the last id is the end."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        smooth = counts + 0.1
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        # The ids after the single ones are cut into classes of about equal weight.
        rest = smooth[order[SINGLE:]]
        before = (np.cumsum(rest) - rest) / rest.sum()
        classes = np.empty(len(counts), np.int64)
        classes[order[:SINGLE]] = np.arange(SINGLE)
        classes[order[SINGLE:]] = SINGLE + (before * (CLASSES - SINGLE)).astype(np.int64)
        self.order, self.rank, self.classes = order, rank.astype(np.int32), classes.astype(np.int32)
        self.alone = smooth / np.bincount(classes, smooth, CLASSES)[classes]
        self.rows = np.where(rank < OWN_ROWS, rank, OWN_ROWS + classes).astype(np.int32)
        self.end = len(counts) - 1

    def learn_shares(self, counts: np.ndarray, texts: int, across: np.ndarray | None = None) -> None:
        """`counts` as counted with these tables; `texts` is how many ends there are.

        `across` are the pairs that `counted_across` finds. Without them, after a word's last id,
        and after an end, any first id follows as often as it begins words or texts.
        """
        counts = counts.astype(np.float32)
        coarse = (CLASSES + 2) * len(self.classes)
        pairs, fine = counts[:coarse].reshape(CLASSES + 2, -1), counts[coarse:].reshape(FINE_LAST, FINE_IDS)
        if across is None:
            begins, ends = pairs[CLASSES].copy(), pairs[CLASSES + 1].copy()
            begins[self.end] = ends[self.end] = texts
            begins /= max(begins.sum(), 1)
            after = pairs[:CLASSES] + np.bincount(self.classes, ends, CLASSES).astype(np.float32)[:, None] * begins
            common, last = self.order[:FINE_IDS], self.order[:FINE_LAST]
            fine = fine + ends[last][:, None] * begins[common]
        else:
            after = pairs[:CLASSES] + across[: CLASSES * len(self.classes)].reshape(CLASSES, -1)
            fine = fine + across[CLASSES * len(self.classes) :].reshape(FINE_LAST, FINE_IDS)
        self.learn_pairs(after, fine)

    def learn_pairs(self, after: np.ndarray, fine: np.ndarray) -> None:
        """The shares, from how often each id follows each class, and each of the commonest ids the
        commonest; both arrays are used up."""
        member = np.zeros((len(self.classes), CLASSES), np.float32)
        member[np.arange(len(member)), self.classes] = 1
        totals = after @ member
        # How often each class follows the id of an embedding row.
        follows = (totals + 1) / (totals + 1).sum(axis=1, keepdims=True)
        after += SMOOTHING * self.alone.astype(np.float32)
        after /= totals[:, self.classes] + SMOOTHING
        # The same after each of the commonest ids, for the commonest ids.
        common, last = self.order[:FINE_IDS], self.order[:FINE_LAST]
        fine_totals = fine @ member[common]
        fine += SMOOTHING * after[self.classes[last]][:, common]
        fine /= fine_totals[:, self.classes[common]] + SMOOTHING
        self.fine, self.shares = np.log(fine, out=fine), np.log(after, out=after)
        self.lowered = np.zeros((FINE_LAST + 1, CLASSES), np.float32)
        self.lowered[:-1] = np.log(SMOOTHING / (fine_totals + SMOOTHING))
        of_class = np.concatenate([self.classes[self.order[:OWN_ROWS]], np.arange(CLASSES), [0]])
        prior = follows[of_class]
        prior[:FINE_LAST] = (fine_totals + SMOOTHING * prior[:FINE_LAST]) / (
            fine_totals.sum(axis=1, keepdims=True) + SMOOTHING
        )
        self.prior = np.log(prior).astype(np.float32)

    def log_shares(self, last: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The log of each id's share in its class after the id before it."""
        low, high = self.rank[last], self.rank[ids]
        common = (low < FINE_LAST) & (high < FINE_IDS)
        fine, other = np.flatnonzero(common), np.flatnonzero(~common)
        found = np.empty(len(ids), np.float32)
        found[fine] = self.fine[low[fine], high[fine]]
        before, after = last[other], ids[other]
        found[other] = self.shares[self.classes[before], after]
        found[other] += self.lowered[np.minimum(low[other], FINE_LAST), self.classes[after]]
        return found


PAD_ROW = OWN_ROWS + CLASSES


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of inputs (padding is -1) and of targets (likewise) for documents that lie one
    after another, each window's keys and queries; and the document of each window."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    per = -(-lengths // STRIDE)
    document = np.repeat(np.arange(len(lengths)), per)
    number = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    low = starts[document] + number * STRIDE
    end = (starts + lengths)[document][:, None]
    keys = low[:, None] + np.arange(STRIDE - WINDOW, STRIDE)
    keys = np.where((keys >= starts[document][:, None]) & (keys < end), keys, -1)
    return keys, keys[:, WINDOW - STRIDE :], document


def lowered_exp(values: np.ndarray) -> None:
    """exp in place, of values that are first lowered by as much as the largest needs."""
    most = values.max(initial=0)
    if most > LARGE:
        values -= most - LARGE
    np.exp(values, out=values)


class Space:
    """Arrays that are used again, as new ones of this size cost more than what is worked out in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


SHAPES = {
    "query": (PAD_ROW + 1, KEY_SIZE),
    "key": (PAD_ROW + 1, KEY_SIZE),
    "value": (PAD_ROW + 1, HIDDEN),
    "own": (PAD_ROW + 1, HIDDEN),
    "distance": (WINDOW,),
    "out": (HIDDEN, CLASSES),
    "bias": (CLASSES,),
}
SIZE = sum(map(math.prod, SHAPES.values()))


def parts_in(numbers: np.ndarray) -> dict[str, np.ndarray]:
    """The parts of a model, or of slopes, by name, as views of the one row that holds them."""
    ends = np.cumsum([math.prod(shape) for shape in SHAPES.values()])
    return {name: part.reshape(shape) for (name, shape), part in zip(SHAPES.items(), np.split(numbers, ends[:-1]))}


def places_of(width: int) -> np.ndarray:
    """Where the numbers of each embedding row lie, two at a time."""
    return np.arange((PAD_ROW + 1) * (width // 2)).reshape(PAD_ROW + 1, -1)


class Model:
    """One masked attention layer: tables by embedding row, a bias by distance, and the output."""

    def __init__(self, prior: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        # The weights, then the fading sums of their slopes and of the squares of these.
        self.held = np.zeros((3, SIZE), np.float32)
        self.steps = 0
        self.prior = prior  # log shares of the classes by embedding row
        self.prepare()
        for name in ("query", "key", "value", "own", "out"):
            self.parts[name][:] = rng.normal(0, 0.1, self.parts[name].shape)

    def prepare(self) -> None:
        """What follows from the numbers, and is not handed on with them."""
        self.parts = parts_in(self.held[0])
        # Distance from query to key; what lies ahead of the query is out of sight.
        self.away = (np.arange(STRIDE)[:, None] + WINDOW - STRIDE) - np.arange(WINDOW)[None, :]
        self.hidden_ahead = np.where(self.away < 0, FAR, np.float32(0))
        self.space = Space()
        self.places = {name: places_of(size) for name, size in (("k", KEY_SIZE), ("v", HIDDEN))}

    def __getstate__(self) -> tuple:
        return self.held, self.steps, self.prior

    def __setstate__(self, state: tuple) -> None:
        self.held, self.steps, self.prior = state
        self.prepare()

    def attend(self, key_rows: np.ndarray) -> dict[str, np.ndarray]:
        """The layer for windows of embedding rows; the last STRIDE of each are the queries.

        The arrays are used again by the next call.
        """
        p, count, space = self.parts, len(key_rows), self.space
        own_rows = np.ascontiguousarray(key_rows[:, WINDOW - STRIDE :])

        def looked_up(name: str, rows: np.ndarray) -> np.ndarray:
            return np.take(p[name], rows, axis=0, out=space(name, *rows.shape, p[name].shape[1]), mode="clip")

        q, k, v = looked_up("query", own_rows), looked_up("key", key_rows), looked_up("value", key_rows)
        scores = np.matmul(q, k.transpose(0, 2, 1), out=space("scores", count, STRIDE, WINDOW))
        scores += p["distance"][np.maximum(self.away, 0)] + self.hidden_ahead
        blank = key_rows == PAD_ROW
        some = np.flatnonzero(blank.any(axis=1))
        if len(some):
            # A query that is padding itself sees nothing; its result is not used.
            scores[some] = np.maximum(scores[some] + np.where(blank[some], FAR, np.float32(0))[:, None, :], FAR)
        lowered_exp(scores)
        total = (scores.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32)).reshape(count, STRIDE, 1)
        total += np.float32(1e-30)
        state = np.matmul(scores, v, out=space("state", count, STRIDE, HIDDEN))
        state /= total
        state += looked_up("own", own_rows)
        np.maximum(state, 0, out=state)
        return {"q": q, "k": k, "v": v, "weights": scores, "total": total, "state": state, "own_rows": own_rows}

    def class_logs(
        self, state: np.ndarray, rows: np.ndarray, classes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The log probability of a class for each state and embedding row; all weights, in an array
        that the next call uses again, and their sums."""
        logits = np.matmul(state, self.parts["out"], out=self.space("logits", len(state), CLASSES))
        logits += np.take(self.prior, rows, axis=0, out=self.space("prior", len(state), CLASSES), mode="clip")
        logits += self.parts["bias"]
        lowered_exp(logits)
        total = logits @ np.ones(CLASSES, np.float32)
        chosen = logits.ravel()[np.arange(0, logits.size, CLASSES) + classes]
        return np.log(np.maximum(chosen, np.float32(1e-35)) / total), logits, total

    def gradients(
        self, key_rows: np.ndarray, classes: np.ndarray, real: np.ndarray, into: np.ndarray | None = None
    ) -> tuple[float, dict]:
        """The mean loss of a batch and its slope in every part, put into the given row if there is one."""
        p, a, space = self.parts, self.attend(key_rows), self.space
        into = np.zeros(SIZE, np.float32) if into is None else into
        into[:] = 0
        found = parts_in(into)
        count, state = len(key_rows), a["state"].reshape(-1, HIDDEN)
        logs, slope, total = self.class_logs(state, a["own_rows"].ravel(), classes.ravel())
        weight = real.ravel().astype(np.float32) / max(1, real.sum())
        slope *= (weight / total)[:, None]
        slope.reshape(-1)[np.arange(0, slope.size, CLASSES) + classes.ravel()] -= weight
        np.matmul(state.T, slope, out=found["out"])
        np.matmul(np.ones(len(slope), np.float32), slope, out=found["bias"])
        back = np.matmul(slope, p["out"].T, out=space("back", len(slope), HIDDEN))
        back *= state > 0
        back = back.reshape(count, STRIDE, HIDDEN)
        weights = a["weights"]
        weights /= a["total"]
        d_scores = np.matmul(back, a["v"].transpose(0, 2, 1), out=space("d_scores", count, STRIDE, WINDOW))
        d_scores -= np.einsum("wqk,wqk->wq", d_scores, weights)[..., None]
        d_scores *= weights
        by_place = np.ones(count, np.float32) @ d_scores.reshape(count, -1)
        found["distance"][:] = np.bincount(np.maximum(self.away, 0).ravel(), by_place, WINDOW)

        def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return np.matmul(left, right, out=space("product", count, left.shape[1], right.shape[2]))

        def add(name: str, kind: str, rows: np.ndarray, values: np.ndarray) -> None:
            # Two numbers at a time, as a complex one, take half the places.
            table = self.places[kind]
            places = space("places", rows.size, table.shape[1], kind=np.int64)
            np.take(table, rows.ravel(), axis=0, out=places, mode="clip")
            np.add.at(found[name].reshape(-1).view(np.complex64), places.ravel(), values.ravel().view(np.complex64))

        add("query", "k", a["own_rows"], product(d_scores, a["k"]))
        add("key", "k", key_rows, product(d_scores.transpose(0, 2, 1), a["q"]))
        add("value", "v", key_rows, product(weights.transpose(0, 2, 1), back))
        add("own", "v", a["own_rows"], back)
        return float(-(logs * weight).sum()), found

    def fit(
        self,
        key_rows: np.ndarray,
        classes: np.ndarray,
        real: np.ndarray,
        seed: int = 11,
        steps: int | None = None,
        rate: float | None = None,
    ) -> list[float]:
        """Adam over shuffled batches of windows; gives the loss of every step.

        The rate falls to nothing over the steps, or is the given one. Called again, it goes on.
        """
        rng = np.random.default_rng(seed)
        steps = STEPS if steps is None else steps
        losses, order = [], np.zeros(0, np.int64)
        slopes = self.space("slopes", SIZE)
        for step in range(1, steps + 1 if len(key_rows) else 1):
            while len(order) < min(BATCH_WINDOWS, len(key_rows)):
                order = np.append(order, rng.permutation(len(key_rows)))
            at, order = order[:BATCH_WINDOWS], order[BATCH_WINDOWS:]
            losses.append(self.gradients(key_rows[at], classes[at], real[at], slopes)[0])
            self.steps += 1
            self.move(slopes, RATE * (1 - step / (steps + 1)) if rate is None else rate)
        return losses

    def move(self, slopes: np.ndarray, rate: float) -> None:
        """One step of Adam along the slopes, which are used up; a stretch at a time stays in the caches."""
        # The sums are ten and a hundred times the means that Adam speaks of.
        of_first, of_root = 0.1 / (1 - 0.9**self.steps), 0.1 / math.sqrt(1 - 0.99**self.steps)
        for low in range(0, SIZE, STRETCH):
            slope = slopes[low : low + STRETCH]
            weights, first, second = self.held[:, low : low + STRETCH]
            first *= 0.9
            first += slope
            slope *= slope
            second *= 0.99
            second += slope
            np.sqrt(second, out=slope)
            slope += 1e-8 / of_root
            np.divide(first, slope, out=slope)
            slope *= rate * of_first / of_root
            weights -= slope

    def numbers(self) -> np.ndarray:
        """All that fitting changes, the weights and the sums of their slopes, in one row."""
        return self.held.ravel().copy()

    def take(self, numbers: np.ndarray) -> None:
        """The reverse of `numbers`."""
        self.held[:] = numbers.reshape(self.held.shape)


def window_rows(ids: np.ndarray, lengths: np.ndarray, tables: IdTables):
    """Embedding rows of keys, target ids, the ids before them, which targets are real, and
    documents, of all windows.

    `ids` are the targets of the documents one after another, each with its end; an input is the
    id before, the first one's input is the end.
    """
    keys, queries, document = windows(lengths)
    inputs = np.empty_like(ids)
    inputs[1:] = ids[:-1]
    inputs[np.cumsum(lengths) - lengths] = tables.end
    key_rows = np.append(tables.rows[inputs], PAD_ROW)[keys]
    before = np.append(inputs, tables.end)[queries]
    return key_rows, np.append(ids, tables.end)[queries], before, queries >= 0, document


def real_logs(key_rows, targets, before, real, tables: IdTables, model: Model) -> np.ndarray:
    """The natural log probability of every real target."""
    targets, before, real = targets.ravel(), before.ravel(), real.ravel()
    classes = tables.classes[targets]
    logs = np.empty(len(targets))
    for low in range(0, len(key_rows), SCORE_WINDOWS):
        attended = model.attend(key_rows[low : low + SCORE_WINDOWS])
        state = attended["state"].reshape(-1, HIDDEN)
        at = slice(low * STRIDE, low * STRIDE + len(state))
        logs[at] = model.class_logs(state, attended["own_rows"].ravel(), classes[at])[0]
    return logs[real] + tables.log_shares(before[real], targets[real])


def scores_of(ids: np.ndarray, lengths: np.ndarray, tables: IdTables, model: Model) -> np.ndarray:
    """The natural log probability of each document."""
    *found, real, document = window_rows(ids, lengths, tables)
    logs = real_logs(*found, real, tables, model)
    return np.bincount(np.repeat(document, STRIDE)[real.ravel()], logs, len(lengths))


class TextIds:
    """The ids of texts as bytes, four each; those of common words are looked up."""

    def __init__(self, path: str, known: dict[bytes, bytes] | None = None):
        self.encode = subwords(path).encoding.encode_ordinary
        self.end_id = subwords(path).size
        self.end = array("I", [self.end_id]).tobytes()
        self.known = known or {}

    def of_word(self, word: bytes) -> bytes:
        return array("I", self.encode(" " + word.decode())).tobytes()

    def of_words(self, words: list[bytes]) -> bytes:
        parts = list(map(self.known.get, words))
        if None in parts:
            parts = [self.of_word(w) if p is None else p for w, p in zip(words, parts)]
        return b"".join(parts) + self.end


def as_ids(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.uint32).astype(np.int64)


def first_share(docs: DataFrame) -> float:
    """The share of the texts that the first rounds take; 1 or more for all."""
    size = docs.agg(
        F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")
    ).first()
    return max(1 / SHARE, LEAST_TEXTS / max(size["texts"], 1), LEAST_CHARS / max(size["chars"], 1))


def learning_ids(
    docs: DataFrame, path: str, known: dict[bytes, bytes] | Broadcast, part: float | None = None
) -> DataFrame:
    """number and ids of the distinct texts of the first rounds, in the order of their hash.

    A share of all, whole; of a small corpus so much that there are enough texts and characters.
    """
    part = first_share(docs) if part is None else part
    number = F.xxhash64("text")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    if part < 1:
        texts = texts.filter(F.pmod(number, F.lit(1 << 20)) < int(part * (1 << 20)))
    distinct = texts.dropDuplicates(["text"]).select(F.shiftright(number, 20).alias("number"), "text")
    return encoded(distinct.sortWithinPartitions("number", "text"), path, known)


def encoded(texts: DataFrame, path: str, known: dict[bytes, bytes] | Broadcast) -> DataFrame:
    """number and ids for number and text."""
    known = sent(texts, known)

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextIds(path, known.value)
        for batch in batches:
            ids = [encode.of_words((text.as_py() or "").encode().lower().split()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["number", "ids"])

    return texts.select("number", "text").mapInArrow(encode_all, "number long, ids binary")


def pools_of(texts: Iterator[bytes], tables: SimpleNamespace) -> Iterator[tuple[np.ndarray, ...]]:
    """Embedding rows of keys, classes of targets, and which are real, of about `POOL_WINDOWS`
    windows at a time; a long text is cut between windows."""
    parts, waiting = [], 0

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(column) for column in zip(*parts))

    for some in gathered(texts, lambda text: len(text) // 4):
        lengths = np.array([len(text) // 4 for text in some])
        ids = as_ids(some)
        cut = parts_of(ids, tables) if len(ids) > SCORE_IDS else [window_rows(ids, lengths, tables)]
        for key_rows, targets, _, real, document in cut:
            part = key_rows, tables.classes[targets], real
            while waiting + len(document) >= POOL_WINDOWS:
                # A pool ends with the text that fills it.
                end = np.searchsorted(document, document[POOL_WINDOWS - waiting - 1], "right")
                parts.append(tuple(column[:end] for column in part))
                yield joined()
                parts, waiting = [], 0
                part, document = tuple(column[end:] for column in part), document[end:]
            if len(document):
                parts.append(part)
                waiting += len(document)
    if parts:
        yield joined()


def gathered(items: Iterable, size_of: Callable) -> Iterator[list]:
    """The items in order, as many at a time as have `SCORE_IDS` ids together; a longer one is alone."""
    some, size = [], 0
    for item in items:
        if some and size + size_of(item) > SCORE_IDS:
            yield some
            some, size = [], 0
        some.append(item)
        size += size_of(item)
    if some:
        yield some


def fitted_round(texts: DataFrame, tables: SimpleNamespace, model: Model, rate: float, steps: int) -> bool:
    """Lets the tasks go on from the model over their texts, `steps` steps each at least, and gives it the
    mean of what they come to, weighted by steps. False if there was nothing to learn from."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(model)
        ids = (text.as_py() for batch in batches for text in batch.column("ids"))
        for pool in pools_of(ids, tables):
            taken = own.steps - model.steps
            # Only a task whose texts fill no pool looks at windows again.
            left = 0 if taken else steps
            own.fit(*pool, seed=own.steps, steps=max(left, -(-len(pool[0]) // BATCH_WINDOWS)), rate=rate)
        taken = own.steps - model.steps
        if taken:
            yield row_of(taken, own.numbers())

    def row_of(taken: int, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([taken], pa.int64()), pa.array([numbers.tobytes()], pa.binary())], names=["steps", "numbers"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, total = 0, 0.0
        for batch in batches:
            for count, numbers in zip(batch.column(0).to_pylist(), batch.column(1)):
                taken += count
                total = total + count * np.frombuffer(numbers.as_py(), np.float32).astype(float)
        if taken:
            yield row_of(taken, (total / taken).astype(np.float32))

    kind = "steps long, numbers binary"
    rows = texts.select("ids").mapInArrow(step, kind).repartition(REDUCERS).mapInArrow(added, kind).collect()
    taken = sum(row["steps"] for row in rows)
    if taken:
        model.take(sum(row["steps"] / taken * np.frombuffer(row["numbers"], np.float32) for row in rows))
        model.steps += steps
    return taken > 0


def windows_in(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.ceil(F.octet_length("ids") / (4 * STRIDE))).alias("windows")).first()["windows"] or 0


def dealt(texts: DataFrame, count: int, least: int) -> DataFrame:
    """The texts in no more partitions than have `least` of the `count` windows each, or than there are cores."""
    return texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, count // least))


def trained(
    docs: DataFrame,
    tables: IdTables,
    path: str,
    known: dict[bytes, bytes] | Broadcast,
    every: DataFrame | None = None,
) -> Model:
    """The model fitted to the documents; `every` has the ids of them all, if they are stored already."""
    part = first_share(docs)
    texts = stored(learning_ids(docs, path, known, part), "learning")
    count = windows_in(texts)
    steps = -(-STEPS // ROUNDS)
    texts = dealt(texts, count, steps * BATCH_WINDOWS)
    # A large corpus is dealt to the rounds; of a small one each round sees all, or a larger part.
    enough = texts.rdd.getNumPartitions() * steps * BATCH_WINDOWS
    slices = min(max(count // enough, 1), ROUNDS)
    small = SimpleNamespace(rows=tables.rows, classes=tables.classes, end=tables.end)
    model = Model(tables.prior)
    for number in range(ROUNDS if count else 0):
        chosen = texts.filter(F.pmod("number", F.lit(slices)) == number % slices)
        fitted_round(chosen, small, model, RATE * (1 - (number + 0.5) / ROUNDS), steps)
    if part < 1:
        # Every window once, at the rate the rounds end with; repeated rows count, as for the shares.
        if every is None:
            # Stored in between, so that a task never has two Python workers, one to encode and one to learn.
            every = encoded(docs.select(F.lit(0).cast("long").alias("number"), "text"), path, known)
            every = stored(every, "every-text")
        fitted_round(dealt(every, windows_in(every), TASK_WINDOWS), small, model, RATE / (2 * ROUNDS), 0)
    return model


def score_texts(docs: DataFrame, learning: Column, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document.

    `learning` is a condition on the rows to learn from.
    """
    path = path or default_path()
    learnt = docs.filter(learning).select("doc_id", "text")
    words = stored(counted_words(learnt), "words")
    corpus = vocabulary(words, learnt.count())
    id_counts = counted_ids(words, path)
    id_counts[-1] = corpus.ends
    tables = IdTables(id_counts)
    plain = TextIds(path)
    known_ids = sent(docs, {word: plain.of_word(word) for word in corpus.frequent})
    # Every text is encoded once; pairs, the weights and the scores all start from the stored ids.
    texts = stored(with_ids(docs, learning, path, corpus, known_ids), "texts")
    every = texts.filter("learnt").select("ids")
    pairs = counted_pairs(every, tables)
    coarse = CLASSES * len(tables.classes)
    tables.learn_pairs(pairs[:coarse].reshape(CLASSES, -1), pairs[coarse:].reshape(FINE_LAST, FINE_IDS))
    in_tasks = sent(docs, (tables, trained(learnt, tables, path, known_ids, every)))
    del plain, learnt, id_counts, pairs, tables

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, model = in_tasks.value
        for batch in batches:
            found = []
            for ids in gathered((text.as_py() for text in batch.column("ids")), lambda text: len(text) // 4):
                lengths = np.array([len(part) // 4 for part in ids])
                if lengths[0] > SCORE_IDS:
                    found.append(np.array([long_score(as_ids(ids), tables, model)]))
                else:
                    found.append(scores_of(as_ids(ids), lengths, tables, model))
            scores = pa.array(np.concatenate([*found, np.zeros(0)]) / math.log(10))
            yield batch.select(kept).append_column("score", scores)

    kept = ["doc_id", "row", "n_tokens", "known", "base", "rare"]
    kinds = dict(texts.dtypes)
    found = texts.select(*kept, "ids").mapInArrow(score, ", ".join([*(f"{c} {kinds[c]}" for c in kept), "score double"]))
    # A row per rare word; the first one carries what the document has already. A document
    # without one gets a key of its own, with a space, which no word has.
    each = found.select(
        "row", "doc_id", "n_tokens", "known", "base", "score", F.posexplode_outer("rare").alias("place", "rare_word")
    ).select(
        "row",
        *(
            F.when(F.coalesce("place", F.lit(0)) == 0, F.col(c)).alias(c)
            for c in ("doc_id", "n_tokens", "known", "base", "score")
        ),
        F.col("rare_word").isNotNull().alias("is_word"),
        F.coalesce("rare_word", F.concat(F.lit(" "), F.col("row").cast("string"))).alias("word"),
    )
    joined = each.join(words, "word", "left")
    scale = F.lit(float(corpus.tokens + corpus.types + 1))
    word_log = F.when(F.col("is_word"), F.log10((F.coalesce("n", F.lit(0)) + 1) / scale)).otherwise(0.0)
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_tokens").alias("n_tokens"),
            (F.sum("known") + F.count_if(F.col("n") > 0)).alias("n_known"),
            F.lit(corpus.tokens).cast("long").alias("train_tokens"),
            (F.sum("base") + F.sum(word_log)).alias("base_score"),
            F.max("score").alias("score"),
        )
        .drop("row")
    )


def with_ids(
    docs: DataFrame, learning: Column, path: str, corpus: Vocabulary, known_ids: dict[bytes, bytes] | Broadcast
) -> DataFrame:
    """doc_id, row, whether it is learnt from, ids, and of the base: n_tokens, known, base and rare words, which are
    those that known and base leave out."""
    known_ids = sent(docs, known_ids)
    common_logs = sent(docs, {word: float(corpus.log(n)) for word, n in corpus.frequent.items()})
    end_log, end_known = float(corpus.log(corpus.ends)), int(corpus.ends > 0)
    kind = dict(docs.dtypes)["doc_id"]
    schema = pa.schema(
        [("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]), ("row", pa.int64()),
         ("learnt", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
         ("rare", pa.list_(pa.string())), ("ids", pa.binary())]
    )

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, logs = TextIds(path, known_ids.value), common_logs.value

        def emitted(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            rows, waiting = [], 0
            for *given, text in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
                parts = (text.as_py() or "").encode().lower().split()
                known = list(map(logs.get, parts))
                rare = [word.decode() for word, value in zip(parts, known) if value is None] if None in known else []
                base = sum(filter(None, known)) + end_log
                ids = encode.of_words(parts)
                rows.append((*given, len(parts) + 1, len(parts) - len(rare) + end_known, base, rare, ids))
                waiting += len(ids) // 4
                if waiting >= HELD_IDS:
                    yield emitted(rows)
                    rows, waiting = [], 0
            if rows:
                yield emitted(rows)

    # A row's number is stored with it, so it stays the same however often the rows are read.
    given = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), learning.alias("learnt"), "text")
    return given.mapInArrow(
        encode_all,
        f"doc_id {kind}, row long, learnt boolean, n_tokens long, known long, base double, rare array<string>, ids binary",
    )


def parts_of(ids: np.ndarray, tables: IdTables | SimpleNamespace) -> Iterator[tuple[np.ndarray, ...]]:
    """What `window_rows` gives for one document, in parts that overlap by a window."""
    size = SCORE_IDS // STRIDE * STRIDE
    for low in range(0, len(ids), size):
        # The ids before the part are context only: their windows are left out.
        start = max(0, low - -(-WINDOW // STRIDE) * STRIDE)
        part = ids[start : low + size]
        found = window_rows(part, np.array([len(part)]), tables)
        # The input of the part's first id is the id before it, not the end.
        yield tuple(f[(low - start) // STRIDE :] for f in found) if start else found


def long_score(ids: np.ndarray, tables: IdTables, model: Model) -> float:
    """The same as `scores_of` for one long document, in parts."""
    return sum(float(real_logs(*found, tables, model).sum()) for *found, _ in parts_of(ids, tables))


def learning_rows(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id, FOLDS) != HELD_OUT, F.lit(False))


@query()
def op4_attention_scores(spark, sf_dir):
    """Base and model scores of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return score_texts(docs, learning_rows(F.col("doc_id"))).withColumn("held_out", held)
