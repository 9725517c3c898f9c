"""Packing documents into sequences by length patterns and non-negative least squares.

1. Documents become subword ids with an end id; those longer than a sequence are cut, the
   first piece taking what is left over. Only lengths and places go on from here.
2. The histogram of lengths (at most one entry per length, whatever the size of the corpus) is
   rounded up to a coarse grid. Patterns of up to `depth` lengths that fill a sequence are
   listed, and repeat counts are fitted to the histogram by non-negative least squares.
3. The counts are rounded down and laid out. Pieces left over go, longest first, where they
   fit best: into the rest of a laid sequence or into a new one. Both work on counts of equal
   lengths, so the layout is a bounded list of runs: "pieces r to s of this length go to
   sequences q, q+1, ... at this offset".
4. Every piece finds its run by its number among the pieces of its length. The number
   is the piece's number within the task that made it, kept with the piece, plus the count of the
   tasks before it. No length, however common, is gathered in one task.

Defined cases: a null or empty text is a document of the end id alone. Repeated rows are packed
each for itself, under their id. A null doc_id is kept. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventtally.llm.common import query, table
from eventtally.llm.subwords import default_path, subwords
from eventtally.session import stored

SEQUENCE = 2048
END_ID = 0
GRID = 64  # lengths per sequence that patterns tell apart
DEPTH = 4  # lengths of a pattern at most

PIECE_SCHEMA = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
)


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than `most`."""
    first = total % most or most
    return [(0, first), *((start, most) for start in range(first, total, most))]


def pieces_of(docs: DataFrame, path: str, most: int = SEQUENCE) -> DataFrame:
    """The pieces of all documents, numbered by task and, within it, by length."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = subwords(path).ids
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
             ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64())]
        )
        for batch in batches:
            columns: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = array("I", ids_of(text.as_py() or ""))
                ids.append(END_ID)
                for piece, (start, length) in enumerate(cut(len(ids), most)):
                    code = zlib.crc32(ids[start : start + length].tobytes())
                    row = (doc_id, piece, start, length, code, task, seen[length])
                    seen[length] += 1
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, PIECE_SCHEMA)


def nonnegative_fit(matrix: np.ndarray, goal: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares with no negative entry, by the active-set method."""
    x = np.zeros(matrix.shape[1])
    free = np.zeros(matrix.shape[1], bool)
    for _ in range(rounds):
        slope = matrix.T @ (goal - matrix @ x)
        slope[free] = 0
        best = int(np.argmax(slope))
        if slope[best] <= 1e-7 * max(1.0, float(np.abs(goal).max(initial=0))):
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            target = np.linalg.lstsq(matrix[:, at], goal, rcond=None)[0]
            if (target > 1e-12).all():
                x[:] = 0
                x[at] = target
                break
            low = target <= 1e-12
            step = np.min(x[at][low] / np.maximum(x[at][low] - target[low], 1e-300))
            x[at] += step * (target - x[at])
            free[at[x[at] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def patterns(grid: int = GRID, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Up to `depth` coarse lengths, longest first, that fill a sequence of `grid` units."""
    found = [(grid,)]
    for parts in range(2, depth + 1):
        for small in combinations_with_replacement(range(1, grid), parts - 1):
            rest = grid - sum(small)
            if rest >= small[-1]:
                found.append((rest, *reversed(small)))
    return found


# A run: pieces `low` up to `high` (exclusive) of `length` go to sequences `first`, `first + 1`,
# and so on, all at `offset`.
RUN_COLUMNS = ["length", "low", "high", "first", "offset"]


# Shares of the fitted counts that are laid out; the best outcome is kept.
SHARES = (1.0, 0.95, 0.85, 0.6)


def layout(histogram: dict[int, int], most: int = SEQUENCE, grid: int = GRID, depth: int = DEPTH) -> pd.DataFrame:
    """The runs that place every piece of the histogram (length: count) in fewest sequences."""
    unit = most / grid
    goal = np.zeros(grid)
    for length, count in histogram.items():
        goal[min(grid, int(np.ceil(length / unit))) - 1] += count
    listed = patterns(grid, depth)
    matrix = np.zeros((grid, len(listed)))
    for k, pattern in enumerate(listed):
        for b in pattern:
            matrix[b - 1, k] += 1
    # Long pieces are harder to place, so missing them weighs more.
    weight = np.sqrt(np.arange(1, grid + 1) / grid)[:, None]
    fitted = nonnegative_fit(matrix * weight, goal * weight[:, 0])
    tried = [
        laid_out(histogram, listed, np.floor(fitted * share + 1e-6).astype(int), most, unit)
        for share in SHARES
    ]
    return pd.DataFrame(min(tried, key=lambda t: t[0])[1], columns=RUN_COLUMNS)


def laid_out(
    histogram: dict[int, int], listed: list[tuple[int, ...]], counts: np.ndarray, most: int, unit: float
) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """The number of sequences and the runs, for given repeat counts of the patterns."""
    left = {length: count for length, count in sorted(histogram.items()) if count}
    used: Counter[int] = Counter()
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens: (first, count)
    sequences = 0

    def take(length: int, count: int, first: int, offset: int) -> None:
        runs.append((length, used[length], used[length] + count, first, offset))
        used[length] += count
        left[length] -= count

    lengths_left = sorted(left)

    def longest(most_of_it: int, taken: Counter[int]) -> int | None:
        """The longest piece that is not yet spoken for and no longer than this."""
        at = bisect_right(lengths_left, most_of_it) - 1
        while at >= 0 and left[lengths_left[at]] <= taken[lengths_left[at]]:
            if not left[lengths_left[at]]:
                del lengths_left[at]
            at -= 1
        return lengths_left[at] if at >= 0 else None

    for k in np.argsort(-counts, kind="stable"):
        todo = int(counts[k])
        while todo > 0:
            # All but the last piece come from their place on the grid; the last one is the
            # longest that still fits, which makes up for the rounding.
            taken: Counter[int] = Counter()
            for place, b in enumerate(listed[k]):
                last = place and place == len(listed[k]) - 1
                room = most - sum(n * c for n, c in taken.items())
                length = longest(room if last else int(b * unit), taken)
                if length is None or (not last and length <= (b - 1) * unit):
                    taken.clear()
                    break
                taken[length] += 1
            if not taken:
                break
            some = min(todo, *(left[x] // n for x, n in taken.items()))
            offset = 0
            for length in taken.elements():
                take(length, some, sequences, offset)
                offset += length
            if offset < most:
                rooms[most - offset].append((sequences, some))
            sequences += some
            todo -= some

    for length in sorted((x for x in left if left[x]), reverse=True):
        while left[length]:
            fitting = [room for room in rooms if room >= length]
            if fitting:
                room = min(fitting)
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                some = min(count, left[length])
                take(length, some, first, most - room)
                if room > length:
                    rooms[room - length].append((first, some))
                if count > some:
                    rooms[room].append((first + some, count - some))
            else:
                # New sequences; the next rounds fill them further.
                count = -(-left[length] // (most // length))
                rooms[most].append((sequences, count))
                sequences += count
    return sequences, runs


def placed(numbered: DataFrame, runs: pd.DataFrame) -> DataFrame:
    """sequence_id and offset of pieces that have length and rank among their length."""
    ordered = runs.sort_values(["length", "low"])
    wide = int(ordered["high"].max() if len(ordered) else 0) + 1
    start = (ordered["length"] * wide + ordered["low"]).to_numpy(np.int64)
    low, first, offset = (ordered[c].to_numpy(np.int64) for c in ("low", "first", "offset"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = frame.pop("rank").to_numpy(np.int64)
            at = np.searchsorted(start, frame["length"].to_numpy(np.int64) * wide + rank, "right") - 1
            yield frame.assign(sequence_id=first[at] + rank - low[at], offset=offset[at])

    fields = [f"{n} {t}" for n, t in numbered.drop("rank").dtypes]
    return numbered.mapInPandas(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, path: str | None = None, most: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    made = stored(pieces_of(docs, path or default_path(), most), "pieces")
    counts = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("pieces"))
    before = F.coalesce(
        F.sum("pieces").over(
            Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    bases = counts.select("task", "length", before.alias("base"))
    # One row per length: at most `most` of them.
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    numbered = (
        made.join(bases, ["task", "length"])
        .withColumn("rank", F.col("base") + F.col("number"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )
    return placed(numbered, layout(histogram, most))


@query()
def op7_packing(spark, sf_dir):
    """The place of every piece of every document."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
