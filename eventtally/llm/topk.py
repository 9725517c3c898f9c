"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into segments at several resolutions, and each segment is summed up by its mean and
its deviation (the length of what is left after taking the mean away). For two vectors the
squared distance is at least the sum over segments of width * (mean - mean)^2 + (deviation -
deviation)^2, and with the lengths of both vectors this bounds their inner product from above:
product = (|q|^2 + |x|^2 - distance^2) / 2. Coarse bounds are tried first; a pair that stays
below the query's k-th best so far is dropped, the others go to the next finer resolution, and
those left are multiplied exactly.

On Spark: vectors are packed into blocks of rows by a hash of their id. Each block of queries
meets each group of candidate blocks, a group being worked through in one task with the best
k per query kept along the way; the best of all groups are merged by a window over at most k
rows per query and group. The work is queries times candidates, as the task asks; a task holds one
block of each.

Defined cases: vectors that are null or hold a null or a non-finite component take no part, nor do
rows without an id. Only vectors of the same number of components are compared; vectors without
components are compared with one another and score 0. Repeated rows are candidates each for
themselves; a query id that occurs with several vectors is answered once per distinct vector, and
never with rows of its own id. Ties go to the smaller
vec_id. Products outside 64 bits are undefined. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventtally.llm.common import query, table
from eventtally.session import stored

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
# Candidate blocks that one task works through, keeping what it has found so far.
BLOCKS_PER_TASK = 4
RESOLUTIONS = (1, 4, 16)

FOUND_SCHEMA = "query_id long, copy long, vec_id long, score long"


def packed(rows: DataFrame, per_block: int, name: str) -> DataFrame:
    """width, blocks, block and rows (vec_id, copy, vector): one row per block of rows.

    A block is dealt by the id and the place a row is read from, so equal rows spread too.
    """
    sizes = rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("blocks"))
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())
    dealt = rows.withColumn("place", place).join(F.broadcast(sizes), "width")
    return stored(
        dealt.groupBy("width", "blocks", F.pmod("place", "blocks").alias("block")).agg(
            F.collect_list(F.struct("vec_id", "copy", "vector")).alias("rows")
        ),
        name,
    )


def statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and deviation per segment, and the widths of the segments."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    widths = np.maximum(np.diff(edges), 0)
    means = np.zeros((len(vectors), segments))
    deviations = np.zeros_like(means)
    for k in range(segments):
        part = vectors[:, edges[k] : edges[k + 1]]
        if part.shape[1]:
            means[:, k] = part.mean(axis=1)
            deviations[:, k] = np.sqrt(((part - means[:, k, None]) ** 2).sum(axis=1))
    return means, deviations, widths


class Summaries:
    """Vectors with their statistics at all resolutions, ready for matrix products."""

    def __init__(self, vectors: np.ndarray):
        self.exact = vectors
        self.rough = vectors.astype(np.float64)
        self.norm = (self.rough**2).sum(axis=1)
        self.levels = []
        for segments in RESOLUTIONS:
            means, deviations, widths = statistics(self.rough, segments)
            self.levels.append((np.hstack([means * np.sqrt(widths), deviations])))

    def pick(self, at: np.ndarray) -> Summaries:
        part = object.__new__(Summaries)
        part.exact, part.rough, part.norm = self.exact[at], self.rough[at], self.norm[at]
        part.levels = [level[at] for level in self.levels]
        return part


def upper_bounds(queries: Summaries, candidates: Summaries, level: int) -> np.ndarray:
    """At least the inner product of every pair, from the lower bound of their distance."""
    a, b = queries.levels[level], candidates.levels[level]
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    total = queries.norm[:, None] + candidates.norm[None, :]
    bound = (total - np.maximum(squares, 0)) / 2
    return bound + 1e-9 * total + 1e-6  # rounding must not lower it


def products(queries: Summaries, candidates: Summaries) -> np.ndarray:
    """The exact integer products: in floating point where that holds all digits."""
    biggest = np.sqrt(queries.norm.max(initial=0) * candidates.norm.max(initial=0))
    if biggest < 2**52:
        return (queries.rough @ candidates.rough.T).astype(np.int64)
    return queries.exact @ candidates.exact.T


class Best:
    """The best k of each query so far: highest score, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), np.iinfo(np.int64).min)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.full = np.zeros((queries, k), bool)

    def limit(self) -> np.ndarray:
        """The score a candidate must reach; the lowest possible while there is room."""
        return np.where(self.full[:, -1], self.scores[:, -1].astype(np.float64), -np.inf)

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[at][self.full[at]], scores])
        ids = np.concatenate([self.ids[at][self.full[at]], ids])
        if len(scores) > 4 * self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= kth
            scores, ids = scores[keep], ids[keep]
        order = np.lexsort((ids, -scores))[: self.k]
        n = len(order)
        self.scores[at, :n], self.ids[at, :n] = scores[order], ids[order]
        self.full[at, :n] = True


def search_block(
    best: Best, query_ids: np.ndarray, queries: Summaries, ids: np.ndarray, candidates: Summaries
) -> None:
    """Let one block of candidates compete for the best of every query."""
    first = min(len(ids), 8 * best.k)
    for low, high in ((0, first), (first, len(ids))):
        if low == high:
            continue
        part, own = candidates.pick(np.arange(low, high)), ids[low:high]
        alive = own[None, :] != query_ids[:, None]
        limit = best.limit()[:, None]
        for level in range(len(RESOLUTIONS)):
            if np.isinf(limit).all():
                break
            # Only candidates that some query still needs go to the finer resolution.
            needed = np.flatnonzero(alive.any(axis=0))
            if not len(needed):
                break
            alive[:, needed] &= upper_bounds(queries, part.pick(needed), level) >= limit
        needed = np.flatnonzero(alive.any(axis=0))
        if not len(needed):
            continue
        scores = products(queries, part.pick(needed))
        alive = alive[:, needed] & (scores >= limit)
        for at in np.flatnonzero(alive.any(axis=1)):
            chosen = np.flatnonzero(alive[at])
            best.add(at, scores[at, chosen], own[needed[chosen]])


def unpacked(column: pa.ListArray, at: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids, copies and vectors of one block."""
    rows = column[at].values
    vectors = rows.field("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ids, copies = (rows.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("vec_id", "copy"))
    return ids, copies, vectors.reshape(len(ids), width)


def search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Work through pairs of blocks; neighbours with the same queries and group share their best."""
    key = best = queries = None

    def flushed() -> pa.RecordBatch:
        at, place = np.nonzero(best.full)
        columns = [query_ids[at], copies[at], best.ids[at, place], best.scores[at, place]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query_id", "copy", "vec_id", "score"]
        )

    for batch in batches:
        for at in range(batch.num_rows):
            row = {n: batch.column(n)[at].as_py() for n in ("width", "group", "query_block")}
            if tuple(row.values()) != key:
                if key is not None:
                    yield flushed()
                key = tuple(row.values())
                query_ids, copies, vectors = unpacked(batch.column("query_rows"), at, row["width"])
                queries, best = Summaries(vectors), Best(len(query_ids), k)
            ids, _, vectors = unpacked(batch.column("rows"), at, row["width"])
            search_block(best, query_ids, queries, ids, Summaries(vectors))
    if key is not None:
        yield flushed()


def top_products(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k best partners of every query.

    `rows` has vec_id and vector (array of long, null where it takes no part); `is_query` is
    a condition on vec_id.
    """
    sized = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).select(
        "vec_id", F.xxhash64("vector").alias("copy"), "vector", F.size("vector").alias("width")
    )
    candidates = packed(sized, BLOCK_ROWS, "vectors").withColumn(
        "group", F.floor(F.col("block") / BLOCKS_PER_TASK)
    )
    queries = packed(sized.filter(is_query).distinct(), QUERY_ROWS, "query-vectors")
    # Blocks, not rows, are paired, and each pair of a group and a query block has a key of
    # its own, so no task gets more than BLOCKS_PER_TASK blocks of one key.
    groups = candidates.groupBy("width").agg(F.max("group").alias("groups"))
    query_blocks = queries.groupBy("width").agg(F.max("block").alias("last"))
    left = candidates.join(F.broadcast(query_blocks), "width").select(
        "width", "group", "rows", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("query_block")
    )
    right = queries.join(F.broadcast(groups), "width").select(
        "width",
        F.col("block").alias("query_block"),
        F.col("rows").alias("query_rows"),
        F.explode(F.sequence(F.lit(0).cast("long"), "groups")).alias("group"),
    )
    key = ["width", "group", "query_block"]
    pairs = left.join(right, key).sortWithinPartitions(*key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return search(batches, k)

    found = pairs.mapInArrow(work, FOUND_SCHEMA)
    order = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def integers(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null if any is null or not finite."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(
        wide, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * scale)))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.vector) = len(c.vector))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 20
"""


@query(OP8_SQL)
def op8_exact_top_k(spark, sf_dir):
    """The 20 best partners of every twentieth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", integers(F.col("embedding")).alias("vector")
    )
    return top_products(vectors, F.col("vec_id") % 20 == 0)
