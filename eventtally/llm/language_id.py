"""Language identification by rank-order profiles.

Training counts all n-grams (1 to 3 characters of a word, with word ends) of the learning rows of
every language and keeps the most frequent ones in order: the language's profile. A document
is compared by its own most frequent n-grams: each is as far out of place as its rank differs
from its rank in the profile, or `PROFILE` when the profile lacks it. The nearest profile wins;
the score is 1 less the distance over the largest possible one.

Only the profiles are collected: `PROFILE` n-grams for each language that occurs in training.

Defined cases: a null text, or one without a letter, is `und` with score 0, and so is any text
when nothing was learned. Ties in frequency go by the n-gram (shorter
ones first, then by code point), ties in distance by the language's
name. Rows without doc_id are scored but never learned from and are not held out. Repeated rows
count each. Empty tables give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventtally.llm.common import fold_of, query, table

UNKNOWN = "und"
PROFILE = 400

# An n-gram is one number: its code points, 21 bits each. A word's end is an underscore, which
# is no letter.
BITS = 21
END = ord("_")
# Training merges counts once a task holds so many n-grams, of all languages together.
MERGE_GRAMS = 2_000_000


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams_of(text: str) -> np.ndarray:
    """The 1-, 2- and 3-grams of the words of a text, as numbers, with repeats."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    line = np.full(len(points) + 2, END, np.int64)
    line[1:-1][is_letter] = points[is_letter]
    gap = line == END
    line = line[~(gap & np.concatenate([[False], gap[:-1]]))]
    pairs = (line[:-1] << BITS) | line[1:]
    triples = (pairs[:-1] << BITS) | line[2:]
    return np.concatenate([line[line != END], pairs, triples[line[1:-1] != END]])


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in ascending order and how often each occurs."""
    ordered = np.sort(grams)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def ranked(text: str, most: int) -> np.ndarray:
    """The most frequent n-grams of a text, the commonest first."""
    grams, counts = counted(grams_of(text))
    if len(grams) > most:
        kept = counts >= np.partition(counts, len(counts) - most)[len(counts) - most]
        grams, counts = grams[kept], counts[kept]
    # The n-grams ascend, so a stable sort by count settles ties.
    return grams[np.argsort(-counts, kind="stable")][:most]


def learn_profiles(rows: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The n-grams of each language of `rows` (text, lang), the commonest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)
        held = 0

        def merged(lang: str) -> pa.RecordBatch:
            grams, counts = counted(np.concatenate(waiting.pop(lang)))
            sizes[lang] = 0
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                grams = grams_of(text.as_py())
                if len(grams):
                    waiting[lang].append(grams)
                    sizes[lang] += len(grams)
                    held += len(grams)
                    if held >= MERGE_GRAMS:
                        most = max(sizes, key=sizes.__getitem__)
                        held -= sizes[most]
                        yield merged(most)
        for lang in list(waiting):
            yield merged(lang)

    learnt = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    totals = (
        learnt.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    best = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = defaultdict(list)
    for row in sorted(best.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles[row["lang"]].append(row["gram"])
    return dict(profiles)


class Profiles:
    """Compares the ranked n-grams of a text with all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(profiles)
        self.grams = np.unique(np.array([g for grams in profiles.values() for g in grams], np.int64))
        # The last row is for n-grams that no profile has.
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, np.array(profiles[lang], np.int64))
            self.ranks[at, column] = np.arange(len(at))

    def nearest(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(text, self.size)
        if not len(own):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        there = self.ranks[np.where(self.grams[at] == own, at, len(self.grams))]
        away = np.abs(there - np.arange(len(own))[:, None])
        distance = np.where(there < 0, self.size, away).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(own))


def identified(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """All columns of `docs` but lang_pred and score, with these two worked out from `text`."""
    kept = docs.drop("lang_pred", "score")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = Profiles(profiles, size)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            found = [compare.nearest(t.as_py()) for t in text]
            columns = [
                *batch.columns,
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return kept.mapInArrow(score, f"{fields}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id, 4) == 2, F.lit(False))


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_of(F.col("doc_id"), 4) != 2)


@query()
def op6_language(spark, sf_dir):
    """The language of every document, learned from three of four labelled ones."""
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(learning_rows(docs.select("doc_id", "text", "lang")))
    return (
        identified(docs.select("doc_id", "text"), profiles)
        .withColumn("held_out", held_out(F.col("doc_id")))
        .select("doc_id", "held_out", "lang_pred", "score")
    )
