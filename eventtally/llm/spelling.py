"""Grouping of spelling variants by permuterm rotations.

A word is marked with a terminator, `word$`, and turned so that any place of it comes last. Two words
that differ in one code point share all of a rotation but its last code point, when that is the
one that differs. A word that lacks a code point of another one is, turned to the place of the gap,
exactly what the other one has before its last code point. So every word gives

- the rotation at each of its places, to be met by longer words, and
- the rotation that ends with each of its code points, split into a prefix and that code point.

Rotations are dealt out by prefix and sorted. Equal prefixes then lie together and one pass finds the
neighbours: a prefix belongs to at most one whole word and one word per last code point, as the
other code points and the place are given. Of a run of equal code points only the first counts as
the one left out, so no two words meet twice and neighbours can be counted without
listing pairs: every rotation gets the number of its partners and the best of them, and both are
added up per word.

The rotations of a word grow with the square of its length. Words of more than `PLAIN` code points go
by a digest, and prefixes of more than that by three rolling hashes (93 bits together), so a long
word costs as many rows as it has code points, each of a few bytes. Ties between long words need
their texts, so their partners, at most one per letter and prefix, are listed.

A word's form is its best neighbour if that one occurs `FACTOR` times as often. Forms of forms are
followed by doubling: each step is at least `FACTOR` times as frequent, so the number of rounds
follows from the largest count.

Defined cases: a null or empty text has no words; a null doc_id counts as an empty one. Repeated rows
count each. Ties between neighbours go to the smallest in code-point order. Texts and words of any
length are taken whole. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import ascii_lower, query, table
from eventtally.session import stored

SHORTEST = 7
LEAST = 2
FACTOR = 10
TERMINATOR = "$"  # no letter of a word
DAMAGED = 31
HASHED = TERMINATOR * 2  # begins a prefix that is not kept as text

# Longest word and prefix that are kept as text.
PLAIN = 64
# Rolling hashes: primes below 2^31, each with a base.
HASHES = ((2_147_483_647, 1_000_003), (2_147_483_629, 998_244_353), (2_147_483_587, 715_827_883))

# Rows scanned at a time.
SCANNED_ROWS = 100_000


def words_of(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """The distinct words (word, n), one in 31 occurrences having lost a code point."""
    # A run is taken from its first letter, so a match is never the rest of a longer run.
    runs = F.regexp_extract_all(
        ascii_lower(F.col("text")), F.lit(f"([A-Za-zÀ-ÿ]{{{shortest},}})"), F.lit(1)
    )
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (
        docs.select("doc_id", F.explode(runs).alias("run"))
        .select("run", F.crc32(key.cast("binary")).alias("h"))
        .select(F.when(F.col("h") % DAMAGED == 0, lost).otherwise(F.col("run")).alias("word"))
        .filter(F.length("word") >= shortest)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least)
    )


def named(word: Column) -> Column:
    """What stands for a word among the rotations: itself, or a digest that is no word."""
    digest = F.concat(F.lit(TERMINATOR), F.sha2(word.cast("binary"), 256))
    return F.when(F.length(word) <= PLAIN, word).otherwise(digest)


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of all words: the prefix, the last code point ('' for a whole word), name and n."""
    word, size = F.col("word"), F.length("word")

    def turned(first: Column, upto: Column, last: Column) -> Column:
        prefix = F.concat(word.substr(first, size), F.lit(TERMINATOR), word.substr(F.lit(1), upto))
        return F.struct(prefix.alias("prefix"), last.alias("last"))

    whole = F.transform(F.sequence(F.lit(0), size), lambda i: turned(i + 1, i, F.lit("")))
    ending = F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: turned(i + 2, i, word.substr(i + 1, F.lit(1)))
    )
    all_of = F.when(size < PLAIN, F.concat(whole, ending)).otherwise(ending)
    plain = (
        words.filter(size <= PLAIN)
        .select(F.explode(all_of).alias("turned"), word.alias("name"), "n")
        .select("turned.prefix", "turned.last", "name", "n")
    )
    hashed = words.filter(size >= PLAIN).mapInArrow(
        hashed_rotations, "prefix string, last string, name string, n long"
    )
    return plain.unionByName(hashed)


def powers(base: int, count: int, prime: int) -> np.ndarray:
    """base^0, base^1, ... modulo a prime, by doubling."""
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:
        step = np.uint64(pow(base, done, prime))
        more = min(done, count - done)
        out[done : done + more] = out[:more] * step % np.uint64(prime)
        done += more
    return out


def hashes_of(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the prefixes of a word's rotations: whole ones, and those less each code point."""
    size = len(word)
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    whole, ending = [], []
    for prime, base in HASHES:
        p = np.uint64(prime)
        up, down = powers(base, size + 2, prime), powers(pow(base, -1, prime), size + 1, prime)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(points * up[:size] % p) % p])
        mark = np.uint64(ord(TERMINATOR))

        def turned(first: np.ndarray, upto: np.ndarray) -> np.ndarray:
            """w[first:] + $ + w[:upto], code point k times base^k."""
            head = (sums[size] + p - sums[first]) % p * down[first] % p
            rest = (mark + sums[upto] * np.uint64(base)) % p * up[size - first] % p
            return (head + rest) % p

        places = np.arange(size + 1)
        whole.append(turned(places, places))
        ending.append(turned(places[1:], places[:-1]))
    return np.stack(whole, axis=1), np.stack(ending, axis=1)


def hashed_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rotations of words (word, n) whose prefixes are too long to be kept as text."""
    names = ["prefix", "last", "name", "n"]
    for batch in batches:
        for word, n in zip(batch.column("word"), batch.column("n").to_pylist()):
            word = word.as_py()
            name = word
            if len(word) > PLAIN:
                name = TERMINATOR + hashlib.sha256(word.encode()).hexdigest()
            whole, ending = hashes_of(word)
            before = TERMINATOR + word  # the code point that a prefix ends with
            parts = [(len(word) + 1, whole, [""] * len(whole))]
            if len(word) > PLAIN:
                parts.append((len(word), ending, list(word)))
            for size, hashes, last in parts:
                for low in range(0, len(hashes), SCANNED_ROWS):
                    rows = hashes[low : low + SCANNED_ROWS].tolist()
                    prefix = [f"{HASHED}{size}:{a}:{b}:{c}:{d}" for (a, b, c), d in zip(rows, before[low:])]
                    columns = [prefix, last[low : low + SCANNED_ROWS], [name] * len(rows), [n] * len(rows)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


Member = tuple[str, str, int]  # last code point, name, count


def best_first(member: Member) -> tuple[int, str]:
    return -member[2], member[1]


def partners(prefix: str, members: list[Member]) -> Iterator[tuple[str, int, int, str]]:
    """For each word of a prefix: the number of its partners, and the best one's count and name."""
    whole = [m for m in members if not m[0]]
    ending = sorted((m for m in members if m[0]), key=best_first)
    # Leaving out a code point equal to the one before it is leaving out that one.
    longer = [m for m in ending if m[0] != prefix[-1]]
    if prefix.startswith(HASHED):
        pairs = [(a, b) for a in ending for b in ending if a is not b]
        pairs += [pair for m in longer for w in whole for pair in ((m, w), (w, m))]
        yield from ((a[1], 1, b[2], b[1]) for a, b in pairs)
        return
    for member in ending:
        others = [m for m in ending[:2] if m is not member][:1]
        count = len(ending) - 1
        if whole and member[0] != prefix[-1]:
            others += whole
            count += 1
        if others:
            best = min(others, key=best_first)
            yield member[1], count, best[2], best[1]
    if whole and longer:
        yield whole[0][1], len(longer), longer[0][2], longer[0][1]


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partners within every prefix of sorted rotations."""
    rest: pa.Table | None = None

    def found(rows: pa.Table) -> pa.RecordBatch:
        prefix = rows.column("prefix").combine_chunks()
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        picked = rows.filter(pa.array(shared))
        lines = zip(*(picked.column(name).to_pylist() for name in ("prefix", "last", "name", "n")))
        out = [
            row
            for key, members in groupby(lines, key=lambda line: line[0])
            for row in partners(key, [m[1:] for m in members])
        ]
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["name", "near", "best_n", "best"]
        )

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        if rest.num_rows >= SCANNED_ROWS:
            # The last prefix may go on in the next batch; it has one row per letter at most.
            prefix = rest.column("prefix").combine_chunks()
            last = pc.equal(prefix, prefix[len(prefix) - 1]).to_numpy(zero_copy_only=False)
            cut = int(np.argmax(last))
            if cut:
                yield found(rest.slice(0, cut))
                rest = rest.slice(cut)
    if rest is not None and rest.num_rows:
        yield found(rest)


def neighbours(words: DataFrame) -> DataFrame:
    """Per word with neighbours: their number, and the most frequent one (best, best_n)."""
    turned = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "last")
    found = turned.mapInArrow(scanned, "name string, near long, best_n long, best string")
    long = words.filter(F.length("word") > PLAIN).select(
        named(F.col("word")).alias("best"), F.col("word").alias("best_word")
    )
    told = lookup_join(found, long, ["best"], ["name"], "left")
    best = F.coalesce("best_word", "best").alias("best")
    top = F.min(F.struct((-F.col("best_n")).alias("order"), best, "best_n")).alias("top")
    return (
        told.groupBy("name")
        .agg(F.sum("near").alias("n_near"), top)
        .select("name", "n_near", "top.best", "top.best_n")
    )


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of words with a form (word, form), by doubling the steps `rounds` times."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        reached = stored(reached, "roots")
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = lookup_join(reached, on, ["root"], ["word"], "left").select(
            "word", F.coalesce("further", "root").alias("root")
        )
    return reached


def spelling_variants(
    docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, factor: int = FACTOR
) -> DataFrame:
    """Every word with its form and root: word, form, root, n, n_near, form_n."""
    words = stored(words_of(docs, shortest, least), "words")
    near = words.withColumn("name", named(F.col("word"))).join(neighbours(words), "name", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= factor * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= factor * F.col("n"), F.col("best_n")).alias("form_n"),
    )
    near = stored(near, "near-words")
    most = near.agg(F.max("form_n")).first()[0]
    forms = near.filter(F.col("form").isNotNull()).select("word", "form")
    # A chain of k forms ends with a word that occurs factor^k times at least.
    steps = max(1, int(log(most, factor)) + 1) if most else 1
    found = roots(forms, ceil(log(steps, 2)))
    return near.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# DuckDB has no crc32: it is worked out byte by byte. Neighbours come from the words less one code point.
OP13_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([i::BIGINT, 0, 1, 2, 3, 4, 5, 6, 7],
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) t(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]{7,}')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
  SELECT run, n, list_concat([0::BIGINT], flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
              ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))) AS b
  FROM counted
), hashes AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], b[2:]),
    lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8))) AS h
  FROM bytes, steps
), damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
  FROM hashes
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT DISTINCT word, n, i, word[:i] || word[i + 2:] AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i
  WHERE a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN other_n >= 10 * n THEN other END AS form,
    CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""


@query(OP13_SQL)
def op13_spelling_variants(spark, sf_dir):
    """Every word of seven letters and more with its spelling form and root."""
    return spelling_variants(table(spark, sf_dir, "documents"))
