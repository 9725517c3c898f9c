"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its five-word shingles; two documents link when 100 * intersection >= 75 *
union, and the classes are the connected components.

1. Documents with the same set form one class (a digest, combined before the shuffle). From here on
   a class has one set, however many copies it stands for.
2. All shingles are put in one order: those that tasks found repeatedly come last, by their summed
   counts, the others first, by hash. If two sets link, the smaller one, of n, has 6/7 n in common
   with the larger one, and that one, of m, has 3/4 m. So they share l tokens of the first
   n - 6/7 n + l and the first m - 3/4 m + l, for any l. Each class picks its own l: longer prefixes
   have more postings to read, but ask for more shared tokens, so fewer candidates are
   verified. A pair must share the smaller l of its two, and as both sizes are known then, within
   the first n - c + l of one and m - c + l of the other, for the c = 3/7 (n + m) it must have
   in common.
3. Postings whose token only one class has are dropped. Within a token, classes are first held
   against some of them (stars), verified and merged; later rounds only look at tokens at which many
   pairs of classes in different components are left, and go on while they find links. Then all pairs
   that are left are counted and verified. So a group of thousands of near copies costs thousands of
   comparisons and not their square, and no link between different components is missed.
4. Verification counts the exact intersection of two whole sets.

The order is an estimate and decides only how many candidates there are; the links do not depend
on it. Shingles are compared by 64-bit hashes.

Defined cases: a null text or one without words has no shingles and links with nothing; fewer than
five words are one shingle, the whole sequence. Repeated rows are copies. Rows without doc_id take
part and get the smallest doc_id of their component, null if there is none. An empty table gives
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join, sized_join
from eventtally.llm.common import query, table
from eventtally.session import stored, stored_with_size

SHINGLE = 5
# A link needs NEED / WHOLE of the union in common.
NEED, WHOLE = 75, 100

# Prefixes are lengthened by at most this many tokens.
MOST_MATCHES = 16
# What verifying a candidate costs, in postings read.
VERIFY_COST = 1.0
# So many repeated shingles are told apart by their counts; all others go by hash alone.
ORDERED = 500_000
# Tokens that a task looks through at a time for repeated ones.
TOGETHER = 5_000_000
# Tokens with a smaller count are not worth it.
LEAST_COUNT = 4
# Hubs of a token in the first star round; one that fits its group badly is made up for by another.
HUBS = 6
# Hubs of a crowded token in later rounds. What is left there links with few of the others, and each
# class that finds none is held against all of them in the end.
LATER_HUBS = 64
# After the first star round, others follow for tokens with more pairs of different components than
# this for each posting; they end when there are no such tokens or a round has found no link. What is left
# after the last round is met pair by pair.
PAIRS_PER_POSTING = 4
ROUNDS = 5
# A token with more than one part in this many of all postings is hot.
SHARES_OF_HOT = 512

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# A posting's set size, the tokens to share, those that are alike in the set, and its place in the
# common order are one number.
SHARES, ALIKE, PLACES = 64, 64, 1 << 24
# A hub with more partners than this is verified in several tasks.
PARTNERS_PER_TASK = 1000


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a whole text in ascending order."""
    # Of bytes, exactly A-Z are lowered and exactly space and tab to carriage return part words.
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(numbers.tobytes())], np.uint64)
    count = len(words) - size + 1
    mixed = numbers[:count].copy()
    for k in range(1, size):
        mixed *= MULTIPLIER
        mixed += numbers[k : k + count]
    mixed.sort()
    fresh = mixed[1:] != mixed[:-1]
    return mixed if fresh.all() else mixed[np.concatenate([[True], fresh])]


def class_of(tokens: np.ndarray) -> int:
    """A digest of a set, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def repeated_tokens(docs: DataFrame, most: int = ORDERED) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that occur in several documents near one another, ascending, and their summed counts.

    The list has a fixed bound: the commonest `most`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held = np.empty(TOGETHER, np.uint64)
        size = 0

        def repeated() -> pa.RecordBatch:
            tokens = held[:size]
            tokens.sort()
            # A token that is there n times follows itself n - 1 times; the others need no more room.
            found, again = np.unique(tokens[1:][tokens[1:] == tokens[:-1]], return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(again.astype(np.int64) + 1)], names=["token", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                tokens = shingles(text.as_py())
                number = class_of(tokens)
                if number not in seen:  # copies are no reason to put a token last
                    if size and size + len(tokens) > len(held):
                        yield repeated()
                        seen.clear()
                        size = 0
                    if len(tokens) > len(held):
                        held = np.empty(len(tokens), np.uint64)
                    seen.add(number)
                    held[size : size + len(tokens)] = tokens
                    size += len(tokens)
        yield repeated()

    totals = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    best = totals.filter(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "token").limit(most).toPandas()
    tokens = best["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], best["n"].to_numpy(np.int64)[order]


def required(n: int | np.ndarray, smaller: bool) -> int | np.ndarray:
    """The tokens that a set of n has in common with any set that links, if it is the smaller one
    of the two, or if it is the larger one."""
    return -(-2 * NEED * n // (WHOLE + NEED)) if smaller else -(-NEED * n // WHOLE)


def prefix_of(tokens: np.ndarray, known: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The tokens of a set's longer prefix, how many of them are in the shorter one, and how
    many a partner must share."""
    n = len(tokens)
    ordered, weight = tokens, np.ones(n)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        common = known[at] == tokens
        if common.any():
            often = counts[at[common]]
            order = np.lexsort((tokens[common], often))
            ordered = np.concatenate([tokens[~common], tokens[common][order]])
            weight = np.concatenate([np.ones(n - len(often)), often[order].astype(float)])
    longer, shorter = n - required(n, False), n - required(n, True)
    matches = np.arange(1, min(MOST_MATCHES, n - longer) + 1)
    postings = np.cumsum(weight)[longer + matches - 1]
    best = int(matches[np.argmin(postings * (1 + VERIFY_COST / matches))])
    return ordered[: longer + best], min(shorter + best, longer + best), best


def row_key():
    """What tells rows apart; only copies with the same id share it."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def classed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n, class, asked, alike and prefix of every document.

    Within a task only the first of equal sets carries the prefix, and `asked`, the number of
    tokens that a partner must share. Postings hold half of a token's hash; `alike` is how many
    tokens of the prefix count for nothing because another one has the same half.
    """
    known, counts = repeated_tokens(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            none = np.zeros(0, np.uint32)
            prefixes: list[np.ndarray] = []
            for text in batch.column(2):
                tokens = shingles(text.as_py())
                if not len(tokens):
                    rows.append((0, None, None, None))
                    prefixes.append(none)
                    continue
                number = class_of(tokens)
                prefix, asked, alike = none, None, None
                if number not in seen:
                    seen.add(number)
                    ordered, _, asked = prefix_of(tokens, known, counts)
                    prefix = (ordered >> np.uint64(32)).astype(np.uint32)
                    alike = min(len(prefix) - len(set(prefix.tolist())), ALIKE - 1)
                rows.append((len(tokens), number, asked, alike))
                prefixes.append(prefix)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = np.concatenate([*prefixes, none])
            n, number, asked, alike = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(number, pa.int64()),
                    pa.array(asked, pa.int32()),
                    pa.array(alike, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int32))),
                ],
                names=["doc_id", "row_key", "n", "class", "asked", "alike", "prefix"],
            )

    given = docs.select("doc_id", row_key(), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return given.mapInArrow(
        work, f"doc_id {kind}, row_key long, n long, class long, asked int, alike int, prefix array<int>"
    )


def hot_tokens(postings: DataFrame, shares: int = SHARES_OF_HOT) -> list[int]:
    """Tokens with more than 1 / `shares` of all postings, and perhaps others; `shares` at most.

    A sketch of bounded size, combined in the tasks, misses none: its error is below a tenth of that.
    """
    sketch = F.expr(f"approx_top_k(token, {shares}, {20 * shares})").alias("top")
    row = postings.agg(sketch, F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] * shares > row["n"]]


def token_range() -> dict[str, Column]:
    """The lowest and the highest class of a token, and whether it is in the shorter prefix of one."""
    return {"low": F.min("class"), "high": F.max("class"), "short": F.max(in_shorter(F.col("info")))}


def shared_postings(found: DataFrame) -> DataFrame:
    """token, class and info of the tokens that several classes have in their prefix, and how
    many such tokens the class has.

    Tokens that no class has in its shorter prefix are counted, but go no further.
    """
    info = (F.col("n") * SHARES + F.col("asked")) * ALIKE + F.col("alike")
    postings = (
        found.filter("asked IS NOT NULL")
        .select("class", info.alias("info"), F.posexplode("prefix").alias("place", "token"))
        .select("token", "class", (F.col("info") * PLACES + F.col("place")).alias("info"))
    )
    # A token in the prefixes of many classes would be one task's; its postings stay where they are.
    hot = hot_tokens(postings)
    of_token = Window.partitionBy("token")
    cold = postings.filter(~F.col("token").isin(hot))
    cold = cold.select("*", *(value.over(of_token).alias(name) for name, value in token_range().items()))
    ranges = postings.filter(F.col("token").isin(hot)).groupBy("token").agg(
        *(value.alias(name) for name, value in token_range().items())
    )
    # A class that several tasks met has as many postings; one is enough.
    once = [
        part.filter("low < high")
        .groupBy("token", "class")
        .agg(F.min("info").alias("info"), F.max("short").alias("short"))
        for part in (cold, postings.join(F.broadcast(ranges), "token"))
    ]
    shared = stored(once[0].unionByName(once[1]), "postings")
    kept = shared.groupBy("class").agg(F.count(F.lit(1)).alias("kept"))
    return lookup_join(shared.filter("short").drop("short"), kept, ["class"], ["token"])


def verified(pairs: DataFrame, docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link. `keys` has class and the row_key of one of its rows.

    The pairs are worked out once and the texts are read once; the sets of a's partners go to where
    the set of `a` is, which is sent to several tasks if there are many.
    """
    pairs = stored(pairs, "pairs")
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS_PER_TASK).alias("parts"))
    parts = lookup_join(pairs, hubs, ["a"], ["b"])
    asked = parts.select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), F.col("b").alias("class")).union(
        hubs.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)), "a")
    )
    wanted = asked.join(keys, "class").select("row_key", "a", "part", "class")
    texts = docs.select("text", row_key())
    sent = lookup_join(texts, wanted, ["row_key"], ["text"]).select("a", "part", "class", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tokens = None, b""
        seen: set[tuple] = set()
        for batch in batches:
            keep, values = [], []
            ids = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for key, text in zip(ids, batch.column(3)):
                if key in seen:  # a repeated row
                    keep.append(False)
                    continue
                seen.add(key)
                if key[2] != last:
                    last, tokens = key[2], shingles(text.as_py()).tobytes()
                keep.append(True)
                values.append(tokens)
            kept = batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(values, pa.binary())], names=["a", "part", "class", "tokens"]
            )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, hub = None, None
        for batch in batches:
            found = []
            ids = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for (a, part, number), tokens in zip(ids, batch.column(3)):
                own = np.frombuffer(tokens.as_buffer(), np.uint64)
                if number == a:
                    here, hub = (a, part), own
                elif here == (a, part) and linked(hub, own):
                    found.append((a, number))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    # The hub comes first among the rows of its key.
    gathered = (
        sent.mapInArrow(cut, "a long, part long, class long, tokens binary")
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("class") != F.col("a"))
    )
    return stored(gathered.mapInArrow(test, "a long, b long"), "links")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets have NEED / WHOLE of their union in common."""
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return WHOLE * shared >= NEED * (len(both) - shared)


def components(links: DataFrame) -> DataFrame:
    """node and label of all nodes of the links: the smallest node that can be reached.

    Each round takes the smallest label around and then the label's own label, so the
    number of rounds grows with the logarithm of the longest path.
    """
    both = stored(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select(F.col("b"), F.col("a")))
        .distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("label")),
        "labels",
    )
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("low"))
        )
        nearer = labels.join(around, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        next_of = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(
            nearer.join(next_of, "label").select("node", "old", F.least("label", "next").alias("label")),
            "labels",
        )
        if jumped.filter("old <> label").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node and label after more links. Only links between different components go on, as one
    per pair of components."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    fresh = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    nodes = stored(labels.unionByName(fresh), "nodes")
    one, other = (nodes.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    pairs = stored(
        links.join(one, "a")
        .join(other, "b")
        .filter("label_a <> label_b")
        .select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b"))
        .distinct(),
        "merged",
    )
    if pairs.isEmpty():
        return nodes
    roots = components(pairs).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return stored(
        nodes.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels"
    )


def labelled(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings of tokens that hold several components, with the class's label."""
    named = lookup_join(postings, labels.withColumnRenamed("node", "class"), ["class"], ["token"], "left")
    named = named.withColumn("label", F.coalesce("label", "class"))
    open_tokens = (
        named.groupBy("token")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("token")
    )
    return stored(named.join(open_tokens, "token"), "open-postings")


def place(info: Column) -> Column:
    return info % PLACES


def alike(info: Column) -> Column:
    return F.floor(info / PLACES) % ALIKE


def asked(info: Column) -> Column:
    return F.floor(info / (PLACES * ALIKE)) % SHARES


def size(info: Column) -> Column:
    return F.floor(info / (PLACES * ALIKE * SHARES))


def ahead(info: Column) -> Column:
    """Whether a token is among the first n - 6/7 n + 1 of its set."""
    n = size(info)
    return place(info) <= n - F.ceil(2 * NEED * n / (WHOLE + NEED))


def in_shorter(info: Column) -> Column:
    """Whether a token is among the first n - 6/7 n + l of its set."""
    n = size(info)
    return place(info) < n - F.ceil(2 * NEED * n / (WHOLE + NEED)) + asked(info)


def in_common(n: Column, m: Column) -> Column:
    """How many tokens sets of two sizes have in common if they link."""
    return F.ceil(NEED * (n + m) / (WHOLE + NEED))


def sizes_allow(n: Column, m: Column) -> Column:
    return NEED * F.greatest(n, m) <= WHOLE * F.least(n, m)


def counts_for(a: Column, b: Column, shares: Column) -> Column:
    """Whether a token in common counts, for two infos and a number of tokens to share."""
    n, m = size(a), size(b)
    common = in_common(n, m)
    return sizes_allow(n, m) & (place(a) < n - common + shares) & (place(b) < m - common + shares)


def may_link(a: Column, b: Column, kept_a: Column, kept_b: Column) -> Column:
    """Whether two sets can have enough in common, by their infos and their shared tokens.

    Let the prefix of one end before that of the other in the common order. What both have up to
    there are shared tokens of both; what both have after it is at most what the one has left.
    """

    def left(info: Column) -> Column:
        return F.ceil(NEED * size(info) / WHOLE) - asked(info) + alike(info)

    most = F.least(kept_a, kept_b) + F.greatest(left(a), left(b))
    return most >= in_common(size(a), size(b))


def first_hubs(postings: DataFrame) -> DataFrame:
    """token and hub (class, info, label) of the classes that are the first of a token in `HUBS` orders."""
    turns = [
        F.min(F.struct(F.xxhash64("class", F.lit(k)).alias("turn"), "class", "info", "label")) for k in range(HUBS)
    ]
    return postings.groupBy("token").agg(F.array(*turns).alias("hubs")).select(
        "token", F.explode(F.array_distinct(F.transform("hubs", lambda h: h.dropFields("turn")))).alias("hub")
    )


def later_hubs(postings: DataFrame, seed: int) -> DataFrame:
    """The same with the first one in each of `LATER_HUBS` parts of the classes, others for every seed."""
    turn = F.xxhash64("class", F.lit(seed))
    first = F.min(F.struct(turn.alias("turn"), "class", "info", "label")).alias("hub")
    return (
        postings.groupBy("token", F.pmod(turn, F.lit(LATER_HUBS)).alias("part"))
        .agg(first)
        .select("token", F.col("hub").dropFields("turn").alias("hub"))
    )


def star_pairs(postings: DataFrame, hubs: DataFrame) -> DataFrame:
    """Classes of a token with its hubs (a), if they are not in one component yet and share as
    many tokens of which `a` is a hub as they must."""
    a, b = F.col("hub.info"), F.col("info")
    shares = F.least(asked(a), asked(b))
    return (
        postings.join(hubs, "token")
        .filter(F.col("label") != F.col("hub.label"))
        .filter(counts_for(a, b, shares))
        .groupBy(F.col("hub.class").alias("a"), F.col("class").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("shared"),
            F.first(shares - F.least(alike(a), alike(b))).alias("needed"),
        )
        .filter("shared >= needed")
        .select("a", "b")
    )


def crowded_tokens(postings: DataFrame) -> DataFrame:
    """Tokens at which `crossing_pairs` would meet many pairs for each of their postings."""
    short = F.count_if(ahead(F.col("info"))).alias("short")
    return (
        postings.groupBy("token", "label")
        .agg(F.count(F.lit(1)).alias("n"), short)
        .groupBy("token")
        .agg(F.sum("n").alias("n"), F.sum("short").alias("short"), F.sum(F.col("n") * F.col("short")).alias("inside"))
        .filter(F.col("n") * F.col("short") - F.col("inside") > PAIRS_PER_POSTING * F.col("n"))
        .select("token")
    )


def crossing_pairs(postings: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs of different components that share as many prefix tokens as they must.

    The smaller set is `a`; of sets of one size, the smaller class. With l = 1 the prefixes are
    shortest, so pairs meet at these tokens only; then all shared tokens are counted, for the l
    that they ask for and, as `may_link` does, for the whole prefixes.
    """
    left, right = (
        postings.select(
            "token", F.col("class").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("info", "label", "kept"))
        )
        for x in "ab"
    )
    a, b = F.col("info_a"), F.col("info_b")
    met = (
        left.filter(ahead(a))
        .join(right, "token")
        .filter("label_a <> label_b")
        .filter(counts_for(a, b, F.lit(1)) & ((size(a) < size(b)) | ((size(a) == size(b)) & (F.col("a") < F.col("b")))))
        .filter(may_link(a, b, F.col("kept_a"), F.col("kept_b")))
        .select("a", "b")
        .distinct()
    )
    prefixes = found.filter("asked IS NOT NULL").groupBy("class").agg(
        F.first(F.struct("n", "asked", "alike", "prefix")).alias("p")
    )
    both = met.join(prefixes.select(F.col("class").alias("a"), F.col("p").alias("p_a")), "a").join(
        prefixes.select(F.col("class").alias("b"), F.col("p").alias("p_b")), "b"
    )
    n, m, shares = F.col("p_a.n"), F.col("p_b.n"), F.least("p_a.asked", "p_b.asked")
    common = in_common(n, m)
    first_of = (
        F.slice("p_a.prefix", F.lit(1), (n - common + shares).cast("int")),
        F.slice("p_b.prefix", F.lit(1), (m - common + shares).cast("int")),
    )
    enough = F.size(F.array_intersect(*first_of)) >= shares - F.least("p_a.alike", "p_b.alike")
    left = F.greatest(*(F.ceil(NEED * p["n"] / WHOLE) - p["asked"] + p["alike"] for p in (F.col("p_a"), F.col("p_b"))))
    whole = F.size(F.array_intersect("p_a.prefix", "p_b.prefix")) + left >= common
    return both.filter(enough & whole).select("a", "b")


def class_components(docs: DataFrame, found: DataFrame) -> DataFrame:
    """class (as node) and label for all classes that link with another one."""
    postings = shared_postings(found)
    keys = found.filter("class IS NOT NULL").groupBy("class").agg(F.min("row_key").alias("row_key"))
    # Not from a list of rows: reading one starts Python workers of another kind, which stay on every executor.
    labels = docs.sparkSession.range(0).select(F.col("id").alias("node"), F.col("id").alias("label"))
    open_postings = labelled(postings, labels)
    for seed in range(ROUNDS):
        here = open_postings
        hubs = first_hubs(here)
        if seed:
            # Once a star round has merged what is close, few tokens hold many components.
            crowded, size = stored_with_size(crowded_tokens(open_postings), "crowded")
            if crowded.isEmpty():
                break
            here = sized_join(open_postings, crowded, size, ["token"], ["class"])
            hubs = later_hubs(here, seed)
        more = verified(star_pairs(here, hubs), docs, keys)
        if more.isEmpty():
            break
        labels = merged(labels, more)
        open_postings = labelled(open_postings.drop("label"), labels)
    last = verified(crossing_pairs(open_postings, found), docs, keys)
    return labels if last.isEmpty() else merged(labels, last)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and class (equal for equal sets) of every document."""
    found = stored(classed(docs), "classes")
    labels = class_components(docs, found)
    firsts = found.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"))
    named = firsts.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class")
    )
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    # Only classes that link are looked up by label; a class holds its copies already.
    of_class = named.join(lowest, "label").select("class", "component_id")
    rows = found.select("doc_id", F.col("n").alias("n_shingles"), "class")
    return lookup_join(rows, of_class, ["class"], ["doc_id"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("component_id"),
        "class",
    )


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
    ELSE array_to_string(words[k:k + 4], ' ') END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m.low, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) m USING (doc_id)
"""


@query(OP5_SQL)
def op5_jaccard_join(spark, sf_dir):
    """The component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
