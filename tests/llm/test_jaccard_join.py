"""The Jaccard join against brute force."""

import random
import re

from eventtally.llm import jaccard_join
from eventtally.llm.jaccard_join import (
    components,
    linked,
    near_duplicates,
    prefix_of,
    required,
    shingles,
)

import numpy as np
import pytest
from pyspark.sql import functions as F

random.seed(3)
WORDS = [f"w{k}" for k in range(400)]


def plain_set(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                group[root(x)] = root(y)
    lowest = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[root(k)] = min(doc_id, lowest.get(root(k), doc_id))
    return sorted(((d, len(s), lowest.get(root(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def changed(words, times):
    words = list(words)
    for _ in range(times):
        words[random.randrange(len(words))] = random.choice(WORDS)
    return words


def corpus():
    rows = []
    passage = [random.choice(WORDS) for _ in range(60)]
    for k in range(120):
        rows.append([random.choice(WORDS) for _ in range(random.randint(1, 90))])
    base = [random.choice(WORDS) for _ in range(80)]
    rows += [changed(base, random.randint(0, 4)) for _ in range(60)]
    rows += [[random.choice(WORDS) for _ in range(random.randint(5, 40))] + passage for _ in range(40)]
    rows += [rows[5]] * 20 + [rows[150][::-1]] * 2
    texts = [" ".join(r) for r in rows] + ["", "   \n", "One", "one", "a b c", "A\tB\nc", None, "x y z w é", "x y z w É"]
    return [(k * 7 % 1000, t) for k, t in enumerate(texts)] + [(None, texts[5]), (None, None), (None, "alone here"), (35, texts[5])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as class", "2 as n", "'t' as token")


def result(found):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)


def test_components_equal_brute_force(spark):
    rows = corpus()
    assert result(near_duplicates(frame(spark, rows).repartition(5))) == brute(rows)


@pytest.mark.parametrize("stars", [True, False])
def test_order_and_rounds_change_nothing(spark, monkeypatch, stars):
    """Star rounds until one finds no link, and none that finds any."""
    rows = corpus()
    if not stars:
        star_pairs = jaccard_join.star_pairs
        monkeypatch.setattr(jaccard_join, "star_pairs", lambda *a: star_pairs(*a).limit(0))
    monkeypatch.setattr(jaccard_join, "LEAST_COUNT", 10**9)
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_POSTING", 0.01)
    monkeypatch.setattr(jaccard_join, "PARTNERS_PER_TASK", 3)
    assert result(near_duplicates(frame(spark, rows).repartition(3))) == brute(rows)


def test_very_long_text_and_empty_table(spark):
    long = " ".join(random.choice(WORDS) for _ in range(150_000))
    found = result(near_duplicates(frame(spark, [(2, long), (1, long + " more"), (3, "short")])))
    assert [r[2] for r in found] == [1, 1, 3]
    assert near_duplicates(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_prefixes_share_what_is_asked():
    """For any two sets that link, by any order of the tokens."""
    for _ in range(300):
        n = random.randint(1, 80)
        x = random.sample(range(10_000), n)
        y = list(set(x[random.randint(0, n // 5) :] + random.sample(range(10_000), random.randint(0, n // 5))))
        x, y = sorted((np.array(sorted(v), np.uint64) for v in (x, y)), key=len)
        if not len(x) or not linked(x, y):
            continue
        known = np.array(sorted(random.sample(range(10_000), 3000)), np.uint64)
        counts = np.array([random.randint(2, 50) for _ in known])
        px, short, ask_x = prefix_of(x, known, counts)
        py, _, ask_y = prefix_of(y, known, counts)
        common = set(px[:short].tolist()) & set(py.tolist())
        assert len(common) >= min(ask_x, ask_y)
        assert set(px[: short - ask_x + 1].tolist()) & set(py.tolist())


def test_required():
    for n in range(1, 60):
        for m in range(n, 2 * n):
            need = next(c for c in range(3 * n + 9) if 100 * c >= 75 * (n + m - c))
            if need <= n:
                assert required(n, True) <= need and required(m, False) <= need


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (95, 90)], "a long, b long")
    found = {r["node"]: r["label"] for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 90, 95: 90, 90: 90}


def test_shingles():
    assert len(shingles(None)) == len(shingles(" \n")) == 0
    assert shingles("A b").tolist() == shingles("a  B\t").tolist() != shingles("b a").tolist()


def test_few_classes_of_a_large_group_are_left_for_the_pairs(spark, monkeypatch):
    """Copies of one text that link with few of the others each."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(110)]

    def edited(k):
        words = list(base)
        for n, at in enumerate(rng.sample(range(5, 105), 2)):
            words[at] = f"x{k}-{n}"
        return " ".join(words)

    docs = spark.createDataFrame([(k, edited(k)) for k in range(500)], "doc_id long, text string").cache()
    left = []
    crossing = jaccard_join.crossing_pairs

    def watched(postings, found):
        left.append(postings.groupBy("class").agg(F.first("label").alias("label")).groupBy("label").count().collect())
        return crossing(postings, found)

    monkeypatch.setattr(jaccard_join, "crossing_pairs", watched)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    sets = {r["doc_id"]: set(jaccard_join.shingles(r["text"]).tolist()) for r in docs.collect()}
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in sets:
        for y in range(x):
            both = len(sets[x] & sets[y])
            if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both) and top(x) != top(y):
                root[max(top(x), top(y))] = min(top(x), top(y))
    assert found == {k: top(k) for k in sets}
    sizes = sorted((r["count"] for r in left[0]), reverse=True)
    assert sum(sizes[1:]) <= 25


def test_pairs_are_worked_out_once(spark):
    """Their joins are what the query shuffles most."""
    texts = [(k, " ".join(WORDS[:50]) + f" x{k}") for k in range(4)]
    docs = frame(spark, texts)
    found = jaccard_join.classed(docs).cache()
    keys = found.groupBy("class").agg(F.min("row_key").alias("row_key"))
    numbers = sorted(r["class"] for r in found.collect())
    met = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    pairs = spark.createDataFrame([(numbers[0], n) for n in numbers[1:]], "a long, b long").mapInArrow(watched, "a long, b long")
    assert jaccard_join.verified(pairs, docs, keys).count() == 3
    assert met.value == 3


def test_repeated_tokens_of_texts_beyond_the_room_for_them(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOGETHER", 50)
    texts = [(k, " ".join(WORDS[: 20 + 40 * (k % 3)]) + f" x{k}") for k in range(12)]
    tokens, counts = jaccard_join.repeated_tokens(frame(spark, texts).coalesce(1))
    assert len(tokens) == len(counts) and (counts >= jaccard_join.LEAST_COUNT).all()
    assert result(near_duplicates(frame(spark, texts))) == brute(texts)


def test_no_python_workers_but_those_of_the_texts_are_started(spark, monkeypatch):
    def from_rows(*_, **__):
        raise AssertionError("a table from a list of rows runs Python workers of another kind")

    docs = frame(spark, [(k, f"a b c d e f g {k // 2}") for k in range(6)])
    monkeypatch.setattr(type(spark), "createDataFrame", from_rows)
    assert {row["doc_id"]: row["component_id"] for row in near_duplicates(docs).collect()} == {
        k: k // 2 * 2 for k in range(6)
    }
