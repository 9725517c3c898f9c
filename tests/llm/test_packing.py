"""Packing: every piece placed once, without gaps, in few sequences; ids as the tokenizer's."""

import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventtally.llm.packing import cut, layout, nonnegative_fit, pack, patterns
from eventtally.llm.subwords import Subwords, default_path

random.seed(4)


def sequences(histogram, runs):
    found = {}
    for length, count in histogram.items():
        at = 0
        for r in runs[runs.length == length].sort_values("low").itertuples():
            assert r.low == at
            at = r.high
            for k in range(r.high - r.low):
                found.setdefault(r.first + k, []).append((r.offset, length))
        assert at == count
    return found


@pytest.mark.parametrize("trial", range(12))
def test_layout(trial):
    kinds = [
        lambda: Counter(random.randint(1, 2048) for _ in range(random.randint(0, 2000))),
        lambda: Counter(min(2048, int(random.lognormvariate(6, 1)) + 1) for _ in range(8000)),
        lambda: Counter({2048: random.randint(0, 5), 1025: random.randint(0, 99), 7: random.randint(0, 500), 683: 100}),
        lambda: Counter({random.randint(1, 300): random.randint(1, 10**6) for _ in range(6)}),
    ]
    histogram = kinds[trial % 4]()
    runs = layout(dict(histogram))
    if trial % 4 != 3:
        found = sequences(histogram, runs)
        for places in found.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
    used = int((runs["first"] + runs["high"] - runs["low"]).max()) if len(runs) else 0
    total = sum(n * c for n, c in histogram.items())
    if trial % 4 in (1, 3):
        assert used <= 1.05 * total / 2048 + 1


def test_fit_equals_the_least_of_all():
    rng = np.random.default_rng(0)
    for _ in range(20):
        matrix, goal = rng.normal(size=(6, 9)), rng.normal(size=6)
        x = nonnegative_fit(matrix, goal)
        slope = matrix.T @ (goal - matrix @ x)
        assert (x >= 0).all() and (slope <= 1e-5).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-5


def test_patterns_fill_a_sequence():
    assert sorted(patterns(4, 3)) == [(2, 1, 1), (2, 2), (3, 1), (4,)]


def test_cut():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(3, 4) == [(0, 3)]


def test_ids_equal_the_tokenizer():
    own, other = Subwords(default_path()), Tokenizer.from_file(default_path())
    bits = ["a", "B", "1", " ", "\n", "\t", "'", "s", "é", "ß", "́", "‍", "\u00a0", "\u3000", "\x85", "\x1c", "!", "_", "Ⅷ", "ー", "😀", "'ll", "<|endoftext|>", "<|"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    for text in [*texts, "a" * 50_000, "1" * 5000, " " * 5000 + "x"]:
        assert own.ids(text) == other.encode(text, add_special_tokens=False).ids


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "some text"), (3, "word " * 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "2 as length", "3 as task", "4 as rank")
    found = pack(docs.repartition(3)).collect()
    by_id = Counter(r["doc_id"] for r in found)
    assert by_id[1] == 1 and by_id[2] == 2 and by_id[None] == 1 and by_id[3] == 5
    assert [r["length"] for r in found if r["doc_id"] in (1, 2)] == [1, 1, 1]
    taken = {}
    for r in found:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in taken.values():
        assert sorted(o for o, _ in places) == [0, *np.cumsum([n for _, n in sorted(places)])[:-1]]
    assert pack(docs.limit(0)).count() == 0
