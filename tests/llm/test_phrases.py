"""Collocations against plain counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventtally.llm import phrases as p
from eventtally.llm.phrases import BITS, Bitmap, HatTrie, bitmap_of, collocations, merged, pair_hashes, runs_of


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pieces(text):
    return [w for x in re.split("[.,;:!?\x0a-\x0d]", lowered(text)) if (w := [v for v in re.split("[ \t]+", x) if v])]


def plain(rows, least, longest=5, most=2000):
    count, total = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text):
            total[lang or "und"] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    count[lang or "und", tuple(words[i : i + m])] += 1
    candidates = {k: n for k, n in count.items() if len(k[1]) > 1 and n >= least}
    dropped = set()
    for (lang, words), n in candidates.items():
        for m in range(2, len(words)):
            for s in range(len(words) - m + 1):
                if n >= count[lang, words[s : s + m]]:
                    dropped.add((lang, words[s : s + m]))
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            n = total[lang]
            cuts = []
            for k in range(1, len(words)):
                left, right = count[lang, words[:k]], count[lang, words[k:]]
                cuts.append((1000 * a * n // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), left, right, n))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:most], 1)
    )


def corpus(seed, documents=60):
    draw = random.Random(seed)
    words = ["a", "B", "é", "ab", "\x01", "c\x00", "x-y", "日", "the", "The", "\x85", "A\xa0b"] + [f"w{k}" for k in range(12)]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for k in range(documents):
        text = "".join(
            draw.choices(words, weights)[0] + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! "])
            for _ in range(draw.randint(0, 80))
        )
        rows.append((draw.choice(["en", "de", "und", None]), text))
    rows += [("en", "one two three four five six")] * 7 + [("en", None), (None, ""), ("fr", "...")]
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, n int")
    return sorted(tuple(r) for r in collocations(docs, **options).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_counts(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows, least=3) == plain(rows, 3)


def test_small_memory_gives_the_same(spark, monkeypatch):
    """Containers burst, subtrees are spilled, ids are given anew and texts are cut into blocks.

    The runs are made in this process, as the settings would not reach Spark's workers.
    """
    rows = [(lang or "und", text) for lang, text in corpus(3) if text is not None]
    for name, value in (("MERGED_ROWS", 5), ("BLOCK", 50)):
        monkeypatch.setattr(p, name, value)
    langs, runs = {}, []
    for k, (lang, text) in enumerate(rows):
        counted = langs.setdefault(lang, p.Counted(lang, (1, 5), None, None))
        counted.trie.burst, counted.trie.heavy = 3, 2
        for _ in counted.feed(text):
            if counted.trie.size > 40:
                runs += counted.run(7, 20)
            if len(counted.ids) > 15:
                runs += counted.run(7)
                counted.renew()
    for counted in langs.values():
        counted.count(last=True)
        runs += counted.run(7)
    assert len(runs) > 20
    lines = [tuple(r.values()) for batch in runs for r in batch.to_pylist()]
    frame = spark.createDataFrame(lines, p.RUN_SCHEMA)
    found_rows = merged(frame.repartition(3), (1, 5), 2).collect()
    got = {(r.lang, r.phrase): r.n for r in found_rows if r.words}
    totals = Counter()
    for r in found_rows:
        totals[r.lang] += 0 if r.words else r.n
    assert totals == Counter(lang for lang, text in rows for words in pieces(text) for _ in words)
    want = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for i in range(len(words)):
                for m in range(1, min(5, len(words) - i) + 1):
                    want[lang, " ".join(words[i : i + m])] += 1
    assert got == {k: n for k, n in want.items() if n >= 2}


def test_trie_counts_and_spills():
    draw = np.random.default_rng(5)
    trie, want, got = HatTrie(4, burst=8, heavy=3), Counter(), Counter()
    for _ in range(30):
        windows = draw.integers(1, 5, (50, 4)).astype(">u4")
        trie.add(windows)
        want.update(map(tuple, windows.tolist()))
        if trie.size > 60:
            taken = trie.spilled(30)
            assert trie.size <= 30
            got.update({tuple(w): int(n) for w, n in zip(taken[0].tolist(), taken[1])})
    windows, counts = trie.spilled()
    got.update({tuple(w): int(n) for w, n in zip(windows.tolist(), counts)})
    assert got == want and trie.size == 0


def test_bitmap_loses_nothing(spark):
    words = spark.createDataFrame([("en", f"w{k}") for k in range(500)], "lang string, phrase string")
    bits = Bitmap(bitmap_of(words, 1 << 16))
    assert all(bits.holds(p.hashed(b"en", b"w%d" % k)) for k in range(500))
    assert sum(bits.holds(p.hashed(b"de", b"w%d" % k)) for k in range(5000)) < 200
    pairs = spark.createDataFrame([("en", f"w{k} w{k + 1}") for k in range(500)], "lang string, phrase string")
    bits = Bitmap(bitmap_of(pairs))
    codes = np.array([p.hashed(b"en", b"w%d" % k) for k in range(501)], np.uint64)
    assert bits.has(pair_hashes(codes[:-1], codes[1:])).all()
    assert len(bits.raw) == BITS // 8


def test_exact_beyond_64_bits():
    import pyarrow as pa

    big = 2**61
    batch = pa.RecordBatch.from_pydict({"a": [big], "l": [big + 1], "r": [big - 1], "n": [big + 7]})
    assert next(p.lowest_cut([batch])).column("score").to_pylist() == [1000 * big * (big + 7) // (big**2 - 1)]


def test_long_text_hot_phrase_and_limits(spark):
    rows = [("en", "the same line again " * 30_000), ("en", "x" * 200_000 + " y" * 300)]
    assert found(spark, rows, least=100) == plain(rows, 100)
    rows = corpus(4)
    assert found(spark, rows, least=2, most=5) == plain(rows, 2, most=5)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None)]) == []


def test_runs_ignore_other_columns(spark):
    docs = spark.createDataFrame([("en", "a b", "z", 5)], "lang string, text string, w1 string, n int")
    assert [tuple(r) for r in merged(runs_of(docs, (2, 2)), (2, 2), 1).collect()] == [("en", "a b", 2, 1)]
