"""Spelling variants against plain edit steps."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from eventtally.llm import spelling as s
from eventtally.llm.spelling import neighbours, roots, spelling_variants

LETTERS = "abcdé×ÿ"


def occurrences(rows, shortest):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                count[run] += 1
    return count


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain(count, factor=10):
    near = {w: [v for v in count if one_apart(w, v)] for w in count}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[word] = best if best is not None and count[best] >= factor * count[word] else None
    out = set()
    for word, n in count.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), count[form[word]] if form[word] else None))
    return out


def texts(seed, words=150, documents=60):
    draw = random.Random(seed)
    known = ["".join(draw.choices(LETTERS, k=draw.randint(3, 9))) for _ in range(words)]
    for word in list(known):
        k = draw.randrange(len(word))
        known.append(draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice(LETTERS) + word[k:],
                                  word[:k] + word[k] + word[k:], word[:k] + "b" + word[k + 1 :]]))
    weights = [1 / (k % words + 1) ** 2 for k in range(len(known))]
    rows = []
    for doc_id in range(documents):
        parts = draw.choices(known, weights, k=120)
        rows.append((doc_id, draw.choice([" ", "-", "1", ", "]).join(w.upper() if draw.random() < 0.1 else w for w in parts)))
    return rows + [(None, "aaaaaaaa aaaaaaaa"), (77, None), (78, "")]


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    return {tuple(r) for r in spelling_variants(docs, **options).collect()}


def test_against_plain_steps(spark):
    for seed, shortest, least in ((1, 4, 1), (2, 7, 2)):
        rows = texts(seed)
        count = {w: n for w, n in occurrences(rows, shortest).items() if n >= least}
        want = plain(count)
        assert any(form for _, form, *_ in want)
        assert found(spark, rows, shortest=shortest, least=least) == want


def test_runs_of_equal_letters_meet_once(spark):
    count = {"aaaa": 50, "aaaaa": 5, "aaaaaa": 1, "aabaa": 7, "baaaa": 3, "aaaab": 2, "abbbbbba": 1, "abbbbba": 90}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    got = {r.name: (r.n_near, r.best, r.best_n) for r in neighbours(words).collect()}
    for word in count:
        others = [v for v in count if one_apart(word, v)]
        best = min(others, key=lambda v: (-count[v], v), default=None)
        assert got.get(word, (0, None, None)) == (len(others), best, count.get(best))


def test_ties_go_to_the_smallest():
    members = [("é", "abcé", 5), ("d", "abcd", 5), ("x", "abcx", 1), ("", "abc", 5)]
    got = {row[0]: row[1:] for row in s.partners("$abc", members)}
    assert got == {"abcé": (3, 5, "abc"), "abcd": (3, 5, "abc"), "abcx": (3, 5, "abc"), "abc": (3, 5, "abcd")}


def test_a_prefix_across_batches(monkeypatch):
    monkeypatch.setattr(s, "SCANNED_ROWS", 2)
    words = {"abcdefg": 3, "abcdefh": 40, "abcdef": 2, "xbcdefg": 1}
    turned = []
    for w, n in words.items():
        turned += [(w[i:] + "$" + w[:i], "", w, n) for i in range(len(w) + 1)]
        turned += [(w[i + 1 :] + "$" + w[:i], w[i], w, n) for i in range(len(w))]
    turned.sort()
    names = ["prefix", "last", "name", "n"]

    def rows(size):
        parts = [turned[k : k + size] for k in range(0, len(turned), size)]
        batches = (pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in part]) for part in parts)
        return sorted(tuple(r.values()) for batch in s.scanned(batches) for r in batch.to_pylist())

    assert rows(1) == rows(3) == rows(1000) and rows(1)


def test_chains_of_forms(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(11)]
    forms = spark.createDataFrame(chain, "word string, form string")
    assert {tuple(r) for r in roots(forms, 4).collect()} == {(w, "w11") for w, _ in chain}


def test_long_text_and_repeated_rows(spark):
    rows = [(1, "Abcdefgh " * 50_000 + "abcdefg " * 100 + "z" * 100_000 + " " + "z" * 50_000 + "y" + "z" * 49_999)] * 2
    got = found(spark, rows)
    assert {(w, n) for w, _, _, n, *_ in got} == {(w, n) for w, n in occurrences(rows, 7).items() if n >= 2}
    assert {near for w, _, _, _, near, _ in got if len(w) == 100_000} == {1}


def test_long_words(spark):
    """Words about the length at which texts give way to hashes, and beyond, with ties and runs."""
    draw = random.Random(9)
    count = {}
    for size in (62, 63, 64, 65, 66, 130, 700):
        word = "".join(draw.choices("abé", k=size))
        variants = [word, word[:5] + "z" + word[6:], word[:5] + "y" + word[6:], word[:40] + "b" + word[40:], word[1:], "z" * size,
                    word[:-1], word + "a", word[:30] + word[30] + word[30:]]
        count |= {v: draw.choice([1, 2, 2, 30, 400]) for v in variants}
    rows = [(None, f"{w} " * n) for w, n in count.items()]
    count = {w: n for w, n in occurrences(rows, 7).items() if n >= 2}
    assert any(len(w) > 64 and form and len(form) > 64 for w, form, *_ in plain(count))
    assert found(spark, rows) == plain(count)


def test_hashes_of_rotations():
    word = "abcéabxÿq" * 9
    whole, ending = s.hashes_of(word)
    for k in range(len(word)):
        less = word[:k] + word[k + 1 :]
        assert (s.hashes_of(less)[0][k] == ending[k]).all()
    assert len({tuple(h) for h in whole.tolist()}) == len(word) + 1


def test_empty_tables(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, None), (None, "short")]) == set()
