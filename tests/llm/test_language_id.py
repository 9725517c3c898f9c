"""Language identification on small texts and its accuracy on held-out documents."""

from collections import Counter

import pytest

from eventtally.llm import language_id
from eventtally.llm.language_id import (
    counted,
    grams_of,
    identified,
    learn_profiles,
    op6_language,
    ranked,
)

SF = "/root/testdata/sf0.01"
ROWS = [("the cat and the dog in the house", "en"), ("der hund und die katze in dem haus", "de")]


def plain_grams(word):
    yield from word
    padded = f"_{word}_"
    for size in (2, 3):
        for k in range(len(padded) - size + 1):
            yield padded[k : k + size]


def as_text(gram):
    points = []
    while gram:
        points.append(chr(gram & 0x1FFFFF))
        gram >>= 21
    return "".join(reversed(points))


def test_counts_equal_a_plain_count():
    text = "Ab ab! C4d_ " + "x" * 90 + " é😀ß 中"
    grams, counts = counted(grams_of(text))
    plain = Counter(g for w in ("ab", "ab", "c", "d", "x" * 90, "é", "ß", "中") for g in plain_grams(w))
    assert dict(zip(map(as_text, grams.tolist()), counts.tolist())) == plain
    assert [as_text(g) for g in ranked("bb a", 3)] == ["b", "a", "_a"]


def test_edge_rows(spark):
    learned = spark.createDataFrame(ROWS * 3 + [(None, "en"), ("the", None)], "text string, lang string")
    profiles = learn_profiles(learned)
    assert set(profiles) == {"en", "de"}
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "123 !?"), (4, "the dog"), (5, "die katze und der hund"), (5, "the " * 100_000),
         (None, "the cat"), (6, "中文字")],
        "doc_id long, text string",
    ).selectExpr("*", "'mine' as score", "'other' as `a b`")
    found = identified(docs, profiles)
    assert found.columns == ["doc_id", "text", "a b", "lang_pred", "score"]
    rows = {(r["doc_id"], (r["text"] or "")[:3]): (r["lang_pred"], r["score"]) for r in found.collect()}
    assert rows[1, ""] == rows[2, ""] == rows[3, "123"] == ("und", 0.0)
    assert rows[4, "the"][0] == rows[5, "the"][0] == rows[None, "the"][0] == "en"
    assert rows[5, "die"][0] == "de" and 0 < rows[5, "die"][1] <= 1
    assert rows[6, "中文字"][1] == 0
    assert learn_profiles(learned.limit(0)) == {}
    assert {r["lang_pred"] for r in identified(docs, {}).collect()} == {"und"}
    assert identified(docs.limit(0), profiles).count() == 0


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = op6_language(spark, SF).join(docs, "doc_id").filter("held_out")
    right, every = found.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert every > 200 and right / every > 0.98


def test_a_task_holds_so_many_n_grams_however_many_languages_there_are(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MERGE_GRAMS", 200)
    rows = [(f"{chr(97 + k % 20) * 9} {chr(97 + k % 7) * 4}", f"l{k % 20}") for k in range(400)]
    given = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    whole, most = language_id.counted, []

    class Learnt:
        """Takes the function that counts, to run it here."""

        def filter(self, *_):
            return self

        select = filter

        def mapInArrow(self, count, kind):
            self.count = count
            raise LookupError

    taken = Learnt()
    with pytest.raises(LookupError):
        language_id.learn_profiles(taken)
    batches = given.toArrow().to_batches(max_chunksize=1)
    at, sums = 0, Counter()

    def counting():
        nonlocal at
        for batch in batches:
            at += len(grams_of(batch.column(0)[0].as_py()))
            yield batch

    monkeypatch.setattr(language_id, "counted", lambda grams: (most.append(len(grams)), whole(grams))[1])
    for found in taken.count(counting()):
        for lang, gram, n in zip(*(found.column(k).to_pylist() for k in range(3))):
            sums[lang, gram] += n
        # What is still held is all that was read and not yet merged.
        assert at - sum(most) <= 200
    want = Counter((lang, int(g)) for text, lang in rows for g in grams_of(text))
    assert sums == want and len(most) > 20
