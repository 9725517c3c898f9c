"""Benchmark decontamination against plain edit distance."""

import random

import pytest

from eventtally.llm.decontaminate import (
    Items,
    distances,
    find_leaks,
    matches,
    plain,
    without_leaks,
)

random.seed(5)
WORDS = [f"{a}{b}" for a in ("tor", "an", "ble", "quo", "is") for b in ("th", "er", "", "um")]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def edited(text, edits):
    letters = list(text)
    for _ in range(edits):
        k = random.randrange(len(letters))
        letters[k : k + 1] = random.choice([[], ["x"], [letters[k], "z"]])
    return "".join(letters)


def table_row(pattern, text, anchored):
    row = list(range(len(pattern) + 1))
    for end, c in enumerate(text, 1):
        diagonal, row[0] = row[0], end if anchored else 0
        for k, p in enumerate(pattern, 1):
            diagonal, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, diagonal + (p != c))
        yield row[-1]


@pytest.mark.parametrize("anchored", [False, True])
def test_distances_equal_the_plain_table(anchored):
    for _ in range(60):
        pattern = "".join(random.choice("abc") for _ in range(random.randint(1, 80)))
        text = "".join(random.choice("abcd") for _ in range(random.randint(0, 90)))
        assert list(distances(pattern, text, anchored)) == list(table_row(pattern, text, anchored))


def test_every_item_within_its_budget_is_found():
    items = [(i, plain(prose(40))) for i in range(12)]
    search = Items(items, 0.08)
    for number, text in items:
        budget = int(len(text) * 0.08)
        for edits in (0, 1, budget // 2, budget):
            document = f"{prose(30)}. {edited(text, edits)}, {prose(30)}"
            whole = plain(document)
            near = {i for i, t in items if list(matches(t, whole, int(len(t) * 0.08)))}
            assert {hit[0] for hit in search.found(document)} == near
            assert number in near


def test_span_is_in_the_original_text():
    item = "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda"
    document = "İ head.\n" + item.upper().replace(" ", "***  ") + "! Tail"
    (hit,) = Items([(7, plain(item))], 0.08).found(document)
    assert hit[:2] == (7, 0)
    assert plain(document[hit[2] : hit[3]]) == plain(item)


def test_spans_after_letters_that_grow_when_lowered():
    """Right before the passage, within it and in Greek, in the item as in the document."""
    item = "Alpha beta gamma ΟΔΟΣ, delta epsilon zeta eta theta iota kappa lambda"
    for head in ("İİİstanbul ", "İstanbul İstanbul İstanbul ", "ΣΑΣ. İ"):
        document = head + item.upper() + " tail"
        (hit,) = Items([(7, plain(item))], 0.08).found(document)
        assert hit[1] == 0 and document[hit[2] : hit[3]] == item.upper()
    turkish = "İstanbul'un taşı toprağı altın, İzmir'in denizi ve güneşi, Ankara'nın bozkırı"
    (hit,) = Items([(1, plain(turkish))], 0.08).found("önce " + turkish)
    assert hit[1:] == (0, 5, 5 + len(turkish))


def test_short_items_are_found_word_for_word():
    items = [(1, "who is who"), (2, "42"), (3, "何ですか"), (4, "x" * 39)]
    search = Items([(i, plain(t)) for i, t in items], 0.08)
    assert list(search.found("So, WHO is -- who? 42!")) == [(1, 0, 4, 17), (2, 0, 19, 21)]
    assert list(search.found("who is whom, 142 420, who is wh")) == []
    assert list(search.found("これは何ですか。")) == [(3, 0, 3, 7)]
    assert list(search.found("x" * 38 + "y " + "x" * 39)) == [(4, 0, 40, 79)]
    assert list(search.found("x" * 40)) == []


def test_edge_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, "x " * 200_000 + item), (5, "clean")],
        "doc_id long, text string",
    ).selectExpr("doc_id", "text", "1 as edits", "2 as item_id")
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "clean"), (5, "?!")], "item_id long, text string")
    found = find_leaks(docs, items).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["edits"]) for r in found) == sorted(
        [(str(d), i, 0) for d in (3, 3, None, 4) for i in (1, 2)] + [("5", 4, 0)]
    )
    # One item per pass gives the same rows.
    small = find_leaks(docs, items, shard_chars=1).collect()
    assert sorted(map(str, small)) == sorted(map(str, found))
    kept = without_leaks(spark, docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    assert find_leaks(docs.limit(0), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0
