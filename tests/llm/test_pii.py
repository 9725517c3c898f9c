"""Personal data against a plain scan with Python's patterns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from eventtally.llm.pii import (
    KINDS,
    Bootstrap,
    find_personal_data,
    listed,
    masked,
    occurrences,
    op1_personal_data,
    scanned,
    without_personal_data,
)

SF = "/root/testdata/sf0.01"
# The plain patterns of the contract.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]


def spans_by_row(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = find_personal_data(docs).select("doc_id", listed(KINDS).alias("spans"))
    return {r["doc_id"]: r["spans"] for r in found.collect()}


def test_spans_equal_a_plain_scan(spark):
    random.seed(11)
    bits = ["a", "b.c", "@", "1", "22", ".", "-", " ", "+", "(", ")", "é", "😀", "%", "\n", "255", "0256", "a@b.c",
            "4111 1111 1111 1111", "4111111111111111", "+1 (017) 555-7713", "10.0.0.1"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "a@b@c.d", "a@b.c.@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1 000255.0.0.00"]
    # The plain patterns take quadratic time here, so these stay short.
    texts += ["x" * 2000, "1" * 2000, "1.2" * 1000, "a." * 1000 + "@b.c", "+1" + "(" * 2000, "a@b" + ".c" * 1000]
    found = spans_by_row(spark, texts)
    for k, text in enumerate(texts):
        assert found[k] == ",".join(plain_spans(text)), repr(text)[:200]


def test_very_long_texts(spark):
    texts = ["x" * 300_000, "1" * 200_000, "a." * 100_000 + "@b.c", "+1" + "(" * 100_000, "a@b" + ".c" * 100_000,
             "1.2" * 50_000, "a@b.cd " * 20_000]
    found = spans_by_row(spark, texts)
    assert [found[0], found[1], found[3]] == ["", "", ""]
    assert found[2] == "email:0:200004" and found[4] == "email:0:200003"
    assert found[5].count("ip:") == 12_500
    assert found[6] == ",".join(f"email:{7 * k}:{7 * k + 6}" for k in range(20_000))


def test_query_equals_a_plain_scan(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op1_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in row["spans"].split(",") if s and not s.startswith("id:")] == base
        for kind in PLAIN:
            assert row[f"n_{kind}"] == sum(s.startswith(f"{kind}:") for s in base)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, f"please write to user{k}@mail.example.com today") for k in range(12)]
    rows += [(100, "so write to QX-88412-Z today"), (101, "the part AB-12345 fits"), (102, None), (102, None)]
    rows += [(None, "do write to QX-88412-Z")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as email", "1 as `row`")


def test_patterns_discover_unseen_identifiers(corpus):
    found = {r["doc_id"]: r for r in find_personal_data(corpus).collect()}
    assert [s["value"] for s in found[100]["id"]] == ["QX-88412-Z"]
    assert [s["value"] for s in found[None]["id"]] == ["QX-88412-Z"]
    assert found[101]["id"] == [] and found[102]["id"] == []
    strict = find_personal_data(corpus, Bootstrap(support=50)).collect()
    assert all(r["id"] == [] for r in strict)


def planted(draw):
    """Keys after an assignment, some not of the form that seeds have, among clean look-alikes."""
    key = lambda n: "".join(draw.choices("0123456789abcdef", k=n - 2)) + "a1"
    rows, want = [], {}
    for k in range(60):
        value = key(40) if k % 6 else f"tok-{k:04d}-x"
        rows.append((k, f'words and words {draw.choice(["here", "there"])}. token = "{value}" more words {k}'))
        want[k] = value
    for k in range(60, 100):
        rows.append((k, draw.choice(['size = "640x480-b"', "see figure fig-2024-7", "room: b1234567", 'color = "a1b2c3d4"'])))
    rows += [(k, f"commit {key(40)}") for k in range(100, 103)]  # too few to trust what stands before them
    return rows, want


def test_assignments_discover_keys_and_leave_clean_texts_alone(spark):
    rows, want = planted(random.Random(8))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [s["value"] for s in r["id"]] for r in find_personal_data(docs).collect()}
    assert {k: v[0] for k, v in found.items() if v} == want  # precision and recall are one
    kept = {r["doc_id"]: r["text"] for r in without_personal_data(docs).collect()}
    assert all(kept[k] == text.replace(want[k], "<ID>") if k in want else kept[k] == text for k, text in rows)


def test_context_reaches_over_a_match_and_into_long_words(spark):
    """Lists in which one word stands between entities, and words longer than the context."""
    rows = [(k, f"user: u{k}0001a user: u{k}0002b " + "y" * 200 + f" u{k}0003c") for k in range(7)]
    docs = spark.createDataFrame(rows + [(9, "1a2b3c4d"), (10, "x u10004d")], "doc_id long, text string")
    edges = occurrences(scanned(docs)).filter("NOT base").select("instance", "pattern").collect()
    by = {r["instance"]: r["pattern"] for r in edges}
    assert by["u30001a"] == by["u30002b"] == "user ="
    assert by["u30003c"] == "^ " + "y" * 63
    assert "1a2b3c4d" not in by and by["u10004d"] == "^ x"


def test_a_context_goes_on_from_block_to_block(spark):
    text = "".join(f"nr x{k:06d} " for k in range(400))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    patterns = {r["pattern"] for r in occurrences(scanned(docs)).select("pattern").collect()}
    assert patterns == {"^ nr", "<id> nr"}


def test_sf_tokens_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    token = re.compile('token = "([0-9a-f]{40})"')
    found = {r["doc_id"]: {s["value"] for s in r["id"]} for r in find_personal_data(docs).collect()}
    assert {k: set(token.findall(t)) for k, t in texts.items()} == found


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame(
        [(1, "a@b.cd", "k", "p", 3, "r")], "doc_id long, text string, _key string, _places string, `_doc` int, `row` string"
    ).selectExpr("*", "1 as key", "2 as places", "3 as doc", "4 as email", "5 as id")
    kept = without_personal_data(docs)
    assert kept.columns == docs.columns
    assert tuple(kept.first()) == (1, "<EMAIL>", "k", "p", 3, "r", 1, 2, 3, 4, 5)


def test_edge_tables(spark, corpus):
    assert find_personal_data(corpus).count() == corpus.count()
    assert find_personal_data(corpus.limit(0)).count() == 0


def test_masking(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd, +1 (017) 555-7713 and 10.0.0.1."), (2, "none"), (3, None)], "doc_id long, text string")
    rows = find_personal_data(docs).join(docs, "doc_id").select("doc_id", masked(F.col("text")).alias("m")).collect()
    assert {r["doc_id"]: r["m"] for r in rows} == {1: "é <EMAIL>, <PHONE> and <IP>.", 2: "none", 3: None}
