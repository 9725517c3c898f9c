"""The pipeline against plain Python, stage by stage, on small tables."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eventtally.llm.subwords import default_path

random.seed(9)
SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(found):
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "near duplicates", "decontamination", "personal data", "packing"
    ]


def test_language_rejects_what_is_in_no_language(spark, docs):
    extra = [(10**6, None, "en", None, None), (10**6 + 1, "12 34 %%", None, "x", 1), (10**6 + 2, "中文 字符 测试", None, "x", 1)]
    found = STAGE["language ID"](spark, docs.unionByName(frame(spark, extra)), SF)
    assert found.columns == docs.columns
    assert texts(found) == texts(docs)


def test_one_row_of_each_group_stays(spark):
    words = [f"w{k}" for k in range(300)]
    base = " ".join(random.choice(words) for _ in range(60))
    other = " ".join(random.choice(words) for _ in range(60))
    rows = [(5, base, "en", "a", 1), (3, base + " end", "en", "b", 2), (9, other, "en", "c", 3), (9, other, "en", "c", 3),
            (1, None, None, None, None), (2, "", "en", "d", 0), (None, other + " x", "en", "e", 4), (7, "lonely", "de", "f", 6)]
    kept = STAGE["near duplicates"](spark, frame(spark, rows), SF)
    assert kept.columns == frame(spark, rows).columns
    found = texts(kept)
    # An id that is missing counts as the smallest.
    assert [d for d, _ in found] == sorted([3, 1, 2, None, 7], key=str)
    assert STAGE["near duplicates"](spark, frame(spark, rows).limit(0), SF).count() == 0


def test_documents_with_benchmark_items_go(spark, docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    extra = frame(spark, [(10**6, f"Before. {item} After.", "en", "x", 1), (10**6 + 1, item.upper(), "en", "x", 1), (10**6 + 2, None, "en", "x", 1)])
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    found = texts(STAGE["decontamination"](spark, docs.unionByName(extra), SF))
    for doc_id, text in found:
        assert not text or not any(plain(i) in plain(text) for i in items)
    ids = {d for d, _ in found}
    assert 10**6 + 2 in ids and not ids & {10**6, 10**6 + 1}
    clean = {r["doc_id"] for r in docs.collect() if not any(plain(i)[:60] in plain(r["text"]) for i in items)}
    assert clean <= ids


def test_personal_data_is_masked(spark):
    rows = [(1, "é write a@b.cd or +1 (017) 555-7713", "en", "s", 9), (2, None, "en", "s", 4), (3, "clean text", "en", "s", 10),
            (None, "ip 10.0.0.1", "en", "s", 1), (3, "clean text", "en", "s", 10)]
    rows += [(100 + k, f"please write to user{k}@mail.example.com", "en", "s", 1) for k in range(8)]
    rows += [(200, "to please write to QX-88412-Z, ok", "en", "s", 1)]
    found = STAGE["personal data"](spark, frame(spark, rows), SF)
    assert found.columns == frame(spark, rows).columns
    by_id = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    assert found.count() == len(rows)
    assert by_id[1] == ("é write <EMAIL> or <PHONE>", 26)
    assert by_id[2] == (None, 4) and by_id[3] == ("clean text", 10) and by_id[None][0] == "ip <IP>"
    assert by_id[200][0] == "to please write to <ID>, ok"


def test_clashing_columns_and_very_long_texts(spark, docs):
    """All stages but the last keep every column, whatever its name."""
    names = ["_key", "_copies", "_places", "key", "copies", "places", "doc", "lowest", "label", "email", "id", "row", "score"]
    some = docs.limit(60).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    long = docs.filter("lang = 'en'").select(F.array_join(F.collect_list("text"), " ")).first()[0] * 4
    added = some.limit(1).withColumns({"doc_id": F.lit(10**7).cast("long"), "text": F.lit(long), "lang": F.lit("en")})
    given = some.unionByName(added).cache()
    assert len(long) > 500_000
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, given, SF)
        assert found.columns == given.columns, name
        kept = {r["doc_id"]: r for r in found.collect()}
        for doc_id, row in {r["doc_id"]: r for r in given.collect()}.items():
            if doc_id in kept:
                assert [kept[doc_id][n] for n in names] == [row[n] for n in names], name
        assert kept
    last = STAGE["packing"](spark, given, SF)
    assert last.filter(F.col("doc_id") == 10**7).agg(F.sum("length")).first()[0] > 100_000


def test_empty_tables_go_through(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_whole_run(spark, docs):
    found = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in found}
    assert ids <= {r["doc_id"] for r in docs.collect()} and len(ids) > 0.7 * docs.count()
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_last_stage_equals_the_tokenizer(spark, docs):
    tokenizer = Tokenizer.from_file(default_path())
    pieces = {}
    for r in STAGE["packing"](spark, docs, SF).collect():
        pieces.setdefault(r["doc_id"], {})[r["start"]] = (r["piece"], r["length"], r["ids_crc32"])
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)]
        want = {}
        for k, start in enumerate(starts):
            part = ids[start : start + (first if k == 0 else 2048)]
            want[start] = (k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
        assert pieces[r["doc_id"]] == want
