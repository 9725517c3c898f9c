"""WARC archives: written, read back, filtered by header."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from eventtally.llm.warc import SCHEMA, page_id, read_warc, records, write_warc

PAGES = [
    (1, "http://a/\r\nWARC-Type: evil", "same"), (2, None, "same"), (3, "http://é/%20", "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""),
    (6, "u", "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n"), (None, "u", "lonely 😀"), (7, "u", "x" * 300_000),
]


def written(spark, folder, rows=PAGES, least=0):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "'c' as first_id")
    path = f"{folder}/warc"
    write_warc(pages.repartition(3), path, least)
    return path


def test_round_trip(spark, folder):
    found = read_warc(spark, written(spark, folder)).withColumn("id", page_id(F.col("record_id"))).collect()
    assert len(found) == len(PAGES)
    html = {p: h or "" for p, _, h in PAGES}
    for r in found:
        payload = html[r["id"]].encode()
        digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r["payload_digest"], r["payload_length"]) == (digest, len(payload))
        if r["id"] in (1, 2):
            assert (r["record_type"], r["refers_to"]) == ("revisit", "<urn:page:3>")
        elif r["id"] == 4:
            assert (r["record_type"], r["refers_to"]) == ("revisit", "<urn:page:5>")
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, payload)
    targets = {r["id"]: r["target_uri"] for r in found}
    assert targets[1] == "http://a/%0D%0AWARC-Type: evil" and targets[2] == ""


def test_small_payloads_can_be_left_alone(spark, folder):
    found = read_warc(spark, written(spark, folder, least=5)).collect()
    assert {r["record_type"] for r in found} == {"response"}


def test_filters_and_columns_reach_the_reader(spark, folder):
    path = written(spark, folder)
    rows = read_warc(spark, path).filter("record_type = 'revisit'").filter("payload_length IN (4, 9)")
    assert rows.count() == 2
    assert "record_type" not in [f for f in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "Filter (" in f]
    headers = read_warc(spark, path, payload=False)
    assert "payload" not in headers.columns and headers.count() == len(PAGES)
    assert read_warc(spark, path).filter("target_uri LIKE 'u%' AND record_id = '<urn:page:7>'").count() == 1


def test_a_refused_record_is_stepped_over():
    class Reader:
        def __init__(self, data):
            self.data, self.at, self.most = data, 0, 0

        def readline(self):
            end = self.data.find(b"\n", self.at) + 1 or len(self.data)
            line, self.at = self.data[self.at : end], end
            return line

        def read(self, size):
            self.most = max(self.most, size)
            part = self.data[self.at : self.at + size]
            self.at += size
            return part

        def seek(self, by, whence):
            self.at += by

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1000\r\n\r\n" + b"x" * 1000 + b"\r\n\r\n"
    reader = Reader(record * 3)
    assert len(list(records(reader, [], False))) == 3 and reader.most == 0
    assert [len(b) for _, b in records(Reader(record * 3), [], True)] == [1000] * 3


def test_gzip_and_empty_archives(spark, folder):
    path = written(spark, folder)
    os.makedirs(f"{folder}/gz")
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(f"{path}/{name}", "rb") as file, gzip.open(f"{folder}/gz/{name}.warc.gz", "wb") as out:
                out.write(file.read())
    assert read_warc(spark, f"{folder}/gz").count() == len(PAGES)
    empty = written(spark, folder + "/empty", PAGES[:0] + PAGES[:1])
    assert read_warc(spark, empty).filter("record_type = 'none'").count() == 0
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    write_warc(nothing, folder + "/nothing")
    assert read_warc(spark, folder + "/nothing").count() == 0
    assert read_warc(spark, folder + "/nothing").columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_schemes_of_hadoop():
    from eventtally.llm.warc import opened

    assert opened("file:///tmp")[1] == opened("file:/tmp")[1] == opened("/tmp")[1] == "/tmp"
    try:
        system, root = opened("s3a://bucket/some/folder")
    except OSError:
        pytest.skip("this pyarrow has no S3")
    assert system.type_name == "s3" and root == "bucket/some/folder"
