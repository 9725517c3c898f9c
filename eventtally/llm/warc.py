"""WARC archives: written by Spark, read by a PySpark Python data source.

Writing: each row becomes one record. Rows whose payloads are equal and long enough are written
once, as a response; the others revisit it. The records go through Spark's text writer with the
blank lines that end a record as the line separator, so any file system Spark can write to works
and a lost task is written anew.

Reading: `WarcSource` plans partitions of whole files, small ones together. It takes over filters
on the record type and the other columns that come from the headers, reads the headers first
and steps over a payload without reading it when the record is filtered out or the schema
asked for holds no payload.

Defined cases: a null html is an empty payload; a null url is an empty target. A null page_id is
written as an empty id and read back as null. Of repeated rows with the largest page_id
every one is a response. Other columns of the input are ignored, whatever their names. An empty
table gives an empty archive.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import query, table
from eventtally.session import shared_folder

RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ID_PREFIX, ID_SUFFIX = "<urn:page:", ">"

SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_length long, date string, payload binary"
)
# Columns that are read from the headers, with the header's name.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "payload_length": "x-payload-length",
    "date": "warc-date",
}
BATCH_BYTES = 8 * 1024 * 1024
# A partition of the reader holds files up to this size together.
PARTITION_BYTES = 32 * 1024 * 1024


def sha1_base32(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32; 160 bits need no padding."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def write_warc(
    pages: DataFrame, path: str, least_payload: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write a record per row of `pages` (page_id, url, html) to the folder `path`.

    Only digests and ids are grouped. The table of repeated payloads is measured: a small
    one is sent to the pages, else both are shuffled with hot digests cut into parts.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumn(
        "digest", sha1_base32(F.col("html").cast("binary"))
    )
    repeated = (
        rows.filter(F.octet_length("html") >= least_payload)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("digest", "first_id")
    )
    marked = lookup_join(rows, repeated, ["digest"], ["page_id"], "left")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def identifier(column: str) -> Column:
        return F.concat(
            F.lit(ID_PREFIX), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(ID_SUFFIX)
        )

    # Control characters would end a header line, "%" marks them.
    target = F.coalesce(F.col("url"), F.lit(""))
    for plain, written in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        target = F.replace(target, F.lit(plain), F.lit(written))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisits, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        identifier("page_id"),
        F.when(revisits, F.concat(F.lit("\r\nWARC-Refers-To: "), identifier("first_id"))).otherwise(""),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit("\r\nX-Payload-Length: "),
        F.octet_length("html").cast("string"),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
    )
    block = F.when(revisits, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    record = F.concat(head, F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    marked.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, of a URI or a plain path."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "/" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):  # as Hadoop calls it
        path = f"s3:{rest}"
    return pafs.FileSystem.from_uri(path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def kept_by(condition: Filter, values: dict[str, object]) -> bool:
    value = values.get(condition.attribute[0])
    if isinstance(condition, EqualNullSafe):
        return value == condition.value
    if value is None:
        return False
    if isinstance(condition, EqualTo):
        return value == condition.value
    if isinstance(condition, In):
        return value in condition.value
    if isinstance(condition, StringStartsWith):
        return str(value).startswith(condition.value)
    return True  # IsNotNull


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.names
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what the headers can answer; hand the rest back to Spark."""
        known = (EqualTo, EqualNullSafe, In, StringStartsWith, IsNotNull)
        for one in filters:
            if isinstance(one, known) and len(one.attribute) == 1 and one.attribute[0] in HEADERS:
                self.conditions.append(one)
            else:
                yield one

    def partitions(self) -> list[Files]:
        system, root = opened(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted(
            (f.path, f.size)
            for f in found
            if f.type == pafs.FileType.File and f.size and f.base_name[0] not in "._"
        )
        groups: list[list[str]] = []
        room = 0
        for path, size in files:
            if not groups or size > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(path)
            room -= size
        return [Files(group) for group in groups] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        wants_payload = "payload" in self.names
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                for values, block in records(stream, self.conditions, wants_payload):
                    values["payload"] = block
                    rows.append(values)
                    held += 400 + len(block or b"")
                    if held >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_length": pa.int64()}
        columns = [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in self.names]
        return pa.RecordBatch.from_arrays(columns, names=self.names)


def records(stream, conditions: list[Filter], wants_payload: bool):
    """The header values and the payload of each record that meets all conditions."""
    columns = {header: column for column, header in HEADERS.items()}
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        values: dict[str, object] = {}
        length, http = 0, False
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("the archive ends within a header")
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            name, value = name.lower(), value.strip()
            if name == "content-length":
                length = int(value)
            elif name == "content-type":
                http = value.startswith("application/http")
            elif name in columns:
                values[columns[name]] = int(value) if name == "x-payload-length" else value
        if all(kept_by(c, values) for c in conditions):
            block = None
            if wants_payload:
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError("the archive ends within a record")
                if http:
                    block = block.partition(b"\r\n\r\n")[2]
            else:
                stream.seek(length, 1)
            yield values, block
        else:
            stream.seek(length, 1)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below a folder; without the payload column no payload is read."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    columns = SCHEMA if payload else SCHEMA.replace(", payload binary", "")
    return spark.read.format("warc").schema(columns).load(path)


def page_id(identifier: Column) -> Column:
    """The id in a record id, null when it is empty."""
    digits = F.substring(identifier, len(ID_PREFIX) + 1, 100)
    return F.regexp_extract(digits, "^(-?[0-9]*)", 1).try_cast("long")


OP10_SQL = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS hex FROM pages),
nibbles AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))) & 31), 1), '' ORDER BY k) AS payload_digest
  FROM (SELECT DISTINCT hex FROM d), range(32) t(k) GROUP BY hex),
m AS (SELECT hex, max(page_id) AS first_id FROM d GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN nibbles USING (hex) JOIN m USING (hex)
"""


@query(OP10_SQL)
def op10_warc(spark, sf_dir):
    """Every page, as read back from the archives that were written for it."""
    path = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    # Responses are read with their payloads and measured; of revisits the headers say enough.
    responses = read_warc(spark, path).filter(F.col("record_type") == "response")
    revisits = read_warc(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    first = responses.select(
        page_id(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
        "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )
    other = revisits.select(
        page_id(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.substring("payload_digest", len("sha1:") + 1, 32).alias("payload_digest"),
        "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )
    return first.unionByName(other)
