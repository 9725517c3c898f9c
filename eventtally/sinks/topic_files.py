"""Topics as files, written by streams through a Python data source.

    records.writeStream.format("topic_files").option("path", ...).option("checkpointLocation", ...)

Records say which topic they go to. Every task writes a file per topic under a name of its own and
tells the driver; a batch is there once its list of files is, `commits/batch_id=N`, which is put in place by
one rename. A task that is killed or repeated, and a batch that runs again after its commit, leave files in
no list: readers, who go by the lists, see each record once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from eventtally.session import names_in

FORMAT = "topic_files"
RECORD = "topic STRING, key STRING, value STRING"
FILE_SCHEMA = pa.schema([(name, pa.string()) for name in ("topic", "key", "value")])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, of a URI or a plain path."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "/" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):  # as Hadoop calls it
        path = f"s3:{rest}"
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The files of a task, as paths below the folder."""

    files: list[str]


class TopicWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Write the records of a task, a batch of rows at a time."""
        system, root = opened(self.path)
        writers: dict[str, pq.ParquetWriter] = {}
        names: dict[str, str] = {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch]).select(FILE_SCHEMA.names).cast(FILE_SCHEMA)
                for topic in pc.unique(batch.column("topic")).to_pylist():
                    if topic is None:
                        raise ValueError("a record without a topic")
                    if topic not in writers:
                        names[topic] = f"topics/{topic}/{uuid.uuid4().hex}.parquet"
                        system.create_dir(f"{root}/topics/{topic}", recursive=True)
                        writers[topic] = pq.ParquetWriter(
                            f"{root}/{names[topic]}", FILE_SCHEMA, filesystem=system
                        )
                    writers[topic].write_table(table.filter(pc.equal(table.column("topic"), topic)))
        finally:
            for writer in writers.values():
                writer.close()
        return Written(list(names.values()))

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        """Put the list of a batch in place, unless an earlier run of it has done so."""
        system, root = opened(self.path)
        place = f"{root}/commits/batch_id={batchId}"
        files = [name for message in messages if message is not None for name in message.files]
        if system.get_file_info(place).type != pafs.FileType.NotFound:
            self._delete(files)
            return
        system.create_dir(f"{root}/commits", recursive=True)
        draft = f"{root}/drafts-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(files).encode())
        system.move(draft, place)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._delete([name for message in messages if message is not None for name in message.files])

    def _delete(self, files: list[str]) -> None:
        system, root = opened(self.path)
        for name in files:
            system.delete_file(f"{root}/{name}")


class TopicFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD

    def streamWriter(self, schema: StructType, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options["path"])


def committed_files(spark: SparkSession, path: str) -> list[str]:
    """The files of all batches that are there."""
    if not names_in(spark, f"{path}/commits"):
        return []
    lists = spark.read.text(f"{path}/commits").select("value").collect()
    return sorted(name for row in lists for name in json.loads(row["value"]))


def read_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The records of a topic: key and value, as Kafka's reader names them."""
    files = [f"{path}/{name}" for name in committed_files(spark, path) if name.startswith(f"topics/{topic}/")]
    records = spark.read.schema(RECORD).parquet(*files) if files else spark.createDataFrame([], RECORD)
    return records.select("key", "value")
