"""Session settings and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Shuffle files of a write go when it is done; else they stay until the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Set what the results depend on; sizes and cluster settings stay as they are."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A JSON object with a repeated key stays readable; its last value counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # The serving table and the batch logs replace whole partitions, never the table.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    # Skewed partitions are split even where that costs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared one, which every executor can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventtally-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/eventtally/{name}-{uuid.uuid4().hex}"


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because nothing has been written to its path yet."""
    return error.getCondition() == "PATH_NOT_FOUND"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder, on whatever file system it is; none if it is not there."""
    files, place = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the entries `name=<number>` below a folder, ascending."""
    found = (entry.partition("=") for entry in names_in(spark, path))
    return sorted(int(number) for key, _, number in found if key == name)


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end."""
    files, place = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def set_mark(spark: SparkSession, path: str) -> None:
    """Make an empty file: there at once or not at all."""
    files, place = _file_system(spark, path)
    files.create(place, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, on whatever file system it is."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The same rows, worked out once and read back from the shared folder."""
    return stored_with_size(rows, name)[0]


def stored_with_size(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The same, with the size of the rows: eight bytes per value plus the bytes of texts.

    The size is taken while the rows are written, which costs no job of its own.
    """
    texts = [
        F.coalesce(F.octet_length(column), F.lit(0))
        for column, kind in rows.dtypes
        if kind == "string"
    ]
    width = sum(texts, F.lit(8 * len(rows.columns))).cast("long")
    size = Observation()
    conf = rows.sparkSession.conf
    path = shared_folder(rows.sparkSession, name)
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        rows.observe(size, F.sum(width).alias("bytes")).write.parquet(path)
    finally:
        conf.set(CLEAN_UP, before)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return back, size.get["bytes"] or 0
