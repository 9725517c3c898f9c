"""A corpus made ready for training, in five stages.

Each stage works on all documents that its predecessor kept and gives the columns of documents, the
last one the pieces and their places in sequences. Stages are written as Parquet to the shared
folder and read again, so a lost executor costs tasks of one stage only.

Defined cases: a null text is kept by all stages but the first, which rejects it, as it does any
text without a letter, the empty one among them. Documents without an id are treated as any other. Texts
are taken whole at any length; a packed document is cut into pieces. Of near duplicates the
smallest id stays, ids that are missing coming first; of rows that are repeated in full one stays, of
rows with one id and one text any one. Ties between languages go by their names. An empty table goes
through all stages and gives no rows. Other columns stay as they are to the last stage but one, whatever
their names; `lang` is learned from and must be there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import prepare, table
from eventtally.llm.decontaminate import without_leaks
from eventtally.llm.jaccard_join import near_duplicates
from eventtally.llm.language_id import UNKNOWN, identified, learn_profiles
from eventtally.llm.packing import pack
from eventtally.llm.pii import without_personal_data
from eventtally.session import configure, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text less like its nearest language than this is in none of those learned. Ordinary texts of
# a few words score 0.4 and more.
LEAST_LIKENESS = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a language that the labelled ones teach."""
    prepare(configure(spark))
    profiles = learn_profiles(docs.select("text", "lang"))
    # Under names of their own, as columns of the input may have the same.
    found = identified(docs.select(F.struct("*").alias("_doc"), "text"), profiles)
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LIKENESS))
    return kept.select("_doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near duplicates."""
    prepare(configure(spark))
    key = F.xxhash64("doc_id", "text")
    found = near_duplicates(docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "text"))
    first = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # All columns in one, so that none can clash with those added here.
    packed = docs.select(F.struct("*").alias("doc"), "text", key.alias("key"))
    kept = lookup_join(packed, first, ["key"], ["text"])
    # A row that is there several times is its own copy.
    once = kept.filter("copies = 1")
    repeated = kept.filter("copies > 1").dropDuplicates(["key"])
    return once.unionByName(repeated).select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    prepare(configure(spark))
    return without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with personal data masked and n_chars counted anew."""
    prepare(configure(spark))
    return without_personal_data(docs).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    prepare(configure(spark))
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("near duplicates", one_of_each_group),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packing),
]

# Edit distance and packing are beyond SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
