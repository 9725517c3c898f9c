import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventtally.sinks import topic_files as tf
from eventtally.sinks.dead_letters import LETTER_SCHEMA, start_dead_letter_topics
from eventtally.sinks.topic_files import FORMAT, RECORD, TopicFiles, TopicWriter, committed_files, opened, read_topic

NAMES = ["topic", "key", "value"]


def batch(*records):
    return pa.RecordBatch.from_pydict({n: [r[k] for r in records] for k, n in enumerate(NAMES)})


def files(folder):
    return sorted(n for _, _, names in os.walk(folder + "/topics") for n in names)


def test_only_committed_files_are_read(spark, folder):
    writer = TopicWriter(folder)
    killed = writer.write(iter([batch(("a", "1", "lost"))]))
    assert read_topic(spark, folder, "a").count() == 0
    first = writer.write(iter([batch(("a", "1", "x"), ("b", None, "y")), batch(("a", "2", None))]))
    empty = writer.write(iter([]))
    writer.commit([first, empty, None], 0)
    # The batch runs again: its files go, the first ones stay.
    writer.commit([writer.write(iter([batch(("a", "1", "x"))]))], 0)
    writer.commit([writer.write(iter([batch(("a", "3", "z"))]))], 1)
    assert rows(read_topic(spark, folder, "a")) == [("1", "x"), ("2", None), ("3", "z")]
    assert rows(read_topic(spark, folder, "b")) == [(None, "y")]
    assert read_topic(spark, folder, "c").count() == 0
    assert len(files(folder)) == 4 and len(committed_files(spark, folder)) == 3
    writer.abort([killed, None], 2)
    assert len(files(folder)) == 3


def test_a_record_needs_a_topic(folder):
    with pytest.raises(ValueError, match="without a topic"):
        TopicWriter(folder).write(iter([batch((None, "1", "x"))]))


def test_schemes_of_hadoop(folder):
    assert opened("file:" + folder)[1] == opened(folder)[1] == folder
    try:
        system, root = opened("s3a://bucket/some/folder")
    except OSError:
        pytest.skip("this pyarrow has no S3")
    assert system.type_name == "s3" and root == "bucket/some/folder"


def test_a_stream_that_is_killed_and_goes_on_writes_each_record_once(spark, folder):
    spark.dataSource.register(TopicFiles)
    records = [(f"t{k % 2}", str(k), "v" * k) for k in range(40)]
    for number in range(2):
        part = spark.createDataFrame(records[number * 20 : number * 20 + 20], RECORD)
        part.repartition(3).write.parquet(f"{folder}/in/part={number}")
    flag = folder + "/killed"

    def dies_once(batches):
        """The first task to come half way is lost, with what it has written."""
        for one in batches:
            yield one.slice(0, 1)
            if not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("killed")
            yield one.slice(1)

    def run():
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 3).parquet(folder + "/in")
        query = (
            stream.select(*NAMES).mapInArrow(dies_once, RECORD)
            .writeStream.format(FORMAT).option("path", folder + "/out").option("checkpointLocation", folder + "/cp")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    # As if the driver had gone between the commit of the batch and its entry in the checkpoint.
    last = max((n for n in os.listdir(folder + "/cp/commits") if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{folder}/cp/commits/{name}")
    run()
    got = rows(read_topic(spark, folder + "/out", "t0")) + rows(read_topic(spark, folder + "/out", "t1"))
    assert sorted(got) == sorted(r[1:] for r in records)


def test_letters_are_streamed_to_their_topics(spark, folder):
    letters = [("{bad", "transaction", "malformed", None), ("x", None, "unknown_type", None)]
    for number in range(2):
        spark.createDataFrame(letters, LETTER_SCHEMA).write.parquet(f"{folder}/letters/batch_id={number}")
        start_dead_letter_topics(spark, folder + "/letters", folder + "/out", folder + "/cp", True).awaitTermination()
    assert rows(read_topic(spark, folder + "/out", "events.transactions.dlq")) == [("malformed", "{bad")] * 2
    assert rows(read_topic(spark, folder + "/out", "events.activities.dlq")) == [("unknown_type", "x")] * 2
