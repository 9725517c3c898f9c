"""Tables stored in the shared folder."""

import time

from pyspark.sql import functions as F

from eventtally.session import CLEAN_UP, stored


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_of_a_stored_table_go_with_its_write(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    found = stored(rows, "counts")
    for _ in range(50):  # the files go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert found.agg(F.sum("n")).first()[0] == 1000 and found.count() == 7
    assert stored(rows, "again").count() == 7
    assert spark.conf.get(CLEAN_UP, "false") == "false"
