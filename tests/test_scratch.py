"""What is left on disk of tables that jobs write for themselves."""

import time

from pyspark.sql import functions as F

from eventloom.session import BRIEF_SHUFFLES, brief_shuffles, cut_lineage


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("|").split("|") if "shuffle_" in name}


def new_files(spark, before):
    """Spark deletes them in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def counted(spark):
    return spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()


def test_a_written_table_leaves_no_shuffle_files(spark):
    setting, before = spark.conf.get(BRIEF_SHUFFLES), shuffle_files(spark)
    written = cut_lineage(counted(spark), "counted")
    assert not new_files(spark, before)
    assert spark.conf.get(BRIEF_SHUFFLES) == setting  # other frames keep theirs
    # The frame itself and the table can be read any number of times.
    frame = counted(spark)
    assert sorted(frame.collect()) == sorted(written.collect()) == sorted(cut_lineage(frame).collect()) == sorted(frame.collect())


def test_the_setting_returns_after_a_failure(spark):
    setting = spark.conf.get(BRIEF_SHUFFLES)
    try:
        with brief_shuffles(spark):
            assert spark.conf.get(BRIEF_SHUFFLES) == "true"
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(BRIEF_SHUFFLES) == setting
