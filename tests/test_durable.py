"""Written tables: what goes with a scope, and what a write leaves behind."""

import os
import time

import pytest
from pyspark.sql import functions as F

from casebook.sources.durable import scratch, settle


def _place(df):
    return df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]


def _shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in kept.split("\n") if "shuffle_" in f}


def test_scratch_removes_what_does_not_last(spark):
    stays = settle(spark.range(3), "x")
    with scratch(spark):
        with scratch(spark):
            gone, passed = settle(spark.range(3), "x"), settle(spark.range(4), "x", lasting=True)
            places = _place(gone), _place(passed)
        assert [os.path.exists(p) for p in places] == [False, True]
        assert passed.count() == 4
    assert not os.path.exists(places[1])
    assert stays.count() == 3


def test_scratch_removes_after_a_failure(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            place = _place(settle(spark.range(3), "x"))
            raise ValueError
    assert not os.path.exists(place)


def test_a_settled_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    grouped = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    settled = settle(grouped.repartition(5, "k"), "x")
    for _ in range(50):  # they are removed behind the write
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert settled.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
