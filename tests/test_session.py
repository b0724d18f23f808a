from __future__ import annotations

import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from retalake.session import Scratch, session_conf, shared_folder, together


def fake(named: str | None, master: str):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf={"spark.checkpoint.dir": named}, sparkContext=context)


def test_the_folder_named_by_the_cluster_is_used():
    assert shared_folder(fake("hdfs://shared/c", "yarn")) == "hdfs://shared/c"
    assert Scratch(fake("hdfs://shared/c", "yarn")).root.startswith("hdfs://shared/c/retalake-")


def test_scratch_tables_lie_in_that_folder(spark, tmp_path):
    named = SimpleNamespace(
        conf={"spark.checkpoint.dir": str(tmp_path / "shared")}, sparkContext=spark.sparkContext, read=spark.read
    )
    with Scratch(named) as scratch:
        assert not (tmp_path / "shared").exists()  # nothing is made before it is needed
        assert scratch.save(spark.range(3), "three").count() == 3
        assert [f.name for f in (tmp_path / "shared").iterdir()] == [os.path.basename(scratch.root)]
    assert list((tmp_path / "shared").iterdir()) == []


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake(None, "yarn"))


def test_scratch_tables_go_away_at_the_end(spark):
    with Scratch(spark) as scratch:
        saved = scratch.save(spark.range(5), "five")
        assert saved.count() == 5
        path = scratch.path("five")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_session_conf_puts_values_back(spark):
    key = "spark.sql.shuffle.partitions"
    with pytest.raises(ZeroDivisionError), session_conf(spark, key, "3"):
        assert spark.conf.get(key) == "3"
        1 / 0
    assert spark.conf.get(key) == "8"
    unset = "spark.sql.retalake.none"
    with session_conf(spark, unset, "1"):
        pass
    assert spark.conf.get(unset, None) is None


def test_blocks_that_overlap_share_an_option(spark):
    key = "spark.sql.shuffle.partitions"
    first, second = session_conf(spark, key, "3"), session_conf(spark, key, "3")
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "3"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == "8"


def test_together_keeps_the_order(spark):
    assert together(spark, [lambda i=i: spark.range(i).count() for i in (3, 1, 2)]) == [3, 1, 2]


def test_shuffles_of_a_saved_table_are_gone(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in blocks.getAllFiles().mkString(" ").split() if "shuffle_" in f}

    before = shuffled()
    with Scratch(spark) as scratch:
        saved = scratch.save(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
        for _ in range(50):  # they are removed in the background
            if not (left := shuffled() - before):
                break
            time.sleep(0.1)
        assert not left
        assert saved.count() == 10
