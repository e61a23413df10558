from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sonomere import storage
from sonomere.operators.frames import number_frames


def session(master, conf=None, context=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf),
        sparkContext=SimpleNamespace(
            master=master, getConf=lambda: SimpleNamespace(get=lambda key: context)
        ),
    )


def test_the_folder_the_cluster_names_is_used():
    assert storage.shared_folder(session("yarn", conf="hdfs:///shared/")) == "hdfs:///shared"
    assert storage.shared_folder(session("yarn", context="/shared")) == "/shared"


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session("yarn"))
    assert storage.shared_folder(session("local[2]")) == storage.shared_folder(session("local[2]"))


def test_written_tables_are_read_back(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = storage.written(spark.range(5), "numbers")
    assert df.count() == 5
    assert all(folder in path for path in df.inputFiles())
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")


def test_a_block_leaves_no_folder_behind(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    kept = storage.written(spark.range(3), "kept")
    before = sorted(folder.iterdir())
    with storage.temporary_tables(spark):
        numbered = number_frames(spark.range(100).withColumn("c", F.lit(1)), ["c"], ["id"])
        assert numbered.agg(F.max("frame")).first()[0] == 99
        assert sorted(folder.iterdir()) != before
    assert sorted(folder.iterdir()) == before and kept.count() == 3
