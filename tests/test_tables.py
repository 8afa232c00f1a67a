import os

import pytest

from millrace.sources import tables


def test_shared_folder_and_tables(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.table(spark, str(tmp_path), "t").count() == 10
    stored = tables.materialize(spark.range(7), "x")
    assert stored.count() == 7 and all(f.removeprefix("file:").removeprefix("//").startswith(tables.shared_dir(spark).removeprefix("file://")) for f in stored.inputFiles())
    assert tables.shared_dir(spark) == tables.shared_dir(spark)


def test_cluster_setting_is_used(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_OWN", {})
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: f"file://{tmp_path}/shared")
    assert tables.shared_dir(spark).startswith(f"file://{tmp_path}/shared/")
    assert tables.materialize(spark.range(3), "y").count() == 3 and os.listdir(tmp_path / "shared")
    tables.clean(spark)
    assert not os.listdir(tmp_path / "shared")


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    monkeypatch.setattr(tables, "_OWN", {})
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: {})
    with pytest.raises(RuntimeError, match="share"):
        tables.shared_dir(spark)


def test_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    assert tables.spread(spark.read.parquet(str(tmp_path / "one.parquet"))).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 32)
    assert tables.spread(many).rdd.getNumPartitions() == 32
