"""A store with commits: a task that fails leaves nothing that counts, a run counts once."""

import os

import pytest
from pyspark.sql import functions as F

from newslake.sources import datasource as D

SCHEMA = "id string, n bigint"


def rows(spark, n=100):
    return spark.range(0, n, 1, 4).select(F.concat(F.lit("é"), "id").alias("id"), F.col("id").alias("n"))


def test_runs_count_once_and_add_up(spark, tmp_path):
    path = str(tmp_path / "store")
    assert D.read_store(spark, path, SCHEMA).count() == 0
    for run in ("a", "b", "a"):
        D.publish_to_store(rows(spark), path, run)
    got = D.read_store(spark, path, SCHEMA)
    assert got.count() == 200 and got.filter("id = 'é7' AND n = 7").count() == 2
    # Two writers of one run: the later one takes its rows back.
    spark.dataSource.register(D.PublishSource)
    rows(spark).write.format("newslake").option("path", path).option("run", "b").mode("append").save()
    assert D.read_store(spark, path, SCHEMA).count() == 200 and len(os.listdir(f"{path}/parts")) == 8
    with pytest.raises(Exception, match="overwritten"):
        rows(spark).write.format("newslake").option("path", path).option("run", "c").mode("overwrite").save()


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    broken = rows(spark).withColumn("n", F.when(F.col("n") == 99, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        D.publish_to_store(broken, path, "a")
    assert D.read_store(spark, path, SCHEMA).count() == 0 and not D.FolderStore(path).committed("a")
    D.publish_to_store(rows(spark), path, "a")
    assert D.read_store(spark, path, SCHEMA).count() == 100
