import os

import pytest
from pyspark.sql import functions as F

from wearlens.sources import committed, daily


def ids(spark, path):
    return sorted(r.id for r in committed.read(spark, path).collect())


def test_a_batch_is_added_once(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        committed.read(spark, path)
    assert committed.append(spark.range(3), path, "a/1") and committed.append(spark.range(3, 5), path, "b")
    assert not committed.append(spark.range(3), path, "a/1")
    assert committed.append(spark.range(9, 10), path) and ids(spark, path) == [0, 1, 2, 3, 4, 9]


def test_a_job_killed_before_its_commit_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    committed.replace(spark.range(3), path, "old")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(committed, "publish", killed)
        for write in (committed.replace, committed.append):
            with pytest.raises(KeyboardInterrupt):
                write(spark.range(5), path, "new")
    assert ids(spark, path) == [0, 1, 2] and len(os.listdir(f"{path}/data")) == 3
    assert committed.replace(committed.read(spark, path).filter("id > 0"), path, "new") and ids(spark, path) == [1, 2]
    assert not committed.replace(spark.range(9), path, "new") and ids(spark, path) == [1, 2]
    committed.sweep(spark, path)
    assert ids(spark, path) == [1, 2] and len(os.listdir(f"{path}/data")) == 1


def test_of_two_replacements_at_once_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    committed.append(spark.range(3), path, "a")
    inner = committed.publish

    def slower(*args):
        with monkeypatch.context() as m:
            m.setattr(committed, "publish", inner)
            committed.replace(spark.range(1), path, "first")
        return inner(*args)

    monkeypatch.setattr(committed, "publish", slower)
    with pytest.raises(RuntimeError, match="another job"):
        committed.replace(spark.range(2), path, "second")
    assert ids(spark, path) == [0]


def test_a_lookback_reads_its_days_only(spark, tmp_path):
    path = str(tmp_path / "series")
    df = spark.range(5000).select("id", F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 600).alias("ts")).unionByName(
        spark.createDataFrame([(-1, None)], "id long, ts timestamp"))
    daily.write_daily(df, path)
    got = daily.read_lookback(spark, path, "2026-01-20 00:30:00", 60)
    assert sorted(r.id for r in got.collect()) == list(range(2734, 2740))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:80]
    files = {os.path.dirname(r.f).split("day=")[1] for r in got.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files == {"2026-01-19", "2026-01-20"}
    assert spark.read.parquet(path).count() == 5001
