import pytest
from frames import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.sinks import batch_log, batches, commit_batch, left_behind, read_batches

N = "n bigint"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], N)


def broken(spark):
    return numbers(spark, 1, 2).withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("broken off")).cast("bigint")).otherwise(F.col("n")))


def test_a_batch_counts_once_and_outputs_come_together(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_batches(spark, root, "a", N).count() == 0 and batch_log(spark, root).count() == 0
    assert commit_batch(spark, root, "b1", {"a": numbers(spark, 1, 2), "b": numbers(spark, 10)})
    assert not commit_batch(spark, root, "b1", {"a": numbers(spark, 1, 2), "b": numbers(spark, 10)})
    with pytest.raises((PySparkException, Exception), match="broken off"):
        commit_batch(spark, root, "b2", {"a": numbers(spark, 3), "b": broken(spark)})
    # The first output of the broken batch lies there, and nobody sees it.
    assert rows(read_batches(spark, root, "a", N)) == [(1,), (2,)] and len(left_behind(spark, root, "a")) == 1
    assert commit_batch(spark, root, "b2", {"a": numbers(spark, 3), "b": numbers(spark, 20)})
    assert rows(read_batches(spark, root, "a", N)) == [(1,), (2,), (3,)]
    assert rows(read_batches(spark, root, "b", N)) == [(10,), (20,)]
    assert rows(read_batches(spark, root, "a", N, ["b2"])) == [(3,)]
    assert rows(batch_log(spark, root), "batch", "output") == [("b1", "a"), ("b1", "b"), ("b2", "a"), ("b2", "b")]


def test_of_two_writers_of_a_batch_one_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert commit_batch(spark, root, "b", {"a": numbers(spark, 1)})
    # The second writer looked before the first was done.
    monkeypatch.setattr(batches, "is_committed", lambda *_: False)
    assert not commit_batch(spark, root, "b", {"a": numbers(spark, 1)})
    assert rows(read_batches(spark, root, "a", N)) == [(1,)] and len(left_behind(spark, root, "a")) == 1
    assert not [p.name for p in (tmp_path / "t" / "log").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_files_that_no_entry_lists_are_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    commit_batch(spark, root, "b", {"a": numbers(spark, 1).coalesce(1)})
    folder = next((tmp_path / "t" / "data" / "a").iterdir())
    numbers(spark, 99).write.mode("append").parquet(str(folder))
    assert rows(read_batches(spark, root, "a", N)) == [(1,)]


def test_partitions_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "n bigint, day string")
    commit_batch(spark, root, "x", {"a": days}, {"a": ["day"]})
    commit_batch(spark, root, "y", {"a": days.where("n > 5")}, {"a": ["day"]})
    commit_batch(spark, root, "z", {"a": days.where("n = 2")}, {"a": ["day"]})
    assert rows(read_batches(spark, root, "a", "n bigint, day string")) == [(1, "2024-01-01"), (2, "2024-01-02"), (2, "2024-01-02")]


@pytest.mark.parametrize("name", ["x/y", "", "..", ".hidden", "a b", "_x"])
def test_names_that_are_no_path_segment_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError, match="is no name"):
        commit_batch(spark, str(tmp_path), name, {"a": numbers(spark, 1)})
    with pytest.raises(ValueError, match="is no name"):
        commit_batch(spark, str(tmp_path), "b", {name: numbers(spark, 1)})


def test_no_marker_file_is_needed(spark, tmp_path):
    option = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(option, "false")
    try:
        commit_batch(spark, str(tmp_path / "t"), "b", {"a": numbers(spark, 1)})
    finally:
        conf.unset(option)
    assert rows(read_batches(spark, str(tmp_path / "t"), "a", N)) == [(1,)]
