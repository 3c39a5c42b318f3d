import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import allocate
from tallyloom.sinks import conserved, differences, must_balance, overwrite, write_conserved


@pytest.fixture
def inputs(spark):
    usage = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "a", 2)], "datetime_h int, who string, event_count long").withColumn("datetime_h", F.timestamp_seconds(F.col("datetime_h") * 3600))
    pool = spark.createDataFrame([(1, 10.0, 9.0), (1, 0.3, 0.1), (2, 5.0, 4.0), (3, 7.0, 0.0)], "datetime_h int, cost double, cost_after_discount double").withColumn("datetime_h", F.timestamp_seconds(F.col("datetime_h") * 3600))
    return usage, pool


def run(tmp_path, pool, job, **options):
    path = str(tmp_path / "out")
    amounts = {"cost": "allocated_cost", "cost_after_discount": "allocated_cost_after_discount"}
    return write_conserved(pool, job, amounts, ["datetime_h"], lambda df: overwrite(df, path), lambda: pool.sparkSession.read.parquet(path), **options)


def test_a_lost_hour_is_reported(tmp_path, inputs):
    usage, pool = inputs
    result = run(tmp_path, pool, lambda p: allocate.allocate_by_hourly_rate(usage, p))
    assert not result.balanced and result.sums["cost"] == (pytest.approx(22.3), pytest.approx(15.3))
    assert rows(result.differences, F.hour("datetime_h"), "amount", "pool", "allocated", "difference") == [(3, "cost", 7.0, 0.0, 7.0)]
    with pytest.raises(RuntimeError, match="not handed out: datetime_h=1970-01-01 03:00:00, amount=cost, pool=7.0"):
        must_balance(result)


def test_a_pool_handed_out_whole_reads_nothing_back(spark, tmp_path, inputs):
    usage, pool = inputs
    whole = pool.where(F.hour("datetime_h") < 3)
    amounts = {"cost": "allocated_cost"}
    result = write_conserved(whole, lambda p: allocate.allocate_by_hourly_rate(usage, p), amounts, ["datetime_h"], lambda df: overwrite(df, str(tmp_path / "o")), lambda: 1 / 0)
    assert result.balanced and must_balance(result) is result and spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_sums_that_only_seem_to_differ_are_checked_by_group(tmp_path, inputs, monkeypatch):
    usage, pool = inputs
    whole = pool.where(F.hour("datetime_h") < 3)

    class Twice(conserved.Observation):  # as if a task had been counted again
        @property
        def get(self):
            return {k: v * (2 if k.startswith("allocated") else 1) for k, v in super().get.items()}

    monkeypatch.setattr(conserved, "Observation", Twice)
    assert run(tmp_path, whole, lambda p: allocate.allocate_by_hourly_rate(usage, p)).balanced


def test_an_hour_handed_out_twice_and_one_that_balances_another(tmp_path, inputs):
    usage, pool = inputs
    twice = run(tmp_path, pool.where(F.hour("datetime_h") < 3), lambda p: allocate.allocate_by_hourly_rate(usage.unionByName(usage.where("who = 'b'")), p))
    assert twice.balanced  # the rate falls as the events grow
    job = lambda p: allocate.allocate_by_hourly_rate(usage, p).withColumn("allocated_cost", F.col("allocated_cost") * F.when(F.hour("datetime_h") == 2, 2).otherwise(1))
    assert rows(run(tmp_path, pool.where(F.hour("datetime_h") < 3), job).differences, F.hour("datetime_h"), "difference") == [(2, -5.0)]


def test_groups_without_a_key_and_values_that_are_no_numbers(spark):
    pool = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", None), ("n", float("nan"))], "k string, cost double")
    out = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("c", 4.0), ("n", 1.0)], "k string, got double")
    found = differences(pool, out, ["k"], {"cost": "got"})
    assert rows(found.where("not isnan(difference)"), "k", "pool", "allocated") == [("c", 0.0, 4.0)] and found.where("k = 'n'").count() == 1
