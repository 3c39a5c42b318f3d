from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators.events import hourly_event_counts
from tallyloom.operators.rules import classify, rules_schema
from tallyloom.streaming import (
    classified_stream, count_batch, counts_so_far, hourly_counts_stream, read_landed, write_counts_stream,
)

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_closed_hours_equal_the_batch_count(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    landed = str(tmp_path / "landed")
    days = events.select(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    for n, (a, b) in enumerate([(0, 10), (10, 20), (20, 40)]):
        first = F.date_add(F.lit(days[0]), a)
        events.where((F.to_date("ts") >= first) & (F.to_date("ts") < F.date_add(F.lit(days[0]), b))).coalesce(1).write.mode("append").parquet(landed)
    stream = hourly_counts_stream(read_landed(spark, landed, SCHEMA, files_per_batch=1), "ts", ["event_type"])
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    horizon = got.agg(F.max("datetime_h")).first()[0]
    batch = hourly_event_counts(events, "ts", ["event_type"]).where(F.col("datetime_h") <= F.lit(horizon))
    assert rows(got, "datetime_h", "event_type", "event_count") == rows(batch, "datetime_h", "event_type", "event_count")
    assert got.count() > 100


RULES = [("feature", 1, "click", None, "CLICKED"), ("feature", 2, "view", None, "SEEN"), ("feature", 3, "view", "7", "SEVENTH"), ("kind", 4, "purchase", None, "SALE")]
TARGETS = ["feature", "kind"]


def land(events, path, condition):
    events.where(condition).coalesce(1).write.mode("append").parquet(path)


def batch_counts(events, rules):
    return hourly_event_counts(classify(events, rules, ["event_type"], TARGETS), "ts", TARGETS)


def test_classified_counts_of_files_that_land_twice_and_late(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("ts < timestamp '2024-01-09'")
    rules = spark.createDataFrame(RULES, rules_schema(["event_type"], ["user_id_is"]))
    landed, root, state = (str(tmp_path / n) for n in ("landed", "counts", "state"))
    day, late = F.dayofmonth("ts"), F.col("user_id") == 3
    late_by_one, late_by_three = (day == 3) & late, (day == 4) & late

    def step():
        query = write_counts_stream(
            classified_stream(read_landed(spark, landed, SCHEMA, 1), rules, ["event_type"], TARGETS, ["event_id"], "ts"), "ts", TARGETS, root, state)
        assert query.awaitTermination(300) and query.exception() is None

    for d in (1, 2, 3, 4):
        land(events, landed, (day == d) & ~late_by_one & ~late_by_three)
        land(events, landed, (day == d) & ~late_by_one & ~late_by_three)  # the same file again
        if d == 4:
            land(events, landed, late_by_one)
            step()  # the job ends here and goes on from its checkpoint
    for d in (5, 6, 7, 8):
        land(events, landed, day == d)
        if d == 8:
            land(events, landed, late_by_three)
    land(events, landed, day == 7)
    step()
    got = counts_so_far(spark, root, "feature string, kind string")
    lost = events.where(late_by_three)
    assert lost.count() > 0 and events.where(late_by_one).count() > 0
    want = batch_counts(events.where(~late_by_three), rules)
    columns = ("datetime_h", "feature", "kind", "event_count")
    assert rows(got, *columns) == rows(want, *columns)
    assert {r["feature"] for r in got.collect()} == {"CLICKED", "SEEN", "N/A"}


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(50)
    count = count_batch("ts", ["event_type"], str(tmp_path / "r"))
    for number in (0, 1, 1, 0):
        count(events, number)
    got = counts_so_far(spark, str(tmp_path / "r"), "event_type string")
    assert got.agg(F.sum("event_count")).first()[0] == 100
