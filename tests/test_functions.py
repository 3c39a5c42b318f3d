import datetime as dt

from pyspark.sql import functions as F

from tallyloom import functions as f


def one(spark, column, schema="s string", *data):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], schema).select(column).collect()]


def test_pieces_of_a_text_are_null_when_missing(spark):
    assert one(spark, f.segment("s", "/", 2), "s string", "/a/b", "/a", "", None) == ["b", None, None, None]
    assert one(spark, f.segment("s", ".", 1), "s string", "a.b", "ab") == ["b", None]
    assert one(spark, f.path_prefix("s", 1, 2), "s string", "/a/b/c", "/a") == ["a/b", None]
    assert one(spark, f.nth("s", 1), "s array<int>", [1, 2], [1], [], None) == [2, None, None, None]


def test_zeros_and_separators(spark):
    assert one(spark, f.strip_zeros("s"), "s string", "0070", "0", "700", "", None) == ["70", "", "700", "", None]
    assert one(spark, f.collapse_separator("s"), "s string", "::a:::b:", "a", ":", "a:b") == ["a:b", "a", "", "a:b"]
    assert one(spark, f.join_present(":", "s", F.lit(""), F.lit(None), F.lit("z")), "s string", "a", None) == ["a:z", "z"]


def test_casts_give_null(spark):
    assert one(spark, f.to_long("s"), "s string", "12", "x", "", None) == [12, None, None, None]
    assert one(spark, f.parse_time("s"), "s string", "2024-01-02T03:00", "no") == [dt.datetime(2024, 1, 2, 3), None]
    assert one(spark, f.json_value("s", "$.a.b"), "s string", '{"a":{"b":"x"}}', "{}", "no") == ["x", None, None]


def test_ratios(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(f.ratio("a", "b")).collect()] == [2.0, None, None]
    assert [r[0] for r in df.select(f.share_pct("a", "b")).collect()] == [200.0, None, None]
    assert [r[0] for r in df.select(f.per_thousand("a", "b")).collect()] == [2000.0, None, None]
    assert [r[0] for r in df.select(f.net_of("a", "b", 10.0, F.lit(5), 0.5)).collect()] == [2.5, -1.0, None]


def test_local_time_over_the_clock_changes(spark):
    utc = [dt.datetime(2024, 3, 10, 9, 59), dt.datetime(2024, 3, 10, 10), dt.datetime(2024, 11, 3, 8, 30), dt.datetime(2024, 11, 3, 9, 30)]
    want = [dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 3), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 11, 3, 1, 30)]
    assert one(spark, f.local_time("s"), "s timestamp", *utc) == want
    assert one(spark, f.local_time("s"), "s timestamp_ntz", *utc) == want


def test_parts_of_a_time(spark):
    t = dt.datetime(2024, 12, 30, 23, 5, 6)
    parts = [f.day_text("s"), f.hour_text("s"), f.month_text("s"), f.week_label("s"), f.weekday_flag("s")]
    assert [one(spark, p, "s timestamp", t)[0] for p in parts] == ["2024-12-30", "23", "2024-12", "W1-2024", 1]
    assert one(spark, f.hour_of("s"), "s timestamp", t) == [dt.datetime(2024, 12, 30, 23)]
    assert one(spark, f.weekday_flag("s"), "s timestamp", dt.datetime(2024, 12, 29), dt.datetime(2024, 12, 28)) == [0, 0]
    assert one(spark, f.shift("s", 1, 3), "s timestamp", t) == [dt.datetime(2024, 12, 31, 23, 5, 9)]
    assert one(spark, f.hours_between("s", F.lit("2024-12-31 00:05:06").cast("timestamp")), "s timestamp", t, None) == [1.0, None]
    assert one(spark, f.correct_dates("s", {"2024-12-30": "2024-12-31"}), "s timestamp", t) == ["2024-12-31 23:05:06"]


def test_half_open_range(spark):
    inside = f.between_half_open("s", F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date"))
    days = [dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 23, 59, 59, 999999), dt.datetime(2024, 1, 3)]
    assert one(spark, inside, "s timestamp", *days) == [False, True, True, False]
