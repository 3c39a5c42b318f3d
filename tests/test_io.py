import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.session import scratch_path, settle, shared_dir, size_for
from tallyloom.sinks import append, append_day, conform, overwrite, write_all, write_selected
from tallyloom.sources import (
    Table, arrays_to_rows, by_environment, day_slice, flatten_structs, load_audit, observed, padded_days, process_day,
    read_csv, read_json, scan,
)

EVENTS = "/root/testdata/sf0.001/events.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_day_reaches_the_scan_with_its_columns(spark):
    df = scan(spark, Table("events", EVENTS), day_slice("ts", "2024-01-15"), ["event_id", "ts"])
    text = plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    whole = spark.read.parquet(EVENTS)
    assert df.count() == whole.where(F.to_date("ts") == "2024-01-15").count() > 0


def test_days_of_a_partitioned_table_are_pruned(spark, tmp_path):
    spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id").write.partitionBy("d").parquet(str(tmp_path / "t"))
    df = scan(spark, Table("t", str(tmp_path / "t")), day_slice("d", "2024-01-05", "2024-01-06"))
    assert df.count() == 2 and "PartitionFilters: [isnotnull(d" in plan(df)


def test_days_around_a_job_day():
    assert process_day(2, dt.date(2024, 3, 1)) == "2024-02-28"
    assert padded_days("2024-03-01") == ("2024-02-29", "2024-03-02")


def test_environment_decides_the_table(spark):
    tables = {"A": Table("events", EVENTS), "B": Table("orders", EVENTS.replace("events", "orders"))}
    assert by_environment(spark, tables, "A").select("environment").first()[0] == "A"
    assert "o_orderkey" in by_environment(spark, tables, "B").columns
    with pytest.raises(KeyError, match="known: A, B"):
        by_environment(spark, tables, "C")


def test_catalog_tables(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert scan(spark, Table("five"), "id > 2").count() == 2


def test_sales_files_with_both_line_endings(spark, tmp_path):
    head = "Thing Type Code,Thing Serial,Thing Name,Owner Group,Alias Config,date,categoryParent,siteCode,siteName,fixture,totalSalesUSD,totalSalesQty"
    (tmp_path / "a.csv").write_bytes(f"{head}\r\nT,S,N,>G,,2024-01-01,C,1,Site,F,335.5,11\r\n".encode())
    (tmp_path / "b.csv").write_bytes(f"{head}\r\n".encode())
    df = read_csv(spark, str(tmp_path), schemas.SALES)
    assert rows(df, "`Thing Type Code`", "`Alias Config`", "totalSalesUSD", "totalSalesQty") == [("T", None, 335.5, 11)]


def test_reference_lists_stay_text(spark, tmp_path):
    (tmp_path / "l.csv").write_text("KeyField_L,FeatureSet,Process,SubProcess\n007,A,,C\n")
    assert rows(read_csv(spark, str(tmp_path), schemas.PROCESS_LIST)) == [("007", "A", None, "C")]


def test_payloads(spark, tmp_path):
    (tmp_path / "z.json").write_text('{"tenant":"t","code":"c","bizLocation":"b","hierarchy":{"premiseId":"p"}}\n')
    flat = flatten_structs(read_json(spark, str(tmp_path / "z.json"), schemas.ZONE))
    assert flat.columns == ["tenant", "code", "bizLocation", "hierarchy.premiseId"] and rows(flat) == [("t", "c", "b", "p")]
    (tmp_path / "w.json").write_text('{"code":"c","hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],"temperature_2m":[1.5]}}\n')
    weather = read_json(spark, str(tmp_path / "w.json"), schemas.WEATHER_PAYLOAD)
    got = arrays_to_rows(weather, {"hour": "hourly.time", "temperature": "hourly.temperature_2m"}, "code", position="n")
    assert rows(got) == [("c", 0, "2024-01-01T00:00", 1.5), ("c", 1, "2024-01-01T01:00", None)]
    assert "Exchange" not in plan(got)


def test_audit_reports_a_missing_source_and_goes_on(spark):
    audit = load_audit(spark, {"events": lambda: spark.read.parquet(EVENTS), "gone": lambda: spark.read.parquet("/nowhere/x")}, "2024-01-01")
    assert rows(audit) == [("2024-01-01", "events", 1000, 6, "ok"), ("2024-01-01", "gone", 0, 0, "PATH_NOT_FOUND")]


def test_rows_are_counted_while_written(spark, tmp_path):
    df, seen = observed(spark.range(7), "seven")
    overwrite(df, str(tmp_path / "o"))
    assert seen.get["rows"] == 7


def test_a_repeated_day_does_not_double(spark, tmp_path):
    path = str(tmp_path / "d")
    day1, day2 = (spark.createDataFrame([(d, 1), (d, 2)], "d string, n int") for d in ("2024-01-01", "2024-01-02"))
    append_day(day1, path, "d")
    append_day(day2, path, "d")
    append_day(day2.where("n = 1"), path, "d")
    assert rows(spark.read.parquet(path), "n") == [(1,), (1,), (2,)]
    append(day2.drop("d"), str(tmp_path / "blind"))
    append(day2.drop("d"), str(tmp_path / "blind"))
    assert spark.read.parquet(str(tmp_path / "blind")).count() == 4
    overwrite(day1, path, ["d"])
    assert spark.read.parquet(path).count() == 2


def test_declared_schema(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    got = conform(df, "b double, a bigint, promotion_credits double")
    assert got.dtypes == [("b", "double"), ("a", "bigint"), ("promotion_credits", "double")] and rows(got) == [(2.0, 1, None)]


def test_a_failing_write_does_not_stop_the_others(spark, tmp_path):
    ok = spark.range(1)
    writes = {
        "bad": lambda: overwrite(ok.select(F.raise_error(F.lit("x"))), str(tmp_path / "bad")),
        "good": lambda: overwrite(ok, str(tmp_path / "good")),
    }
    status = write_all(writes)
    assert status["good"] == "ok" and status["bad"] != "ok"
    assert write_selected(writes, "good") == {"good": "ok"}
    with pytest.raises(KeyError):
        write_selected(writes, "other")


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder and scratch_path(spark, "x").startswith(folder)
    assert settle(spark.range(3)).count() == 3


def test_shuffles_are_sized_by_the_input(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    assert size_for(spark, 10) == 2 * spark.sparkContext.defaultParallelism
    assert size_for(spark, 100 * 1024**4) == 819_200 and spark.conf.get("spark.sql.shuffle.partitions") == "819200"
