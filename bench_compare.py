"""Time the chosen plans against the obvious alternatives, at BENCH_SF_DIR. Prints one line per comparison."""

from __future__ import annotations

import os
import time
from itertools import islice, product

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import pivot_first, share_of_total
from tallyloom.operators.intervals import assign_interval, build_intervals
from tallyloom.operators.rules import classify, rules_as_case, rules_schema
from tallyloom.session import build_session

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
KEYS = ["l_returnflag", "l_linestatus", "p_type", "p_brand", "adjective", "noun"]
TARGETS = ["t1", "t2", "t3", "t4"]


def timed(df) -> float:
    best = None
    for _ in range(3):
        begin = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best or 1e9, time.perf_counter() - begin)
    return best


def main() -> None:
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    line, part = spark.read.parquet(f"{SF}/lineitem.parquet"), spark.read.parquet(f"{SF}/part.parquet")
    words = F.split("p_name", " ")
    wide = line.join(F.broadcast(part), line.l_partkey == part.p_partkey).withColumns(
        {"adjective": words[0], "noun": words[1]}
    ).select("l_orderkey", "l_shipdate", "l_suppkey", "l_quantity", *KEYS).repartition(8).persist()
    wide.count()

    domains = [[r[0] for r in wide.select(k).distinct().orderBy(k).collect()] for k in KEYS]
    for size in (70, 333):
        combos = list(islice(product(*domains), 0, None, max(1, len(list(product(*domains))) // size)))[:size]
        rules = [
            {"target": t, "priority": n, **dict(zip(KEYS, c)), "value": f"{t}-{n % 25}"} for t in TARGETS for n, c in enumerate(combos)
        ]
        table = spark.createDataFrame([tuple(r.values()) for r in rules], rules_schema(KEYS))
        begin = time.perf_counter()
        joined = classify(wide, table, KEYS, TARGETS)
        prepared = time.perf_counter() - begin
        chain = wide.withColumns({t: rules_as_case(rules, KEYS, t) for t in TARGETS})
        print(f"rules {size} x 4: join {timed(joined):.2f} s (+ {prepared:.2f} s to prepare), CASE {timed(chain):.2f} s", flush=True)

    for count in (30, 1000):
        days = spark.range(count).select(
            F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") * 2500 / count).cast("int")).cast("timestamp_ntz").alias("at"),
            F.concat(F.lit("v"), "id").alias("name"),
        )
        cal = build_intervals(days, "at", "name").persist()
        cal.count()
        placed = assign_interval(wide, cal, "l_shipdate", "release")
        loop = wide.join(F.broadcast(cal), (F.col("l_shipdate") >= F.col("start")) & (F.col("l_shipdate") < F.col("end")), "left")
        print(f"intervals {count}: by day {timed(placed):.2f} s, nested loop {timed(loop):.2f} s", flush=True)

    shared = share_of_total(wide, ["l_returnflag"], "l_quantity", "total", "share")
    window = wide.withColumn("total", F.sum("l_quantity").over(Window.partitionBy("l_returnflag")))
    print(f"share of 3 totals: aggregate and join {timed(shared):.2f} s, window {timed(window):.2f} s", flush=True)

    pairs = wide.select(F.monotonically_increasing_id().alias("i"), F.explode(F.array(
        F.struct(F.lit("a").alias("k"), F.col("p_type").alias("v")), F.struct(F.lit("b").alias("k"), F.col("noun").alias("v"))
    )).alias("p")).select("i", "p.k", "p.v").persist()
    pairs.count()
    given = pivot_first(pairs, "i", "k", "v", ["a", "b"])
    begin = time.perf_counter()
    found = pairs.distinct().groupBy("i").pivot("k").agg(F.first("v"))
    found.write.format("noop").mode("overwrite").save()
    print(f"pivot: keys given {timed(given):.2f} s, distinct and keys discovered {time.perf_counter() - begin:.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
