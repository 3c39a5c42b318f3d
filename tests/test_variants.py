import pytest
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources import credits_of_text, read_variants, shred, shred_all, variant_path, variant_schema
from tallyloom.workload import QUERIES


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([
        '{"code": "a", "hierarchy": {"premiseId": "p1"}, "size": 3}',
        '{"code": "b", "hierarchy": "p2", "size": "4", "tags": ["x", "y"]}',
        '{"code": "c", "size": "many", "it\'s": 1.5}', "", "no json", '{"code": 7, "size": null}']))
    return read_variants(spark, str(tmp_path / "a.json"))


def test_each_row_is_read_by_itself(landed):
    got = shred(landed, "payload", {
        "code": ("$.code", "string"), "premise": ("$.hierarchy.premiseId", "string"), "size": ("$.size", "int"), "tag": ("$.tags[1]", "string"),
        "odd": (variant_path("it's"), "double")})
    assert rows(got, "code", "premise", "size", "tag", "odd") == [
        ("7", None, None, None, None), ("a", "p1", 3, None, None), ("b", None, 4, "y", None), ("c", None, None, None, 1.5), (None, None, None, None, None)]
    assert rows(got.where("payload is null"), "line") == [("no json",)]


def test_columns_of_all_payloads(landed):
    kind = variant_schema(landed, "payload")
    types = {f.name: f.dataType for f in kind.fields}
    assert set(types) == {"code", "hierarchy", "size", "tags", "it's"}
    assert isinstance(types["hierarchy"], T.VariantType) and isinstance(types["size"], T.VariantType) and types["tags"] == T.ArrayType(T.StringType())
    got = shred_all(landed, "payload")
    assert set(got.columns) == {"line", "code", "hierarchy", "size", "tags", "it's"}
    assert rows(got.where("tags is not null"), "tags") == [(["x", "y"],)]
    assert rows(got.select(F.col("`it's`").cast("double").alias("n")).where("n is not null")) == [(1.5,)]


def test_nested_fields_are_named_by_their_path(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"a": {"b c": 1, "d": {"e": "x"}}}\n{"a": {"b c": 2}}\n')
    got = shred_all(read_variants(spark, str(tmp_path / "b.json")), "payload").drop("line")
    assert sorted(got.columns) == ["a.b c", "a.d.e"] and rows(got, "`a.b c`", "`a.d.e`") == [(1, "x"), (2, None)]


def test_no_payloads(spark, tmp_path):
    (tmp_path / "c.json").write_text("")
    assert shred_all(read_variants(spark, str(tmp_path / "c.json")), "payload").columns == ["line"]


def test_credits_that_arrive_as_text(spark):
    one = "{'name': 'x', 'amount': -1.5, 'full_name': 'f', 'id': '', 'type': 'PROMOTION'}"
    two = "{'name': \"it's, {odd}: None\", 'amount': None, 'full_name': 'a}b', 'id': 'i', 'type': 'D'}"
    texts = [f"[{one}]", f"[{one}\n {two}]", f"[{one}, {two}]", one, "[]", "", "garbage", None, "[{'name': 'x', 'amount': 2, 'type': 'T'}]"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: None if r["c"] is None else [tuple(c) for c in r["c"]] for r in frame.select("i", credits_of_text("t").alias("c")).collect()}
    first, second = ("x", -1.5, "f", "", "PROMOTION"), ("it's, {odd}: None", None, "a}b", "i", "D")
    assert got == {0: [first], 1: [first, second], 2: [first, second], 3: [first], 4: [], 5: [], 6: [], 7: None, 8: [("x", 2.0, None, None, "T")]}


def test_printed_credits_are_parsed_once_a_line_and_spread_over_tasks(spark):
    plan = QUERIES["split_credits_text"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(part) for part in ("from_json(", "RLIKE(", "Relation [", "RebalancePartitions")] == [1, 1, 1, 1], plan
