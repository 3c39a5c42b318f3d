"""Landed service payloads: nested JSON to columns, parallel arrays to rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every leaf of nested structs as a column named by its path (``hierarchy.premiseId``). Arrays stay as they are."""

    def leaves(struct: T.StructType, path: tuple[str, ...]):
        for f in struct.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))


def arrays_to_rows(df: DataFrame, arrays: Mapping[str, str], *keep: str, position: str | None = None) -> DataFrame:
    """Parallel arrays to one row per element; ``arrays`` maps the output column to the array.

    Works inside each row, so nothing is shuffled. A shorter array yields nulls at its end.
    """
    zipped = F.arrays_zip(*[F.col(a).alias(out) for out, a in arrays.items()])
    if position:
        rows = df.select(*keep, F.posexplode(zipped).alias(position, "_e"))
    else:
        rows = df.select(*keep, F.explode(zipped).alias("_e"))
    return rows.select(*keep, *([position] if position else []), *[F.col("_e")[out].alias(out) for out in arrays])


# -- payloads of changing shape ----------------------------------------------------------------------------------------


def read_variants(spark: SparkSession, path: str, out: str = "payload") -> DataFrame:
    """One JSON document per line as a VARIANT, whatever its fields, beside its ``line``; null where the line is no JSON."""
    lines = spark.read.text(path).select(F.col("value").alias("line")).where(F.trim("line") != "")
    return lines.select("line", F.try_parse_json("line").alias(out))


def variant_path(*names: str) -> str:
    """``$['a']['b']``: any name may stand in it that does not hold both kinds of quotes."""
    if any("'" in n and '"' in n for n in names):
        raise ValueError(f"no path can name {names!r}")
    return "$" + "".join(f'["{n}"]' if "'" in n else f"['{n}']" for n in names)


def shred(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """VARIANT fields as columns of their own; ``fields`` maps the output name to (path, type).

    Each row is read by itself: a field that a row lacks, or that does not fit the type, is null there and nowhere else.
    """
    return df.withColumns({out: F.try_variant_get(column, path, kind) for out, (path, kind) in fields.items()})


def variant_schema(df: DataFrame, column: str) -> T.DataType:
    """The type that holds all values of a VARIANT column; a field whose values have several types stays a VARIANT.

    An aggregate over all rows, of which one value reaches the driver. Null fields, and no rows, are text.
    """
    found = df.agg(F.schema_of_variant_agg(F.col(column)).alias("s")).first()["s"] or "VOID"
    # The words stand for types outside back-quoted names only.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    named = [p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bVOID\b", "STRING", p)) for p in parts]
    return T.StructType.fromDDL(f"v {''.join(named)}").fields[0].dataType


def shred_all(df: DataFrame, column: str, separator: str = ".") -> DataFrame:
    """Every field of a VARIANT column as a column named by its path, in place of it; types as ``variant_schema`` finds them."""
    def leaves(kind: T.DataType, names: tuple[str, ...]):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from leaves(f.dataType, (*names, f.name))
        elif names:
            yield separator.join(names), (variant_path(*names), kind.simpleString())

    return shred(df, column, dict(leaves(variant_schema(df, column), ()))).drop(column)


CREDITS = "array<struct<name:string,amount:double,full_name:string,id:string,type:string>>"


def credits_of_text(text: Column | str) -> Column:
    """Credits that arrive as printed text, ``[{'name': 'x', 'amount': -1.5, ...}\\n {...}]``, as the array they were printed from.

    Between the credits there may be commas, white space or both. Empty or unreadable text is an empty array, null stays null.
    """
    text = F.col(text) if isinstance(text, str) else text

    def once(value: Column, body: Callable[[Column], Column]) -> Column:
        # As an element of an array the value is worked out once, wherever the body uses it.
        return F.transform(F.array(value), body)[0]

    def listed(text: Column) -> Column:
        found = F.regexp_replace(text, r"\}[\s,]*\{", "},{")
        # Outside quotes only: a word right after the colon, which no quote begins.
        return F.regexp_replace(F.regexp_replace(found, r":\s*(?:None|nan)\s*(?=[,}])", ": null"), r"^\s*(?=\{)", "[")

    def parsed(found: Column) -> Column:
        closed = F.when(found.rlike(r"\]\s*$"), found).otherwise(F.concat(found, F.lit("]")))
        credits = F.from_json(closed, CREDITS, {"allowSingleQuotes": "true"})
        return F.coalesce(F.filter(credits, lambda c: c.isNotNull()), F.array().cast(CREDITS))

    return once(text, lambda t: F.when(t.isNotNull(), once(listed(t), parsed)))
