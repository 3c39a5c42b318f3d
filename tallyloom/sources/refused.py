"""Delimited files whose rows may not fit their schema: good rows typed, the others set apart with a reason and their text.

A cell that does not fit its type is a null to a plain read, which nobody sees. Here the reader hands on the text of every
line that does not fit, beside the typed rows, so a line is parsed once; only the refused lines, which are few, are looked at again
for the first thing that is wrong with them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE, REASON, FILE = "line", "reason", "file"
_BAD = "_line"


class Split(NamedTuple):
    good: DataFrame
    refused: DataFrame


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, required: tuple[str, ...] = (), header: bool = True, separator: str = ",",
) -> Split:
    """Good rows in the types of ``schema``, and refused ones as ``file, line, reason``.

    Refused is, in this order: a line with too few or too many cells, a cell that is not of its type, and an empty cell in one of the
    ``required`` columns (its line is written out of its cells again). An empty cell is null. Quoted cells may hold separators, but
    no line breaks. A header is told by its cells, in every file; a file whose header differs has that line refused, if a
    column has another type than text.
    """
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    names = [f.name for f in fields]
    unknown = [n for n in required if n not in names]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    column = {n: F.col(f"`{n}`") for n in names}
    options = {"sep": separator, "mode": "PERMISSIVE", "escape": '"', "columnNameOfCorruptRecord": _BAD}
    rows = spark.read.options(**options).schema(T.StructType([*fields, T.StructField(_BAD, T.StringType())])).csv(path)
    # Always true, but it names every column: the reader judges a line by the columns asked for, and each query must see the same split.
    rows = rows.where(F.xxhash64(*column.values()).bitwiseOR(F.lit(1)) != 0)
    rows = rows.select(F.col("_metadata.file_path").alias(FILE), *column.values(), _BAD)
    fits, empty = rows.where(F.col(_BAD).isNull()), reduce(or_, (column[n].isNull() for n in required), F.lit(False))
    if header and all(isinstance(f.dataType, T.StringType) for f in fields):
        fits = fits.where(~reduce(and_, (F.coalesce(column[n] == n, F.lit(False)) for n in names)))
    wanting = fits.where(empty).select(
        FILE, F.to_csv(F.struct(*column.values()), {"sep": separator}).alias(LINE),
        F.coalesce(*[F.when(column[n].isNull(), F.lit(f"{n} is empty")) for n in required]).alias(REASON)) if required else None

    bad = rows.where(F.col(_BAD).isNotNull()).select(FILE, F.col(_BAD).alias(LINE))
    cells = ", ".join(f"c{i} string" for i in range(len(fields)))
    bad = bad.select(FILE, LINE, F.from_csv(LINE, cells, {"sep": separator, "escape": '"'}).alias("cells"), _cell_count(F.col(LINE), separator).alias("n"))
    cell = [F.col(f"cells.c{i}") for i in range(len(fields))]
    if header:
        bad = bad.where((F.col("n") != len(names)) | ~reduce(and_, (F.coalesce(c == n, F.lit(False)) for c, n in zip(cell, names))))
    wrong = [F.when(F.col("n") != len(names), F.concat(F.col("n").cast("string"), F.lit(f" cells instead of {len(names)}")))]
    for f, c in zip(fields, cell):
        if not isinstance(f.dataType, T.StringType):
            wrong.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), c)))
    refused = bad.select(FILE, LINE, F.coalesce(*wrong, F.lit("does not fit the schema")).alias(REASON))
    return Split(
        fits.where(~empty).select(*column.values()),
        refused if wanting is None else refused.unionByName(wanting))


def _cell_count(line: Column, separator: str) -> Column:
    """Cells of a line; a separator between quotes is part of its cell."""
    outside = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(separator), F.lit(""))) + 1
