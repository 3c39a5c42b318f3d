"""Column helpers. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Los_Angeles"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text ------------------------------------------------------------------------------------------------------------

def nth(array: Column | str, i: int) -> Column:
    """Array element by ordinal; null when the array is shorter (plain ``[]`` would raise)."""
    return F.get(_col(array), F.lit(i))


def segment(text: Column | str, separator: str, i: int) -> Column:
    """The i-th piece of a separated text; null when there are fewer pieces."""
    return nth(F.split(_col(text), re.escape(separator)), i)


def path_prefix(text: Column | str, first: int, last: int, separator: str = "/") -> Column:
    """Pieces ``first..last`` joined again; null as soon as one piece is missing."""
    pieces = []
    for i in range(first, last + 1):
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(segment(text, separator, i))
    return F.concat(*pieces)


def strip_zeros(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "^0+", "")


def join_present(separator: str, *columns: Column | str) -> Column:
    """Row-wise join of columns, skipping nulls and empty texts."""
    return F.concat_ws(separator, *[F.nullif(_col(c), F.lit("")) for c in columns])


def collapse_separator(text: Column | str, separator: str = ":") -> Column:
    """One separator where several stood together, none at the ends."""
    mark = re.escape(separator)
    inner = F.regexp_replace(_col(text), f"(?:{mark})+", separator)
    return F.regexp_replace(inner, f"^{mark}|{mark}$", "")


def correct_dates(time: Column | str, corrections: Mapping[str, str]) -> Column:
    """Replace wrongly recorded dates inside a timestamp text; the caller names each correction."""
    out = _col(time).cast("string")
    for wrong, right in corrections.items():
        out = F.regexp_replace(out, re.escape(wrong), right)
    return out


def json_value(document: Column | str, path: str) -> Column:
    return F.get_json_object(_col(document), path)


def to_long(text: Column | str) -> Column:
    return _col(text).try_cast("bigint")


# -- time ------------------------------------------------------------------------------------------------------------

def hour_of(time: Column | str) -> Column:
    return F.date_trunc("hour", _col(time))


def local_time(time: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant to the zone-less local time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(time).cast("timestamp_ntz"))


def day_text(time: Column | str) -> Column:
    return F.date_format(_col(time), "yyyy-MM-dd")


def hour_text(time: Column | str) -> Column:
    return F.date_format(_col(time), "HH")


def month_text(time: Column | str) -> Column:
    return F.date_format(_col(time), "yyyy-MM")


def parse_time(text: Column | str, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(text))


def between_half_open(time: Column | str, start: Column, end: Column) -> Column:
    """``start <= time < end``, a shape that parquet statistics and partition pruning can use."""
    return (_col(time) >= start) & (_col(time) < end)


def shift(time: Column | str, days: int = 0, seconds: int = 0) -> Column:
    """The instant that many days and seconds later."""
    return _col(time) + F.make_dt_interval(days=F.lit(days), secs=F.lit(float(seconds)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    return micros / F.lit(3.6e9)


def seconds_to_hours(seconds: Column | str) -> Column:
    return _col(seconds) / F.lit(3600.0)


def weekday_flag(day: Column | str) -> Column:
    """1 from Monday to Friday, 0 on the weekend."""
    return F.when(F.weekday(_col(day)) < 5, F.lit(1)).otherwise(F.lit(0))


def week_label(day: Column | str, iso_year: bool = False) -> Column:
    """``W<ISO week>-<year>``. The year is the calendar year (30 Dec 2024 gives W1-2024) unless ``iso_year``."""
    day = _col(day)
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    return F.concat(F.lit("W"), F.weekofyear(day).cast("string"), F.lit("-"), year.cast("string"))


# -- arithmetic ------------------------------------------------------------------------------------------------------

def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields null on a zero denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def per_thousand(total: Column | str, count: Column | str) -> Column:
    return ratio(_col(total), _col(count) / F.lit(1000.0))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def net_of(total: Column | str, base: Column | str, flat: float, groups: Column, rate: float) -> Column:
    """``total`` less an equal part of a flat credit and less a percentage of ``base``."""
    return _col(total) - ratio(F.lit(float(flat)), groups) - _col(base) * F.lit(float(rate))
