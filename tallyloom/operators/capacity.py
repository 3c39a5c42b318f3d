"""Time off, the resource x sprint grid and utilisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_last
from tallyloom.functions.columns import week_label, weekday_flag
from tallyloom.operators.aggregate import positions, sum_by
from tallyloom.operators.intervals import assign_interval, listing_fits
from tallyloom.operators.joins import fits_broadcast, full_outer, lookup, skew_join, split_by_match
from tallyloom.operators.shape import fill_by_column, fill_zero, union_by_name
from tallyloom.operators.work import UNKNOWN_TYPE, WORK_TYPES


def expand_days(ranges: DataFrame, start: str = "start", end: str = "end", out: str = "day") -> DataFrame:
    """One row per day of each range, both ends included; ranges that end before they start have no day."""
    proper = ranges.where(F.col(start).cast("date") <= F.col(end).cast("date"))
    return proper.withColumn(out, F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))))


def weekday_time_off(
    time_off: DataFrame, name: str = "name", start: str = "start", end: str = "end", iso_year: bool = False
) -> DataFrame:
    """Working days off per name and week. A week of weekend days only is reported with 0."""
    days = expand_days(time_off, start, end)
    labelled = days.select(
        F.col(name).alias("NAME"), week_label("day", iso_year).alias("YEAR_WEEK"), weekday_flag("day").alias("days")
    )
    return sum_by(labelled, ["NAME", "YEAR_WEEK"], {"days": "days"})


def time_off_per_sprint(
    weekly: DataFrame, weeks: DataFrame, keys: Sequence[str], out: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Days off per sprint through the week list. ``aliases`` renames people the two systems spell differently."""
    per_sprint = sum_by(lookup(weekly, weeks, "YEAR_WEEK", "inner"), [*keys, "RESOURCE_SPRINT_NAME"], {out: "days"})
    if not aliases:
        return per_sprint
    chain = [(F.col("NAME") == old, new) for old, new in aliases.items()]
    return per_sprint.withColumn("NAME", case_last(chain, F.col("NAME")))


def capacity_grid(
    resources: DataFrame,
    sprints: DataFrame,
    holidays: DataFrame,
    time_off: DataFrame,
    name: str = "NAME",
    order: Sequence[str] = ("START_DATE", "SPRINT_NAME"),
) -> DataFrame:
    """Every resource in every sprint with its holidays and time off, 0 where there are none.

    The grid is the result itself. Each resource is given the sprint numbers and meets the sprint on its number, so the
    work is spread like the resources and no task sees more than its own rows.
    """
    few = fits_broadcast(sprints)
    numbered = positions(sprints, list(order), "_n", few).select(
        "_n", F.col("SPRINT_NAME").alias("RESOURCE_SPRINT_NAME"), F.col("STATE").alias("RESOURCE_STATE_SPRINT_NAME")
    )
    last = numbered.agg(F.max("_n")).scalar()
    seats = resources.withColumn("_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    grid = lookup(lookup(seats, numbered, "_n", small=few).drop("_n"), holidays, "RESOURCE_SPRINT_NAME")
    grid = grid.join(time_off, [name, "RESOURCE_SPRINT_NAME"], "left")
    return fill_zero(grid, "HOLIDAYS", "PTO").withColumns({
        "HOLIDAYS": F.col("HOLIDAYS").cast("int"), "PTO": F.col("PTO").cast("int"),
    })


# Work type of an issue type for unplanned work, by key prefix where one is named. The prefixes are defaults of
# parameters: another installation has its own.
OPERATIONAL_TYPES = (
    ("Dev", ("Dev-Sub-task", "Test"), ()),
    ("Bug", ("Bug", "Sub-bug"), ()),
    ("Task", ("Sub-task", "Improvement"), ()),
    ("Infra", ("Sub-CloudOps",), ("RECM",)),
    ("Infra", ("Task", "Sub-task", "Service Request"), ("CM",)),
    ("Infra", ("Vulnerability",), ("RPLAT", "BPLAT")),
    ("Doc", ("Doc", "Sub-doc"), ()),
)
INCIDENT_PREFIXES = ("TICKET", "COE")
INCIDENT_TYPE = "Troubleshooting"


def _starts(key: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | key.startswith(p)
    return out


def utilisation_type(
    root: str = "ISSUE_KEY", logged: str = "ISSUE_KEY_LOGGED", kind: str = "ISSUE_TYPE_NAME_LOGGED",
    incidents: Sequence[str] = INCIDENT_PREFIXES,
) -> Column:
    """Idea when the log belongs to a root, Incident for tickets and troubleshooting, otherwise Operational."""
    return case_last([
        (F.col(root).isNotNull(), "Idea"),
        (F.col(root).isNull(), "Operational"),
        (_starts(F.coalesce(F.col(logged), F.lit("")), incidents), "Incident"),
        (F.col(kind) == INCIDENT_TYPE, "Incident"),
    ], UNKNOWN_TYPE)


def worklog_type(
    use: str = "UTILIZATION_TYPE", logged: str = "ISSUE_KEY_LOGGED", kind: str = "ISSUE_TYPE_NAME_LOGGED",
    operational: Sequence[tuple[str, Sequence[str], Sequence[str]]] = OPERATIONAL_TYPES,
) -> Column:
    """Kind of work of a log; the last rule that holds decides. ``operational``: label, issue types, key prefixes (none: any key)."""
    planned, incident, unplanned = (F.col(use) == u for u in ("Idea", "Incident", "Operational"))
    chain = [(planned & F.col(kind).isin(list(names)), label) for label, names in WORK_TYPES]
    chain.append((incident, "Support"))
    for label, names, prefixes in operational:
        hit = unplanned & F.col(kind).isin(list(names))
        chain.append((hit & _starts(F.col(logged), prefixes) if prefixes else hit, label))
    return case_last(chain, UNKNOWN_TYPE)


def match_worklogs(
    logs: DataFrame, hierarchy: DataFrame, carried: Sequence[str], logged: str = "ISSUE_KEY_LOGGED",
    child: str = "CHILD_ISSUE_KEY", sub: str = "SUB_ISSUE_KEY",
) -> DataFrame:
    """Logs with the hierarchy row they were written on: as a sub, or as a child that has no subs.

    A log on such a child takes its row from there; every other log keeps its sub match, or none.
    """
    by_sub = hierarchy.select(F.col(sub).alias(logged), *carried).where(F.col(logged).isNotNull()).distinct()
    leafs = hierarchy.where(F.col(child).isNotNull() & F.coalesce(F.col(sub) == "", F.lit(True)))
    by_child = leafs.select(F.col(child).alias(logged), *carried).distinct()
    # Decide between the two once per issue, so that the logs are moved by a single join.
    _, only_sub = split_by_match(by_sub, by_child, logged)
    return skew_join(logs, union_by_name(by_child, only_sub), logged, "left")


def utilisation(
    logs: DataFrame,
    hierarchy: DataFrame,
    grid: DataFrame,
    intervals: DataFrame,
    carried: Sequence[str],
    person: str = "UPDATE_NAME",
    time: str = "START_DATE",
    root: str = "ISSUE_KEY",
    incidents: Sequence[str] = INCIDENT_PREFIXES,
    operational: Sequence[tuple[str, Sequence[str], Sequence[str]]] = OPERATIONAL_TYPES,
) -> DataFrame:
    """Logged work by sprint and person beside the capacity grid, idle capacity included.

    ``logs`` carries ``ISSUE_KEY_LOGGED`` and ``ISSUE_TYPE_NAME_LOGGED``; ``carried`` are the hierarchy columns to keep,
    ``root`` among them. ``incidents`` and ``operational`` are the rules of ``utilisation_type`` and ``worklog_type``.
    """
    matched = match_worklogs(logs, hierarchy, carried)
    typed = matched.withColumn("UTILIZATION_TYPE", utilisation_type(root, incidents=incidents))
    typed = typed.withColumn("WORKLOG_TYPE", worklog_type(operational=operational))
    small = listing_fits(intervals)
    placed = assign_interval(typed, intervals, time, "SPRINT_ASSIGNED", carry=("start", "end"), small=small)
    seats = grid.withColumnsRenamed({"NAME": person, "RESOURCE_SPRINT_NAME": "SPRINT_ASSIGNED"})
    # Matching keeps every log, so the logs alone tell which seats are taken.
    taken = assign_interval(logs.select(person, time), intervals, time, "SPRINT_ASSIGNED", small=small)
    out = full_outer(placed, seats, [person, "SPRINT_ASSIGNED"], left_keys=taken)
    return fill_by_column(out, {person: "Unknown"})
