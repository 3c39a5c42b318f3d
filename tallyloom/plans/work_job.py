"""Work tracking: from the tracker's tables to hierarchies, spread points and utilisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.capacity import capacity_grid, time_off_per_sprint, utilisation, weekday_time_off
from tallyloom.operators.intervals import assign_interval, build_intervals, listing_fits
from tallyloom.operators.joins import full_outer
from tallyloom.operators.work import (
    issue_hierarchy, issue_wide, last_assignee, releases, spread_points, status_milestones, work_type,
)
from tallyloom.session import settle

# Columns every level of a hierarchy carries, beside its key, type and points.
LEVEL = (
    "CREATED", "SUMMARY", "STATUS_CATEGORY_CHANGE_DATE", "ISSUE_STATUS_NAME", "SPRINT_NAME", "STATE", "START_DATE", "END_DATE",
    "COMPLETE_DATE", "VERSION_NAME", "CURRENT_ASSIGNEE_NAME", "REPORTER_NAME", "CATEGORY", "BU", "CUSTOMERS", "THEME", "PROGRESS",
)
SPREAD = (
    "LINKED_1_ISSUE_KEY", "LINKED_1_ISSUE_STATUS_NAME", "LINKED_1_BU", "LINKED_1_VERSION_NAME", "CHILD_SPRINT_DATE_VERSION",
    "CHILD_SPRINT_END_DATE_VERSION", "SUB_ISSUE_KEY", "SUB_STATUS_CATEGORY_CHANGE_DATE", "SUB_STORYPOINTS",
)
CARRIED = (
    "ISSUE_KEY", "SUMMARY", "ISSUE_STATUS_NAME", "LINKED_1_ISSUE_KEY", "LINKED_1_ISSUE_TYPE_NAME", "LINKED_1_ISSUE_STATUS_NAME",
    "LINKED_1_VERSION_NAME", "CHILD_ISSUE_KEY", "CHILD_ISSUE_TYPE_NAME", "CHILD_ISSUE_STATUS_NAME", "CHILD_SPRINT_DATE_VERSION",
    "CHILD_SPRINT_END_DATE_VERSION", "CHILD_SPRINT_NAME", "SUB_ISSUE_KEY", "SUB_ISSUE_TYPE_NAME", "SUB_ISSUE_STATUS_NAME",
    "SUB_STATUS_CATEGORY_CHANGE_DATE", "SUB_PROGRESS", "SUB_SPRINT_NAME", "TOTAL_STORYPOINTS",
)
# Columns of a resource, as they are called beside a work log and beside an idea.
RESOURCE_NAMES = {
    "NAME_ID": ("UPDATE_NAME_ID", "RESOURCE_NAME_ID"),
    "AREA_ID": ("UPDATE_NAME_AREA_ID", "RESOURCE_AREA_ID"),
    "AREA": ("UPDATE_NAME_AREA", "RESOURCE_AREA"),
    "RESOURCE_STATUS": ("UPDATE_NAME_STATUS", "RESOURCE_STATUS"),
    "TRACKING_PHASE": ("UPDATE_NAME_TRACK_PHASE", "RESOURCE_TRACK_PHASE"),
    "DEPARTMENT": ("UPDATE_NAME_DEPARTMENT", "RESOURCE_DEPARTMENT"),
}
UNKNOWN = "Unknown"


@dataclass
class Tracker:
    """The tables of the issue tracker and the lists kept beside it."""

    issues: DataFrame
    issue_sprints: DataFrame
    sprints: DataFrame
    links: DataFrame
    versions: DataFrame
    labels: Mapping[str, tuple[DataFrame, str]]
    time_in_status: DataFrame
    worklogs: DataFrame
    resources: DataFrame
    time_off: DataFrame
    holidays: DataFrame
    weeks: DataFrame
    aliases: Mapping[str, str]


def wide_issues(t: Tracker) -> DataFrame:
    return issue_wide(t.issues, t.issue_sprints, t.sprints, t.labels, status_milestones(t.time_in_status))


def dated_hierarchy(t: Tracker, wide: DataFrame, root: str, level: Sequence[str] = LEVEL) -> DataFrame:
    """Hierarchy of a root type with the release its child sprint starts and ends in."""
    tree = issue_hierarchy(wide, t.links, root, level)
    calendar = build_intervals(releases(t.versions), "RELEASE_DATE", "VERSION_NAME")
    small = listing_fits(calendar)
    dated = assign_interval(tree, calendar, "CHILD_START_DATE", "CHILD_SPRINT_DATE_VERSION", closed=True, small=small)
    return assign_interval(dated, calendar, "CHILD_END_DATE", "CHILD_SPRINT_END_DATE_VERSION", closed=True, small=small)


def grid(t: Tracker) -> DataFrame:
    valid = t.sprints.where(F.col("SPRINT_NAME").startswith("v"))
    off = time_off_per_sprint(weekday_time_off(t.time_off), t.weeks, ["NAME"], "PTO", t.aliases)
    free = time_off_per_sprint(weekday_time_off(t.holidays), t.weeks, [], "HOLIDAYS")
    return capacity_grid(t.resources, valid, free, off)


def ideas_with_capacity(tree: DataFrame, seats: DataFrame) -> DataFrame:
    """Ideas beside the grid of their last assignee and child sprint; idle seats stay. Ideas without a sub have its
    texts empty."""
    subs = [f.name for f in tree.schema.fields if f.name.startswith("SUB_") and f.dataType.simpleString() == "string"]
    assigned = tree.fillna("", subset=subs).withColumn(
        "LAST_ASSIGNEE_NAME", last_assignee("CHILD_CURRENT_ASSIGNEE_NAME", "SUB_CURRENT_ASSIGNEE_NAME")
    )
    named = seats.withColumnsRenamed({
        "NAME": "LAST_ASSIGNEE_NAME", "RESOURCE_SPRINT_NAME": "CHILD_SPRINT_NAME",
        **{old: idea for old, (_, idea) in RESOURCE_NAMES.items()},
    })
    out = full_outer(assigned, named, ["LAST_ASSIGNEE_NAME", "CHILD_SPRINT_NAME"])
    return out.withColumns({"UTILIZATION_TYPE": F.lit("Idea"), "WORK_TYPE": work_type("SUB_ISSUE_TYPE_NAME")})


def logged_work(
    logs: DataFrame, ideas: DataFrame, seats: DataFrame, calendar: DataFrame, carried: Sequence[str] = CARRIED, **rules: Sequence
) -> DataFrame:
    """Work logs beside the grid; what is not known about a person is called so. ``rules`` are those of ``utilisation``."""
    named = seats.withColumnsRenamed({old: log for old, (log, _) in RESOURCE_NAMES.items()})
    out = utilisation(logs, ideas, named, calendar, carried, **rules)
    texts = [log for log, _ in RESOURCE_NAMES.values() if log in out.columns]
    return out.fillna(UNKNOWN, subset=[*texts, "SUB_SPRINT_NAME"])


def work_tracking(
    t: Tracker, level: Sequence[str] = LEVEL, carried: Sequence[str] = CARRIED, spread: Sequence[str] = SPREAD, **rules: Sequence
) -> dict[str, DataFrame]:
    """All outputs of the job, by name. What several of them read is computed once and settled.

    ``level``, ``carried`` and ``spread`` are the columns kept of every level, beside a work log and beside spread points; ``rules``
    (``incidents``, ``operational``) say what kind of work a log is.
    """
    wide = settle(wide_issues(t))
    requests, ideas = (settle(dated_hierarchy(t, wide, root, level)) for root in ("Product Request", "Idea"))
    seats = settle(grid(t))
    kinds = t.issues.select(
        F.col("ISSUE_KEY").alias("ISSUE_KEY_LOGGED"), F.col("ISSUE_TYPE_NAME").alias("ISSUE_TYPE_NAME_LOGGED")
    )
    logs = t.worklogs.withColumnRenamed("ISSUE_KEY", "ISSUE_KEY_LOGGED").join(kinds, "ISSUE_KEY_LOGGED", "left")
    valid = t.sprints.where(F.col("SPRINT_NAME").startswith("v"))
    calendar = build_intervals(valid, "END_DATE", "SPRINT_NAME", numbered=False)
    out = {
        "requests": requests,
        "ideas": ideas_with_capacity(ideas, seats),
        "worklogs": logged_work(logs, ideas, seats, calendar, carried, **rules),
    }
    for name, tree in (("requests", requests), ("ideas", ideas)):
        for label in ("CUSTOMERS", "CATEGORY"):
            table, value = t.labels[label]
            out[f"{name}_{label.lower()}"] = spread_points(tree.select(*spread), table, value)
    return out
