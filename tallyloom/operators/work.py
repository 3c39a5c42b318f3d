"""Work items: multi-valued attributes, milestones, hierarchy, work types, spread points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_first, case_last
from tallyloom.functions.columns import ratio, seconds_to_hours
from tallyloom.operators.aggregate import delimited_values, last_per_key
from tallyloom.operators.joins import left_fan_out, lookup, may_have_hot_key, skew_join
from tallyloom.operators.shape import prefix_columns

# Work type of an issue type for planned work.
WORK_TYPES = (
    ("Dev", ("Dev-Sub-Task", "Sub-task", "Vulnerability")),
    ("Bug", ("Bug", "Sub-bug")),
    ("Task", ("Test", "Sub-Design")),
    ("Infra", ("Sub-CloudOps",)),
    ("Doc", ("Doc", "Sub-doc")),
)
UNKNOWN_TYPE = "Unk"

# Milestone, text its status contains, the time it is read from.
MILESTONES = (
    ("DELIVERED_DATE", "Delivered", "LAST_TRANSITION_TO_STATUS"),
    ("BACKLOG_DATE", "Backlog", "LAST_TRANSITION_TO_STATUS"),
    ("PRD_DATE", "PRD", "FIRST_TRANSITION_TO_STATUS"),
    ("FACTORY_DATE", "Factory", "FIRST_TRANSITION_TO_STATUS"),
    ("ARCHITECTURE_SECONDS", "Architecture", "DURATION_IN_BUSINESS_DAYS_BH"),
)


def status_milestones(
    time_in_status: DataFrame,
    milestones: Sequence[tuple[str, str, str]] = MILESTONES,
    key: str = "ISSUE_KEY",
    status: str = "ISSUE_STATUS_NAME",
    order: Sequence[str] = ("FIRST_TRANSITION_TO_STATUS",),
    prefix: str | None = "IDEA",
) -> DataFrame:
    """One row per issue with a column per milestone, taken from its first row of that status.

    All milestones come from one aggregation; an issue without any of the statuses still has its row.
    """
    rows = time_in_status.where(F.col(key).startswith(prefix)) if prefix else time_in_status
    place = F.struct(*order)
    out = rows.groupBy(key).agg(*[
        F.min_by(F.col(value), F.when(F.col(status).contains(text), place)).alias(name)
        for name, text, value in milestones
    ])
    if "ARCHITECTURE_SECONDS" in out.columns:
        hours = seconds_to_hours("ARCHITECTURE_SECONDS")
        out = out.withColumn("ARCHITECTURE_BUSINESS_HOURS_DURATION", hours).drop("ARCHITECTURE_SECONDS")
    return out


def releases(versions: DataFrame, name: str = "VERSION_NAME") -> DataFrame:
    """Versions that are releases: a v followed by 1 to 9."""
    return versions.where(F.col(name).rlike("^v[1-9]"))


def latest_sprint(issue_sprints: DataFrame) -> DataFrame:
    return last_per_key(issue_sprints, ["ISSUE_KEY"], ["SPRINT_ID"])


def issue_wide(
    issues: DataFrame,
    issue_sprints: DataFrame,
    sprints: DataFrame,
    labels: Mapping[str, tuple[DataFrame, str]],
    milestones: DataFrame,
    single: Sequence[DataFrame] = (),
    key: str = "ISSUE_KEY",
) -> DataFrame:
    """One wide row per issue: latest sprint, delimited labels, sprint dates, milestones, single-valued extras.

    ``labels`` maps an output column to (long table, value column). All sides are grouped by the issue key, so the
    issues are shuffled once and every join reuses that partitioning.
    """
    latest = latest_sprint(issue_sprints).select(key, "SPRINT_ID", "SPRINT_NAME")
    out = issues.join(latest, key, "left")
    for name, (table, value) in labels.items():
        out = out.join(delimited_values(table, key, value, name), key, "left")
    out = out.join(milestones, key, "left")
    for extra in single:
        out = out.join(extra, key, "left")
    # Issues without a sprint share the null key.
    return lookup(out, sprints, ["SPRINT_ID", "SPRINT_NAME"])


def product_request_links(linked: DataFrame) -> Column:
    """Links that make a product request a root: outward dependencies only."""
    return (F.col("TYPE") == "Depends") & (F.col("DIRECTION") == "Outward")


def idea_links(linked: DataFrame) -> Column:
    """Links that make an idea a root: Polaris links, or no link at all."""
    return F.col("TYPE").startswith("Polaris") | F.col("TYPE").isNull()


ROOTS = {"Product Request": product_request_links, "Idea": idea_links}


def issue_hierarchy(
    issues: DataFrame,
    links: DataFrame,
    root: str,
    attributes: Sequence[str],
    points: str = "STORYPOINTS",
    key: str = "ISSUE_KEY",
    parent: str = "PARENT_ISSUE_KEY",
    issue_type: str = "ISSUE_TYPE_NAME",
) -> DataFrame:
    """Root issue, linked issue, its children and their subs, with the points of the deepest level present.

    ``attributes`` are carried for every level under ``LINKED_1_``, ``CHILD_`` and ``SUB_``. One linked issue may own
    any number of children, so those joins keep childless rows apart instead of relying on a left join. The lower two
    levels are joined first: they come straight from the issues, and the roots are then joined once.
    """
    level = list(dict.fromkeys([issue_type, *attributes, points]))
    roots = issues.where(F.col(issue_type).startswith(root))
    edges = links.select(key, F.col("LINKED_ISSUE_KEY").alias("LINKED_1_" + key), "TYPE", "DIRECTION")
    rooted = left_fan_out(roots, edges, key)
    rooted = rooted.where(ROOTS[root](rooted))
    linked = prefix_columns(issues.select(key, *level), "LINKED_1_")
    rooted = rooted.join(linked, "LINKED_1_" + key, "left")
    below = issues.where((F.col(issue_type) != root) & F.col(parent).isNotNull()).select(key, parent, *level)
    children = prefix_columns(below, "CHILD_").withColumnRenamed("CHILD_" + parent, "LINKED_1_" + key)
    subs = prefix_columns(below.distinct(), "SUB_").withColumnRenamed("SUB_" + parent, "CHILD_" + key)
    hot = may_have_hot_key(below)
    family = left_fan_out(children, subs, "CHILD_" + key, hot=hot)
    tree = left_fan_out(rooted, family, "LINKED_1_" + key, child_keys=children, hot=hot)
    return tree.withColumn("TOTAL_" + points, deepest_present([
        (F.col("SUB_" + key), F.col("SUB_" + points)),
        (F.col("CHILD_" + key), F.col("CHILD_" + points)),
        (F.col("LINKED_1_" + key), F.col("LINKED_1_" + points)),
    ]))


def deepest_present(levels: Sequence[tuple[Column, Column]]) -> Column:
    """Value of the first level whose key is present, even if that value is null. Not a coalesce of the values."""
    return case_first([(key.isNotNull(), value) for key, value in levels])


def work_type(
    issue_type: Column | str, types: Sequence[tuple[str, Sequence[str]]] = WORK_TYPES, unknown: str = UNKNOWN_TYPE
) -> Column:
    issue_type = F.col(issue_type) if isinstance(issue_type, str) else issue_type
    return case_last([(issue_type.isin(list(names)), label) for label, names in types], unknown)


def last_assignee(child: str = "CHILD_ASSIGNEE_NAME", sub: str = "SUB_ASSIGNEE_NAME") -> Column:
    """Assignee of the sub if it has one, else of the child."""
    present = [F.nullif(F.col(c), F.lit("")) for c in (sub, child)]
    return F.coalesce(*present)


def spread_points(
    hierarchy: DataFrame, long_attribute: DataFrame, value: str, points: str = "SUB_STORYPOINTS",
    linked: str = "LINKED_1_ISSUE_KEY", key: str = "ISSUE_KEY",
) -> DataFrame:
    """One row per hierarchy row and attribute value of its linked issue, with an equal part of the points."""
    counted = long_attribute.groupBy(key).agg(F.count(value).alias(f"{value}_COUNT"))
    valued = skew_join(long_attribute.select(key, value), counted, key, "left").withColumnRenamed(key, linked)
    return skew_join(hierarchy, valued, linked).withColumn("ADJ_" + points, ratio(points, f"{value}_COUNT"))
