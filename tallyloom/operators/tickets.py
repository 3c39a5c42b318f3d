"""Support tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_last, contains_rules
from tallyloom.functions.columns import hours_between, seconds_to_hours, to_long
from tallyloom.operators.aggregate import pivot_sum

TICKET_PREFIX = "TICKET"


def only_tickets(df: DataFrame, key: str = "ISSUE_KEY", prefix: str = TICKET_PREFIX) -> DataFrame:
    return df.where(F.col(key).startswith(prefix))


def keyword_tag(text: str, keywords: Sequence[tuple[str, str]]):
    """Tag of the last keyword (case-sensitive) the text contains, null without one."""
    return case_last(contains_rules(F.col(text), keywords))


def ticket_facts(
    issues: DataFrame,
    keywords: Sequence[tuple[str, str]],
    created: str = "CREATED",
    resolved: str = "RESOLUTION_DATE",
    responded: str = "FIRST_RESPONSE_DATE",
    text: str = "SUMMARY",
) -> DataFrame:
    """Tickets with hours to resolution and first response and the tenant named in the summary."""
    return only_tickets(issues).withColumns({
        "HOURS_TO_RESOLVED": hours_between(created, resolved),
        "HOURS_TO_FIRST_RESPONSE": hours_between(created, responded),
        "TENANT": keyword_tag(text, keywords),
    })


def ticket_worklogs(worklogs: DataFrame, tickets: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Logged hours on tickets with attributes of the ticket."""
    logs = only_tickets(worklogs).withColumn("LOGGED_HOURS", seconds_to_hours("LOGGED_TIME"))
    return logs.join(tickets.select("ISSUE_KEY", *attributes), "ISSUE_KEY", "left")


def ticket_time_in_status(time_in_status: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Business hours per ticket and status, one column per status."""
    hours = seconds_to_hours(to_long("DURATION_IN_BUSINESS_DAYS_BH"))
    return pivot_sum(only_tickets(time_in_status), "ISSUE_KEY", "ISSUE_STATUS_NAME", hours, statuses)
