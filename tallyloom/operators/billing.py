"""Cloud billing lines: flattening, credits, compute and storage parts, components, project summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cases import case_first, case_last, contains_rules, like_rules
from tallyloom.functions.columns import LOCAL_ZONE, local_time, nth
from tallyloom.operators.aggregate import sum_by
from tallyloom.operators.joins import MAX_BROADCAST_BYTES, lookup
from tallyloom.operators.shape import fill_zero
from tallyloom.session import settle

STORAGE_MARK = "SSD"


def flatten_billing(lines: DataFrame, resource: bool = False) -> DataFrame:
    """Nested billing lines to flat columns: the first two credits, and type and amount of any further ones in ``credits_rest``.

    ``credits_rest`` is null without further ones, which is nearly always. Only the struct fields named here are read.
    """
    columns = [
        F.col("service.description").alias("service_description"),
        F.col("sku.description").alias("sku_description"),
        F.col("usage_start_time"),
        F.col("project.id").alias("id_project"),
        F.col("cost"),
        F.col("usage.amount").alias("usage_amount"),
        F.col("usage.unit").alias("usage_unit"),
        F.col("cost_type"),
    ]
    for i in (1, 2):
        credit = nth("credits", i - 1)
        columns += [credit[f].alias(f"credits_{i}_{f}") for f in ("name", "amount", "type")]
    further = F.size("credits") - 2
    rest = F.arrays_zip(
        F.slice("credits.type", 3, further).alias("type"), F.slice("credits.amount", 3, further).alias("amount"))
    columns.append(F.when(further > 0, rest).alias("credits_rest"))
    if resource:
        columns += [
            F.col("resource.name").alias("resource_name"),
            F.col("resource.global_name").alias("resource_global_name"),
        ]
    return lines.select(*columns)


def _types_and_amounts() -> list[tuple[Column, Column]]:
    return [(F.col(f"credits_{i}_type"), F.col(f"credits_{i}_amount")) for i in (1, 2)]


def _rest(flat: DataFrame, sums: Mapping[str, Callable[[Column], Column]], missing: float | None) -> dict[str, tuple[Column, Column]]:
    """Whether a credit beyond the second hits and the sum of those that do, by name; all in one pass over those credits.

    Lines without such credits do not begin the pass. A missing amount is ``missing``; null makes the sum null.
    """
    if "credits_rest" not in flat.columns:
        return {name: (F.lit(False), F.lit(0.0)) for name in sums}
    start = F.struct(*[F.struct(F.lit(False).alias("hit"), F.lit(0.0).alias("amount")).alias(name) for name in sums])

    def add(total: Column, credit: Column) -> Column:
        amount = credit["amount"].cast("double") if missing is None else F.coalesce(credit["amount"].cast("double"), F.lit(missing))
        parts = []
        for name, hits in sums.items():
            hit = F.coalesce(hits(credit["type"]), F.lit(False))
            parts.append(F.struct(
                (total[name]["hit"] | hit).alias("hit"), F.when(hit, total[name]["amount"] + amount).otherwise(total[name]["amount"]).alias("amount")).alias(name))
        return F.struct(*parts)

    found, some = F.aggregate("credits_rest", start, add), F.col("credits_rest").isNotNull()
    return {name: (F.when(some, found[name]["hit"]).otherwise(False), F.when(some, found[name]["amount"]).otherwise(0.0)) for name in sums}


def _sum_where(hits: Sequence[Column], amounts: Sequence[Column]) -> Column:
    """The sum of the amounts whose credit hits, 0 when none does or an amount taken is missing."""
    taken = [F.when(F.coalesce(h, F.lit(False)), a).otherwise(F.lit(0.0)) for h, a in zip(hits, amounts)]
    return F.coalesce(sum(taken[1:], taken[0]), F.lit(0.0))


def split_credits(flat: DataFrame, policy: str = "like") -> DataFrame:
    """Add ``credits_discounts`` and ``credits_promotion``.

    ``like``: by ``%DISCOUNT%`` / ``%PROMOTION%`` in the type; ``exact``: type ``PROMOTION`` is a promotion and
    everything else a discount; ``all``: every credit is a discount.
    """
    (t1, a1), (t2, a2) = _types_and_amounts()
    if policy == "like":
        kinds = ("%DISCOUNT%", "%PROMOTION%")
        rest = _rest(flat, {kind: lambda t, kind=kind: t.like(kind) for kind in kinds}, None)
        discount, promotion = (
            _sum_where([t1.like(kind), t2.like(kind), rest[kind][0]], [a1, a2, rest[kind][1]]) for kind in kinds)
    elif policy == "exact":
        zero = F.lit(0.0)
        parts = [(F.coalesce(t == "PROMOTION", F.lit(False)), F.coalesce(a, zero)) for t, a in _types_and_amounts()]
        is_promotion = lambda t: F.coalesce(t == "PROMOTION", F.lit(False))
        rest = _rest(flat, {"promotion": is_promotion, "discount": lambda t: ~is_promotion(t)}, 0.0)
        promotion = sum((F.when(hit, a).otherwise(zero) for hit, a in parts), rest["promotion"][1])
        discount = sum((F.when(hit, zero).otherwise(a) for hit, a in parts), rest["discount"][1])
    elif policy == "all":
        discount = F.coalesce(a1, F.lit(0.0)) + F.coalesce(a2, F.lit(0.0)) + _rest(flat, {"all": lambda t: F.lit(True)}, 0.0)["all"][1]
        promotion = F.lit(0.0)
    else:
        raise ValueError(f"unknown credit policy: {policy}")
    return flat.withColumns({"credits_discounts": discount, "credits_promotion": promotion})


def is_storage(sku: str = "sku_description", mark: str = STORAGE_MARK) -> Column:
    return F.col(sku).contains(mark)


def split_compute_storage(credited: DataFrame, sku: str = "sku_description", mark: str = STORAGE_MARK) -> DataFrame:
    """Compute and storage parts of the cost and of the discount. Credits are negative, so they are added.

    A line without an SKU belongs to neither part.
    """
    storage = is_storage(sku, mark)
    cost, discount = F.col("cost"), F.col("credits_discounts")
    return credited.withColumns({
        "compute_cost": F.when(~storage, cost),
        "storage_cost": F.when(storage, cost),
        "compute_discount": F.when(~storage, discount),
        "storage_discount": F.when(storage, discount),
        "compute_after_discount": F.when(~storage, cost + discount),
        "storage_after_discount": F.when(storage, cost + discount),
        "total_after_discounts": cost + discount,
        "total_after_discounts_promotion": cost + discount + F.col("credits_promotion"),
    })


def only_compute(flat: DataFrame, sku: str = "sku_description", mark: str = STORAGE_MARK) -> DataFrame:
    """Compute lines. Filter before deriving anything, so that the predicate reaches the scan."""
    return flat.where(~F.col(sku).like(f"%{mark}%"))


def only_storage(flat: DataFrame, sku: str = "sku_description", mark: str = STORAGE_MARK) -> DataFrame:
    return flat.where(F.col(sku).like(f"%{mark}%"))


def map_component(
    lines: DataFrame,
    name_rules: Sequence[tuple[str, str]],
    global_rules: Sequence[tuple[str, str]] = (),
    mode: str = "first",
    out: str = "component",
    name: str = "resource_name",
    global_name: str = "resource_global_name",
    default: str | None = None,
) -> DataFrame:
    """Component of a line from ordered patterns on the resource name, then on its global name.

    ``first``: the first matching LIKE pattern decides. ``last``: patterns are substrings, the last one contained in the
    resource name decides, and the global name is asked only where no resource rule matched.
    """
    by_name, by_global = F.col(name), F.col(global_name)
    if mode == "first":
        rule = case_first(like_rules(by_name, name_rules) + like_rules(by_global, global_rules), default)
    elif mode == "last":
        rule = F.coalesce(
            case_last(contains_rules(by_name, name_rules)),
            case_last(contains_rules(by_global, global_rules)),
            F.lit(default),
        )
    else:
        raise ValueError(f"unknown mode: {mode}")
    return lines.withColumn(out, rule)


def map_once(lines: DataFrame, columns: Sequence[str], mapped: Callable[[DataFrame], DataFrame], max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """What ``mapped`` adds to ``lines``, worked out once for each distinct combination of ``columns`` and joined back.

    ``mapped`` may look at ``columns`` alone. Names repeat from line to line, so long lists of patterns are tried on few rows; every
    line then costs one look-up, whatever the number of patterns. The answers are settled: their true size decides whether they
    are broadcast, and adaptive execution splits a name with many lines otherwise. Nulls are names like any other.
    """
    names = lines.select(*columns).distinct()
    answers = mapped(names)
    added = [c for c in answers.columns if c not in columns]
    answers = settle(answers.select(*[F.col(c).alias(f"_name_{i}") for i, c in enumerate(columns)], *added))
    same = reduce(and_, (lines[c].eqNullSafe(answers[f"_name_{i}"]) for i, c in enumerate(columns)))
    kept = [c for c in lines.columns if c not in added]
    return lookup(lines.select(*kept), answers, same, "left", max_bytes).select(*kept, *added)


def map_subcomponent(
    lines: DataFrame,
    rules: Sequence[tuple[str, str]],
    verbatim: Sequence[str] = (),
    component: str = "component",
    name: str = "resource_name",
    out: str = "sub_component",
    default: str | None = "N/A",
) -> DataFrame:
    """Sub-component of a line that has a component; for the ``verbatim`` patterns it is the resource name itself."""
    known, by_name = F.col(component).isNotNull(), F.col(name)
    chain = [(known & hit, value) for hit, value in like_rules(by_name, rules)]
    chain += [(known & by_name.like(p), by_name) for p in verbatim]
    return lines.withColumn(out, case_first(chain, default))


def detailed_costs(
    lines: DataFrame,
    name_rules: Sequence[tuple[str, str]],
    global_rules: Sequence[tuple[str, str]],
    sub_rules: Sequence[tuple[str, str]],
    verbatim: Sequence[str] = (),
    zone: str = LOCAL_ZONE,
    mark: str = STORAGE_MARK,
    once: bool = False,
) -> DataFrame:
    """Every billing line with its component, sub-component, local time and cost parts.

    ``once`` tries the patterns on the distinct names instead of on every line (``map_once``): for long lists of patterns.
    """
    def with_parts(rows: DataFrame) -> DataFrame:
        return map_subcomponent(map_component(rows, name_rules, global_rules), sub_rules, verbatim)

    flat = fill_zero(flatten_billing(lines, resource=True), "cost", "credits_1_amount", "credits_2_amount")
    mapped = map_once(flat, ["resource_name", "resource_global_name"], with_parts) if once else with_parts(flat)
    parts = split_compute_storage(split_credits(mapped, "like"), mark=mark)
    return parts.withColumn("usage_start_time_local", local_time("usage_start_time", zone))


def project_cost_summary(
    lines: DataFrame,
    projects: DataFrame,
    project_of_service: Mapping[str, str] | None = None,
    zone: str = LOCAL_ZONE,
    mark: str = STORAGE_MARK,
) -> DataFrame:
    """Seven measures per (time, project, service, SKU, unit) with the finance attributes of the project.

    ``project_of_service`` moves the lines of a service to another project before summing.
    """
    parts = split_compute_storage(split_credits(flatten_billing(lines), "like"), mark=mark)
    moves = [(F.col("service_description") == s, p) for s, p in (project_of_service or {}).items()]
    parts = parts.withColumn("id_project", case_first(moves, F.col("id_project")))
    keys = ["usage_start_time", "id_project", "service_description", "sku_description", "usage_unit"]
    summary = sum_by(parts, keys, {
        "total_cost": "cost",
        "total_amount": "usage_amount",
        "total_after_discounts": "total_after_discounts",
        "total_amount_credits": "credits_discounts",
        "total_compute_cost": "compute_cost",
        "total_storage_cost": "storage_cost",
        "total_promotion_credits": "credits_promotion",
    })
    named = lookup(summary, projects.withColumnRenamed("id", "id_project"), "id_project")
    return named.withColumn("usage_start_time_local", local_time("usage_start_time", zone))
