"""Data-quality checks.

All checks over the same table share one scan and one aggregation. Row checks add up flags. For uniqueness and
relationships each row offers its keys under the check's number; they are counted per key before the shuffle, and parents
offer theirs into the same count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shiplake.operators.keys import check_inputs, duplicate_keys
from shiplake.schemas import FACT_COLUMNS, FACT_REQUIRED_KEYS, RELATIONSHIPS, RISK_LEVELS


# --- violation rows ---------------------------------------------------------------------------

def null_rows(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull())


def unaccepted_rows(frame: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list; nulls are left to the not-null check."""
    return frame.filter(~F.col(column).isin(list(values)))


def failing_rows(frame: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a constraint is false; like a CHECK constraint, unknown passes."""
    return frame.filter(~condition)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


# --- measures ---------------------------------------------------------------------------------

def null_counts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the null count of every column, in one pass."""
    return frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (columns or frame.columns)])


def require_no_nulls(frame: DataFrame, columns: Sequence[str]) -> None:
    counts = null_counts(frame, columns).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise RuntimeError(f"null values found: {bad}")


def duplicate_report(frame: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Duplicated keys, most repeated first; the report length is a parameter, ``None`` for all."""
    ranked = duplicate_keys(frame, keys).orderBy(F.desc("row_count"), *keys)
    return ranked if limit is None else ranked.limit(limit)


def distinct_profile(frame: DataFrame, key: str) -> DataFrame:
    return frame.agg(F.count("*").alias("row_count"), F.count_distinct(F.col(key)).alias("distinct_keys"))


def require_shape(frame: DataFrame, rows: int, columns: int) -> None:
    actual = (frame.count(), len(frame.columns))
    if actual != (rows, columns):
        raise RuntimeError(f"expected {rows} rows and {columns} columns, got {actual[0]} and {actual[1]}")


def table_profile(frame: DataFrame, name: str) -> DataFrame:
    """Per column: type, null count and a sample of up to 50 characters.

    The sample is the least value, so it does not depend on the order of the rows.
    """
    total = F.count("*").alias("_rows")
    parts = []
    for column, kind in frame.dtypes:
        sample = F.substring(F.replace(F.min(column).cast("string"), F.lit("|"), F.lit("/")), 1, 50)
        parts.append(F.struct(
            F.lit(column).alias("column_name"), F.lit(kind).alias("data_type"),
            F.count_if(F.col(column).isNull()).alias("null_count"), F.coalesce(sample, F.lit("")).alias("sample_value"),
        ))
    profiled = frame.agg(total, F.array(*parts).alias("_columns"))
    return profiled.select(
        F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"),
        F.lit(len(frame.columns)).cast("bigint").alias("column_count"), F.inline("_columns"),
    )


# --- checks and report ------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """A named check: a condition marking bad rows of ``frame``, a parent its keys must exist in, columns that no two
    rows share, or a frame that already holds the one number."""

    name: str
    frame: DataFrame
    bad_row: Column | None = None
    parent: Parent | None = None
    unique_by: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Parent:
    key: str
    frame: DataFrame
    frame_key: str
    null_is_orphan: bool


def not_null(name: str, frame: DataFrame, column: str) -> Check:
    return Check(name, frame, F.col(column).isNull())


def accepted_values(name: str, frame: DataFrame, column: str, values: Sequence) -> Check:
    return Check(name, frame, ~F.col(column).isin(list(values)))


def expression(name: str, frame: DataFrame, holds: Column) -> Check:
    return Check(name, frame, ~holds)


def unique(name: str, frame: DataFrame, *keys: str) -> Check:
    """Counts duplicated key values. Null keys are not compared."""
    return Check(name, frame, unique_by=keys)


def relationship(
    name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str, *, null_is_orphan: bool = False
) -> Check:
    """Counts child rows without a parent."""
    return Check(name, child, parent=Parent(key, parent, parent_key, null_is_orphan))


def row_count(name: str, frame: DataFrame, expected: int) -> Check:
    return Check(name, frame.agg(F.abs(F.count("*") - F.lit(expected)).alias("violations")))


def column_order(name: str, frame: DataFrame, expected: Sequence[str]) -> Check:
    wrong = 0 if list(frame.columns) == list(expected) else 1
    return Check(name, frame.sparkSession.range(1).select(F.lit(wrong).cast("bigint").alias("violations")))


def row_total(name: str, violations: DataFrame) -> Check:
    """Counts the rows of a frame of violations."""
    return Check(name, violations.agg(F.count("*").alias("violations")))


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """``(check_name, violations, passed)`` for every check; lazy, one plan with one scan per checked table."""
    by_table: dict[int, list[Check]] = {}
    reports: list[DataFrame] = []
    for check in checks:
        if check.bad_row is not None or check.parent is not None or check.unique_by is not None:
            by_table.setdefault(id(check.frame), []).append(check)
        else:
            reports.append(check.frame.select(F.lit(check.name).alias("check_name"), "violations"))
    for group in by_table.values():
        if all(c.bad_row is not None for c in group):
            reports.append(named_counts(group[0].frame, {c.name: F.count_if(c.bad_row) for c in group}))
        else:
            reports.append(fused_counts(group))
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("passed", F.col("violations") == 0)


def named_counts(frame: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """``(check_name, violations)`` rows from several aggregates over one frame."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("check_name"), count.alias("violations")) for name, count in counts.items()
    ])
    return frame.agg(rows.alias("_checks")).select(F.inline("_checks"))


def key_text(keys: Sequence[str]) -> Column:
    """A key as text, null if any part is. Parts are written with their length, so different keys differ."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def fused_counts(checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one scan: each row offers its flags and its keys, by the number of the check."""
    rows = [i for i, c in enumerate(checks) if c.bad_row is not None]
    zero = F.lit(0).cast("long")
    flags = F.array(*[F.when(checks[i].bad_row, 1).otherwise(0).cast("long") for i in rows]) if rows else F.array().cast("array<bigint>")

    def entry(number: int, key: Column, known: int, own: Column) -> Column:
        return F.struct(F.lit(number).alias("check"), key.alias("key"), F.lit(known).alias("known"), own.alias("flags"))

    none = F.lit(None).cast("array<bigint>")
    offers = [entry(-1, F.lit(None).cast("string"), 0, flags)]
    parents = []
    for i, check in enumerate(checks):
        if check.unique_by is not None:
            offers.append(entry(i, key_text(check.unique_by), 0, none))
        elif check.parent is not None:
            offers.append(entry(i, key_text([check.parent.key]), 0, none))
            parents.append(check.parent.frame.select(entry(i, key_text([check.parent.frame_key]), 1, none).alias("e")).select("e.*"))
    offered = checks[0].frame.select(F.inline(F.array(*offers)))
    counted = reduce(DataFrame.unionByName, [offered, *parents]).groupBy("check", "key").agg(
        F.count_if(F.col("known") == 0).alias("rows"), F.max("known").alias("known"),
        *[F.sum(F.get("flags", F.lit(at))).alias(f"flag{at}") for at in range(len(rows))],
    )
    counts = {}
    for i, check in enumerate(checks):
        mine = F.col("check") == i
        if check.bad_row is not None:
            counts[check.name] = F.coalesce(F.sum(F.when(F.col("check") == -1, F.col(f"flag{rows.index(i)}"))), zero)
        elif check.unique_by is not None:
            counts[check.name] = F.count_if(mine & F.col("key").isNotNull() & (F.col("rows") > 1))
        else:
            lost = mine & ((F.col("known") == 0) | F.col("key").isNull())
            if not check.parent.null_is_orphan:
                lost = lost & F.col("key").isNotNull()
            counts[check.name] = F.coalesce(F.sum(F.when(lost, F.col("rows"))), zero)
    return named_counts(counted, counts)


def require_passed(report: DataFrame) -> None:
    """Raise with the names and counts of failed checks; the report has one row per check."""
    failed = {r.check_name: r.violations for r in report.filter(~F.col("passed")).collect()}
    if failed:
        raise RuntimeError(f"data checks failed: {failed}")


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    missing = sorted(n for n in names if not spark.catalog.tableExists(n))
    if missing:
        raise RuntimeError(f"missing prerequisite tables: {missing}")


# --- check suites -----------------------------------------------------------------------------

def warehouse_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> list[Check]:
    """The generic tests of the staging layer on the fact and its dimensions."""
    checks = [
        unique("fact.shipment_id unique", fact, "shipment_id"),
        column_order("fact columns in order", fact, FACT_COLUMNS),
        accepted_values("fact.on_time accepted", fact, "on_time", [True, False]),
        not_null("fact.on_time not null", fact, "on_time"),
        Check("fact keys not null", fact, any_null(FACT_REQUIRED_KEYS)),
        expression(
            "fact.delay_hours formula", fact,
            F.col("delay_hours").eqNullSafe((F.col("lead_time") - F.col("scheduled_time")) * 24),
        ),
    ]
    checks += [not_null(f"fact.{c} not null", fact, c) for c in FACT_REQUIRED_KEYS]
    for key, (dim, dim_key) in RELATIONSHIPS.items():
        checks += [
            relationship(f"fact.{key} in {dim}", fact, key, dims[dim], dim_key),
            not_null(f"{dim}.{dim_key} not null", dims[dim], dim_key),
            unique(f"{dim}.{dim_key} unique", dims[dim], dim_key),
        ]
    return checks


def mart_checks(carriers: DataFrame, routes: DataFrame, monthly: DataFrame) -> list[Check]:
    return [
        not_null("carrier_performance.carrier_id not null", carriers, "carrier_id"),
        unique("carrier_performance.carrier_id unique", carriers, "carrier_id"),
        not_null("route_performance.route_id not null", routes, "route_id"),
        unique("route_performance.route_id unique", routes, "route_id"),
        not_null("sla_monthly.year not null", monthly, "year"),
        not_null("sla_monthly.month not null", monthly, "month"),
        unique("sla_monthly month unique", monthly, "year", "month"),
        Check("sla_monthly values sane", monthly, sla_insane()),
    ]


def sla_insane() -> Column:
    return (
        F.col("year").isNull() | F.col("month").isNull() | ~F.col("on_time_rate").between(0, 1)
        | (F.col("on_time_shipments") > F.col("total_shipments"))
    )


def staging_fact_checks(fact: DataFrame, dims: dict[str, DataFrame], expected_rows: int) -> list[Check]:
    """What must hold before a new fact version is published; a null key counts as an orphan."""
    checks = [
        row_count("row count", fact, expected_rows),
        unique("shipment_id unique", fact, "shipment_id"),
        Check("required keys not null", fact, any_null(FACT_REQUIRED_KEYS)),
    ]
    for key, (dim, dim_key) in RELATIONSHIPS.items():
        checks.append(relationship(f"{key} in {dim}", fact, key, dims[dim], dim_key, null_is_orphan=True))
    return checks


def prediction_checks(predictions: DataFrame) -> list[Check]:
    check_inputs(
        ("predictions", predictions, ("shipment_id", "late_risk_probability", "predicted_is_late", "risk_level"))
    )
    probability = F.col("late_risk_probability")
    return [
        not_null("shipment_id not null", predictions, "shipment_id"),
        unique("shipment_id unique", predictions, "shipment_id"),
        Check("probability in range", predictions, ~F.coalesce(probability.between(0, 1), F.lit(False))),
        Check("risk_level accepted", predictions, ~F.coalesce(F.col("risk_level").isin(RISK_LEVELS), F.lit(False))),
    ]
