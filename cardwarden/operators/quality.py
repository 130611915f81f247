"""Quality rules as data: one suite, one results table, one quarantine.

All row rules of a suite are counted in a single aggregate. Each uniqueness rule
adds one grouped count, which Spark pre-aggregates before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import schemas
from cardwarden.functions import parse_amount, parse_timestamp
from cardwarden.operators.skew import DEFAULT_SKEW, SkewPolicy, hot_keys, split_hot

# Rule categories and severities.
PHYSICAL, BUSINESS = "F", "N"
STOP, WARN = "stop", "warn"
HELD, ACCEPTED = "held", "accepted"


@dataclass(frozen=True)
class Rule:
    """One expectation on one column.

    ``kind`` is ``not_null``, ``unique``, ``between``, ``in_set``,
    ``date_between``, ``well_formed``, ``is_amount`` or ``is_timestamp``; the last
    two ask whether text converts. All but ``not_null`` and ``well_formed`` skip
    NULLs. ``upper=None`` leaves a range open; for ``date_between`` it means "now".
    """

    rule_id: str
    column: str
    kind: str
    category: str = PHYSICAL
    severity: str = STOP
    lower: object = None
    upper: object = None
    allowed: tuple[str, ...] = ()


# The documented rule matrix, and the gates of the two layers.
MATRIX = (
    Rule("DQ-F01", "transaction_id", "not_null"),
    Rule("DQ-F02", "transaction_id", "unique"),
    Rule("DQ-F03", "customer_id", "not_null"),
    Rule("DQ-N01", "points_earned", "between", BUSINESS, WARN, lower=0),
    Rule(
        "DQ-N02",
        "status",
        "in_set",
        BUSINESS,
        allowed=("processed", "pending", "cancelled"),
    ),
    Rule("DQ-N03", "transaction_date", "date_between", BUSINESS, lower="2020-01-01"),
)
BRONZE_RULES = (
    Rule("DQ-F01", "tx_id", "not_null"),
    Rule("DQ-F02", "tx_id", "unique"),
    Rule("DQ-F03", "cust_id", "not_null"),
)
SILVER_RULES = (
    Rule("DQ-F01", "transaction_id", "not_null"),
    Rule("DQ-F02", "transaction_id", "unique"),
    Rule("DQ-F03", "customer_id", "not_null"),
    Rule("DQ-F04", "amount", "not_null"),
)
# Raw text that would be lost on the way to Silver. Warnings, as nothing says stop.
TEXT_RULES = (
    Rule("DQ-R01", schemas.CORRUPT_RECORD, "well_formed", severity=WARN),
    Rule("DQ-R02", "tx_amount", "is_amount", severity=WARN),
    Rule("DQ-R03", "tx_datetime", "is_timestamp", severity=WARN),
)


class QualityGateError(Exception):
    """A stop-level rule failed. ``results`` holds one row per rule."""

    def __init__(self, layer: str, results: Sequence) -> None:
        self.layer = layer
        self.results = list(results)
        failed = [
            f"{r['rule_id']} on {r['column']}: {r['failed']} of {r['evaluated']}"
            for r in self.results
            if not r["success"]
        ]
        super().__init__(f"{layer} quality gate failed: " + "; ".join(failed))


def _row_failure(rule: Rule, as_of: datetime | None) -> Column:
    """True on rows that break the rule, never NULL."""
    value = F.col(rule.column)
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "well_formed":
        return value.isNotNull()
    if rule.kind == "is_amount":
        return value.isNotNull() & parse_amount(value).isNull()
    if rule.kind == "is_timestamp":
        return value.isNotNull() & parse_timestamp(value).isNull()
    if rule.kind == "in_set":
        bad = ~value.isin(*rule.allowed)
    elif rule.kind in ("between", "date_between"):
        lower, upper = rule.lower, rule.upper
        if rule.kind == "date_between":
            lower = F.lit(lower).cast("timestamp") if lower is not None else None
            upper = F.lit(upper if upper is not None else as_of).cast("timestamp")
            upper = F.coalesce(upper, F.current_timestamp())
        bad = F.lit(False)
        if lower is not None:
            bad = bad | (value < lower)
        if upper is not None:
            bad = bad | (value > upper)
    else:
        raise ValueError(f"unknown rule kind: {rule.kind}")
    return F.coalesce(bad, F.lit(False))


def _evaluated(rule: Rule) -> Column:
    every_row = rule.kind in ("not_null", "well_formed")
    return F.count(F.lit(1)) if every_row else F.count(rule.column)


def _repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .filter(F.col("count") > 1)
        .select(key)
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: ``column_name, null_count``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
            for c in columns
        ]
    )
    return counts.select(F.inline(pairs))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key. NULL keys are duplicates of each other."""
    return (
        df.groupBy(key)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_count"))
    )


def check_nulls(df: DataFrame, columns: Sequence[str]) -> tuple[bool, str]:
    """Whether the columns hold no NULL, naming the first that does."""
    counts = {r["column_name"]: r["null_count"] for r in null_counts(df, columns).collect()}
    for column in columns:
        if counts[column]:
            return False, f"column {column} holds {counts[column]} NULL values"
    return True, "null check passed"


def check_duplicates(df: DataFrame, key: str) -> tuple[bool, str]:
    """Whether every key occurs once, with the number of surplus rows."""
    surplus = duplicate_count(df, key).first()["duplicate_count"]
    if surplus:
        return False, f"{surplus} duplicate rows for key {key}"
    return True, "duplicate check passed"


def _mark_repeated(df: DataFrame, key: str, name: str, policy: SkewPolicy) -> DataFrame:
    """Add a boolean: does the row's non-NULL key occur more than once?

    Rows meet their key's count in a join, so one key's rows meet in one task.
    Hot keys, NULL among them, stay out of it: a sample has seen them repeat.
    """
    hot = hot_keys(df, key, policy)
    rest, large = (df, None) if hot is None else split_hot(df, key, hot)
    repeated = _repeated_keys(rest, key).withColumn(name, F.lit(True))
    marked = rest.join(repeated, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    if large is None:
        return marked
    return marked.unionByName(large.withColumn(name, F.col(key).isNotNull()))


def unique_violations(df: DataFrame, key: str, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """All rows of every repeated non-NULL key."""
    marked = _mark_repeated(df, key, "_repeated", policy)
    return marked.filter("_repeated").select(*df.columns)


def evaluate(df: DataFrame, rules: Sequence[Rule], as_of: datetime | None = None) -> DataFrame:
    """The suite's results, one row per rule.

    Columns: ``rule_id, column, category, severity, evaluated, failed, success``.
    """

    def labels(rule: Rule) -> list[Column]:
        return [
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.column).alias("column"),
            F.lit(rule.category).alias("category"),
            F.lit(rule.severity).alias("severity"),
        ]

    row_rules = [r for r in rules if r.kind != "unique"]
    counted = []
    if row_rules:
        totals = df.agg(
            *[_evaluated(r).alias(f"evaluated_{i}") for i, r in enumerate(row_rules)],
            *[
                F.count_if(_row_failure(r, as_of)).alias(f"failed_{i}")
                for i, r in enumerate(row_rules)
            ],
        )
        per_rule = [
            F.struct(
                *labels(r),
                F.col(f"evaluated_{i}").alias("evaluated"),
                F.col(f"failed_{i}").alias("failed"),
            )
            for i, r in enumerate(row_rules)
        ]
        counted.append(totals.select(F.inline(F.array(*per_rule))))
    for rule in rules:
        if rule.kind == "unique":
            n = F.col("count")
            counted.append(
                df.filter(F.col(rule.column).isNotNull())
                .groupBy(rule.column)
                .count()
                .agg(
                    F.coalesce(F.sum(n), F.lit(0)).alias("evaluated"),
                    F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("failed"),
                )
                .select(*labels(rule), "evaluated", "failed")
            )
    results = reduce(DataFrame.unionByName, counted)
    return results.withColumn("success", F.col("failed") == 0)


def suite_success(results: DataFrame) -> DataFrame:
    """One row: did all rules pass, and did all stop-level rules pass."""
    stops = F.when(F.col("severity") == STOP, F.col("success"))
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.coalesce(F.bool_and(stops), F.lit(True)).alias("may_proceed"),
    )


def gate(results: DataFrame, layer: str) -> list:
    """Raise if a stop-level rule failed; return the results (one row per rule)."""
    rows = results.collect()
    if any(r["severity"] == STOP and not r["success"] for r in rows):
        raise QualityGateError(layer, rows)
    return rows


def with_failed_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``failed_rules``, the ids of the rules each row breaks, in suite order."""
    marked, reasons, helpers = df, [], []
    for i, rule in enumerate(rules):
        if rule.kind == "unique":
            helper = f"_repeated_{i}"
            marked = _mark_repeated(marked, rule.column, helper, policy)
            helpers.append(helper)
            broken = F.col(helper)
        else:
            broken = _row_failure(rule, as_of)
        reasons.append(F.when(broken, F.lit(rule.rule_id)))
    failed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return marked.withColumn("failed_rules", failed).drop(*helpers).select(
        *df.columns, "failed_rules"
    )


def screened(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``failed_rules`` and ``outcome``: ``held`` if a stop-level rule is broken."""
    stops = F.array(*[F.lit(r.rule_id) for r in rules if r.severity == STOP])
    held = F.arrays_overlap("failed_rules", stops.cast("array<string>"))
    return with_failed_rules(df, rules, as_of, policy).withColumn(
        "outcome", F.when(held, HELD).otherwise(ACCEPTED)
    )


def quarantine(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Rows that break a stop-level rule, with all the rules they break."""
    rows = screened(df, rules, as_of, policy)
    return rows.filter(F.col("outcome") == HELD).drop("outcome")


def accepted(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Rows that break no stop-level rule: the complement of ``quarantine``."""
    rows = screened(df, rules, as_of, policy)
    return rows.filter(F.col("outcome") == ACCEPTED).select(*df.columns)


def schema_check(
    df: DataFrame, contract: T.StructType, mandatory: Sequence[str] = ()
) -> DataFrame:
    """Compare a table with its contract, column by column.

    Columns: ``column_name, expected_type, actual_type, status, null_count``.
    Status is ``ok``, ``missing``, ``wrong_type``, ``unexpected``, or
    ``null_values`` for a mandatory column that holds NULLs. NULLs are counted
    in the mandatory columns only, in one pass.
    """
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counted = [c for c in mandatory if c in actual]
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in counted],
    )
    rows = []
    for name in [*expected, *[c for c in actual if c not in expected]]:
        nulls = F.col(f"_nulls_{name}") if name in counted else F.lit(None).cast("long")
        if name not in actual:
            status = F.lit("missing")
        elif name not in expected:
            status = F.lit("unexpected")
        elif actual[name] != expected[name]:
            status = F.lit("wrong_type")
        elif name in counted:
            status = F.when(nulls > 0, "null_values").otherwise("ok")
        else:
            status = F.lit("ok")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(expected.get(name)).cast("string").alias("expected_type"),
                F.lit(actual.get(name)).cast("string").alias("actual_type"),
                status.alias("status"),
                nulls.alias("null_count"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL key has no parent."""
    known = parents.select(F.col(parent_key).alias("_parent")).filter(
        F.col("_parent").isNotNull()
    )
    return df.filter(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_parent"), "left_anti"
    )
