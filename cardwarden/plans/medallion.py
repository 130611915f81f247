"""The batch run: land, gate, refine, gate, alert, aggregate.

Each layer is computed once, written, and read back by what follows, so no plan
is run twice and a lost executor repeats at most one layer's tasks. Running the
same input again gives the same tables.

The lake lives through many deliveries. Silver and everything after it is kept by day.
A delivery covers the days of its rows, the days that Silver has of its files, and the
days where its transaction ids lie now; it replaces those days, the emptied ones too, and
reads no others. What is derived from a customer's sequence changes on the covered days
and in that customer's next row after them, so beyond the covered days only the days of
such rows are rewritten.

A run may fail anywhere and be repeated. The days that Silver has of a file are noted before
they change, and so are the customers and days that a delivery touches; the second note
is kept until everything that depends on it has been written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions import parse_timestamp
from cardwarden.operators import devices, fraud, gold, quality, silver
from cardwarden.operators.skew import DEFAULT_SKEW, SkewPolicy
from cardwarden.session import stored
from cardwarden.sources import (
    days_of,
    drop_table,
    existing,
    land_profiles,
    land_transactions,
    partition_days,
    read_or_empty,
    read_partitions,
    read_table,
    replace_days,
    replace_files,
    write_flat,
    write_partitions,
)

BRONZE_GATE = quality.BRONZE_RULES + quality.TEXT_RULES
# Within a delivery the Bronze gate has proven ids unique, and Silver keeps the newest
# row of an id among the days that a delivery covers.
SILVER_GATE = tuple(r for r in quality.SILVER_RULES if r.kind != "unique")


@dataclass(frozen=True)
class Layout:
    """Where each table of a lake lies."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._at("bronze", "transactions")

    @property
    def silver(self) -> str:
        return self._at("silver", "transactions_refined")

    @property
    def profiles(self) -> str:
        return self._at("bronze", "profiles")

    @property
    def customer_state(self) -> str:
        """Each customer's last row of each day."""
        return self._at("silver", "customer_state")

    @property
    def customer_recent(self) -> str:
        """Each customer's last row of each of their latest days, in one compact table."""
        return self._at("silver", "customer_recent")

    @property
    def file_days(self) -> str:
        """The days that Silver has, or has had, of each delivered file."""
        return self._at("silver", "file_days")

    @property
    def id_days(self) -> str:
        """The day of each transaction id."""
        return self._at("silver", "id_days")

    @property
    def changes(self) -> str:
        """Customers and days that were touched and not yet carried through."""
        return self._at("silver", "changes")

    @property
    def kpi_daily(self) -> str:
        """Sums and counts by day and category, of which the KPIs are sums."""
        return self._at("gold", "kpi_daily")

    @property
    def fraud_alerts(self) -> str:
        return self._at("gold", "fraud_alerts")

    @property
    def bi_metrics(self) -> str:
        return self._at("gold", "dashboard_fraud_metrics")

    @property
    def category_kpis(self) -> str:
        return self._at("gold", "kpi_category_finance")

    @property
    def reward_eligible(self) -> str:
        return self._at("gold", "reward_eligible")

    def device_alerts(self, rule: str) -> str:
        return self._at("gold", "device_alerts", rule)

    def results(self, layer: str) -> str:
        return self._at("quality", "results", layer)

    def quarantine(self, layer: str) -> str:
        return self._at("quality", "quarantine", layer)


@dataclass(frozen=True)
class RunSummary:
    layout: Layout
    alert_count: int
    results: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Delivery:
    """Files that came together, by their keys."""

    id: str
    files: tuple[str, ...]


DAY = "dt"
_LANDING = ("source_path", "ingested_at", "source_file", "delivery", "failed_rules", DAY)
#: Latest days of a customer whose last rows the compact table keeps.
RECENT_DAYS = 4
_BUCKETS = 64


def _gate(
    spark: SparkSession,
    rows: DataFrame,
    rules: Sequence[quality.Rule],
    layer: str,
    layout: Layout,
    as_of: datetime | None,
    policy: SkewPolicy,
    hold: bool,
    delivery: Delivery,
) -> tuple[DataFrame, list]:
    """Add the suite's results; return the rows to go on with, and the results.

    If a stop-level rule fails, the rows that break one are held apart, in place of
    what was held of the same files before. The run then ends, unless ``hold`` lets
    it go on with the others.
    """
    if not rules:
        return rows, []
    results = quality.evaluate(rows, rules, as_of).coalesce(1)
    results = results.withColumn("delivery", F.lit(delivery.id))
    write_partitions(results, layout.results(layer), ["delivery"])
    mine = read_table(spark, layout.results(layer)).filter(F.col("delivery") == delivery.id)
    try:
        found = quality.gate(mine.drop("delivery"), layer)
    except quality.QualityGateError as failure:
        screened = stored(quality.screened(rows, rules, as_of, policy), "screened")
        outcome = F.col("outcome")
        held = screened.filter(outcome == quality.HELD).drop("outcome")
        replace_files(spark, held, layout.quarantine(layer), delivery.files, delivery.id)
        if not hold:
            raise
        passed = screened.filter(outcome == quality.ACCEPTED).select(*rows.columns)
        return passed, failure.results
    replace_files(spark, None, layout.quarantine(layer), delivery.files, delivery.id)
    return rows, found


def _content(rows: DataFrame) -> DataFrame:
    """Rows with a hash of what was delivered in them."""
    names = [c for c in rows.columns if c not in _LANDING]
    return rows.withColumn("_content", F.xxhash64(*sorted(names)))


def _not_held(spark: SparkSession, layout: Layout, rows: DataFrame) -> DataFrame:
    """Bronze rows without those that the gate has held."""
    held = existing(spark, layout.quarantine("bronze"))
    if held is None:
        return rows
    keys = _content(held).select("source_file", "_content").distinct()
    return _content(rows).join(keys, ["source_file", "_content"], "left_anti").drop("_content")


def land_and_gate(
    spark: SparkSession,
    transactions: str,
    layout: Layout,
    rules: Sequence[quality.Rule] = BRONZE_GATE,
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
    hold: bool = False,
) -> tuple[DataFrame, list, Delivery]:
    """Raw files to Bronze; return the delivered rows that may go on, and the results.

    Files may differ in their headers, but one without a column of the contract is an
    error before anything is landed. Only the delivered files' partitions are read back.
    """
    required = schemas.BRONZE.fieldNames()
    files = land_transactions(spark, transactions, layout.bronze, as_of, required)
    delivery = Delivery(uuid.uuid4().hex, tuple(files))
    rows = read_partitions(spark, layout.bronze, "source_file", files)
    if rows is None:  # nothing but empty files
        text = [*required, schemas.CORRUPT_RECORD, "source_file"]
        names = ", ".join(f"{name} string" for name in text)
        rows = spark.createDataFrame([], names)
    passed, results = _gate(
        spark, rows, rules, "bronze", layout, as_of, policy, hold, delivery
    )
    return passed, results, delivery


def _days_of_files(spark: SparkSession, layout: Layout, delivery: Delivery) -> set[date | None]:
    return days_of(read_partitions(spark, layout.file_days, "source_file", delivery.files), DAY)


def _note_files(spark: SparkSession, layout: Layout, rows: DataFrame, files: Iterable[str]) -> None:
    """Replace what is noted of the days that Silver has of these files."""
    noted = stored(rows.select("source_file", DAY).distinct(), "file_days")
    write_partitions(noted, layout.file_days, ["source_file"])
    gone = set(files) - days_of(noted, "source_file")
    replace_days(noted.filter(F.lit(False)), layout.file_days, "source_file", gone)


def _days_of_ids(
    spark: SparkSession, layout: Layout, rows: DataFrame, covered: set[date | None]
) -> set[date | None]:
    """The other days where the rows' transaction ids lie now.

    Of the index only the ids of days that are not covered are read.
    """
    index = existing(spark, layout.id_days)
    if index is None:
        return set()
    elsewhere = index.filter(~_within(covered)).join(
        rows.select("transaction_id").distinct(), "transaction_id", "left_semi"
    )
    return days_of(elsewhere, DAY)


def _within(days: Iterable[date | None]) -> Column:
    days = set(days)
    known = F.coalesce(F.col(DAY).isin(*[F.lit(d) for d in days if d is not None]), F.lit(False))
    return known | F.col(DAY).isNull() if None in days else known


def _by_day(spark: SparkSession, path: str, days: Iterable[date | None], name: str = DAY):
    return read_partitions(spark, path, name, days, "date")


def build_silver(
    spark: SparkSession,
    layout: Layout,
    rows: DataFrame | None = None,
    delivery: Delivery | None = None,
    rules: Sequence[quality.Rule] = SILVER_GATE,
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
    hold: bool = False,
) -> tuple[list, set[date | None]]:
    """The delivered rows, or all of Bronze that is not held, to Silver.

    Returns the gate's results and the covered days. Of rows with one id on these days
    the newest stays.
    """
    everything = rows is None or delivery is None
    if everything:
        rows = _not_held(spark, layout, read_table(spark, layout.bronze, merge=True))
        files = days_of(rows, "source_file")
        delivery = Delivery(uuid.uuid4().hex, tuple(sorted(files)))
    refined = silver.refine_enriched(rows, as_of, keep=["source_file"])
    refined = stored(refined.withColumn(DAY, F.to_date("transaction_date")), "refined")
    passed, results = _gate(
        spark, refined, rules, "silver", layout, as_of, policy, hold, delivery
    )
    if everything:
        before = partition_days(spark, layout.silver, DAY)
        covered = days_of(passed, DAY) | before
        noted = passed
    else:
        of_files = _days_of_files(spark, layout, delivery)
        covered = days_of(passed, DAY) | of_files
        covered |= _days_of_ids(spark, layout, passed, covered)
        # Until Silver has changed, what the files had before counts too.
        noted = passed.select("source_file", DAY)
        had = read_partitions(spark, layout.file_days, "source_file", delivery.files)
        noted = noted if had is None else noted.union(had.select("source_file", DAY))
    _note_files(spark, layout, noted, delivery.files)
    have = None if everything else _by_day(spark, layout.silver, covered)
    if have is not None:
        others = have.filter(~F.col("source_file").isin(*delivery.files))
        passed = passed.unionByName(others.select(*passed.columns))
    newest = [F.desc("ingested_at"), F.desc("transaction_date"), F.desc("source_file")]
    merged = stored(silver.latest_per_key(passed, ["transaction_id"], newest), "merged")
    last = silver.latest_per_key(merged, ["customer_id", DAY], _latest())
    last = stored(last.filter(F.col("customer_id").isNotNull()), "last")
    _note_changes(spark, layout, last, covered, delivery)
    replace_days(merged, layout.silver, DAY, covered)
    replace_days(merged.select("transaction_id", DAY), layout.id_days, DAY, covered)
    replace_days(last, layout.customer_state, DAY, covered)
    return results, covered


def _latest() -> list[Column]:
    return [F.desc("transaction_date"), F.desc("transaction_id")]


_CHANGE = "customer_id string, dt date"


def _note_changes(
    spark: SparkSession, layout: Layout, last: DataFrame, covered: set[date | None], delivery: Delivery
) -> None:
    """Note the covered days, and the customers who have or had rows on them."""
    touched = last.select("customer_id", DAY)
    before = _by_day(spark, layout.customer_state, covered)
    if before is not None:
        touched = touched.union(before.select("customer_id", DAY))
    days = spark.createDataFrame([(None, d) for d in covered], _CHANGE)
    noted = touched.union(days).distinct().withColumn("delivery", F.lit(delivery.id))
    write_partitions(noted, layout.changes, ["delivery"])


@dataclass(frozen=True)
class Affected:
    """What a delivery changes in what is derived from a customer's sequence."""

    days: frozenset  # covered, in full
    later: DataFrame  # customer_id, dt: the customers' next days after them
    later_days: frozenset
    earlier: DataFrame | None  # the customers' last rows before all these


@dataclass(frozen=True)
class Changed:
    """The notes of deliveries that are not yet carried through: customer_id, dt."""

    rows: DataFrame
    days: frozenset


def changes(spark: SparkSession, layout: Layout) -> Changed:
    """The noted customers and days, of this delivery and of any that failed before."""
    noted = read_or_empty(spark, layout.changes, _CHANGE)
    rows = stored(noted.select("customer_id", DAY).distinct(), "changed")
    return Changed(rows, frozenset(days_of(rows, DAY)))


def affected(spark: SparkSession, layout: Layout, changed: Changed) -> Affected:
    """Follow the noted changes to each touched customer's next and last rows.

    Days before the first covered one are read only for customers whose changes lie
    before what the compact table keeps of them.
    """
    days = changed.days
    known = [d for d in days if d is not None]
    if not known or not partition_days(spark, layout.customer_state, DAY) - days:
        none = spark.createDataFrame([], _CHANGE)
        return Affected(days, none, frozenset(), None)
    dated = changed.rows.filter(F.col("customer_id").isNotNull() & F.col(DAY).isNotNull())
    touched = dated.groupBy("customer_id").agg(F.min(DAY).alias("start"))
    touched = stored(touched, "touched")
    state = read_table(spark, layout.customer_state)
    unchanged = state.filter(F.col(DAY).isNotNull() & ~_within(days))
    active = unchanged.filter(F.col(DAY) > F.lit(min(known))).select("customer_id", DAY)
    active = active.join(touched.select("customer_id"), "customer_id", "left_semi")
    marks = dated.withColumn("active", F.lit(None).cast("date")).union(
        active.withColumn("active", F.col(DAY))
    )
    # From the last day backward, the least active day so far is the next one.
    after = Window.partitionBy("customer_id").orderBy(F.desc(DAY))
    following = F.min("active").over(after.rowsBetween(Window.unboundedPreceding, -1))
    later = marks.withColumn("next", following).filter(
        F.col("active").isNull() & F.col("next").isNotNull()
    )
    later = later.select("customer_id", F.col("next").alias(DAY)).distinct()
    later = stored(later, "later")
    names = state.columns
    recent = existing(spark, layout.customer_recent)
    if recent is None:
        earlier = unchanged.join(touched.select("customer_id"), "customer_id", "left_semi")
    else:
        mine = stored(recent.join(touched, "customer_id"), "recent")
        kept = mine.filter(F.col(DAY).isNotNull() & ~_within(days))
        beyond = (
            mine.groupBy("customer_id", "start")
            .agg(
                F.max("from_dt").alias("from_dt"),
                F.min(F.when(~_within(days), F.col(DAY))).alias("first"),
            )
            .filter(
                F.col("from_dt").isNotNull()
                & F.coalesce(F.col("first") >= F.col("start"), F.lit(True))
            )
        )
        beyond = stored(beyond.select("customer_id"), "beyond")
        earlier = kept.select(*names)
        if not beyond.isEmpty():
            earlier = earlier.join(beyond, "customer_id", "left_anti").unionByName(
                unchanged.join(beyond, "customer_id", "left_semi")
            )
    earlier = earlier.join(later, ["customer_id", DAY], "left_anti").select(*names)
    return Affected(days, later, frozenset(days_of(later, DAY)), earlier)


def _rewrite(
    spark: SparkSession, rows: DataFrame, path: str, name: str, change: Affected | None
) -> None:
    """Replace the covered days, and on later ones the rows of the customers affected.

    Without a change everything is replaced.
    """
    if change is None:
        replace_days(rows, path, name, partition_days(spark, path, name))
        return
    have = _by_day(spark, path, change.later_days, name)
    if have is not None:
        pairs = change.later.withColumnRenamed(DAY, name)
        have = have.join(pairs, ["customer_id", name], "left_anti")
        rows = rows.unionByName(have.select(*rows.columns))
    rows = stored(rows, "rewritten")
    replace_days(rows, path, name, change.days | change.later_days)


def build_fraud(
    spark: SparkSession,
    layout: Layout,
    preset: str = "strict",
    policy: SkewPolicy = DEFAULT_SKEW,
    changed: Changed | None = None,
) -> int:
    """Silver to alerts, BI metrics and reward eligibility; return the alert count.

    With ``changed``, only these notes are followed: the covered days, each touched
    customer's next day after them, and the last rows before. The count is that of
    the alerts among these. One pass flags the rows; alerts and eligible transactions
    are its two parts.
    """
    change = None if changed is None else affected(spark, layout, changed)
    if change is None:
        rows = read_table(spark, layout.silver).withColumn("_earlier", F.lit(False))
    else:
        table = read_table(spark, layout.silver)
        parts = [(table.filter(F.lit(False)), False)]
        parts.append((_by_day(spark, layout.silver, change.days), False))
        later = _by_day(spark, layout.silver, change.later_days)
        if later is not None:
            parts.append((later.join(change.later, ["customer_id", DAY], "left_semi"), False))
        parts.append((change.earlier, True))
        rows = None
        for part, earlier in parts:
            if part is not None:
                part = part.select(*table.columns).withColumn("_earlier", F.lit(earlier))
                rows = part if rows is None else rows.unionByName(part)
        # Finding large keys and ordering both read it.
        rows = stored(rows, "sequence")
    flagged = fraud.flag(fraud.travel_metrics(rows, policy), preset)
    flagged = stored(flagged.filter(~F.col("_earlier")), "flagged")
    found = fraud.alerts(flagged)
    _rewrite(spark, found, layout.fraud_alerts, "dt_particao", change)
    metrics = fraud.bi_metrics(found, keep=["dt_particao"])
    _rewrite(spark, metrics, layout.bi_metrics, "dt_particao", change)
    eligible = fraud.reward_eligible(flagged).select(*schemas.SILVER.fieldNames(), DAY)
    _rewrite(spark, eligible, layout.reward_eligible, DAY, change)
    return found.count()


def build_kpis(
    spark: SparkSession,
    layout: Layout,
    as_of: datetime | None = None,
    changed: Changed | None = None,
) -> None:
    """Category KPIs, one small file, as sums over a table by day and category.

    With ``changed`` only the days of these notes are aggregated anew; Silver is
    not read beyond them. Sums are decimals, so their order does not matter.
    """
    if changed is None:
        days = partition_days(spark, layout.kpi_daily, DAY)
        rows = read_table(spark, layout.silver)
    else:
        days = changed.days
        rows = _by_day(spark, layout.silver, days)
    if rows is None:
        rows = read_table(spark, layout.silver).filter(F.lit(False))
    daily = stored(gold.daily_category_sums(rows, DAY), "kpi_daily")
    replace_days(daily, layout.kpi_daily, DAY, days)
    sums = existing(spark, layout.kpi_daily)
    kpis = gold.kpis_from_sums(daily if sums is None else sums, as_of.date() if as_of else None)
    write_flat(kpis.coalesce(1), layout.category_kpis)


def _around(days: Iterable[date | None], reach: int) -> set[date | None]:
    """The days and those up to ``reach`` days from them."""
    near = {d + timedelta(days=i) for d in days if d for i in range(-reach, reach + 1)}
    return near | ({None} if None in days else set())


def build_device_alerts(
    spark: SparkSession,
    layout: Layout,
    profiles: str,
    as_of: datetime | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
    changed: Changed | None = None,
    profile_lines: bool = False,
) -> None:
    """Silver and profiles to the device, IP and city rules' alerts.

    A covered day can change the days beside it, with whose rows it may share a device
    or whose rows it may precede; these rules look at most one day away, so one day
    more is read and the covered days with those beside them are replaced.
    """
    files = land_profiles(spark, profiles, layout.profiles, as_of, not profile_lines)
    landed = read_partitions(spark, layout.profiles, "source_file", files)
    if landed is None:
        landed = spark.createDataFrame([], schemas.PROFILE)
    known = gold.one_profile_each(landed.select(*schemas.PROFILE.fieldNames()))
    known = stored(known, "profiles")
    enriched = read_table(spark, layout.silver)
    if changed is not None:
        replaced = _around(changed.days, 1)
        near = _by_day(spark, layout.silver, _around(changed.days, 2))
        enriched = enriched.filter(F.lit(False)) if near is None else near
        enriched = stored(enriched, "near")
    for rule, hits in {
        "unknown_device": devices.device_mismatch(enriched, known),
        "shared_device": devices.shared_key_events(enriched, "device_id", policy=policy),
        "shared_ip": devices.shared_key_events(enriched, "ip_address", policy=policy),
        "city_change": fraud.physical_city_changes(enriched, policy=policy),
    }.items():
        path = layout.device_alerts(rule)
        if changed is None:
            replaced = partition_days(spark, path, DAY)
        else:
            hits = hits.filter(_within(replaced))
        replace_days(stored(hits, rule), path, DAY, replaced)


def finish(spark: SparkSession, layout: Layout, changed: Changed) -> None:
    """Bring the compact table up to date and close the notes of a run that went through.

    The compact table has the last row of each of a customer's latest days, up to
    ``RECENT_DAYS``; nothing is left out from ``from_dt`` on, which is null for customers
    whose days are all there. Doing it again changes nothing.
    """
    days = changed.days
    dated = changed.rows.filter(F.col("customer_id").isNotNull() & F.col(DAY).isNotNull())
    touched = dated.select("customer_id").distinct()
    state = existing(spark, layout.customer_state)
    recent = existing(spark, layout.customer_recent)
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(_BUCKETS)).cast("int").alias("bucket")
    if state is not None:
        names = state.columns
        no_day = F.lit(None).cast("date")
        if recent is None:
            rows = state.filter(F.col(DAY).isNotNull()).withColumn("from_dt", no_day)
            buckets: set = set()
        else:
            buckets = days_of(touched.select(bucket), "bucket")
            recent = read_partitions(spark, layout.customer_recent, "bucket", buckets, "int")
            fresh = _by_day(spark, layout.customer_state, [d for d in days if d is not None])
            fresh = state.filter(F.lit(False)) if fresh is None else fresh
            fresh = fresh.select(*names)
            if recent is None:
                rows = fresh.withColumn("from_dt", no_day)
            else:
                bounds = recent.groupBy("customer_id").agg(F.max("from_dt").alias("from_dt"))
                fresh = fresh.join(bounds, "customer_id", "left").filter(
                    F.col("from_dt").isNull() | (F.col(DAY) >= F.col("from_dt"))
                )
                rows = fresh.select(*names, "from_dt")
                # A row without a day remembers the bound of a customer who has no day left.
                rows = rows.unionByName(recent.filter(~_within(days)).select(*rows.columns))
                bare = bounds.filter(F.col("from_dt").isNotNull())
                rows = rows.unionByName(bare, allowMissingColumns=True)
        newest = Window.partitionBy("customer_id").orderBy(F.desc_nulls_last(DAY))
        every = Window.partitionBy("customer_id")
        ranked = rows.withColumns(
            {"n": F.row_number().over(newest), "all": F.count(DAY).over(every)}
        ).filter((F.col("n") <= RECENT_DAYS) & (F.col(DAY).isNotNull() | (F.col("n") == 1)))
        least = F.when(F.col("all") > RECENT_DAYS, F.min(DAY).over(every))
        ranked = ranked.withColumn("from_dt", F.coalesce(least, F.max("from_dt").over(every)))
        ranked = stored(ranked.select(*names, "from_dt", bucket), "recent")
        replace_days(ranked, layout.customer_recent, "bucket", buckets)
    drop_table(spark, layout.changes)


def run(
    spark: SparkSession,
    transactions: str,
    out: str,
    profiles: str | None = None,
    *,
    bronze_rules: Sequence[quality.Rule] = BRONZE_GATE,
    silver_rules: Sequence[quality.Rule] = SILVER_GATE,
    preset: str = "strict",
    as_of: datetime | None = None,
    hold_bad_rows: bool = False,
    profile_lines: bool = False,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> RunSummary:
    """Run every layer over the transaction files, stopping at the first failed gate.

    Earlier deliveries are kept: the result is the same as if all files had come at
    once, in any order of deliveries. A file delivered again replaces its rows, and a
    day that loses its last row or alert becomes empty in every table. A run that failed
    is made good by running it again. Where two files hold the same id, the one that
    came last wins; if it then comes again without the id, the other file's row is back
    only when that file comes again or all of Bronze is refined.

    A failed gate keeps its results and the offending rows under ``quality/`` and
    raises ``QualityGateError``; nothing after it is written. ``hold_bad_rows``
    holds those rows back instead and goes on with the others. With ``profiles``,
    JSON arrays or with ``profile_lines`` a profile in each line, the device and IP
    rules run too.
    """
    layout = Layout(out)
    rows, bronze_results, delivery = land_and_gate(
        spark, transactions, layout, bronze_rules, as_of, policy, hold_bad_rows
    )
    silver_results, _ = build_silver(
        spark, layout, rows, delivery, silver_rules, as_of, policy, hold_bad_rows
    )
    changed = changes(spark, layout)
    alert_count = build_fraud(spark, layout, preset, policy, changed)
    build_kpis(spark, layout, as_of, changed)
    if profiles is not None:
        build_device_alerts(spark, layout, profiles, as_of, policy, changed, profile_lines)
    finish(spark, layout, changed)
    return RunSummary(layout, alert_count, {"bronze": bronze_results, "silver": silver_results})
