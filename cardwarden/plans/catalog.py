"""Registered queries over the given tables, each with its plain-SQL equivalent.

The SQL states what a query means on whole tables; the function builds the same
result from the library's operators. Distances and other transcendental results
are rounded, since two engines' maths libraries differ in the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import schemas, sources
from cardwarden.functions import (
    haversine_km,
    parse_amount,
    parse_timestamp,
    sentinel_to_null,
    speed_kmh,
)
from cardwarden.operators import devices, fraud, gold, history, quality, silver
from cardwarden.operators.sequence import with_previous
from cardwarden.plans import adapters, medallion
from cardwarden.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 2, 1)
ORDERS_AS_OF = datetime(2001, 1, 1)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        key = name or build.__name__
        QUERIES[key] = build
        ORACLE[key] = sql
        return build

    return register


# --- SQL building blocks -----------------------------------------------------

_EVENTS = """ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)"""

_TX = f"""{_EVENTS}, tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         value AS amount, ts AS transaction_date, event_type AS category,
         CASE WHEN k % 17 <> 0 THEN CAST((k % 10) * 10 - 45.0 AS DOUBLE) END AS latitude,
         CASE WHEN k % 17 <> 0 THEN CAST(floor(k / 10.0) * 20 - 90.0 AS DOUBLE) END AS longitude,
         CASE WHEN event_type = 'purchase' THEN 'Físico'
              WHEN event_type IN ('click', 'view') THEN 'App' ELSE 'Online' END AS channel,
         CASE WHEN event_type = 'purchase' THEN 'C' || (k % 20) END AS location_city,
         CASE WHEN event_type <> 'purchase' THEN '10.0.0.' || k END AS ip_address,
         CAST(k AS VARCHAR) AS device_id,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec
  FROM ev
)"""

_TX_TO_SECOND = _TX.replace("ts AS transaction_date", "date_trunc('second', ts) AS transaction_date")


def _metrics(tx: str = _TX) -> str:
    return f"""{tx}, seq AS (
  SELECT *, lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude,
         lag(sec) OVER w AS prev_time_unix
  FROM tx
  WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id)
), hav AS (
  SELECT *, least(1.0,
           power(sin(radians(prev_latitude - latitude) / 2), 2)
           + cos(radians(latitude)) * cos(radians(prev_latitude))
             * power(sin(radians(prev_longitude - longitude) / 2), 2)) AS h,
         sec - prev_time_unix AS diff_seconds,
         abs(sec - prev_time_unix) / 3600.0 AS time_diff_hours
  FROM seq
), met AS (
  SELECT *,
         CASE WHEN latitude IS NULL OR longitude IS NULL OR prev_latitude IS NULL
                   OR prev_longitude IS NULL
              THEN 0.0 ELSE 2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) END AS dist_km
  FROM hav
)"""


_TRAVEL_SQL = {
    "permissive": "dist_km >= 0 AND time_diff_hours >= 0",
    "distance_5km": "dist_km > 5 AND diff_seconds > 0",
    "strict": (
        "latitude IS NOT NULL AND longitude IS NOT NULL AND prev_latitude IS NOT NULL"
        " AND prev_longitude IS NOT NULL AND dist_km > 800 * time_diff_hours"
    ),
}


def _flagged(preset: str, tx: str = _TX) -> str:
    quick = "FALSE" if preset == "strict" else "diff_seconds >= 0 AND diff_seconds < 86400"
    return f"""{_metrics(tx)}, flagged AS (
  SELECT *, coalesce({_TRAVEL_SQL[preset]}, FALSE) AS is_impossible_travel,
         coalesce({quick}, FALSE) AS is_velocity_fraud
  FROM met
)"""


def _alerts(preset: str, tx: str = _TX) -> str:
    return f"""{_flagged(preset, tx)}, alerts AS (
  SELECT transaction_id, customer_id, transaction_date, amount, category, latitude, longitude,
         dist_km, diff_seconds,
         CASE WHEN is_impossible_travel AND is_velocity_fraud
              THEN 'IMPOSSIBLE_TRAVEL_AND_VELOCITY'
              WHEN is_impossible_travel THEN 'IMPOSSIBLE_TRAVEL'
              WHEN is_velocity_fraud THEN 'HIGH_VELOCITY' ELSE 'UNKNOWN' END AS fraud_reason,
         CAST(transaction_date AS DATE) AS dt_particao
  FROM flagged WHERE is_impossible_travel OR is_velocity_fraud
)"""


_ALERT_COLUMNS = (
    "transaction_id, customer_id, transaction_date, amount, category, latitude, longitude,"
    " round(dist_km, 2) AS dist_km, diff_seconds, fraud_reason, dt_particao"
)

_BRONZE = f"""{_EVENTS}, bronze AS (
  SELECT CASE WHEN k <> 13 THEN CAST(event_id AS VARCHAR) END AS tx_id,
         CAST(user_id AS VARCHAR) AS cust_id,
         CASE WHEN k = 9 THEN strftime(ts, '%d/%m/%Y')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tx_datetime,
         CASE WHEN k = 7 THEN 'abc'
              WHEN k = 8 THEN '1.' || replace(CAST(value AS VARCHAR), '.', ',')
              WHEN k % 2 = 1 THEN replace(CAST(value AS VARCHAR), '.', ',')
              ELSE CAST(value AS VARCHAR) END AS tx_amount,
         event_type AS tx_category,
         CASE WHEN event_type = 'purchase' THEN 'Físico'
              WHEN event_type IN ('click', 'view') THEN 'App' ELSE 'Online' END AS channel,
         CASE WHEN event_type = 'purchase' THEN 'C' || (k % 20) ELSE 'N/A' END AS location_city,
         CASE WHEN event_type = 'purchase' THEN 'N/A' ELSE '10.0.0.' || k END AS ip_address,
         CAST(k AS VARCHAR) AS device_id
  FROM ev
)"""

_PROFILES = f"""{_EVENTS}, used AS (
  SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds,
         list_sort(list(DISTINCT CAST(k AS VARCHAR)) FILTER (WHERE k < 50)) AS devices
  FROM ev GROUP BY user_id
), profiles AS (
  SELECT c_custkey + 15 AS cust_id, c_name AS name,
         CASE WHEN c_acctbal < 2500 THEN 'Bronze' WHEN c_acctbal < 5000 THEN 'Silver'
              WHEN c_acctbal < 7500 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
         'C' || c_nationkey AS home_city,
         coalesce(kinds, [c_mktsegment]) AS active_products,
         coalesce(devices, []) AS known_devices
  FROM customer LEFT JOIN used ON user_id = c_custkey
)"""

_TX_PROFILES = _TX + _PROFILES.removeprefix(_EVENTS)

_REPEATED = f"""{_TX}, repeated AS (
  SELECT * EXCLUDE (amount), amount, 1 AS version FROM tx
  UNION ALL
  SELECT * EXCLUDE (amount), amount + 1, 2 FROM tx WHERE category = 'error'
)"""

_RULE_ROWS = """rule_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CASE WHEN o_custkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CAST(floor(o_totalprice) AS BIGINT) - 20000 AS points_earned,
         CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'pending'
              ELSE 'void' END AS status,
         o_orderdate AS transaction_date
  FROM orders
)"""

_KPI_COLUMNS = """category, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue,
       count(transaction_id) AS transaction_volume"""


def _alert_output(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dist_km", F.round("dist_km", 2))


def _wall_clock(rows: DataFrame, *columns: str) -> DataFrame:
    """Zone-free timestamps, as the given tables hold them."""
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _metrics_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.travel_metrics(adapters.transactions(spark, sf_dir))


# --- Sources, landing, sinks -------------------------------------------------

_BRONZE_COLUMNS = (
    "tx_id, cust_id, tx_datetime, tx_amount, tx_category, channel, location_city,"
    " ip_address, device_id"
)


def _bronze_csv(spark: SparkSession, sf_dir: str, located: bool = False) -> str:
    path = scratch_path(spark, "transactions_csv")
    rows = (adapters.bronze_located if located else adapters.bronze)(spark, sf_dir)
    rows.write.option("header", True).csv(path)
    return path


@_query(f"WITH {_BRONZE} SELECT {_BRONZE_COLUMNS} FROM bronze")
def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sources.read_transactions_csv(spark, _bronze_csv(spark, sf_dir))
    return raw.select(*schemas.BRONZE.fieldNames())


@_query(
    f"""WITH {_TX} SELECT CAST(customer_id AS BIGINT) AS cust_id, amount AS tx_amount,
    category AS tx_category, latitude, CAST(device_id AS BIGINT) AS device_id FROM tx"""
)
def bronze_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sources.read_transactions_csv(spark, _bronze_csv(spark, sf_dir, True), infer=True)
    return raw.select(
        F.col("cust_id").cast("long").alias("cust_id"),
        "tx_amount",
        "tx_category",
        "latitude",
        F.col("device_id").cast("long").alias("device_id"),
    )


@_query(
    f"""WITH {_TX} SELECT transaction_id, customer_id, amount, transaction_date, category,
    latitude, longitude FROM tx"""
)
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    sources.write_flat(adapters.transactions(spark, sf_dir), path)
    return sources.read_table(spark, path).select(
        "transaction_id",
        "customer_id",
        "amount",
        "transaction_date",
        "category",
        "latitude",
        "longitude",
    )


def _profile_files(spark: SparkSession, sf_dir: str) -> str:
    """Profiles as JSON array files, one per 500 customers."""
    path = scratch_path(spark, "profiles_json")
    rows = adapters.profiles(spark, sf_dir)
    (
        rows.select(
            F.floor(F.col("cust_id") / 500).alias("part"), F.to_json(F.struct("*")).alias("row")
        )
        .groupBy("part")
        .agg(F.array_join(F.collect_list("row"), ",\n").alias("rows"))
        .select("part", F.concat(F.lit("["), "rows", F.lit("]")).alias("value"))
        .write.partitionBy("part")
        .text(path)
    )
    return path


@_query(
    f"""WITH {_PROFILES} SELECT cust_id, name, loyalty_tier, home_city,
    array_to_string(active_products, ',') AS active_products,
    array_to_string(known_devices, ',') AS known_devices FROM profiles"""
)
def profile_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = sources.read_profiles(spark, _profile_files(spark, sf_dir))
    return read.select(
        "cust_id",
        "name",
        "loyalty_tier",
        "home_city",
        F.array_join("active_products", ",").alias("active_products"),
        F.array_join("known_devices", ",").alias("known_devices"),
    )


@_query(
    f"""WITH {_PROFILES} SELECT cust_id, name, loyalty_tier, home_city,
    array_to_string(active_products, ',') AS active_products,
    array_to_string(known_devices, ',') AS known_devices FROM profiles"""
)
def profile_json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "profiles_lines")
    adapters.profiles(spark, sf_dir).write.json(path)
    read = sources.read_profiles(spark, path, multi_line=False)
    return read.withColumns(
        {c: F.array_join(c, ",") for c in ("active_products", "known_devices")}
    )


def _delivered(rows: DataFrame, folder: str) -> str:
    """Rows as files part-0.csv, part-1.csv, ...: the same names in every folder.

    Delivering to a folder again replaces its files.
    """
    spark = rows.sparkSession
    written = f"{folder}-written"
    spread = rows.repartition(4, "tx_id")
    spread.write.mode("overwrite").option("header", True).csv(written)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(path(written))]
    system.mkdirs(path(folder))
    names = sorted(n for n in names if n.startswith("part-"))
    for i in range(4):
        target = path(f"{folder}/part-{i}.csv")
        system.delete(target, False)
        if i < len(names):
            system.rename(path(f"{written}/{names[i]}"), target)
        else:  # Spark writes no file without rows but the first
            system.create(target).close()
    return folder


_LATER = "2024-01-15"


def _split(rows: DataFrame, column: str = "tx_datetime") -> tuple[DataFrame, DataFrame]:
    later = F.col(column) >= _LATER
    return rows.filter(~later), rows.filter(later)


@_query(f"WITH {_BRONZE} SELECT {_BRONZE_COLUMNS} FROM bronze")
def landing_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with files of the same names: all rows are kept."""
    root, landed = scratch_path(spark, "incoming"), scratch_path(spark, "bronze")
    rows = adapters.bronze(spark, sf_dir)
    even = F.pmod(F.xxhash64("tx_id"), F.lit(2)) == 0
    for name, part in (("a", rows.filter(even)), ("b", rows.filter(~even))):
        sources.land_transactions(spark, _delivered(part, f"{root}/{name}"), landed, AS_OF)
    return sources.read_table(spark, landed).select(*schemas.BRONZE.fieldNames())


def _both_deliveries(spark: SparkSession, sf_dir: str, repeat: bool = False) -> tuple[str, str]:
    """A lake after the earlier and the later days came one after the other."""
    root, lake = scratch_path(spark, "incoming"), scratch_path(spark, "lake")
    earlier, later = _split(adapters.bronze_located(spark, sf_dir))
    medallion.run(spark, _delivered(earlier, f"{root}/a"), lake, as_of=AS_OF)
    if repeat:
        later = later.union(earlier.filter(F.col("tx_category") == "error"))
    medallion.run(spark, _delivered(later, f"{root}/b"), lake, as_of=AS_OF)
    return root, lake


_SILVER_ROWS = "transaction_id, customer_id, amount, category, latitude, longitude"


@_query(
    f"""WITH {_TX_TO_SECOND}
SELECT way, transaction_id, customer_id, amount, category,
  CASE WHEN transaction_date >= DATE '{_LATER}' THEN latitude END AS latitude,
  CASE WHEN transaction_date >= DATE '{_LATER}' THEN longitude END AS longitude
FROM tx, (VALUES ('forward'), ('backward'), ('mixed')) AS ways(way)"""
)
def landing_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier files have no coordinates, later ones do: in both orders and in one folder."""
    bare, placed = _split(adapters.bronze_located(spark, sf_dir))
    bare = bare.drop("latitude", "longitude")
    found = None
    for way in ("forward", "backward", "mixed"):
        root, lake = scratch_path(spark, "incoming"), scratch_path(spark, "lake")
        layout = medallion.Layout(lake)
        a, b = _delivered(bare, f"{root}/in/a"), _delivered(placed, f"{root}/in/b")
        sources_of = {"forward": [a, b], "backward": [b, a], "mixed": [f"{root}/in/*"]}
        for folder in sources_of[way]:
            rows, _, delivery = medallion.land_and_gate(spark, folder, layout, as_of=AS_OF)
            medallion.build_silver(spark, layout, rows, delivery, as_of=AS_OF)
        table = sources.read_table(spark, layout.silver)
        table = table.select(F.lit(way).alias("way"), *_SILVER_ROWS.split(", "))
        found = table if found is None else found.unionByName(table)
    return found


@_query(
    f"""WITH {_alerts('strict', _TX_TO_SECOND.replace("FROM ev\n", "FROM ev WHERE event_id % 3 <> 0\n"))}
SELECT 'alert' AS output, transaction_id FROM alerts
UNION ALL SELECT 'silver', transaction_id FROM tx"""
)
def medallion_after_failed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery fails its gate and comes again with fewer rows: only these stay."""
    root, lake = scratch_path(spark, "incoming"), scratch_path(spark, "lake")
    rows = adapters.bronze_located(spark, sf_dir)
    medallion.run(spark, _delivered(rows, f"{root}/a"), lake, as_of=AS_OF)
    twice = rows.union(rows.filter(F.col("tx_category") == "error"))
    try:
        medallion.run(spark, _delivered(twice, f"{root}/a"), lake, as_of=AS_OF)
        raise AssertionError("the gate let repeated ids pass")
    except quality.QualityGateError:
        pass
    fewer = rows.filter(F.col("tx_id").cast("long") % 3 != 0)
    medallion.run(spark, _delivered(fewer, f"{root}/a"), lake, as_of=AS_OF)
    layout = medallion.Layout(lake)
    parts = [
        sources.read_table(spark, path).select(F.lit(output).alias("output"), "transaction_id")
        for output, path in (("alert", layout.fraud_alerts), ("silver", layout.silver))
    ]
    return parts[0].unionByName(parts[1])


@_query(
    f"""WITH {_TX_TO_SECOND}
SELECT transaction_id, CASE WHEN category = 'error' AND transaction_date < DATE '{_LATER}'
  THEN DATE '2024-03-01' ELSE CAST(transaction_date AS DATE) END AS day FROM tx"""
)
def silver_id_moved_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another file moves ids to a day that no delivery has touched: each stays once."""
    root, lake = scratch_path(spark, "incoming"), scratch_path(spark, "lake")
    rows = adapters.bronze_located(spark, sf_dir)
    medallion.run(spark, _delivered(rows, f"{root}/a"), lake, as_of=AS_OF)
    moved = _split(rows)[0].filter(F.col("tx_category") == "error")
    moved = moved.withColumn("tx_datetime", F.lit("2024-03-01 12:00:00"))
    later = datetime(2024, 3, 2)
    medallion.run(spark, _delivered(moved, f"{root}/b"), lake, as_of=later)
    table = sources.read_table(spark, medallion.Layout(lake).silver)
    return table.select("transaction_id", F.to_date("transaction_date").alias("day"))


_ALERT_KEYS = "transaction_id, customer_id, fraud_reason, dt_particao"


@_query(f"WITH {_alerts('strict', _TX_TO_SECOND)} SELECT {_ALERT_KEYS} FROM alerts")
def medallion_two_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of two deliveries are those of one."""
    layout = medallion.Layout(_both_deliveries(spark, sf_dir)[1])
    return sources.read_table(spark, layout.fraud_alerts).select(*_ALERT_KEYS.split(", "))


@_query(f"WITH {_TX_TO_SECOND} SELECT transaction_id, customer_id, amount, category FROM tx")
def silver_two_deliveries_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first delivery come again in the second and count once."""
    layout = medallion.Layout(_both_deliveries(spark, sf_dir, repeat=True)[1])
    silver_rows = sources.read_table(spark, layout.silver)
    return silver_rows.select("transaction_id", "customer_id", "amount", "category")


@_query(
    f"""WITH {_alerts('strict', _TX_TO_SECOND)}, kept AS (
  SELECT transaction_id FROM alerts WHERE dt_particao < DATE '{_LATER}'
)
SELECT 'alert' AS output, transaction_id FROM kept
UNION ALL SELECT 'eligible', transaction_id FROM tx
  WHERE transaction_id NOT IN (SELECT transaction_id FROM kept)"""
)
def alerts_corrected_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files come again without positions: their days lose every alert."""
    root, lake = _both_deliveries(spark, sf_dir)
    _, later = _split(adapters.bronze_located(spark, sf_dir))
    unknown = F.lit(None).cast("string")
    corrected = later.withColumns({"latitude": unknown, "longitude": unknown})
    medallion.run(spark, _delivered(corrected, f"{root}/b"), lake, as_of=AS_OF)
    layout = medallion.Layout(lake)
    parts = [
        sources.read_table(spark, path).select(F.lit(output).alias("output"), "transaction_id")
        for output, path in (("alert", layout.fraud_alerts), ("eligible", layout.reward_eligible))
    ]
    return parts[0].unionByName(parts[1])


@_query(f"WITH {_BRONZE} SELECT {_BRONZE_COLUMNS} FROM bronze WHERE tx_datetime < '{_LATER}'")
def landing_emptied_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come again without rows take their rows away."""
    root, landed = scratch_path(spark, "incoming"), scratch_path(spark, "bronze")
    earlier, later = _split(adapters.bronze(spark, sf_dir))
    for name, part in (("a", earlier), ("b", later), ("b", later.filter(F.lit(False)))):
        sources.land_transactions(spark, _delivered(part, f"{root}/{name}"), landed, AS_OF)
    return sources.read_table(spark, landed).select(*schemas.BRONZE.fieldNames())


@_query(f"WITH {_BRONZE} SELECT {_BRONZE_COLUMNS} FROM bronze")
def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files delivered twice leave one copy of every row."""
    files, landed = _bronze_csv(spark, sf_dir), scratch_path(spark, "bronze")
    sources.land_transactions(spark, files, landed, AS_OF)
    sources.land_transactions(spark, files, landed, AS_OF)
    return sources.read_table(spark, landed).select(*schemas.BRONZE.fieldNames())


def _stored_alerts(spark: SparkSession, sf_dir: str, preset: str = "distance_5km") -> str:
    path = scratch_path(spark, "fraud_alerts")
    found = fraud.fraud_alerts(adapters.transactions(spark, sf_dir), preset)
    sources.write_daily(found, path)
    return path


@_query(f"WITH {_alerts('distance_5km')} SELECT {_ALERT_COLUMNS} FROM alerts")
def alerts_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = sources.read_table(spark, _stored_alerts(spark, sf_dir))
    return _alert_output(stored.select(*schemas.ALERT.fieldNames()))


@_query(
    f"""WITH {_alerts('distance_5km')}
SELECT transaction_id, customer_id,
       CASE WHEN dt_particao >= DATE '2024-01-15' THEN amount * 2 ELSE amount END AS amount,
       fraud_reason, dt_particao
FROM alerts"""
)
def alerts_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write holding only the later days replaces those and no others."""
    path = _stored_alerts(spark, sf_dir)
    redone = fraud.fraud_alerts(adapters.transactions(spark, sf_dir), "distance_5km")
    redone = redone.filter(F.col("dt_particao") >= F.lit(date(2024, 1, 15)))
    sources.write_daily(redone.withColumn("amount", F.col("amount") * 2), path)
    return sources.read_table(spark, path).select(
        "transaction_id", "customer_id", "amount", "fraud_reason", "dt_particao"
    )


@_query(
    f"""WITH {_alerts('distance_5km')} SELECT fraud_reason, count(*) AS alert_count,
    round(sum(amount), 2) AS alert_amount FROM alerts GROUP BY fraud_reason"""
)
def alerts_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources.path_view(spark, "v_fraud_alerts", _stored_alerts(spark, sf_dir))
    return spark.sql(
        """SELECT fraud_reason, count(*) AS alert_count, round(sum(amount), 2) AS alert_amount
        FROM v_fraud_alerts GROUP BY fraud_reason"""
    )


@_query(
    f"""WITH {_alerts('distance_5km')} SELECT {_ALERT_COLUMNS} FROM alerts
    WHERE dt_particao BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""
)
def alerts_by_day_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dashboard's day range reads those days' directories only."""
    stored = sources.read_table(spark, _stored_alerts(spark, sf_dir))
    days = F.col("dt_particao").between(F.lit(date(2024, 1, 10)), F.lit(date(2024, 1, 12)))
    return _alert_output(stored.filter(days).select(*schemas.ALERT.fieldNames()))


@_query(
    f"""WITH {_metrics()} SELECT customer_id, transaction_id, round(dist_km, 2) AS dist_km,
    diff_seconds FROM met ORDER BY amount DESC, transaction_id LIMIT 5"""
)
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _metrics_of(spark, sf_dir).select(
        "customer_id",
        "transaction_id",
        F.round("dist_km", 2).alias("dist_km"),
        "diff_seconds",
        (-F.col("amount")).alias("descending"),
    )
    return sources.preview(top, ["descending", "transaction_id"], 5).drop("descending")


# --- Projections and scalar functions ----------------------------------------


@_query(
    f"""WITH {_BRONZE} SELECT tx_id AS transaction_id, cust_id AS customer_id,
    TRY_CAST(replace(tx_amount, ',', '.') AS DOUBLE) AS amount,
    TRY_CAST(tx_datetime AS TIMESTAMP) AS transaction_date, tx_category AS category,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
FROM bronze WHERE tx_id IS NOT NULL"""
)
def silver_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    refined = silver.refine(adapters.bronze(spark, sf_dir), AS_OF).drop("ingested_at")
    return _wall_clock(refined, "transaction_date")


@_query(
    f"""WITH {_BRONZE} SELECT tx_id, tx_amount,
    TRY_CAST(replace(tx_amount, ',', '.') AS DOUBLE) AS amount FROM bronze"""
)
def amount_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.bronze(spark, sf_dir).select(
        "tx_id", "tx_amount", parse_amount(F.col("tx_amount")).alias("amount")
    )


@_query(
    f"""WITH {_BRONZE} SELECT tx_id, tx_datetime,
    TRY_CAST(tx_datetime AS TIMESTAMP) AS transaction_date FROM bronze"""
)
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = adapters.bronze(spark, sf_dir).select(
        "tx_id", "tx_datetime", parse_timestamp(F.col("tx_datetime")).alias("transaction_date")
    )
    return _wall_clock(parsed, "transaction_date")


@_query(
    f"""WITH {_TX} SELECT 'present' AS source, transaction_id, latitude, longitude FROM tx
UNION ALL SELECT 'absent', transaction_id, NULL, NULL FROM tx"""
)
def geo_resilience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with and without coordinate columns refine to one schema."""
    raw = sources.read_transactions_csv(spark, _bronze_csv(spark, sf_dir, located=True))
    outputs = {"present": raw, "absent": raw.drop("latitude", "longitude")}
    refined = [
        silver.refine(rows, AS_OF).select(
            F.lit(label).alias("source"), "transaction_id", "latitude", "longitude"
        )
        for label, rows in outputs.items()
    ]
    return refined[0].unionByName(refined[1])


@_query(
    f"""WITH {_BRONZE} SELECT tx_id, nullif(location_city, 'N/A') AS location_city,
    nullif(ip_address, 'N/A') AS ip_address FROM bronze"""
)
def sentinel_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.bronze(spark, sf_dir).select(
        "tx_id",
        sentinel_to_null(F.col("location_city")).alias("location_city"),
        sentinel_to_null(F.col("ip_address")).alias("ip_address"),
    )


@_query(
    f"""WITH {_TX}, h AS (
  SELECT transaction_id, latitude, longitude, least(1.0,
           power(sin(radians(38.7223 - latitude) / 2), 2)
           + cos(radians(latitude)) * cos(radians(38.7223))
             * power(sin(radians(-9.1393 - longitude) / 2), 2)) AS h
  FROM tx)
SELECT transaction_id,
       CASE WHEN latitude IS NULL OR longitude IS NULL THEN 0.0
            ELSE round(2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)), 2) END AS dist_km
FROM h""",
    "haversine_km",
)
def distance_from_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every transaction from one fixed city."""
    away = haversine_km(
        F.col("latitude"), F.col("longitude"), F.lit(38.7223), F.lit(-9.1393)
    )
    return adapters.transactions(spark, sf_dir).select(
        "transaction_id", F.round(away, 2).alias("dist_km")
    )


@_query(
    f"""WITH {_metrics()} SELECT transaction_id, diff_seconds,
    round(CASE WHEN diff_seconds <> 0 THEN dist_km * 3600.0 / abs(diff_seconds) END, 2) AS speed_kmh
FROM met"""
)
def travel_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = speed_kmh(F.col("dist_km"), F.col("diff_seconds"))
    return _metrics_of(spark, sf_dir).select(
        "transaction_id", "diff_seconds", F.round(speed, 2).alias("speed_kmh")
    )


# --- Sequences and fraud rules -----------------------------------------------


@_query(
    f"""WITH {_metrics()} SELECT transaction_id, customer_id, prev_latitude, prev_longitude,
    prev_time_unix FROM met"""
)
def txn_prev_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_of(spark, sf_dir).select(
        "transaction_id", "customer_id", "prev_latitude", "prev_longitude", "prev_time_unix"
    )


@_query(
    f"""WITH {_metrics()} SELECT transaction_id, sec AS current_time_unix, diff_seconds,
    round(time_diff_hours, 6) AS time_diff_hours, round(diff_seconds / 60.0, 2) AS tempo_minutos
FROM met"""
)
def txn_time_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_of(spark, sf_dir).select(
        "transaction_id",
        "current_time_unix",
        "diff_seconds",
        F.round("time_diff_hours", 6).alias("time_diff_hours"),
        F.round(F.col("diff_seconds") / 60, 2).alias("tempo_minutos"),
    )


@_query(
    f"""WITH {_flagged('distance_5km')} SELECT transaction_id, is_impossible_travel,
    is_velocity_fraud, is_impossible_travel OR is_velocity_fraud AS is_fraud FROM flagged"""
)
def fraud_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.flag(_metrics_of(spark, sf_dir), "distance_5km").select(
        "transaction_id", "is_impossible_travel", "is_velocity_fraud", "is_fraud"
    )


def _preset_query(preset: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _alert_output(fraud.fraud_alerts(adapters.transactions(spark, sf_dir), preset))

    return build


for _key, _preset in {
    "fraud_alerts_permissive": "permissive",
    "fraud_alerts_5km": "distance_5km",
    "fraud_alerts_strict": "strict",
}.items():
    _query(f"WITH {_alerts(_preset)} SELECT {_ALERT_COLUMNS} FROM alerts", _key)(
        _preset_query(_preset)
    )


@_query(
    f"""WITH {_metrics()} SELECT transaction_id, customer_id, diff_seconds FROM met
    WHERE diff_seconds >= 0 AND diff_seconds < 86400"""
)
def velocity_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = fraud.flag(_metrics_of(spark, sf_dir), "distance_5km")
    return flagged.filter("is_velocity_fraud").select(
        "transaction_id", "customer_id", "diff_seconds"
    )


@_query(
    f"""WITH {_alerts('permissive')} SELECT customer_id, transaction_date, amount, category,
    latitude, longitude, round(dist_km, 2) AS distancia_km,
    round(diff_seconds / 60.0, 2) AS tempo_minutos, fraud_reason FROM alerts"""
)
def fraud_bi_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.bi_metrics(fraud.fraud_alerts(adapters.transactions(spark, sf_dir), "permissive"))


@_query(
    f"""WITH {_TX}, seq AS (
  SELECT *, lag(location_city) OVER w AS prev_city, sec - lag(sec) OVER w AS diff_seconds
  FROM tx WHERE channel = 'Físico'
  WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id))
SELECT transaction_id, customer_id, location_city, prev_city, diff_seconds FROM seq
WHERE location_city <> prev_city AND diff_seconds < 86400"""
)
def fraud_geo_physical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.physical_city_changes(adapters.transactions(spark, sf_dir)).select(
        "transaction_id", "customer_id", "location_city", "prev_city", "diff_seconds"
    )


@_query(
    f"""WITH {_alerts('strict')} SELECT transaction_id, customer_id, amount FROM tx
    WHERE transaction_id NOT IN (SELECT transaction_id FROM alerts)"""
)
def reward_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    eligible = fraud.reward_eligible(fraud.flag(fraud.travel_metrics(rows), "strict"))
    return eligible.select("transaction_id", "customer_id", "amount")


# --- Devices -----------------------------------------------------------------


@_query(
    f"""WITH {_TX_PROFILES}
SELECT t.transaction_id, t.customer_id, t.device_id,
       CASE WHEN p.cust_id IS NULL THEN 'NO_PROFILE' ELSE 'UNKNOWN_DEVICE' END AS device_status,
       'high' AS criticality
FROM tx t LEFT JOIN profiles p ON CAST(p.cust_id AS VARCHAR) = t.customer_id
WHERE t.channel IN ('Online', 'App')
  AND NOT coalesce(list_contains(p.known_devices, t.device_id), FALSE)"""
)
def device_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, known = adapters.transactions(spark, sf_dir), adapters.profiles(spark, sf_dir)
    return devices.device_mismatch(rows, known).select(
        "transaction_id", "customer_id", "device_id", "device_status", "criticality"
    )


def _shared_sql(key: str) -> str:
    return f"""WITH {_TX}
SELECT transaction_id, customer_id, {key} FROM tx a
WHERE EXISTS (SELECT 1 FROM tx b WHERE b.{key} = a.{key} AND b.customer_id <> a.customer_id
              AND b.sec BETWEEN a.sec - 600 AND a.sec + 600)"""


@_query(_shared_sql("device_id"))
def shared_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    return devices.shared_key_events(rows, "device_id").select(
        "transaction_id", "customer_id", "device_id"
    )


@_query(_shared_sql("ip_address"))
def shared_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    return devices.shared_key_events(rows, "ip_address").select(
        "transaction_id", "customer_id", "ip_address"
    )


@_query(
    f"""WITH {_TX}, seq AS (
  SELECT *, lag(transaction_id) OVER w AS prev_transaction_id,
         lag(customer_id) OVER w AS prev_customer_id, sec - lag(sec) OVER w AS gap_seconds
  FROM tx
  WINDOW w AS (PARTITION BY device_id ORDER BY transaction_date, transaction_id))
SELECT device_id, prev_transaction_id, prev_customer_id, transaction_id, customer_id, gap_seconds
FROM seq WHERE customer_id <> prev_customer_id AND gap_seconds <= 600"""
)
def shared_device_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.shared_key_pairs(adapters.transactions(spark, sf_dir), "device_id")


@_query(
    f"""WITH {_TX}, uses AS (SELECT DISTINCT device_id, customer_id, sec FROM tx), near AS (
  SELECT a.device_id, a.customer_id, a.sec, count(DISTINCT b.customer_id) AS n
  FROM uses a JOIN uses b ON b.device_id = a.device_id AND b.customer_id <> a.customer_id
   AND b.sec BETWEEN a.sec - 600 AND a.sec + 600
  GROUP BY a.device_id, a.customer_id, a.sec)
SELECT transaction_id, device_id, coalesce(n, 0) AS other_customers
FROM tx LEFT JOIN near USING (device_id, customer_id, sec)"""
)
def shared_device_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    return devices.shared_key_counts(rows, "device_id").select(
        "transaction_id", "device_id", "other_customers"
    )


_SNAPSHOTS = """snapshots AS (
  SELECT CAST(user_id AS VARCHAR) AS cust_id,
         CAST(date_trunc('week', ts) AS DATE) + 7 AS snapshot_date,
         list_sort(list(DISTINCT CAST(k AS VARCHAR))) AS known_devices,
         CASE WHEN count(DISTINCT k) > 1 THEN 'Gold' ELSE 'Silver' END AS loyalty_tier
  FROM ev GROUP BY ALL
), dated AS (
  SELECT t.*, s.snapshot_date, s.known_devices, s.loyalty_tier
  FROM tx t ASOF LEFT JOIN snapshots s
  ON s.cust_id = t.customer_id AND CAST(t.transaction_date AS DATE) >= s.snapshot_date
)"""


@_query(
    f"""WITH {_TX}, {_SNAPSHOTS}
SELECT transaction_id, customer_id, snapshot_date, loyalty_tier,
       array_to_string(known_devices, ',') AS known_devices FROM dated"""
)
def profile_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    dated = adapters.profile_snapshots(spark, sf_dir)
    return history.profiles_as_of(rows, dated, ["loyalty_tier", "known_devices"]).select(
        "transaction_id",
        "customer_id",
        "snapshot_date",
        "loyalty_tier",
        F.array_join("known_devices", ",").alias("known_devices"),
    )


@_query(
    f"""WITH {_TX}, {_SNAPSHOTS}
SELECT transaction_id, customer_id, device_id,
       CASE WHEN device_id IS NULL THEN 'NO_DEVICE' WHEN snapshot_date IS NULL THEN 'NO_PROFILE'
            ELSE 'UNKNOWN_DEVICE' END AS device_status, 'high' AS criticality
FROM dated WHERE channel IN ('Online', 'App')
  AND NOT coalesce(list_contains(known_devices, device_id), FALSE)"""
)
def device_mismatch_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    dated = adapters.profile_snapshots(spark, sf_dir)
    return devices.device_mismatch_as_of(rows, dated).select(
        "transaction_id", "customer_id", "device_id", "device_status", "criticality"
    )


# --- Aggregates and serving queries ------------------------------------------


@_query(
    f"""WITH {_TX} SELECT {_KPI_COLUMNS}, DATE '2024-02-01' AS calculation_date
FROM tx GROUP BY category"""
)
def kpi_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_kpis(adapters.transactions(spark, sf_dir), AS_OF.date())


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_kpis(adapters.transactions(spark, sf_dir), AS_OF.date())


@_query(
    f"""WITH {_TX} SELECT {_KPI_COLUMNS} FROM tx WHERE category IN ('purchase', 'signup')
GROUP BY category"""
)
def kpi_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = gold.kpis_for_categories(_kpis(spark, sf_dir), ["purchase", "signup"])
    return chosen.drop("calculation_date")


@_query(
    f"""WITH {_TX}, kpi AS (SELECT {_KPI_COLUMNS} FROM tx GROUP BY category), totals AS (
  SELECT round(coalesce(sum(total_revenue), 0.0), 2) AS total_revenue,
         CAST(coalesce(sum(transaction_volume), 0) AS BIGINT) AS transaction_volume FROM kpi)
SELECT *, CASE WHEN transaction_volume > 0 THEN round(total_revenue / transaction_volume, 2)
               ELSE 0.0 END AS average_ticket
FROM totals"""
)
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.kpi_totals(_kpis(spark, sf_dir))


@_query("SELECT DISTINCT event_type AS category FROM events")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.distinct_categories(adapters.transactions(spark, sf_dir))


@_query("SELECT count(DISTINCT user_id) AS active_customers FROM events")
def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.active_customers(adapters.transactions(spark, sf_dir))


@_query(
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS week,
       count(DISTINCT user_id) AS exact_customers, TRUE AS within_error
FROM events GROUP BY 1"""
)
def active_customers_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir).withColumn("day", F.to_date("transaction_date"))
    week = F.trunc("day", "week").cast("date").alias("week")
    merged = gold.customers_from_sketches(gold.customer_sketches(rows, "day"), week)
    exact = rows.groupBy(week).agg(F.count_distinct("customer_id").alias("exact_customers"))
    error = F.abs(F.col("active_customers") - F.col("exact_customers"))
    within = error <= F.ceil(gold.SKETCH_ERROR * F.col("exact_customers"))
    return exact.join(merged, "week").select("week", "exact_customers", within.alias("within_error"))


@_query(f"WITH {_alerts('strict')} SELECT count(*) AS alert_count FROM alerts")
def alert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.alert_count(fraud.fraud_alerts(adapters.transactions(spark, sf_dir), "strict"))


@_query(
    f"""WITH {_alerts('strict')}, daily AS (
  SELECT dt_particao, count(*) AS n FROM alerts GROUP BY dt_particao)
SELECT d.dt_particao, d.n AS alert_count, p.n AS previous_count,
       round((d.n - p.n) * 100.0 / p.n, 2) AS pct_change
FROM daily d LEFT JOIN daily p ON p.dt_particao = d.dt_particao - INTERVAL 1 DAY"""
)
def alerts_daily_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fraud.fraud_alerts(adapters.transactions(spark, sf_dir), "strict")
    return gold.alerts_daily_change(found)


@_query(
    f"""WITH {_TX_PROFILES}
SELECT t.transaction_id, t.customer_id, p.loyalty_tier, p.home_city,
       array_to_string(p.active_products, ',') AS active_products
FROM tx t LEFT JOIN profiles p ON CAST(p.cust_id AS VARCHAR) = t.customer_id"""
)
def profile_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, known = adapters.transactions(spark, sf_dir), adapters.profiles(spark, sf_dir)
    return gold.enrich_with_profiles(rows, known).select(
        "transaction_id",
        "customer_id",
        "loyalty_tier",
        "home_city",
        F.array_join("active_products", ",").alias("active_products"),
    )


@_query(
    f"""WITH {_PROFILES} SELECT product, count(DISTINCT cust_id) AS customers
FROM (SELECT cust_id, unnest(active_products) AS product FROM profiles) GROUP BY product"""
)
def product_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_segments(adapters.profiles(spark, sf_dir))


# --- Data quality ------------------------------------------------------------


@_query(
    f"""WITH {_BRONZE}
SELECT 'tx_id' AS column_name, count(*) FILTER (WHERE tx_id IS NULL) AS null_count FROM bronze
UNION ALL SELECT 'cust_id', count(*) FILTER (WHERE cust_id IS NULL) FROM bronze
UNION ALL SELECT 'amount', count(*) FILTER
  (WHERE TRY_CAST(replace(tx_amount, ',', '.') AS DOUBLE) IS NULL) FROM bronze"""
)
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.bronze(spark, sf_dir)
    typed = rows.withColumn("amount", parse_amount(F.col("tx_amount")))
    return quality.null_counts(typed, ["tx_id", "cust_id", "amount"])


@_query(
    f"""WITH {_REPEATED} SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count FROM
  (SELECT count(*) AS n FROM repeated GROUP BY transaction_id)"""
)
def dq_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.with_repeats(adapters.transactions(spark, sf_dir))
    return quality.duplicate_count(rows, "transaction_id")


@_query(
    f"""WITH {_REPEATED} SELECT transaction_id, customer_id, amount, version FROM repeated
WHERE transaction_id IN (SELECT transaction_id FROM repeated GROUP BY 1 HAVING count(*) > 1)"""
)
def dq_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.with_repeats(adapters.transactions(spark, sf_dir))
    return quality.unique_violations(rows, "transaction_id").select(
        "transaction_id", "customer_id", "amount", "version"
    )


@_query(
    f"""WITH {_REPEATED} SELECT transaction_id, customer_id, amount, version FROM repeated
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY version DESC) = 1"""
)
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.with_repeats(adapters.transactions(spark, sf_dir))
    return silver.latest_per_key(rows, ["transaction_id"], [F.desc("version")]).select(
        "transaction_id", "customer_id", "amount", "version"
    )


def _rules_for_orders() -> tuple[quality.Rule, ...]:
    return quality.MATRIX[:-1] + (
        quality.Rule(
            "DQ-N03", "transaction_date", "date_between", quality.BUSINESS, lower="1996-01-01"
        ),
    )


# rule id, column, category, severity, rows looked at, rows that fail
_RULES_SQL = [
    ("DQ-F01", "transaction_id", "F", "stop", "count(*)", "transaction_id IS NULL"),
    ("DQ-F03", "customer_id", "F", "stop", "count(*)", "customer_id IS NULL"),
    ("DQ-N01", "points_earned", "N", "warn", "count(points_earned)", "points_earned < 0"),
    (
        "DQ-N02",
        "status",
        "N",
        "stop",
        "count(status)",
        "status NOT IN ('processed', 'pending', 'cancelled')",
    ),
    (
        "DQ-N03",
        "transaction_date",
        "N",
        "stop",
        "count(transaction_date)",
        "transaction_date < TIMESTAMP '1996-01-01' OR transaction_date > TIMESTAMP '2001-01-01'",
    ),
]

_SUITE_SQL = (
    f"WITH {_RULE_ROWS}, results AS ("
    + " UNION ALL ".join(
        f"SELECT '{i}' AS rule_id, '{c}' AS \"column\", '{g}' AS category, '{s}' AS severity,"
        f" {n} AS evaluated, count(*) FILTER (WHERE {bad}) AS failed FROM rule_rows"
        for i, c, g, s, n, bad in _RULES_SQL
    )
    + """ UNION ALL SELECT 'DQ-F02', 'transaction_id', 'F', 'stop',
  CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM rule_rows WHERE transaction_id IS NOT NULL
        GROUP BY transaction_id))
"""
)


@_query(_SUITE_SQL + "SELECT *, failed = 0 AS success FROM results")
def dq_suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.rule_matrix_rows(spark, sf_dir)
    return quality.evaluate(rows, _rules_for_orders(), ORDERS_AS_OF)


@_query(
    _SUITE_SQL
    + """SELECT bool_and(failed = 0) AS success,
       bool_and(failed = 0 OR severity <> 'stop') AS may_proceed FROM results"""
)
def dq_suite_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.rule_matrix_rows(spark, sf_dir)
    return quality.suite_success(quality.evaluate(rows, _rules_for_orders(), ORDERS_AS_OF))


def _one_rule(rule_id: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = next(r for r in _rules_for_orders() if r.rule_id == rule_id)
        rows = adapters.rule_matrix_rows(spark, sf_dir)
        broken = quality.with_failed_rules(rows, [rule], ORDERS_AS_OF)
        return broken.filter(F.size("failed_rules") > 0).select("transaction_id", rule.column)

    return build


for _key, _rule_id, _column in (
    ("dq_in_set", "DQ-N02", "status"),
    ("dq_date_between", "DQ-N03", "transaction_date"),
):
    _bad = next(r[5] for r in _RULES_SQL if r[0] == _rule_id)
    _query(
        f"WITH {_RULE_ROWS} SELECT transaction_id, {_column} FROM rule_rows WHERE {_bad}", _key
    )(_one_rule(_rule_id))


@_query(
    """SELECT 'DQ-N01' AS rule_id, 'c_acctbal' AS "column", 'N' AS category, 'warn' AS severity,
    count(c_acctbal) AS evaluated, count(*) FILTER (WHERE c_acctbal < 0) AS failed,
    count(*) FILTER (WHERE c_acctbal < 0) = 0 AS success FROM customer"""
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = quality.Rule(
        "DQ-N01", "c_acctbal", "between", quality.BUSINESS, quality.WARN, lower=0
    )
    return quality.evaluate(adapters.table(spark, sf_dir, "customer"), [rule])


@_query(
    f"""WITH {_BRONZE}, results AS (
  SELECT 'DQ-R02' AS rule_id, 'tx_amount' AS "column", 'F' AS category, 'warn' AS severity,
         count(tx_amount) AS evaluated, count(tx_amount) FILTER
           (WHERE TRY_CAST(replace(tx_amount, ',', '.') AS DOUBLE) IS NULL) AS failed
  FROM bronze
  UNION ALL SELECT 'DQ-R03', 'tx_datetime', 'F', 'warn', count(tx_datetime),
         count(tx_datetime) FILTER (WHERE TRY_CAST(tx_datetime AS TIMESTAMP) IS NULL)
  FROM bronze)
SELECT *, failed = 0 AS success FROM results"""
)
def dq_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text that does not convert."""
    rules = [r for r in quality.TEXT_RULES if r.column in schemas.BRONZE.fieldNames()]
    return quality.evaluate(adapters.bronze(spark, sf_dir), rules)


@_query(
    f"""WITH {_RULE_ROWS}, marked AS (
  SELECT *, concat_ws(',',
       CASE WHEN transaction_id IS NULL THEN 'DQ-F01' END,
       CASE WHEN count(transaction_id) OVER (PARTITION BY transaction_id) > 1 THEN 'DQ-F02' END,
       CASE WHEN customer_id IS NULL THEN 'DQ-F03' END,
       CASE WHEN points_earned < 0 THEN 'DQ-N01' END,
       CASE WHEN status NOT IN ('processed', 'pending', 'cancelled') THEN 'DQ-N02' END,
       CASE WHEN transaction_date < TIMESTAMP '1996-01-01'
              OR transaction_date > TIMESTAMP '2001-01-01' THEN 'DQ-N03' END) AS failed_rules
  FROM rule_rows)
SELECT transaction_id, customer_id, failed_rules FROM marked
WHERE failed_rules NOT IN ('', 'DQ-N01')"""
)
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.rule_matrix_rows(spark, sf_dir)
    held = quality.quarantine(rows, _rules_for_orders(), ORDERS_AS_OF)
    return held.select(
        "transaction_id", "customer_id", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@_query(
    f"""WITH {_BRONZE}, n AS (
  SELECT count(*) FILTER (WHERE tx_id IS NULL) AS ids,
         count(*) FILTER (WHERE cust_id IS NULL) AS customers FROM bronze)
SELECT * FROM (VALUES
  ('tx_amount', 'string', 'string', 'ok'), ('tx_category', 'string', 'string', 'ok'),
  ('channel', 'string', 'string', 'ok'), ('location_city', 'string', 'string', 'ok'),
  ('ip_address', 'string', NULL, 'missing'), ('device_id', 'string', 'int', 'wrong_type'),
  ('tx_datetime', 'string', 'string', 'ok'), ('points', NULL, 'double', 'unexpected'))
  v(column_name, expected_type, actual_type, status), (SELECT CAST(NULL AS BIGINT) AS null_count)
UNION ALL SELECT 'tx_id', 'string', 'string',
  CASE WHEN ids > 0 THEN 'null_values' ELSE 'ok' END, ids FROM n
UNION ALL SELECT 'cust_id', 'string', 'string',
  CASE WHEN customers > 0 THEN 'null_values' ELSE 'ok' END, customers FROM n"""
)
def dq_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.bronze(spark, sf_dir)
    altered = rows.drop("ip_address").withColumns(
        {"device_id": F.col("device_id").cast("int"), "points": F.lit(0.0)}
    )
    return quality.schema_check(altered, schemas.BRONZE, ["tx_id", "cust_id"])


@_query(
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey + 15 FROM customer)"""
)
def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer's number is not among the shifted ones."""
    parents = adapters.table(spark, sf_dir, "customer")
    parents = parents.select((F.col("c_custkey") + 15).alias("c_custkey"))
    children = adapters.table(spark, sf_dir, "orders")
    return quality.orphans(children, "o_custkey", parents, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


# --- Ties, and the whole run -------------------------------------------------


@_query(
    """SELECT o_orderkey, o_custkey, lag(o_orderkey) OVER w AS prev_orderkey,
    lag(o_totalprice) OVER w AS prev_price FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
)
def sequence_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-precision timestamps tie often; the key settles the order."""
    rows = adapters.table(spark, sf_dir, "orders")
    previous: dict[str, Column] = {
        "prev_orderkey": F.col("o_orderkey"),
        "prev_price": F.col("o_totalprice"),
    }
    return with_previous(rows, "o_custkey", ["o_orderdate", "o_orderkey"], previous).select(
        "o_orderkey", "o_custkey", "prev_orderkey", "prev_price"
    )


@_query(
    f"""WITH {_alerts('strict', _TX_TO_SECOND)}
SELECT 'silver' AS output, count(*) AS row_count, round(sum(amount), 2) AS amount FROM tx
UNION ALL SELECT 'fraud_alerts', count(*), round(sum(amount), 2) FROM alerts
UNION ALL SELECT 'bi_metrics', count(*), round(sum(amount), 2) FROM alerts
UNION ALL SELECT 'reward_eligible', count(*), round(sum(amount), 2) FROM tx
  WHERE transaction_id NOT IN (SELECT transaction_id FROM alerts)
UNION ALL SELECT 'category_kpis', count(DISTINCT category), round(sum(amount), 2) FROM tx"""
)
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to serving tables: rows and amounts of every output of the run."""
    files = _bronze_csv(spark, sf_dir, located=True)
    layout = medallion.run(spark, files, scratch_path(spark, "lake"), as_of=AS_OF).layout
    parts = []
    for output, path, amount in (
        ("silver", layout.silver, "amount"),
        ("fraud_alerts", layout.fraud_alerts, "amount"),
        ("bi_metrics", layout.bi_metrics, "amount"),
        ("reward_eligible", layout.reward_eligible, "amount"),
        ("category_kpis", layout.category_kpis, "total_revenue"),
    ):
        parts.append(
            sources.read_table(spark, path).agg(
                F.lit(output).alias("output"),
                F.count(F.lit(1)).alias("row_count"),
                F.round(F.sum(amount), 2).alias("amount"),
            )
        )
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first
