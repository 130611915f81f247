"""Table contracts, from raw text to serving tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_TEXT, _DOUBLE, _LONG = T.StringType(), T.DoubleType(), T.LongType()

CORRUPT_RECORD = "_corrupt_record"

BRONZE = _schema(
    tx_id=_TEXT,
    cust_id=_TEXT,
    tx_datetime=_TEXT,
    tx_amount=_TEXT,
    tx_category=_TEXT,
    channel=_TEXT,
    location_city=_TEXT,
    ip_address=_TEXT,
    device_id=_TEXT,
)

PROFILE = _schema(
    cust_id=_LONG,
    name=_TEXT,
    loyalty_tier=_TEXT,
    home_city=_TEXT,
    active_products=T.ArrayType(_TEXT),
    known_devices=T.ArrayType(_TEXT),
)

SILVER = _schema(
    transaction_id=_TEXT,
    customer_id=_TEXT,
    amount=_DOUBLE,
    transaction_date=T.TimestampType(),
    category=_TEXT,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    ingested_at=T.TimestampType(),
)

# Context the channel and device rules need, carried beside the Silver columns.
SILVER_ENRICHED = T.StructType(
    SILVER.fields
    + _schema(channel=_TEXT, location_city=_TEXT, ip_address=_TEXT, device_id=_TEXT).fields
)

ALERT = _schema(
    transaction_id=_TEXT,
    customer_id=_TEXT,
    transaction_date=T.TimestampType(),
    amount=_DOUBLE,
    category=_TEXT,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    dist_km=_DOUBLE,
    diff_seconds=_LONG,
    fraud_reason=_TEXT,
    dt_particao=T.DateType(),
)

BI_METRICS = _schema(
    customer_id=_TEXT,
    transaction_date=T.TimestampType(),
    amount=_DOUBLE,
    category=_TEXT,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    distancia_km=_DOUBLE,
    tempo_minutos=_DOUBLE,
    fraud_reason=_TEXT,
)

CATEGORY_KPI = _schema(
    category=_TEXT,
    total_revenue=_DOUBLE,
    transaction_volume=_LONG,
    calculation_date=T.DateType(),
)
