"""Column expressions: text cleaning and great-circle geometry."""

from cardwarden.functions.clean import (
    parse_amount,
    parse_timestamp,
    sentinel_to_null,
    source_or_null,
)
from cardwarden.functions.geo import haversine_km, speed_kmh

__all__ = [
    "haversine_km",
    "parse_amount",
    "parse_timestamp",
    "sentinel_to_null",
    "source_or_null",
    "speed_kmh",
]
