"""Reading raw and refined tables, landing raw files, writing outputs."""

from cardwarden.sources.landing import file_keys, land_profiles, land_transactions
from cardwarden.sources.readers import (
    path_view,
    preview,
    read_or_empty,
    read_profiles,
    read_table,
    read_transactions_by_header,
    read_transactions_csv,
)
from cardwarden.sources.sinks import (
    days_of,
    drop_table,
    existing,
    partition_days,
    read_partitions,
    replace_days,
    replace_files,
    write_daily,
    write_flat,
    write_partitions,
)

__all__ = [
    "days_of",
    "drop_table",
    "existing",
    "file_keys",
    "land_profiles",
    "land_transactions",
    "partition_days",
    "path_view",
    "preview",
    "read_or_empty",
    "read_partitions",
    "read_profiles",
    "read_table",
    "read_transactions_by_header",
    "read_transactions_csv",
    "replace_days",
    "replace_files",
    "write_daily",
    "write_flat",
    "write_partitions",
]
