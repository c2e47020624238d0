"""Sources and sinks."""

from rankforge.sources.csv import (
    read_csv_skip_long,
    read_csv_strict_rows,
    read_csv_typed,
    read_feature_groups,
    read_many,
    read_table,
)
from rankforge.sources.sinks import (
    write_bucketed,
    write_csv,
    write_parquet,
    write_shards,
    write_single_csv,
)

__all__ = [
    "read_csv_skip_long", "read_csv_strict_rows", "read_csv_typed",
    "read_feature_groups", "read_many", "read_table", "write_bucketed", "write_csv",
    "write_parquet", "write_shards", "write_single_csv",
]
