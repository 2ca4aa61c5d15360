"""Readers and writers: JSON, daily Parquet partitions, JDBC."""

from stocklake.sources.documents import read_split_array
from stocklake.sources.files import (
    latest_file,
    read_json_array,
    read_json_lines,
    read_key,
    read_latest_json_array,
    read_partition,
    read_table,
)
from stocklake.sources.jdbc import read_jdbc, write_jdbc
from stocklake.sources.payloads import (
    candle_envelope,
    candles_from_text,
    import_raw_candles,
    merge_fetches,
    rejected_payloads,
    union_sources,
    unnest_envelope,
)
from stocklake.sources.writers import (
    PACKED,
    append_key_ranges,
    append_table,
    export_all,
    export_rows,
    write_days,
    write_json_array,
    write_json_lines,
    write_partition,
)

__all__ = [
    "PACKED",
    "append_key_ranges",
    "append_table",
    "candle_envelope",
    "candles_from_text",
    "export_all",
    "export_rows",
    "import_raw_candles",
    "latest_file",
    "merge_fetches",
    "read_jdbc",
    "read_json_array",
    "read_json_lines",
    "read_key",
    "read_latest_json_array",
    "read_partition",
    "read_split_array",
    "read_table",
    "rejected_payloads",
    "union_sources",
    "unnest_envelope",
    "write_days",
    "write_jdbc",
    "write_json_array",
    "write_json_lines",
    "write_partition",
]
