"""Table operators, generic over column names."""

from stocklake.operators.clean import clean_rows, dedup_rows
from stocklake.operators.explode import (
    explode_distinct,
    explode_structs_outer,
    exploded_counts,
    split_explode,
    stage_marked,
)
from stocklake.operators.feeds import halve_minutes, label_windows
from stocklake.operators.incremental import CurrentVersions, KeyIndex, Ledger, load_dimension
from stocklake.operators.joins import (
    absent_from,
    denormalise,
    fanout_counts,
    lookup,
    not_in,
    within_bounds,
)
from stocklake.operators.keys import assign_keys, bucketed_keys, next_key
from stocklake.operators.latest import latest_by, latest_versions, top_rows
from stocklake.operators.quality import (
    column_bounds,
    file_counts,
    fk_violations,
    length_violations,
    not_null_violations,
    range_violations,
    table_counts,
    unique_violations,
)
from stocklake.operators.upsert import append_new, append_snapshot, insert_ignore

__all__ = [
    "column_bounds",
    "file_counts",
    "CurrentVersions",
    "KeyIndex",
    "Ledger",
    "absent_from",
    "append_new",
    "append_snapshot",
    "assign_keys",
    "bucketed_keys",
    "label_windows",
    "clean_rows",
    "dedup_rows",
    "denormalise",
    "explode_distinct",
    "explode_structs_outer",
    "exploded_counts",
    "fanout_counts",
    "fk_violations",
    "halve_minutes",
    "insert_ignore",
    "latest_by",
    "latest_versions",
    "length_violations",
    "load_dimension",
    "lookup",
    "next_key",
    "not_in",
    "not_null_violations",
    "range_violations",
    "split_explode",
    "stage_marked",
    "table_counts",
    "top_rows",
    "unique_violations",
    "within_bounds",
]
