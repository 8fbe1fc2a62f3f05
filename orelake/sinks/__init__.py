"""Sinks and table maintenance: Parquet layers, partition replace, keyed upsert."""

from orelake.sinks.tables import (
    Commit,
    CommitConflict,
    ConstraintViolation,
    materialize,
    merge_upsert,
    partitions,
    table_exists,
    upsert,
    vacuum,
    read_current,
    read_tables,
    remove_orphans,
    replace_partition,
    scratch_copy,
    write_json_record,
    write_layer,
    write_version,
)

__all__ = ["Commit", "CommitConflict", "ConstraintViolation", "partitions", "read_tables", "remove_orphans",
           "scratch_copy", "table_exists", "upsert", "vacuum", "materialize", "merge_upsert", "read_current", "replace_partition",
           "write_json_record", "write_layer", "write_version"]
