"""File readers: day-slice Parquet scans, tolerant JSON lines, extended JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions import unify_extended


def read_partition(spark: SparkSession, root: str, part_col: str, value, schema=None) -> DataFrame:
    """One partition of a ``partitionBy`` table: the filter becomes a ``PartitionFilters`` prune."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(root).filter(F.col(part_col) == F.lit(value))


def require_rows(df: DataFrame, what: str, required: bool = True) -> bool:
    """Presence check of an input slice: ``False`` when empty and optional, error when required.

    Only one row is ever fetched (``limit(1)``), whatever the slice size.
    """
    present = not df.isEmpty()
    if not present and required:
        raise FileNotFoundError(f"required input is empty: {what}")
    return present


def read_jsonl_tolerant(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines with a fixed schema; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_extended_json(spark: SparkSession, path: str, schema, id_col: str = "_id",
                       date_cols: tuple[str, ...] = (), multi_line: bool = True) -> DataFrame:
    """JSON (arrays per file, or JSON lines) whose ids / dates may be plain or ``$oid`` / ``$date`` wrapped.

    Mixed fields are read as text (an object arrives as its JSON text) and
    unified to the plain value.
    """
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    out = df.withColumn(id_col, unify_extended(F.col(id_col), "$oid"))
    for c in date_cols:
        out = out.withColumn(c, unify_extended(F.col(c), "$date"))
    return out
