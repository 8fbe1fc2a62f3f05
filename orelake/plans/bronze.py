"""Bronze layer: document normalisation, provenance stamp, quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.functions import iso_z, unify_extended
from orelake.operators import lookup_email
from orelake.operators.health import list_files
from orelake.sources import student_documents, user_documents

def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def normalize_documents(docs: DataFrame, id_col: str = "_id",
                        date_cols: tuple[str, ...] = ("createdAt", "updatedAt")) -> DataFrame:
    """Document -> flat text row: ids unwrapped, dates as ISO-Z text, nested values as JSON text."""
    out = []
    for field in docs.schema.fields:
        name, dtype = field.name, field.dataType
        c = F.col(name)
        if name == id_col:
            c = unify_extended(c.cast("string"), "$oid")
        elif name in date_cols and isinstance(dtype, T.StringType):
            c = unify_extended(c, "$date")
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            c = iso_z(c, 6)
        elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(name))
    return docs.select(*out)


def stamp_bronze(df: DataFrame, batch_id, table_name: str, ds, ingested_at,
                 source: str = "watermark", operation: str = "UPSERT") -> DataFrame:
    """Provenance columns and the per-row quality flags (as JSON text).

    ``batch_id``, ``ds`` and ``ingested_at`` are literals for one run, or
    columns when many runs are stamped in one plan.
    """
    has_null_pk = F.col("_id").isNull() | (F.col("_id") == "")
    missing_upd = F.col("updatedAt").isNull() | (F.col("updatedAt") == "")
    return df.withColumns({
        "_operation": F.lit(operation),
        "_source": F.lit(source),
        "_ingested_at": _lit(ingested_at).cast("string"),
        "_batch_id": _lit(batch_id).cast("string"),
        "_table_name": F.lit(table_name),
        "_partition_key": _lit(ds).cast("string"),
        "_quality_flags": F.to_json(F.struct(has_null_pk.alias("has_null_pk"),
                                             missing_upd.alias("has_missing_updated_at"))),
    })


def bronze_students(spark: SparkSession, sf_dir: str, with_email: bool = False,
                    docs: DataFrame | None = None) -> DataFrame:
    """All bronze student rows of every day slice (``_partition_key``).

    ``with_email`` adds the user look-up; the silver projection drops it
    again, so the KPI plans leave it out.
    """
    docs = student_documents(spark, sf_dir) if docs is None else docs
    out = normalize_documents(docs)
    if with_email:
        out = lookup_email(out, user_documents(spark, sf_dir))
    out = stamp_bronze(out, F.col("batch_id"), "students", F.col("ingest_ds"), F.col("ingested_at"))
    return out.drop("ingest_ds", "ingested_at", "batch_id")


def batch_metadata(bronze: DataFrame, slice_col: str = "_partition_key") -> DataFrame:
    """Side-car counts per slice: record count and gate status, in one aggregate pass."""
    agg = bronze.groupBy(F.col(slice_col).alias("partition")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.first("_table_name", ignorenulls=True).alias("collection"),
        F.first("_source", ignorenulls=True).alias("source"))
    return agg.select("collection", "partition", "record_count", gate_status("record_count").alias("quality_status"), "source")


def gate_status(count) -> Column:
    """The two states of a batch's gate."""
    return F.when(F.col(count) > 0, F.lit("PASSED_7_POINT_GATE")).otherwise(F.lit("EMPTY_BATCH"))


def batch_sidecar(batch: DataFrame, collection: str, ds: str, batch_id: str, ingested_at: str,
                  files: DataFrame | None = None, source: str = "watermark") -> DataFrame:
    """The one-row side-car of a batch: counts, files and bytes written, status; an empty batch has a row too.

    ``files`` lists the files of the batch (file_path, file_size).
    """
    zero = F.lit(0).cast("long")
    parts = batch.agg(F.count(F.lit(1)).alias("r")).select("r", zero.alias("f"), zero.alias("b"))
    if files is not None:
        parts = parts.unionByName(files.agg(F.count(F.lit(1)).alias("f"), F.coalesce(F.sum("file_size"), zero).alias("b"))
                                  .select(zero.alias("r"), "f", "b"))
    n = parts.agg(F.sum("r").alias("record_count"), F.sum("f").alias("file_count"), F.sum("b").alias("total_size_bytes"))
    return n.select(F.lit(batch_id).alias("batch_id"), F.lit(collection).alias("collection"), F.lit(ds).alias("partition"),
                    "record_count", "file_count", "total_size_bytes",
                    gate_status("record_count").alias("quality_status"), F.lit(ingested_at).alias("ingested_at"),
                    F.lit(source).alias("source"))


def file_sizes(spark: SparkSession, path: str, slice_col: str) -> DataFrame:
    """Files, bytes per partition of a written Parquet layer, from one row per file."""
    files = list_files(spark, path).withColumn(
        slice_col, F.regexp_extract("file_path", f"/{slice_col}=([^/]*)/", 1))
    return files.groupBy(slice_col).agg(F.count(F.lit(1)).alias("file_count"),
                                        F.sum("file_size").cast("long").alias("total_size_bytes"))
