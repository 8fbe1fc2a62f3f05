"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the session's time zone to UTC, the one setting that results depend on.

    It stays set: timestamps are rendered when a returned DataFrame is run,
    after this call.  Planner settings are left to the caller.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM, for listing and deleting whole folders in any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context).

    On a cluster it must be set.  In local mode, where driver and executors
    are one process, a temporary folder is set when there is none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orelake-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root.

    All scratch folders of an application are in one folder, which is deleted
    when the application ends.
    """
    own = f"{checkpoint_root(spark)}/orelake-{spark.sparkContext.applicationId}"
    fs, path = hadoop_path(spark, own)
    fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one provided Parquet table, as it is now.

    Files are listed at every call.  The schema is told from a footer (a job
    of its own) only where the file or folder has changed since it last was;
    stores that keep no time of change are asked each time.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, p = hadoop_path(spark, path)
    changed = fs.getFileStatus(p).getModificationTime() if fs.exists(p) else 0
    known = _SCHEMAS.get((path, changed))
    if known is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    if changed > 0:
        _SCHEMAS[path, changed] = df.schema
    return df
