"""orelake: a Spark-native medallion pipeline and KPI library.

Bronze ingest, silver standardisation, a gold star schema and the business
KPIs of an online-course platform, expressed as lazily composed DataFrame
plans.  Every public builder takes and returns DataFrames, so Catalyst sees
one plan from the Parquet scans to the KPI.
"""

from orelake.session import prepare_session, scratch_path

__all__ = ["prepare_session", "scratch_path"]
