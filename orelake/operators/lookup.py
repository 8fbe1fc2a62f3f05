"""E-mail look-up of students in the user collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.functions import py_strip


def email_by_key(users: DataFrame) -> DataFrame:
    """``(key, email)`` map from users, keyed by both ``userId`` and ``_id``.

    ``email`` is used when it is non-empty text, else ``mail``; the chosen
    value is stripped and dropped if blank.  The two key columns are stacked
    (UNION ALL) instead of joining on ``a = x OR b = x``, which would plan
    as a nested-loop join.  A key claimed by several users keeps the smallest
    address: an aggregate with map-side combine, safe for hot keys.
    """
    raw = F.when(F.col("email").isNull() | (F.col("email") == ""), F.col("mail")).otherwise(F.col("email"))
    cols = set(users.columns)
    if "mail" not in cols:
        users = users.withColumn("mail", F.lit(None).cast("string"))
    if "userId" not in cols:
        users = users.withColumn("userId", F.lit(None).cast("string"))
    base = users.select(F.col("userId").cast("string").alias("uid"),
                        F.col("_id").cast("string").alias("oid"),
                        py_strip(raw.cast("string")).alias("email"))
    base = base.filter(F.col("email").isNotNull() & (F.col("email") != ""))
    stacked = base.select(F.explode(F.array("uid", "oid")).alias("lookup_key"), "email")
    stacked = stacked.filter(F.col("lookup_key").isNotNull() & (F.col("lookup_key") != ""))
    return stacked.groupBy("lookup_key").agg(F.min("email").alias("email"))


def lookup_email(students: DataFrame, users: DataFrame, key_col: str = "userId") -> DataFrame:
    """Left join: every student row kept, ``email`` added where the stripped key matches.

    One pass over each side: the stacked users are joined once to the students.
    """
    keyed = students.withColumn("__lookup_key", py_strip(F.col(key_col).cast("string")))
    emails = email_by_key(users)
    out = keyed.join(emails, keyed["__lookup_key"] == emails["lookup_key"], "left")
    return out.drop("__lookup_key", "lookup_key")
