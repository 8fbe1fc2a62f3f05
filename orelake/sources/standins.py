"""Source collections of the course platform, derived from the provided tables.

The platform's own sources are a document store (students, users, courses)
and a course-event topic.  Here the same shapes are derived from the given
Parquet tables, so every plan's work grows with them:

* a student document version  = one ``orders`` row of customer ``o_custkey``
  (updated in the month of ``o_orderdate``; that month is its day slice);
  its city = ``region, nation``; its enrolments = the order's ``lineitem``
  rows with ``l_returnflag = 'A'`` (course = ``l_partkey``);
* a user = one ``customer`` row;
* a course = one ``part`` row; course events = a bootstrap event per part
  plus one update event per ``events`` row (course ``props.k``).

Dirty values the standardisation must survive (NULL / blank ids, extended
JSON wrappers, bad timestamps, blank cities, odd flags, key aliases inside
enrolments) are injected by fixed rules on the keys, never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions import iso_z
from orelake.session import table

# First day used as the ingest time of the course bootstrap.
COURSE_BOOTSTRAP_TS = "2023-12-31 00:00:00"
COURSE_TOPIC = "courses.events"


def _mod(col: str, n: int):
    return F.pmod(F.col(col), F.lit(n)) == 0


def _enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolment array per order: one element per ``'A'`` line of that order.

    The array is the document's own content; it is assembled once per order
    (``collect_list`` with partial aggregation), the group being the lines of
    one order.
    """
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "A")
    pk = F.col("l_partkey").cast("string")
    alias_row = _mod("l_linenumber", 4)
    element = F.struct(
        F.when(~alias_row, F.when(_mod("l_partkey", 50), F.lit(" ")).otherwise(pk)).alias("courseId"),
        F.when(alias_row, pk).alias("course_id"),
        iso_z("l_shipdate").alias("enrolledAt"),
        F.when(F.col("l_linestatus") == "O", iso_z(F.col("l_shipdate") + F.expr("INTERVAL 400 DAYS"))).alias("endAt"),
        F.when(F.col("l_quantity") <= 45,
               F.when(F.col("l_linestatus") == "F", F.lit("full")).otherwise(F.lit("trial"))).alias("accessType"),
        F.array().cast("array<string>").alias("progress"),
    )
    # sorted: the array content must not depend on the order rows arrive in
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(element)).alias("courses"))


def student_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Student document versions (typed like the store returns them: mixed encodings)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    # Plain joins: the planner's own exchanges may be coalesced, and split where a key is hot.
    base = (o.join(_enrolments(spark, sf_dir), "o_orderkey", "left")
             .join(c, F.col("o_custkey") == F.col("c_custkey"))
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))

    cust = F.col("o_custkey").cast("string")
    created = F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS")
    updated = F.expr("timestampadd(MILLISECOND, pmod(o_orderkey, 997) * 1000 + pmod(o_orderkey, 7) * 100, o_orderdate)")

    def date_text(ts, wrap_when):
        return F.when(wrap_when, F.concat(F.lit('{"$date": "'), iso_z(ts), F.lit('"}'))).otherwise(iso_z(ts))

    return base.select(
        F.col("o_orderkey").alias("doc_seq"),
        F.when(_mod("o_orderkey", 101), F.lit(None).cast("string"))
         .when(_mod("o_orderkey", 103), F.lit("  "))
         .when(_mod("o_custkey", 4), F.concat(F.lit('{"$oid": "'), cust, F.lit('"}')))
         .otherwise(cust).alias("_id"),
        F.when(_mod("o_custkey", 19), F.lit(None).cast("string"))
         .when(_mod("o_custkey", 3), F.concat(F.lit("acct-"), cust))
         .otherwise(cust).alias("userId"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Active"))
         .when(F.col("o_orderstatus") == "O", F.lit(" INACTIVE ")).alias("status"),
        F.when(_mod("o_custkey", 7), F.lit("n/a"))
         .otherwise(F.concat(F.lit("+216 "), F.col("c_nationkey").cast("string"), F.lit("-"),
                             F.lpad(F.pmod("o_custkey", F.lit(1000)).cast("string"), 3, "0"))).alias("phone"),
        F.replace(F.lower("c_name"), F.lit("#"), F.lit("'s ")).alias("name"),
        F.when(_mod("o_custkey", 13), F.lit(None).cast("string"))
         .when(_mod("o_custkey", 11), F.concat(F.lit("  "), F.lower("n_name")))
         .when(_mod("o_custkey", 17), F.concat_ws(", ", "r_name", "n_name", F.lit("Old")))
         .when(_mod("o_custkey", 23), F.lit(""))
         .otherwise(F.concat_ws(", ", "r_name", "n_name")).alias("city"),
        F.col("c_mktsegment").alias("educationLevel"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("true"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Yes"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(" y "))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("0")).alias("isContacted"),
        F.when(_mod("o_orderkey", 43), F.lit(None))
         .otherwise(F.coalesce(F.col("courses"), F.array())).alias("enrolledCourses"),
        F.array().cast("array<string>").alias("enrolledChapters"),
        F.lit(None).cast("array<string>").alias("boughtBooks"),
        F.when(_mod("o_orderkey", 31), F.lit("bad")).otherwise(date_text(created, F.pmod("o_custkey", F.lit(4)) == 1)).alias("createdAt"),
        F.when(_mod("o_orderkey", 29), F.lit(""))
         .when(_mod("o_orderkey", 37), iso_z(F.date_trunc("second", updated), 0))
         .otherwise(date_text(updated, F.pmod("o_custkey", F.lit(4)) == 2)).alias("updatedAt"),
        F.lit(0).alias("__v"),
        # ingest context of this version: slice (month) and arrival time
        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("ingest_ds"),
        F.when(_mod("o_orderkey", 41), F.lit(None).cast("string"))
         .otherwise(iso_z(F.col("o_orderdate") + F.expr("INTERVAL 26 HOURS"), 6)).alias("ingested_at"),
        F.concat(F.lit("batch-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("batch_id"),
    )


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User collection: one user per customer; some keyed by ``userId``, some e-mails blank or in ``mail``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key = F.col("c_custkey").cast("string")
    return c.select(
        key.alias("_id"),
        F.when(_mod("c_custkey", 3), F.concat(F.lit("acct-"), key)).alias("userId"),
        F.when(_mod("c_custkey", 7), F.lit("  "))
         .when(_mod("c_custkey", 5), F.lit(None).cast("string"))
         .otherwise(F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com"))).alias("email"),
        F.when(_mod("c_custkey", 5), F.concat(F.lit("alt."), key, F.lit("@example.org"))).alias("mail"),
        F.col("c_name").alias("firstName"),
    )


def course_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course collection: one course per part, with a 24-hex object id (ordered like the key)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.select(object_id("p_partkey").alias("_id"), F.col("p_name").alias("course_name"),
                    F.lit(COURSE_BOOTSTRAP_TS).alias("created_at"), F.lit(None).cast("string").alias("updated_at"))


def object_id(col: str):
    """24-hex-digit document id of a non-negative integer key; text order equals key order."""
    return F.lpad(F.lower(F.hex(F.col(col).cast("long"))), 24, "0")


def course_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course events as the topic delivers them (bronze stream rows before ingest stamping).

    Bootstrap: one ``upsert`` per course document, name under ``course_name``.
    Updates: one per ``events`` row for course ``props.k``; ``click`` events
    carry the name under ``title`` (the poll path), others under
    ``course_name``; the name includes the event type, so "last wins" is
    visible in the result.  ``_offset`` orders events within one ingest time.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    boot = part.select(
        F.concat(F.lit("boot-"), F.col("p_partkey").cast("string")).alias("event_id"),
        F.lit(COURSE_BOOTSTRAP_TS + "Z").alias("event_time"),
        F.col("p_partkey").cast("string").alias("course_id"),
        F.col("p_name").alias("course_name"),
        F.lit(None).cast("string").alias("title"),
        F.lit("upsert").alias("event_type"),
        F.lit(COURSE_BOOTSTRAP_TS).alias("created_at"),
        F.lit("").alias("updated_at"),
        F.lit(COURSE_BOOTSTRAP_TS + "Z").alias("_ingested_at"),
        F.col("p_partkey").cast("long").alias("_offset"),
    )
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")
    k = F.get_json_object("props", "$.k")
    ev = ev.join(part, k.cast("long") == F.col("p_partkey"), "left")
    name = F.concat_ws(" ", F.coalesce("p_name", F.lit("course")), F.concat(F.lit("("), F.col("event_type"), F.lit(")")))
    upd = ev.select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("event_id"),
        iso_z("ts", 6).alias("event_time"),
        F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(k).alias("course_id"),
        F.when(F.col("event_type") != "click", name).alias("course_name"),
        F.when(F.col("event_type") == "click", name).alias("title"),
        F.lit("upsert").alias("event_type"),
        F.lit(COURSE_BOOTSTRAP_TS).alias("created_at"),
        # every seventh update reports an older change time than it is delivered with
        iso_z(F.when(_mod("event_id", 7), F.col("ts") - F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts")), 6).alias("updated_at"),
        iso_z("ts", 6).alias("_ingested_at"),
        F.col("event_id").cast("long").alias("_offset"),
    )
    out = boot.unionByName(upd)
    return out.withColumns({"_topic": F.lit(COURSE_TOPIC), "_partition": F.lit(0),
                            "ingest_ds": F.substring("_ingested_at", 1, 10)})
