"""The whole lake as one lazy plan over the provided tables.

``silver_students`` / ``silver_courses`` / ``gold`` compose the stand-in
sources with the bronze, silver and gold builders.  Run time, batch id and
the ``as_of`` instant are fixed parameters, so every result is repeatable.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.plans import gold as G
from orelake.plans.bronze import bronze_students
from orelake.plans.silver import split_clean_quarantine, standardize_courses, standardize_students
from orelake.session import prepare_session
from orelake.sinks import materialize
from orelake.sources import course_events

# The run parameters of the reproducible build.
RUN_TS = "2024-02-01 00:00:00"
AS_OF = "1999-01-01 00:00:00"
SILVER_BATCH_ID = "silver-0001"
BRONZE_ROOT = "bronze/students"


def bronze_path_of(slice_col: str = "_partition_key"):
    """Lineage path of a bronze day slice, as a column."""
    return F.concat(F.lit(BRONZE_ROOT + "/"), F.col(slice_col))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised student rows of every day slice, before the split."""
    prepare_session(spark)
    return standardize_students(bronze_students(spark, sf_dir), RUN_TS, SILVER_BATCH_ID)


def silver_students(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) silver student tables of every day slice."""
    return split_clean_quarantine(standardized(spark, sf_dir), bronze_path_of(), RUN_TS)


def silver_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver courses: the last event per course in each ingest day."""
    prepare_session(spark)
    return standardize_courses(course_events(spark, sf_dir), "ingest_ds")


# Silver columns the gold facts and the city / date dimensions read.
CORE_COLUMNS = ["_partition_key", "entity_id", "city", "is_paid_student", "enrolled_courses"]


class Lake:
    """Silver and gold tables over the provided tables, built on first use.

    With ``shared=True`` the silver columns the facts and the city / date
    dimensions need are written once to the shared checkpoint folder and
    those tables read them back (the layered pipeline stores silver too);
    a plan with a single consumer keeps silver inline (``shared=False``),
    so column pruning reaches the source scans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, shared: bool = True):
        self.spark, self.sf_dir, self.shared = prepare_session(spark), sf_dir, shared

    @cached_property
    def silver_clean(self) -> DataFrame:
        """The full silver student table (profile columns for ``dim_student``)."""
        clean, _ = silver_students(self.spark, self.sf_dir)
        return clean

    @cached_property
    def silver_core(self) -> DataFrame:
        """The silver columns the facts and city / date dimensions need.

        Shared: written once to the checkpoint folder, so the fact, the
        dimensions and the enrolment fact of one plan read it instead of each
        recomputing silver; only these columns are computed for it.
        """
        core = self.silver_clean.select(*CORE_COLUMNS)
        return materialize(core, "silver_core") if self.shared else core

    @cached_property
    def silver_courses(self) -> DataFrame:
        return silver_courses(self.spark, self.sf_dir)

    @cached_property
    def dim_date(self) -> DataFrame:
        return G.dim_date(self.silver_core)

    @cached_property
    def dim_city(self) -> DataFrame:
        return G.dim_city(self.silver_core, RUN_TS)

    @cached_property
    def dim_course(self) -> DataFrame:
        # one newest-wins pass over all events equals "last per day, then latest day":
        # the ingest day is the date of the ingest time that orders the events.
        latest = standardize_courses(course_events(self.spark, self.sf_dir), None)
        return G.dim_course(latest, RUN_TS, order=(), unique=True)

    @cached_property
    def dim_student(self) -> DataFrame:
        return G.dim_student(self.silver_clean, RUN_TS)

    @cached_property
    def fact_student_daily(self) -> DataFrame:
        return G.fact_student_daily(self.silver_core, RUN_TS)

    @cached_property
    def mv_paid_students_daily(self) -> DataFrame:
        return G.mv_paid_students_daily(self.fact_student_daily, RUN_TS)

    @cached_property
    def fact_course_enrollment_event(self) -> DataFrame:
        return G.fact_course_enrollment_event(self.silver_core, AS_OF, RUN_TS)

    @cached_property
    def mv_course_enrollment_region_daily(self) -> DataFrame:
        # The mart counts distinct students; a repeated enrolment key is the same student,
        # course and city, so the mart reads the rows before the key de-duplication
        # (one sort and one shuffle less, same result).
        enrol = G.fact_course_enrollment_event(self.silver_core, AS_OF, RUN_TS, dedupe=False)
        return G.mv_course_enrollment_region_daily(enrol, self.dim_city, self.dim_course, RUN_TS)


def course_students(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(daily course bitmaps, date dimension) over every day slice; the bitmaps are written once, as the daily run does."""
    g = Lake(spark, sf_dir)
    enrol = G.fact_course_enrollment_event(g.silver_core, AS_OF, RUN_TS, dedupe=False)
    numbers = G.student_numbers(g.silver_core.select(F.col("entity_id").alias("student_id")))
    bitmaps = G.mv_course_students_bitmap(enrol, numbers, g.dim_city, g.dim_course)
    return materialize(bitmaps, "course_students"), g.dim_date


def gold(spark: SparkSession, sf_dir: str, shared: bool = True) -> Lake:
    """Lazily built gold tables over every day slice (attribute per table)."""
    return Lake(spark, sf_dir, shared)


def region_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary feature collections (GeoJSON-like text), one per region row.

    ``shapeName`` is written the way boundary files spell names
    (``Middle-East``), so matching needs the region-key normalisation.
    """
    from orelake.functions import capitalize_first
    from orelake.session import table
    r = table(spark, sf_dir, "region")
    name = capitalize_first(F.replace(F.lower("r_name"), F.lit(" "), F.lit("-")))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(name.alias("shapeName")).alias("properties"))
    doc = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    return r.select(F.to_json(doc).alias("geojson"))
