"""Driver contract: entry, registries, and every registered query of the library against its DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from orelake.catalog import QUERIES
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

# Queries that sort, with the columns (and direction) their rows come ordered by.
ORDER = {
    "kpi_daily_paid": [("date_value", 1)],
    "kpi_region_daily_paid": [("date_value", 1), ("region_name", 1)],
    "kpi_course_enrollment": [("date_value", 1), ("enrolled_students_count", -1)],
    "kpi_access_mix": [("events_count", -1)],
    "kpi_region_rank_latest": [("paid_rate_pct", -1), ("region_name", 1)],
    "kpi_region_table": [("date_value", -1), ("paid_rate_pct", -1), ("region_name", 1)],
    "kpi_top_courses_latest": [("enrolled_students_count", -1), ("course_name", 1), ("region_name", 1)],
    "bronze_incremental": [("updated_ts", 1), ("doc_seq", 1)],
}


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date_value", "region_name", "total_students", "paid_students", "paid_rate_pct"]


def test_every_query_of_the_library_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not set(QUERIES) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = oracle.execute(entry.oracle_sql()[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert rows and sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows)[1] == digest(cols, want)[1]
    if name in ORDER:
        def key(r):
            return [(-r[df.columns.index(c)] if d < 0 and not hasattr(r[df.columns.index(c)], "toordinal")
                     else -r[df.columns.index(c)].toordinal() if d < 0 else r[df.columns.index(c)]) for c, d in ORDER[name]]
        assert [key(r) for r in rows] == sorted(key(r) for r in rows)
