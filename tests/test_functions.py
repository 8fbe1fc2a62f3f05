"""Column expressions against the dirty-value matrix (FIXTURES.md section 5)."""

import datetime as dt

from pyspark.sql import functions as F

from orelake import functions as OF


def one(spark, col_expr, values, ddl="x string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(col_expr).collect()]


def test_title_case_matches_python_title(spark):
    vals = ["o'neil-smith 3rd", "  élodie  DUPONT", "a--b", "mc'donald's", "straße", "", "x\ty"]
    assert one(spark, OF.title_case("x"), vals) == [v.title() for v in vals]
    assert one(spark, OF.title_case("x"), [None]) == [None]


def test_strip_removes_all_python_whitespace(spark):
    vals = ["  a b \t\n", " x　", "", "y"]
    assert one(spark, OF.py_strip("x"), vals) == [v.strip() for v in vals]


def test_capitalize_then_strip(spark):
    vals = ["AFRICA, NATION_1", "  nation_3", "", "x"]
    got = one(spark, OF.py_strip(OF.capitalize_first("x")), vals)
    assert got == [v.capitalize().strip() for v in vals]


def test_digits_only(spark):
    assert one(spark, OF.digits_only("x"), ["20xxxxxx", "+216 20-1", "xx", None]) == ["20", "216201", None, None]


def test_truthy(spark):
    got = one(spark, OF.truthy("x"), ["true", "yes", "Y", "1", "no", None, " y "])
    assert got == [True, True, True, True, False, False, True]


def test_nested_to_list_shapes(spark):
    vals = ["[]", '[{"a": 1}, {"b": 2}]', '{"a": 1}', "[1,", "", None, '[1,null,{"c":3}]', "text", "  [2] "]
    sizes = one(spark, F.size(OF.nested_to_list("x")), vals)
    assert sizes == [0, 2, 1, 0, 0, 0, 3, 0, 1]
    elems = one(spark, OF.nested_to_list("x"), ['[{"a": 1}]'])
    assert elems == [['{"a":1}']]


def test_unify_extended(spark):
    got = one(spark, OF.unify_extended("x", "$oid"), ['{"$oid": "abc"}', "plain", None])
    assert got == ["abc", "plain", None]


def test_city_split(spark):
    norm = OF.city_normalized("x")
    df = spark.createDataFrame([(v,) for v in ["a, b", "a", "a, b, c", "", None, " x , y "]], "x string")
    rows = df.select(norm.alias("n"), OF.city_part(norm).alias("c"), OF.region_part(norm).alias("r")).collect()
    assert [(r.n, r.c, r.r) for r in rows] == [
        ("A, B", "B", "A"), ("A", "A", "A"), ("A, B, C", "B", "A"), ("", "", ""),
        ("UNKNOWN", "UNKNOWN", "UNKNOWN"), ("X , Y", "Y", "X")]


def test_surrogate_and_event_keys(spark):
    import hashlib
    df = spark.createDataFrame([("s1", "c1", dt.datetime(2020, 1, 2, 3, 4, 5), 20200101)],
                               "s string, c string, t timestamp_ntz, k int")
    r = df.select(OF.surrogate_key(F.lit(None).cast("string")).alias("u"),
                  OF.event_key("s", "c", "t", "k").alias("e"),
                  OF.event_key("s", "c", F.lit(None).cast("timestamp_ntz"), "k").alias("f")).first()
    assert r.u == hashlib.md5(b"UNKNOWN").hexdigest()
    assert r.e == hashlib.md5(b"s1|c1|2020-01-02 03:04:05").hexdigest()
    assert r.f == hashlib.md5(b"s1|c1|20200101").hexdigest()


def test_parse_ts_each_value_on_its_own(spark):
    got = one(spark, OF.parse_ts("x"), ["2020-01-01T00:00:00.5Z", "2020-01-01T00:00:01Z", "", "bad", None])
    assert got == [dt.datetime(2020, 1, 1, 0, 0, 0, 500000), dt.datetime(2020, 1, 1, 0, 0, 1), None, None, None]


def test_percent_text_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 8), (2, 3), (0, 0), (5, 5), (1, 3)], "n long, d long")
    got = [r[0] for r in df.select(OF.percent_text("n", "d")).collect()]
    assert got == ["12.50%", "66.67%", "0.00%", "100.00%", "33.33%"]


def test_region_key(spark):
    assert one(spark, OF.region_key("x"), ["Middle-East", " middle east ", "Port_Saint'Anne", None]) == [
        "MIDDLEEAST", "MIDDLEEAST", "PORTSAINTANNE", ""]


def test_date_key_and_week(spark):
    from orelake.plans.gold import dim_date
    df = spark.createDataFrame([("2027-01-01",), ("2024-02-04",)], "_partition_key string")
    rows = {r.date_key: r for r in dim_date(df).collect()}
    assert rows[20270101].week_of_year == 53 and rows[20270101].day_of_week == 5
    assert rows[20240204].day_of_week == 0


def test_student_numbers_are_dense_and_stable(spark):
    from orelake.plans.gold import student_numbers
    ids = spark.createDataFrame([(f"s{i % 300}",) for i in range(900)] + [(None,)], "student_id string")
    first = student_numbers(ids, buckets=16)
    got = {r.student_id: r.number for r in first.collect()}
    assert sorted(got.values()) == list(range(1, 301)) and got == {r.student_id: r.number for r in student_numbers(ids.repartition(5), buckets=16).collect()}
    more = student_numbers(ids.unionByName(spark.createDataFrame([("new1",), ("new2",)], "student_id string")), first, 301, buckets=16)
    assert sorted(r.number for r in more.collect()) == [301, 302] and {r.student_id for r in more.collect()} == {"new1", "new2"}


def test_bitmaps_count_distinct_students_of_any_range(spark):
    import random

    from pyspark.sql import functions as F

    from orelake.plans import gold, kpi
    rng = random.Random(3)
    rows = [(20240101 + rng.randrange(5), f"k{rng.randrange(3)}", f"c{rng.randrange(4)}", f"s{rng.randrange(70_000)}") for _ in range(4000)]
    enrol = spark.createDataFrame(rows, "date_key int, city_key string, course_key string, student_id string")
    numbers = spark.range(70_000).selectExpr("concat('s', id) student_id", "id + 1 number")
    cities = spark.createDataFrame([("k0", "R0"), ("k1", "R1")], "city_key string, region_name string")
    courses = spark.createDataFrame([("c0", "C0")], "course_key string, course_name string")
    dates = spark.createDataFrame([(20240101 + i, i // 2) for i in range(5)], "date_key int, week int")
    bitmaps = gold.mv_course_students_bitmap(enrol, numbers, cities, courses)
    assert bitmaps.select("bucket").distinct().count() == 3
    region = {"k0": "R0", "k1": "R1", "k2": "UNKNOWN"}
    want = {}
    for d, k, c, s in rows:
        want.setdefault(((d - 20240101) // 2, region[k], c), set()).add(s)
    got = kpi.course_reach(bitmaps, dates, [F.col("week")], ["region_name", "course_key"]).collect()
    assert {(r.period_0, r.region_name, r.course_key): r.students_count for r in got} == {k: len(v) for k, v in want.items()}
    every = kpi.course_reach(bitmaps.filter("date_key < 20240104"), dates, [], ["course_key"]).collect()
    assert {r.course_key: r.students_count for r in every} == {c: len({s for d, _, x, s in rows if x == c and d < 20240104}) for c in ("c0", "c1", "c2", "c3")}


def test_bitmaps_hold_only_words_with_bits_and_merge_with_plain_ones(spark):
    from pyspark.sql import functions as F

    from orelake.plans import gold, kpi
    ids = [*range(1, 66), 70, 4000, 32767, 32768, 32769, 65536]
    rows = [(20240101, "k", f"c{i % 2}", f"s{i}") for i in ids] + [(20240101, "k", "one", "s40000")]
    enrol = spark.createDataFrame(rows, "date_key int, city_key string, course_key string, student_id string")
    numbers = spark.range(70_000).selectExpr("concat('s', id) student_id", "id number")
    cities = spark.createDataFrame([("k", "R")], "city_key string, region_name string")
    courses = spark.createDataFrame([("c0", "C0")], "course_key string, course_name string")
    dates = spark.createDataFrame([(20240101, 1), (20240102, 1)], "date_key int, week int")
    bitmaps = gold.mv_course_students_bitmap(enrol, numbers, cities, courses)
    assert [len(r.students) for r in bitmaps.filter("course_key = 'one'").collect()] == [10]
    plain = spark.range(50, 300).selectExpr("id number").groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("students"))
    plain = plain.selectExpr("20240102 date_key", "'R' region_name", "'c0' course_key", "'C0' course_name", "bucket", "students")
    got = kpi.course_reach(bitmaps.unionByName(plain), dates, [F.col("week")], ["course_key"]).collect()
    assert {r.course_key: r.students_count for r in got} == {
        "c0": len({i for i in ids if i % 2 == 0} | set(range(50, 300))), "c1": sum(i % 2 for i in ids), "one": 1}
