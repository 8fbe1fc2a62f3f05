"""Property tests: the text expressions agree with their Python definitions on generated text."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orelake import functions as OF

TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=30)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def run(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr).collect()]


# Scripts with and without case, cased symbols, digraphs, marks, digits and white space.
MIXED = st.text(alphabet="abcXYZ éÉñßǆǅ'-_ 3.\t中文ابⅠⅳⓐⒷΑλжЖ", max_size=20)


@SETTINGS
@given(st.lists(MIXED, min_size=1, max_size=40))
def test_title_case_property(spark, values):
    assert run(spark, OF.title_case("x"), values) == [v.title() for v in values]


@SETTINGS
@given(st.lists(MIXED, min_size=1, max_size=40))
def test_capitalize_property(spark, values):
    assert run(spark, OF.capitalize_first("x"), values) == [v.capitalize() for v in values]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_strip_property(spark, values):
    assert run(spark, OF.py_strip("x"), values) == [v.strip() for v in values]


def test_digits_pairs(spark):
    pairs = {"+216 20-1": "216201", "n/a": None, "": None, "٣3": "3", " 0 ": "0", "a1b2": "12"}
    assert run(spark, OF.digits_only("x"), list(pairs)) == list(pairs.values())


def test_truthy_pairs(spark):
    pairs = {"1": True, "true": True, "TRUE": True, " yes ": True, "Y\t": True, "no": False, "0": False, "": False,
             "  ": False, "maybe": False, "11": False, None: False}
    assert run(spark, OF.truthy("x"), list(pairs)) == list(pairs.values())


def test_nested_lists_are_strict(spark):
    pairs = {"['a']": [], "[{'courseId':'c1'}]": [], "[1,2] xyz": [], '{"a":1} xyz': [], '{"a":1} {"b":2}': [], "[1],[2]": [],
             "[1] ] x": [], '{"a":1},{"b":2}': [], "[1,2": [], "3": [], "": [], None: [], "[]": [], " [1, {\"a\": [2]}] ": ["1", '{"a":[2]}'],
             '{"a": 1}': ['{"a": 1}'], '["x", null]': ["x", None]}
    assert run(spark, OF.nested_to_list("x"), list(pairs)) == list(pairs.values())
