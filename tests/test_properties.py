"""Property tests: Spark column functions against plain-Python semantics.

Each example is a batch of values evaluated in one Spark job.
"""

from urllib.parse import unquote_plus

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airshed.functions import country_of, decode_key, file_name, first_non_empty, starts_with_any

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.text(alphabet=st.sampled_from(list("ab,/ %+2F4c5CąșIăi\t.-_")), max_size=14)


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.o for r in df.select("i", expr(F.col("c")).alias("o")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_decode_key_matches_unquote_plus(spark, values):
    assert run(spark, values, decode_key) == [unquote_plus(v) for v in values]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_country_and_file_name(spark, values):
    assert run(spark, values, country_of) == [v.split(",")[-1].strip(" \t") for v in values]
    assert run(spark, values, file_name) == [v.split("/")[-1] for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)), min_size=1, max_size=30))
def test_first_non_empty_matches_python(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r.o for r in df.select("i", first_non_empty("a", "b").alias("o")).orderBy("i").collect()]

    def py(*vals):
        for v in vals:
            if v:
                return v.strip(" \t")
        return ""
    assert got == [py(a, b) for a, b in pairs]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_starts_with_any(spark, values):
    prefixes = ("a/", "b,", "%2")
    assert run(spark, values, lambda c: starts_with_any(c, prefixes)) == \
        [v.startswith(prefixes) for v in values]


NAMES = st.sampled_from(["Iasi", "Iași", "IASI", "Cluj", "iasi", None])


@SETTINGS
@given(st.lists(st.lists(st.tuples(NAMES, st.integers(0, 99)), max_size=5), min_size=1, max_size=20),
       st.booleans())
def test_first_match_is_the_first_hit_in_order(spark, responses, case_sensitive):
    from pyspark.sql import types as T
    from airshed.operators import first_match
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("info", T.ArrayType(
        T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())])))])
    df = spark.createDataFrame([(i, [{"name": a, "n": b} for a, b in r]) for i, r in enumerate(responses)],
                               schema)
    names = ["Iasi", "Iași"]
    got = [r.h for r in df.select("i", first_match("info", names, case_sensitive)["n"].alias("h"))
           .orderBy("i").collect()]

    def py(entries):
        for name, n in entries:
            if name is not None and (name in names if case_sensitive
                                     else name.lower() in [x.lower() for x in names]):
                return n
        return None
    assert got == [py(r) for r in responses]


KEYS = st.text(alphabet=st.sampled_from(list("ab/.")), max_size=8).map(lambda s: "p/" + s)


@SETTINGS
@given(st.lists(st.one_of(KEYS, st.sampled_from(["p/", "p", "q/x", "p//"])), min_size=1, max_size=30,
                unique=True))
def test_remap_plan_matches_listing_rule(spark, keys):
    from airshed.operators import remap_plan
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = sorted((r.key, r.dest_key) for r in remap_plan(df, "p/", "archive/").collect())
    exp = sorted((k, "archive/" + k[len("p/"):]) for k in keys
                 if k.startswith("p/") and not (k.endswith("/") and k == "p/"))
    assert got == exp
