"""Expressions on literal edge rows (54-58, 62, 65)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from quarry.operators import plan_string

from quarry.functions import (
    duration_min,
    duration_sec,
    first_letter_class,
    is_printable_word,
    parse_ntz,
    register_sql_functions,
    split_first,
    split_words,
)
from quarry.functions.geo import haversine_km


def test_haversine_known_pair(spark):
    # fixed values: a pair of points and its distance that the original jobs state as a check
    df = spark.createDataFrame([(-69.6518630981445, 42.982208251953125, -73.95278930664062, 40.80302047729492)],
                               "a double, b double, c double, d double")
    v = df.select(haversine_km("a", "b", "c", "d").alias("x")).first().x
    assert round(v, 6) == 430.551751


def test_haversine_equal_and_antipodal(spark):
    df = spark.createDataFrame([(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 180.0, 0.0), (30.0, 45.0, -150.0, -45.0)],
                               "a double, b double, c double, d double")
    vals = [r.x for r in df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()]
    assert vals[0] == 0.0
    assert math.isclose(vals[1], 6371 * math.pi, rel_tol=1e-12)
    assert math.isclose(vals[2], 6371 * math.pi, rel_tol=1e-9)
    assert not any(math.isnan(v) for v in vals)


def test_duration(spark):
    rows = [(dt.datetime(2015, 3, 8, 23, 54, 12), dt.datetime(2015, 3, 9, 0, 12, 35)),
            (dt.datetime(2015, 3, 8, 1, 0, 0), dt.datetime(2015, 3, 8, 1, 0, 0)),
            (dt.datetime(2015, 3, 9, 0, 0, 10), dt.datetime(2015, 3, 9, 0, 0, 0))]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    out = df.select(duration_sec("s", "e").alias("sec"), duration_min("s", "e").alias("m")).collect()
    assert [r.sec for r in out] == [1103, 0, -10]
    assert math.isclose(out[0].m, 1103 / 60)


def test_duration_ignores_session_zone_dst(spark):
    # 2024-03-10 is the spring-forward day in New York: two local hours apart stay 7200 s
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 3, 0))],
                                   "s timestamp_ntz, e timestamp_ntz")
        assert df.select(duration_sec("s", "e").alias("x")).first().x == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_printable_word(spark):
    cases = [("", False), (None, False), (" a", False), ("é", False), ("!", True), ("~x", True), ("a", True),
             ("\x7f", False)]
    df = spark.createDataFrame(cases, "w string, want boolean")
    got = df.select(is_printable_word("w").alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_first_letter_class(spark):
    cases = [("a", "A"), ("Z", "Z"), ("zoo", "Z"), ("7", "0Number"), ("#", "!Symbol"), ("~", "!Symbol")]
    df = spark.createDataFrame(cases, "w string, want string")
    got = df.select(first_letter_class("w").alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b ",), (None,)], "t string")
    rows = df.select(split_words("t", " ").alias("w")).collect()
    assert rows[0].w == ["a", "", "b", ""]
    assert rows[1].w is None
    assert df.select(F.explode(split_words("t", " "))).count() == 4


def test_split_first(spark):
    df = spark.createDataFrame([("1,a,b,c",), ("x",)], "t string")
    rows = df.select(split_first("t", ",").alias("p")).collect()
    assert rows[0].p == ["1", "a,b,c"]
    assert rows[1].p == ["x"]


def test_speed_by_ieee_division(spark):
    from quarry.functions.timefn import speed_ieee

    df = spark.createDataFrame([(10.0, 30.0), (5.0, 0.0), (0.0, 0.0), (None, 0.0), (5.0, -30.0)], "d double, m double")
    got = [r.s for r in df.select(speed_ieee("d", "m").alias("s")).collect()]
    assert got[0] == 20.0 and got[1] == float("inf") and got[2] != got[2] and got[3] is None and got[4] == -10.0


def test_parse_ntz(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",), ("2024-13-01 10:00:00",), (None,)], "s string")
    got = [r.t for r in df.select(parse_ntz("s").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0), None, None, None]


def test_sql_functions_match_column_expressions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(-73.9, 40.7, -74.0, 40.8, "word"), (-70.0, 46.0, -80.0, 40.0, "7x")],
                               "a double, b double, c double, d double, w string")
    df.createOrReplaceTempView("pts")
    sql = spark.sql("SELECT haversine(a, b, c, d) h, is_printable_word(w) p, first_letter_class(w) f FROM pts")
    col = df.select(haversine_km("a", "b", "c", "d").alias("h"), is_printable_word("w").alias("p"),
                    first_letter_class("w").alias("f"))
    assert sorted(sql.collect()) == sorted(col.collect())
    # SQL UDFs are inlined: no UDF operator in the plan
    assert "PythonUDF" not in plan_string(sql, "formatted")


def test_split_separator_is_literal(spark):
    df = spark.createDataFrame([("a|b.c||d",)], "t string")
    row = df.select(split_words("t", "|").alias("p"), split_words("t", ".").alias("d"),
                    split_words("t", "||").alias("m"), split_first("t", ".").alias("f")).first()
    assert row.p == ["a", "b.c", "", "d"]
    assert row.d == ["a|b", "c||d"]
    assert row.m == ["a|b.c", "d"]
    assert row.f == ["a|b", "c||d"]


def test_sql_speed_matches_column_expression(spark):
    from quarry.functions import speed_kmh

    register_sql_functions(spark)
    df = spark.createDataFrame([(10.0, 30.0), (5.0, 0.0), (None, 10.0)], "d double, m double")
    got = [r.s for r in spark.sql("SELECT speed_kmh(d, m) s FROM {df}", df=df).collect()]
    want = [r.s for r in df.select(speed_kmh("d", "m").alias("s")).collect()]
    assert got == want == [20.0, None, None]
