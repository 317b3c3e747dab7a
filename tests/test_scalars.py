import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from clickloom.functions import (
    OCCUPATION_BUCKETS, OCCUPATION_BUCKETS_LITERAL, STAR_BUCKETS, STAR_BUCKETS_LITERAL, code_bucket, digamma,
    hash_unit, last_element, list_element, list_length, local_time, ratio, smoothed_rate, time_parts,
)


def column(spark, values, kind, *exprs):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_short_lists(spark):
    rows = column(spark, ["", "a", "a;b", "a;b;c"], "string",
                  list_length("x"), list_element("x", 1), list_element("x", 2), last_element("x"))
    assert rows == [(1, "", "", ""), (1, "", "", "a"), (2, "b", "", "b"), (3, "b", "c", "c")]


def test_code_sets(spark):
    codes = [-1, 3000, 3009, 3010, 3005, None]
    assert column(spark, codes, "int", code_bucket("x", STAR_BUCKETS)) == [(1,), (1,), (2,), (2,), (3,), (3,)]
    assert column(spark, codes, "int", code_bucket("x", STAR_BUCKETS_LITERAL)) == [(3,)] * 6
    codes = [-1, 2003, 2002, 2005]
    assert column(spark, codes, "int", code_bucket("x", OCCUPATION_BUCKETS)) == [(1,), (1,), (2,), (3,)]
    assert column(spark, codes, "int", code_bucket("x", OCCUPATION_BUCKETS_LITERAL)) == [(3,), (3,), (2,), (3,)]


def test_time_follows_session_zone(spark):
    stamp = 1537236544  # 2018-09-18 02:09:04 UTC
    parts = time_parts("x")
    try:
        assert column(spark, [stamp], "bigint", local_time("x"), parts["day"], parts["hour"], parts["minute"]) == [
            ("2018-09-18 02:09:04", 18, 2, 9)]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert column(spark, [stamp], "bigint", local_time("x"), parts["hour"]) == [("2018-09-18 10:09:04", 10)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratio_and_smoothing(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (None, 3), (1, None)], "a int, b int")
    got = [tuple(r) for r in df.select(ratio("a", "b"), smoothed_rate("a", "b", 1.0, 3.0)).collect()]
    assert got == [(0.5, 2 / 6), (None, 2 / 4), (None, 1 / 4), (None, 1 / 7), (None, 2 / 4)]


def test_digamma_differences(spark):
    # psi(n + a) - psi(a) is a finite sum of reciprocals.
    for a in (1e-3, 0.3, 2.3, 71.0):
        df = spark.range(1).select((digamma(F.lit(a + 5)) - digamma(F.lit(a))).alias("d"))
        assert math.isclose(df.first()["d"], sum(1 / (a + k) for k in range(5)), rel_tol=1e-11)
    euler = spark.range(1).select(digamma(F.lit(1.0)).alias("d")).first()["d"]
    assert math.isclose(euler, -0.5772156649015329, rel_tol=1e-11)


def test_hash_unit_is_uniform_and_stable(spark):
    df = spark.range(4000).select(hash_unit("id").alias("u"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] < 1 and abs(row[2] - 0.5) < 0.02
    assert df.first() == df.first() and isinstance(df.first(), Row)
