import math

import pytest
from pyspark.sql import functions as F

from clickloom.operators.indexing import encode, equal_folds, fit_dictionary, global_index, hash_folds, holdout
from clickloom.operators.scores import (
    area_under_roc, calibrate, correlation_matrix, log_loss, mean_blend, nested_blend, top_n, top_ranks, weighted_blend,
)


def test_global_index(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("key", (F.col("id") * 7919) % 1000)
    got = global_index(df, ["key"]).filter("row_index != key").count()
    assert got == 0


def test_codes_sort_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (-1, "B"), (None, None), (10, "b")], "n bigint, s string")
    d = fit_dictionary(df, ["n", "s"])
    assert d.sizes == {"n": 3, "s": 3}
    for bound in (0, 1000):
        got = {tuple(r) for r in encode(df, d, {"n": "cn", "s": "cs"}, bound).collect()}
        assert got == {(10, "b", 2, 2), (9, "a", 1, 1), (-1, "B", 0, 0), (None, None, None, None)}


@pytest.mark.parametrize("n", [100, 105, 7])
def test_equal_folds(spark, n):
    df = spark.range(n).withColumnRenamed("id", "instance_id")
    sizes = {r["fold"]: r["count"] for r in equal_folds(df, 10).groupBy("fold").count().collect()}
    assert sum(sizes.values()) == n and max(sizes) == 9 if n >= 10 else sum(sizes.values()) == n
    if n >= 10:
        assert all(sizes[k] == n // 10 for k in range(9)) and sizes[9] == n // 10 + n % 10


def test_hash_folds_and_holdout_cover_all_rows_once(spark):
    df = spark.range(2000).withColumnRenamed("id", "instance_id")
    folds = hash_folds(df, 10)
    assert folds.count() == 2000 and folds.select("fold").distinct().count() == 10
    rest, held = holdout(df, 0.3)
    assert rest.count() + held.count() == 2000 and rest.join(held, "instance_id").count() == 0
    assert abs(held.count() / 2000 - 0.3) < 0.05


def tables(spark):
    one = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.6)], "instance_id bigint, predicted_score double")
    two = spark.createDataFrame([(3, 0.2), (1, 0.5), (2, 0.4)], "instance_id bigint, predicted_score double")
    three = spark.createDataFrame([(2, 0.9), (3, 0.3), (1, 0.0)], "instance_id bigint, predicted_score double")
    return one, two, three


def values(df):
    return {r[0]: round(r[1], 12) for r in df.collect()}


def test_blends_align_by_id(spark):
    one, two, three = tables(spark)
    assert values(weighted_blend([one, two], (1, 0))) == values(one)
    assert values(weighted_blend([one, two], (0.7, 0.3))) == {1: 0.22, 2: 0.26, 3: 0.48}
    assert values(mean_blend([one, two, three])) == {1: 0.2, 2: 0.5, 3: round(1.1 / 3, 12)}
    assert values(nested_blend(one, two, three)) == {1: 0.15, 2: 0.6, 3: 0.35}


def test_calibrated_mean(spark):
    mean = calibrate(tables(spark)[0], 0.0273).agg(F.avg("predicted_score")).first()[0]
    assert math.isclose(mean, 0.0273)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.5)], "is_trade int, predicted_score double")
    assert math.isclose(log_loss(df).first()[0], math.log(2) / 3, rel_tol=1e-9)
    wrong = spark.createDataFrame([(1, 0.0)], "is_trade int, predicted_score double")
    assert math.isclose(log_loss(wrong).first()[0], -math.log(1e-15), rel_tol=1e-9)


def test_area_under_roc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "is_trade int, predicted_score double")
    assert math.isclose(area_under_roc(df), 0.875)


def test_ranks(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([5.0, 4.0, 4.0, 3.0, 3.0, 1.0])], "id int, s double")
    got = sorted(tuple(r) for r in top_ranks(df, 3, "s").collect())
    assert got == [(0, 5.0, 1), (1, 4.0, 2), (2, 4.0, 2)]
    got = sorted(r["rank"] for r in top_ranks(df, 4, "s").collect())
    assert got == [1, 2, 2, 4, 4]
    assert len(top_ranks(df, 50, "s").collect()) == 6
    assert [r["id"] for r in top_n(df, 2, "s", "id").collect()] == [0, 1]


def test_correlation_with_nulls_and_constants(spark):
    rows = [(1.0, 2.0, 3.0, None), (2.0, 4.5, 3.0, 1.0), (3.0, None, 3.0, -1.0), (4.0, 8.0, 3.0, 0.5), (5.0, 9.0, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = df.toPandas().astype(float).corr()
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert len(got) == 16
    for (x, y), v in got.items():
        expected = want.loc[x, y]
        assert (v is None and math.isnan(expected)) or math.isclose(v, expected, rel_tol=1e-9)
