import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import position
from clickloom.operators.position import (
    add_positions, drop_latest, keep_end, position_table, reclick_table, repeat_clicks, scale_scores,
)

SCHEMA = "instance_id bigint, user_id bigint, item_id bigint, shop_id bigint, context_timestamp bigint"


def rows_of(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_positions_with_ties_and_null_keys(spark):
    log = rows_of(
        spark, (1, 5, 9, 100), (1, 5, 9, 100), (1, 5, 9, 160), (1, 5, 9, 130),  # tie at the front
        (2, 5, 9, 7),  # single
        (None, 5, 9, 10), (None, 5, 9, 30),  # NULL keys are one key
        (3, 5, 9, 50), (3, 5, 9, 40),  # file order differs from time order
    )
    got = add_positions(log, ["user_id", "item_id", "shop_id"], scope=()).orderBy("instance_id")
    values = [(r["maybe"], r["diffTime_first"], r["diffTime_last"]) for r in got.collect()]
    assert values == [
        (2, 0, 60), (1, 0, 60), (3, 60, 0), (1, 30, 30), (0, -1, -1), (2, 0, 20), (3, 20, 0), (3, 10, 0), (2, 0, 10)]


def test_positions_keep_every_row(spark):
    log = rows_of(spark, *[(i % 4, i % 3, 1, i // 2) for i in range(60)]).withColumn(
        "item_brand_id", F.col("item_id")).withColumn("last_category_id", F.lit("c")).withColumn("slice", F.lit(1))
    assert position_table(log).count() == 60


def brute_force(rows, sign):
    out = {}
    for i, (u, it, _, t) in enumerate(rows):
        if u is None or it is None:
            out[i] = None
        else:
            out[i] = sum(1 for v, jt, _, s in rows if (v, jt) == (u, it) and (s <= t if sign < 0 else s >= t)) - 1
    return out


@pytest.mark.parametrize("direction,sign", [("before", -1), ("after", 1)])
def test_reclicks_against_brute_force(spark, direction, sign):
    """Ties, NULL keys, and one key with a third of the rows, spread over several day-long chunks."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), rng.choice([1, 2, 3]), 0, rng.randrange(0, 5 * 86_400, 3_000)) for _ in range(200)]
    rows += [(7, 7, 0, rng.randrange(0, 5 * 86_400, 1_000)) for _ in range(100)]
    got = reclick_table(rows_of(spark, *rows), carry=("instance_id",), scope=(), direction=direction)
    assert {r[0]: r[1] for r in got.collect()} == brute_force(rows, sign)


def test_reclick_windows_are_bounded(spark):
    """No window holds more rows than a chunk has seconds, whatever the key holds."""
    log = spark.range(50_000).select(
        F.col("id").alias("instance_id"), F.lit(1).alias("user_id"), F.lit(1).alias("item_id"),
        (F.col("id") % 100).alias("context_timestamp"))
    counts = position.running_count(log, ["user_id", "item_id"], "context_timestamp", "n")
    assert counts.count() == 100 and counts.agg(F.max("n")).first()[0] == 50_000


def test_drop_latest_and_keep_end(spark):
    log = rows_of(spark, (1, 1, 1, 5), (1, 1, 1, 9), (1, 1, 1, 9), (2, 1, 1, 3), (None, 1, 1, 3), (None, 1, 1, 4))
    keys = ["user_id", "item_id", "shop_id"]
    assert {r["instance_id"] for r in drop_latest(log, keys).collect()} == {0, 1}
    assert {r["instance_id"] for r in keep_end(log, keys).collect()} == {0, 3, 4}
    assert {r["instance_id"] for r in keep_end(log, keys, last=True).collect()} == {2, 3, 5}


def test_repeat_clicks_and_scaling(spark):
    log = rows_of(
        spark, (1, 1, 1, 10), (1, 1, 1, 20),  # repeat within the hour: the later one goes
        (1, 1, 1, 4000),  # alone in its hour: never a repeat
        (1, 1, 1, 8000), (1, 1, 1, 8001),  # second repeat of the same group: holds the latest row
        (2, 1, 1, 10), (2, 1, 1, 4000),  # two rows in different hours
    ).withColumn("event_date", F.lit("d")).withColumn("hour", F.floor(F.col("context_timestamp") / 3600))
    repeats = repeat_clicks(log)
    assert {r["instance_id"] for r in repeats.collect()} == {0, 1, 3}
    scores = log.select("instance_id", F.lit(0.5).alias("predicted_score"))
    got = {r[0]: r[1] for r in scale_scores(scores, repeats).collect()}
    assert got == {0: 0.1, 1: 0.1, 2: 0.5, 3: 0.1, 4: 0.5, 5: 0.5, 6: 0.5}
