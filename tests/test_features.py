import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.operators.features import Conversion, Family, JoinPolicy, Measure, family_table
from clickloom.operators.position import drop_latest, position_table, reclick_table, repeated_groups
from clickloom.plans import specs
from clickloom.plans.slices import TimeSlice, history_rows, label_rows, month_slices
from clickloom.sources import stage

SCHEMA = "slice int, instance_id bigint, user_id bigint, item_brand_id bigint, item_id bigint, is_trade int, event_date date"
DAY = dt.date(2024, 1, 5)

# One policy per way to compute a lookup; all must agree.
POLICIES = {
    "broadcast": JoinPolicy(rollup_ratio=0.0),
    "shuffle": JoinPolicy(broadcast_bytes=0, rollup_ratio=0.0),
    "rolled up, broadcast": JoinPolicy(rollup_ratio=100.0),
    "rolled up, shuffle": JoinPolicy(broadcast_bytes=0, rollup_ratio=100.0),
    "budget for some": JoinPolicy(total_broadcast_bytes=300, rollup_ratio=0.0),
}


def frame(spark, *rows):
    return spark.createDataFrame([(1, i, *r, DAY) for i, r in enumerate(rows)], SCHEMA)


FAMILY = Family.of_conversions("t", (
    Conversion(("user_id",), "user_clicks", "user_buys", "user_rate", prior=(1.0, 3.0)),
    Conversion(("item_brand_id",), "brand_clicks", "brand_buys", "brand_rate", hits="ones"),
    Conversion(("user_id", "item_brand_id"), "pair_clicks", "pair_buys", "pair_rate"),
    Conversion(("item_id",), "item_clicks", "item_buys", "item_rate"),
))


@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES)
def test_missing_keys_and_labels(spark, policy):
    history = frame(spark, (1, 10, 5, 1), (1, 10, 5, 0), (1, None, 5, 1), (2, 11, 6, None), (None, 10, 6, 1))
    labels = frame(spark, (1, 10, 5, None), (2, 11, 6, None), (3, 12, 7, None), (None, None, 5, None))
    got = family_table(labels, history, FAMILY, keep_counts=True, policy=policy).orderBy("instance_id").collect()
    by = [r.asDict() for r in got]
    # A known user: three clicks, two buys, NULL brand not counted for the pair.
    assert (by[0]["user_clicks"], by[0]["user_buys"], by[0]["user_rate"]) == (3, 2, 3 / 7)
    assert (by[0]["pair_clicks"], by[0]["pair_buys"], by[0]["pair_rate"]) == (2, 1, 0.5)
    assert (by[0]["brand_clicks"], by[0]["brand_buys"]) == (3, 2)
    # A key whose labels are all NULL: clicks but zero buys.
    assert (by[1]["user_clicks"], by[1]["user_buys"], by[1]["brand_rate"]) == (1, 0, 0.0)
    # An unseen user gets filled counts and the prior mean; unfilled features stay NULL.
    assert (by[2]["user_clicks"], by[2]["user_rate"], by[2]["brand_clicks"], by[2]["item_rate"]) == (0, 0.25, None, None)
    # A NULL key never finds the NULL rows of the history.
    assert (by[3]["user_clicks"], by[3]["brand_clicks"], by[3]["pair_clicks"], by[3]["item_clicks"]) == (0, None, None, 3)


def test_zero_denominator(spark):
    labels = frame(spark, (1, 10, 5, 0))
    for spec in (specs.shop_share(), specs.shop_share(distinct=True)):
        rows = labels.withColumn("shop_id", F.lit(7))
        got = family_table(rows, rows, spec).first()
        assert got["shop_user_share_on_brand"] is None and got["shop_market_share_on_brand"] == 1.0


def is_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_and_exact(spark):
    """A third of all rows under one key, in a plan without broadcast: the join is split, the counts hold."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 30_000
    rows = spark.range(0, n, 1, 8).select(
        (F.col("id") % 5 % 3).cast("int").alias("slice"), F.col("id").alias("instance_id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("user_id"),
        (F.col("id") % 2).cast("int").alias("is_trade"), F.lit(DAY).alias("event_date"),
    )
    spec = Family("hot", (Measure("clicks", ("user_id",)), Measure("buys", ("user_id",), "label_sum")))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = family_table(rows, rows, spec, carry=("slice", "instance_id", "user_id"), policy=JoinPolicy(broadcast_bytes=0))
        want = {r["slice"]: (r["n"], r["b"]) for r in rows.where("user_id = -1").groupBy("slice").agg(
            F.count("*").alias("n"), F.sum("is_trade").alias("b")).collect()}
        got = out.filter("user_id = -1").groupBy("slice").agg(
            F.min("clicks"), F.max("clicks"), F.min("buys"), F.max("buys")).collect()
        assert {r[0]: tuple(r[1:]) for r in got} == {s: (n, n, b, b) for s, (n, b) in want.items()} and len(want) == 3
        assert is_split(out)
        timed = stage(rows.select("instance_id", "user_id", F.col("instance_id").alias("context_timestamp")))
        assert is_split(drop_latest(timed, ["user_id"]))
        assert is_split(timed.join(stage(repeated_groups(timed, ["user_id"])), ["user_id"]))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tables_as_long_as_the_log_do_not_pass_through_the_driver(spark):
    """Only lookups within the budget are broadcast, however small the files of the others."""
    rows = stage(frame(spark, *((i % 5, i % 3, i % 7, i % 2) for i in range(40))).withColumns({
        "context_timestamp": F.col("instance_id"), "shop_id": F.lit(1), "last_category_id": F.lit(2)}))
    policy = JoinPolicy(broadcast_bytes=0, rollup_ratio=0.0)
    for joined in (family_table(rows, rows, FAMILY, policy=policy), position_table(rows), reclick_table(rows)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and joined.count() == 40


def test_slices_never_see_their_label_day(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]
    log = spark.createDataFrame([(d,) for d in days], "event_date date")
    slices = month_slices(2024, 1)
    history = {(r["slice"], r["event_date"].day) for r in history_rows(log, slices).collect()}
    assert {d for s, d in history if s == 1} == set(range(1, 23))
    assert {d for s, d in history if s == 2} == set(range(19, 24))
    assert {d for s, d in history if s == 3} == set(range(20, 25))
    assert {(r["slice"], r["event_date"].day) for r in label_rows(log, slices).collect()} == {(1, 23), (2, 24), (3, 25)}


def test_slices_across_a_month_end(spark):
    log = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 2, 2),)], "event_date date")
    slices = (TimeSlice(7, dt.date(2024, 2, 2), 5),)
    assert [tuple(r) for r in history_rows(log, slices).collect()] == [(dt.date(2024, 1, 30), 7)]


def test_family_sizes():
    """Columns and key sets of the six families, as specified."""
    sizes = {f.name: (len(f.columns), len({(m.keys, m.daily) for m in f.measures}))
             for f in (*specs.EXECUTED, specs.DAILY_AVERAGE, specs.shop_share())}
    assert sizes == {
        "same_day": (19, 19), "one_key": (39, 13), "two_key": (50, 18), "three_key": (48, 16),
        "daily_average": (14, 6), "shop_share": (10, 3),
    }
    assert sum(len(f.outputs()) for f in specs.EXECUTED) == 72
