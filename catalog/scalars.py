"""Projections, filters, scalar functions and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import SLICES, SLICES_END, prepared, query, sliced
from clickloom.functions import (
    OCCUPATION_BUCKETS, OCCUPATION_BUCKETS_LITERAL, STAR_BUCKETS, STAR_BUCKETS_LITERAL, code_bucket,
    last_element, list_element, list_length, local_time, ratio, time_parts,
)
from clickloom.operators.indexing import encode, fit_dictionary, shuffled
from clickloom.operators.position import keep_end
from clickloom.plans.slices import history_rows
from clickloom.sources import click_log, stage
from oracle.click_log import with_log, with_slices


@query("p1_local_time", with_log('SELECT instance_id, "time" AS local_time FROM click_log'))
def p1(spark, sf):
    return click_log(spark, sf).select("instance_id", local_time("context_timestamp").alias("local_time"))


@query("p2_time_parts", with_log("SELECT instance_id, event_date, day, hour, minute FROM click_log"))
def p2(spark, sf):
    return click_log(spark, sf).select("instance_id", *[e.alias(n) for n, e in time_parts("context_timestamp").items()])


@query("p3_list_length", with_log("SELECT instance_id, len_item_category, len_item_property FROM click_log"))
def p3(spark, sf):
    return click_log(spark, sf).select(
        "instance_id",
        list_length("item_category_list").alias("len_item_category"),
        list_length("item_property_list").alias("len_item_property"),
    )


@query("p4_list_element", with_log("SELECT instance_id, item_category_list1, item_category_list2 FROM click_log"))
def p4(spark, sf):
    return click_log(spark, sf).select(
        "instance_id",
        list_element("item_category_list", 1).alias("item_category_list1"),
        list_element("item_category_list", 2).alias("item_category_list2"),
    )


@query("p5_last_element", with_log("SELECT instance_id, last_category_id FROM click_log"))
def p5(spark, sf):
    return click_log(spark, sf).select("instance_id", last_element("item_category_list").alias("last_category_id"))


ENCODED = ("item_id", "item_brand_id", "item_city_id", "user_id", "shop_id", "context_id",
           "item_category_list1", "item_category_list2")


@query("p6_ordinal_codes", with_log(
    "SELECT instance_id, "
    + ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_code" for c in ENCODED)
    + " FROM click_log"
))
def p6(spark, sf):
    """Codes of six ids and two category levels: numbers in numeric order, texts in binary order."""
    log = stage(prepared(spark, sf).select("instance_id", *ENCODED), "log")
    coded = encode(log, fit_dictionary(log, ENCODED), {c: f"{c}_code" for c in ENCODED})
    return coded.select("instance_id", *[f"{c}_code" for c in ENCODED])


@query("p7_code_buckets", with_log("""
SELECT instance_id, occupation0, star0,
  CASE WHEN user_occupation_id = 2002 THEN 2 ELSE 3 END AS occupation_literal, 3 AS star_literal
FROM click_log
"""))
def p7(spark, sf):
    return click_log(spark, sf).select(
        "instance_id",
        code_bucket("user_occupation_id", OCCUPATION_BUCKETS).alias("occupation0"),
        code_bucket("user_star_level", STAR_BUCKETS).alias("star0"),
        code_bucket("user_occupation_id", OCCUPATION_BUCKETS_LITERAL).alias("occupation_literal"),
        code_bucket("user_star_level", STAR_BUCKETS_LITERAL).alias("star_literal"),
    )


DROPPED = ("item_category_list", "item_property_list", "predict_category_property")


@query("p8_drop_columns", f"WITH q AS ({with_log('SELECT * FROM raw_log')}) SELECT * EXCLUDE ({', '.join(DROPPED)}) FROM q")
def p8(spark, sf):
    return click_log(spark, sf).drop(*DROPPED)


@query("p9_p11_select_and_rename", with_log("""
SELECT instance_id AS id, is_trade AS user_buy_times, context_timestamp AS "diffTime_first" FROM click_log
"""))
def p9(spark, sf):
    return click_log(spark, sf).select(
        F.col("instance_id").alias("id"), F.col("is_trade").alias("user_buy_times"), "context_timestamp"
    ).withColumnRenamed("context_timestamp", "diffTime_first")


@query("p10_p12_p13_p21_counts_ratio_fill", with_log("""
SELECT item_id, count(*) AS clicks, CAST(sum(is_trade) AS BIGINT) AS buys,
  sum(is_trade)::DOUBLE / count(*)::DOUBLE AS rate,
  coalesce(sum(is_trade)::DOUBLE / nullif(sum(CASE WHEN hour < 1 THEN 1 ELSE 0 END), 0)::DOUBLE, 0) AS night_ratio
FROM click_log GROUP BY item_id
"""))
def p12(spark, sf):
    """Ratio of two aggregates, with a zero denominator becoming NULL and then the fill value."""
    counts = prepared(spark, sf).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("clicks"), F.sum("is_trade").alias("buys"), F.count_if(F.col("hour") < 1).alias("night")
    )
    return counts.select(
        "item_id", "clicks", "buys", ratio("buys", "clicks").alias("rate"),
        F.coalesce(ratio("buys", "night"), F.lit(0.0)).alias("night_ratio"),
    )


@query("p14_fill_frame", with_slices("""
SELECT l.instance_id, l.slice, coalesce(k.n, 0) AS user_click_same_item_times,
  coalesce(k.b, 0) AS user_buy_same_item_times
FROM l LEFT JOIN k ON k.slice = l.slice AND k.user_id = l.user_id AND k.item_id = l.item_id
""", """k AS (SELECT slice, user_id, item_id, count(*) AS n, CAST(sum(is_trade) AS BIGINT) AS b
              FROM h GROUP BY slice, user_id, item_id)"""))
def p14(spark, sf):
    labels, history = sliced(spark, sf, ["user_id", "item_id"])
    keys = ["slice", "user_id", "item_id"]
    lookup = history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("user_click_same_item_times"), F.sum("is_trade").alias("user_buy_same_item_times")
    )
    return labels.join(stage(lookup, "lookup"), keys, "left").select(
        "instance_id", "slice", "user_click_same_item_times", "user_buy_same_item_times"
    ).na.fill(0)


@query("p15_history_range", with_slices("SELECT slice, instance_id, event_date FROM h"))
def p15(spark, sf):
    """History rows of all slices; the bound of the last label day reaches the Parquet scan."""
    log = prepared(spark, sf, SLICES_END).select("instance_id", "event_date")
    return history_rows(log, SLICES).select("slice", "instance_id", "event_date")


@query("p18_slice_by_source", with_log("""
SELECT instance_id, CASE WHEN event_date < DATE '2024-01-24' THEN 'train'
  WHEN event_date < DATE '2024-01-25' THEN 'test_a' ELSE 'test_b' END AS source
FROM click_log WHERE event_date >= DATE '2024-01-25'
"""))
def p18(spark, sf):
    """Rows of one source file, by its tag instead of by position."""
    date = F.col("event_date")
    source = (
        F.when(date < dt.date(2024, 1, 24), "train").when(date < dt.date(2024, 1, 25), "test_a").otherwise("test_b")
    )
    return prepared(spark, sf).select("instance_id", source.alias("source")).filter("source = 'test_b'")


@query("p19_dummy_columns", with_log("""
SELECT instance_id,
  CASE WHEN user_gender_id = 0 THEN 1 ELSE 0 END AS user_gender_id_0,
  CASE WHEN user_gender_id = 1 THEN 1 ELSE 0 END AS user_gender_id_1,
  CASE WHEN user_gender_id = 2 THEN 1 ELSE 0 END AS user_gender_id_2,
  CASE WHEN star0 = 1 THEN 1 ELSE 0 END AS star0_1,
  CASE WHEN star0 = 2 THEN 1 ELSE 0 END AS star0_2,
  CASE WHEN star0 = 3 THEN 1 ELSE 0 END AS star0_3
FROM click_log
"""))
def p19(spark, sf):
    values = {"user_gender_id": (0, 1, 2), "star0": (1, 2, 3)}
    return prepared(spark, sf).select("instance_id", *[
        F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c, vs in values.items() for v in vs
    ])


@query("d1_union_by_name", with_log("""
SELECT instance_id, user_id, item_id, context_timestamp,
  CASE WHEN event_date < DATE '2024-01-25' THEN is_trade END AS is_trade,
  CASE WHEN event_date < DATE '2024-01-25' THEN 'train' ELSE 'test' END AS source
FROM click_log
"""))
def d1(spark, sf):
    """Labelled and unlabelled rows stacked by name; the missing label becomes NULL."""
    columns = ["instance_id", "user_id", "item_id", "context_timestamp"]
    train = click_log(spark, sf, until=dt.date(2024, 1, 25)).select(*columns, "is_trade", F.lit("train").alias("source"))
    test = click_log(spark, sf, since=dt.date(2024, 1, 25)).select(*columns, F.lit("test").alias("source"))
    return train.unionByName(test, allowMissingColumns=True)


@query("d3_distinct_rows", with_log(
    "SELECT DISTINCT user_id, item_id, shop_id, event_date, is_trade FROM click_log"))
def d3(spark, sf):
    return prepared(spark, sf).select("user_id", "item_id", "shop_id", "event_date", "is_trade").dropDuplicates()


@query("d4_distinct_on_key", with_log("""
SELECT user_id, last_category_id, context_timestamp, instance_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, last_category_id
                               ORDER BY context_timestamp, instance_id) AS place FROM click_log)
WHERE place = 1
"""))
def d4(spark, sf):
    log = prepared(spark, sf).select("user_id", "last_category_id", "context_timestamp", "instance_id")
    return keep_end(log, ["user_id", "last_category_id"])


@query("t4_random_order", with_log("""
SELECT instance_id, row_number() OVER (ORDER BY md5(concat_ws('|', instance_id::VARCHAR, '')), instance_id) - 1 AS row_index
FROM click_log
"""))
def t4(spark, sf):
    """A random but repeatable numbering of all rows."""
    return shuffled(click_log(spark, sf).select("instance_id"))
