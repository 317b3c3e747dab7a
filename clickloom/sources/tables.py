"""The click log seen through the star-schema test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.sizing import broadcast_if_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def click_log(
    spark: SparkSession,
    sf_dir: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """One row per event, with user attributes from ``customer`` and item attributes from ``part``.

    ``since`` (inclusive) and ``until`` (exclusive) are put on the raw timestamp column, so they
    reach the Parquet scan as pushed filters.
    """
    events = table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(dt.datetime.combine(until, dt.time())).cast("timestamp_ntz"))
    events = events.select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("context_timestamp"),
    )
    users = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    items = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    k, name = F.col("k"), F.col("p_name")
    return (
        events
        .join(broadcast_if_small(users), F.col("c_custkey") == F.col("user_id"))
        .join(broadcast_if_small(items), F.col("p_partkey") == k)
        .select(
            F.col("event_id").alias("instance_id"),
            "user_id",
            k.alias("item_id"),
            F.concat_ws(";", "p_type", "p_brand").alias("item_category_list"),
            F.replace(name, F.lit(" "), F.lit(";")).alias("item_property_list"),
            F.concat(
                F.col("p_type"), F.lit(":"), F.replace(name, F.lit(" "), F.lit(",")), F.lit(";"), F.col("p_brand")
            ).alias("predict_category_property"),
            F.col("p_brand").alias("item_brand_id"),
            (k % 7).alias("item_city_id"),
            F.floor(F.col("p_retailprice") / 100).cast("int").alias("item_price_level"),
            (F.col("p_size") % 18).alias("item_sales_level"),
            (F.col("p_size") % 17).alias("item_collected_level"),
            (F.col("p_size") % 22).alias("item_pv_level"),
            (F.col("c_nationkey") % 3).alias("user_gender_id"),
            (1000 + F.col("c_custkey") % 8).cast("int").alias("user_age_level"),
            (2002 + F.col("c_nationkey") % 4).alias("user_occupation_id"),
            (3000 + F.col("c_custkey") % 11).cast("int").alias("user_star_level"),
            (F.col("event_id") % 500).alias("context_id"),
            (4001 + F.col("event_id") % 20).cast("int").alias("context_page_id"),
            "context_timestamp",
            (k % 10).alias("shop_id"),
            (k % 25).alias("shop_review_num_level"),
            (5000 + k % 22).alias("shop_star_level"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_trade"),
        )
    )
