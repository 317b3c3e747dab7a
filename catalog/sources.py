"""Sources and sinks: each query writes the log or scores as text and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import RATES, family, prepared, query
from clickloom.plans.prepare import prepare_log
from clickloom.sources import (
    click_log, click_schema, cut_by_position, new_path, read_click_logs, read_comma_csv, read_predictions, read_space_text, stage,
    with_file_rows, write_comma_csv, write_space_text,
)
from oracle.click_log import with_log
from oracle.families import family_sql

# The test tables name brands by text.
OVERRIDES = {"item_brand_id": T.StringType()}


def _columns(labeled: bool = True) -> list[str]:
    return click_schema(labeled).fieldNames()


@query("s1_space_text_log", with_log("SELECT * FROM raw_log"))
def s1(spark, sf):
    path = new_path(spark, "log-text")
    write_space_text(click_log(spark, sf).select(*_columns()), path)
    return read_space_text(spark, path, click_schema(True, OVERRIDES))


@query("s1_d1_d3_stacked_logs", with_log("""
SELECT instance_id, user_id, item_id, item_category_list, context_timestamp, event_date, last_category_id,
  CASE WHEN day < 25 THEN is_trade END AS is_trade, CASE WHEN day < 25 THEN 'train' ELSE 'test' END AS source
FROM click_log
"""))
def stacked_logs(spark, sf):
    """A labelled file with doubled rows and an unlabelled one, read, freed of copies and stacked."""
    log = stage(prepared(spark, sf), "log")
    train, test = new_path(spark, "train"), new_path(spark, "test")
    labelled = log.filter("day < 25").select(*_columns())
    write_space_text(labelled.unionAll(labelled), train)
    write_space_text(log.filter("day >= 25").select(*_columns(False)), test)
    stacked = read_click_logs(spark, {"train": train}, {"test": test}, OVERRIDES)
    return prepare_log(stacked).select(
        "instance_id", "user_id", "item_id", "item_category_list", "context_timestamp", "event_date",
        "last_category_id", "is_trade", "source",
    )


@query("s2_s3_comma_csv_table", family_sql(RATES))
def csv_table(spark, sf):
    """A feature table written as comma CSV and read with its declared schema."""
    features = family(spark, sf, RATES)
    path = new_path(spark, "features-csv")
    write_comma_csv(features, path)
    return read_comma_csv(spark, path, features.schema)


@query("s4_prediction_file", f"SELECT instance_id, user_transfer_rate AS predicted_score FROM ({family_sql(RATES)})")
def s4(spark, sf):
    path = new_path(spark, "predictions")
    scores = family(spark, sf, RATES).select("instance_id", F.col("user_transfer_rate").alias("predicted_score"))
    write_space_text(scores, path)
    return read_predictions(spark, path)


@query("s1_p18_file_order_cut", with_log("""
SELECT instance_id, place AS file_row, CASE WHEN place < 500 THEN 'test_a' ELSE 'test_b' END AS source
FROM (SELECT instance_id, row_number() OVER (ORDER BY instance_id) - 1 AS place FROM click_log)
"""))
def file_order(spark, sf):
    """Two stacked files told apart by position: rows are numbered in file order, the first 500 are the first file's."""
    path = new_path(spark, "stacked")
    schema = click_schema(True, OVERRIDES)
    ordered = click_log(spark, sf).select(*_columns()).repartitionByRange(4, "instance_id").sortWithinPartitions("instance_id")
    write_space_text(ordered, path)
    numbered = stage(with_file_rows(read_space_text(spark, path, schema)), "numbered")
    first, second = cut_by_position(numbered.withColumn("place", F.col("file_row")), 500)
    both = first.withColumn("source", F.lit("test_a")).unionByName(second.withColumn("source", F.lit("test_b")))
    return both.select("instance_id", F.col("place").alias("file_row"), "source")


@query("s5_stage_boundary", with_log("""
SELECT event_date, count(*) AS n_rows, CAST(sum(is_trade) AS BIGINT) AS n_trades, count(DISTINCT user_id) AS n_users
FROM click_log GROUP BY event_date
"""))
def s5(spark, sf):
    """The prepared log stored by date, then aggregated per date from the stored copy."""
    columns = ["event_date", "is_trade", "user_id"]
    log = prepared(spark, sf).select(*columns).repartition("event_date", F.pmod(F.hash("user_id"), F.lit(4)))
    stored = stage(log, "log-by-date", ("event_date",))
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_trade").alias("n_trades"),
        F.count_distinct("user_id").alias("n_users"),
    )
