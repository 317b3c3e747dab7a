"""Blending, calibration, evaluation, ranking and folds, on smoothed rates taken as scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import RATES, family_table, prepared, query, sliced
from clickloom.operators.indexing import equal_folds, hash_folds, holdout
from clickloom.operators.position import repeat_clicks, scale_scores
from clickloom.operators.scores import (
    align, area_under_roc, calibrate, log_loss, mean_blend, mean_fold_loss, nested_blend, top_n, top_ranks,
    weighted_blend,
)
from clickloom.sources import click_log, stage
from catalog.windows import REPEAT_ROWS
from oracle.click_log import with_log, with_slices
from oracle.families import family_sql

RATE_COLUMNS = ("user_transfer_rate", "item_quality", "shop_quality")


def rate_scores(spark, sf) -> DataFrame:
    """(slice, id, label and the three rates) of every label row."""
    labels, history = sliced(spark, sf, RATES.keys)
    return family_table(labels, history, RATES, carry=("slice", "instance_id", "is_trade"))


def three_tables(spark, sf) -> list[DataFrame]:
    scores = stage(rate_scores(spark, sf), "scores")
    return [scores.select("instance_id", F.col(c).alias("predicted_score")) for c in RATE_COLUMNS]


SCORES = "r AS (" + family_sql(RATES) + "),\ns AS (" + with_slices(
    "SELECT slice, instance_id, is_trade FROM l") + "),\nt AS (SELECT * FROM r JOIN s USING (slice, instance_id))"


def on_scores(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SCORES, *ctes]) + "\n" + body


@query("j8_aligned_scores", on_scores(
    "SELECT instance_id, user_transfer_rate AS s0, item_quality AS s1, shop_quality AS s2 FROM t"))
def j8(spark, sf):
    return align(*three_tables(spark, sf))


@query("m14_weighted_blend", on_scores(
    "SELECT instance_id, round(user_transfer_rate * 0.7::DOUBLE + item_quality * 0.3::DOUBLE, 9) AS predicted_score FROM t"))
def m14(spark, sf):
    blend = weighted_blend(three_tables(spark, sf)[:2], (0.7, 0.3))
    return blend.withColumn("predicted_score", F.round("predicted_score", 9))


@query("m15_nested_blend", on_scores("""
SELECT instance_id,
  round(((user_transfer_rate + item_quality) / 2::DOUBLE + shop_quality) / 2::DOUBLE, 9) AS predicted_score FROM t"""))
def m15(spark, sf):
    return nested_blend(*three_tables(spark, sf)).withColumn("predicted_score", F.round("predicted_score", 9))


@query("m16_mean_blend", on_scores("""
SELECT instance_id, round((user_transfer_rate + item_quality + shop_quality) / 3::DOUBLE, 9) AS predicted_score FROM t"""))
def m16(spark, sf):
    return mean_blend(three_tables(spark, sf)).withColumn("predicted_score", F.round("predicted_score", 9))


@query("m17_calibrated_scores", on_scores("""
SELECT instance_id, round(user_transfer_rate * (0.0273::DOUBLE / (SELECT avg(user_transfer_rate) FROM t)), 9)
  AS predicted_score FROM t"""))
def m17(spark, sf):
    return calibrate(three_tables(spark, sf)[0]).withColumn("predicted_score", F.round("predicted_score", 9))


DOWN_WEIGHTED = (
    f"WITH down AS ({with_log('SELECT instance_id FROM down', REPEAT_ROWS)}),\n{SCORES}\n"
    "SELECT t.instance_id, round(CASE WHEN d.instance_id IS NULL THEN item_quality ELSE item_quality / 5::DOUBLE END, 9) "
    "AS predicted_score FROM t LEFT JOIN down d USING (instance_id)"
)


@query("j7_p17_m18_down_weighted_repeats", DOWN_WEIGHTED)
def m18(spark, sf):
    """Scores of rows that are repeat clicks, divided by five."""
    scores = rate_scores(spark, sf).select("instance_id", F.col("item_quality").alias("predicted_score"))
    columns = ["instance_id", "user_id", "item_id", "shop_id", "event_date", "hour", "context_timestamp"]
    repeats = repeat_clicks(stage(prepared(spark, sf).select(*columns), "log"))
    return scale_scores(scores, repeats).withColumn("predicted_score", F.round("predicted_score", 9))


@query("j7_rows_in_id_list", on_scores("""
SELECT t.instance_id, user_transfer_rate FROM t WHERE instance_id IN (SELECT instance_id FROM down)
""", f"down AS ({with_log('SELECT instance_id FROM down', REPEAT_ROWS)})"))
def j7(spark, sf):
    columns = ["instance_id", "user_id", "item_id", "shop_id", "event_date", "hour", "context_timestamp"]
    repeats = repeat_clicks(stage(prepared(spark, sf).select(*columns), "log"))
    scores = rate_scores(spark, sf).select("instance_id", "user_transfer_rate")
    return scores.join(repeats.select("instance_id"), "instance_id", "left_semi")


@query("p20_score_added_by_id", on_scores("""
SELECT c.instance_id, c.user_id, t.item_quality AS predicted_score FROM c LEFT JOIN t USING (instance_id)
""", f"c AS ({with_log('SELECT instance_id, user_id FROM click_log')})"))
def p20(spark, sf):
    scores = rate_scores(spark, sf).select("instance_id", F.col("item_quality").alias("predicted_score"))
    return click_log(spark, sf).select("instance_id", "user_id").join(scores, "instance_id", "left")


LOSS = ("avg(-(is_trade * ln(least(greatest({p}, 1e-15::DOUBLE), (1 - 1e-15::DOUBLE)))"
        " + (1 - is_trade) * ln(1 - least(greatest({p}, 1e-15::DOUBLE), (1 - 1e-15::DOUBLE)))))")


@query("a12_log_loss", on_scores(
    f"SELECT slice, round({LOSS.format(p='item_quality')}, 6) AS log_loss FROM t GROUP BY slice"))
def a12(spark, sf):
    return log_loss(rate_scores(spark, sf), ["slice"], score="item_quality").select(
        "slice", F.round("log_loss", 6).alias("log_loss"))


FOLD = "CAST(floor(CAST('0x' || substr(md5(concat_ws('|', instance_id::VARCHAR, '')), 1, 8) AS BIGINT) / 4294967296::DOUBLE * 10) AS INT)"


@query("a13_mean_fold_loss", on_scores(f"""
SELECT round(avg(loss), 6) AS mean_log_loss FROM (
  SELECT {FOLD} AS fold, {LOSS.format(p='item_quality')} AS loss FROM t GROUP BY 1)"""))
def a13(spark, sf):
    folded = hash_folds(rate_scores(spark, sf))
    return mean_fold_loss(folded, score="item_quality").select(F.round("mean_log_loss", 6).alias("mean_log_loss"))


@query("a16_area_under_roc", on_scores("""
SELECT round(sum(pos * (below + neg / 2::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE, 6) AS auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT item_quality AS p, sum(is_trade) AS pos, sum(1 - is_trade) AS neg FROM t GROUP BY 1))"""))
def a16(spark, sf):
    auc = area_under_roc(rate_scores(spark, sf), score="item_quality")
    return spark.createDataFrame([(auc,)], "auc double").select(F.round("auc", 6).alias("auc"))


@query("t2_top_scores", on_scores("""
SELECT slice, instance_id, user_transfer_rate FROM t ORDER BY user_transfer_rate DESC, instance_id, slice LIMIT 100"""))
def t2(spark, sf):
    scores = rate_scores(spark, sf).select("slice", "instance_id", "user_transfer_rate")
    return top_n(scores, 100, "user_transfer_rate", "instance_id", "slice")


@query("t3_ranks_with_ties", on_scores("""
SELECT * FROM (SELECT slice, instance_id, item_quality, rank() OVER (ORDER BY item_quality DESC) AS rank FROM t)
WHERE rank <= 25"""))
def t3(spark, sf):
    scores = stage(rate_scores(spark, sf).select("slice", "instance_id", "item_quality"), "scores")
    return top_ranks(scores, 25, "item_quality")


@query("m4_hash_folds", with_log(f"SELECT instance_id, {FOLD} AS fold FROM click_log"))
def m4_hash(spark, sf):
    return hash_folds(click_log(spark, sf).select("instance_id"))


@query("m4_d2_equal_folds", with_log("""
SELECT instance_id, CAST(least(place // greatest(n // 10, 1), 9) AS INT) AS fold FROM (
  SELECT instance_id, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5(concat_ws('|', instance_id::VARCHAR, '')), instance_id) - 1 AS place
  FROM click_log)"""))
def m4_equal(spark, sf):
    """Ten folds of equal size; the complement of a fold is a filter on its number."""
    return equal_folds(click_log(spark, sf).select("instance_id"))


HELD = "CAST('0x' || substr(md5(concat_ws('|', instance_id::VARCHAR, 'holdout')), 1, 8) AS BIGINT) / 4294967296::DOUBLE < 0.3::DOUBLE"


@query("m7_holdout_split", with_log(
    f"SELECT instance_id, CASE WHEN {HELD} THEN 'held' ELSE 'rest' END AS part FROM click_log"))
def m7_split(spark, sf):
    rest, held = holdout(click_log(spark, sf).select("instance_id"))
    return rest.withColumn("part", F.lit("rest")).unionAll(held.withColumn("part", F.lit("held")))
