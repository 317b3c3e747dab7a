"""Aggregates in their plain form, shares, the prior fit, correlations and sizes."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from catalog.registry import RATES, SLICES, SLICES_END, family, prepared, query, sliced
from clickloom.operators.prior import fit_beta_priors
from clickloom.operators.scores import correlation_matrix, slice_sizes
from clickloom.plans.slices import history_rows, label_rows
from oracle.click_log import with_log, with_slices
from oracle.families import family_sql


@query("a1_a4_key_aggregates", with_log("""
SELECT item_brand_id, hour, count(*) AS n_rows, CAST(sum(is_trade) AS BIGINT) AS label_sum,
  count(*) FILTER (WHERE is_trade = 1) AS label_ones, count(item_id) AS non_null
FROM click_log GROUP BY item_brand_id, hour
"""))
def a1_a4(spark, sf):
    return prepared(spark, sf).groupBy("item_brand_id", "hour").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("is_trade"), F.lit(0)).alias("label_sum"),
        F.count_if(F.col("is_trade") == 1).alias("label_ones"),
        F.count("item_id").alias("non_null"),
    )


ENTITIES = {
    "user": ("user_click_total_times", "user_buy_times"),
    "item": ("item_is_click_total_times", "item_is_trade_times"),
    "shop": ("shop_is_click_total_times", "shop_is_trade_times"),
}
STEPS, TOLERANCE = 1000, 1e-8


def prior_sql() -> str:
    """The fixed-point steps as a recursive query; digamma differences as sums of reciprocals."""
    counts = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, {t} AS t, {h} AS h FROM r" for e, (t, h) in ENTITIES.items()
    )
    # Tables of a recursive query may be read in it, so the tails come as lists, one row per entity.
    ctes = [
        f"r AS MATERIALIZED ({family_sql(RATES)})",
        f"c AS ({counts})",
        """tails AS (
          SELECT entity, kind, k, CAST(sum(w) AS DOUBLE) AS w FROM (
            SELECT entity, kind, unnest(range(n)) AS k, w FROM (
              SELECT entity, 'hits' AS kind, h AS n, count(*) AS w FROM c GROUP BY ALL
              UNION ALL SELECT entity, 'misses', t - h, count(*) FROM c GROUP BY ALL
              UNION ALL SELECT entity, 'tries', t, count(*) FROM c GROUP BY ALL))
          GROUP BY ALL)""",
        """packed AS MATERIALIZED (
          SELECT entity,
            list({'k': k, 'w': w} ORDER BY k) FILTER (WHERE kind = 'hits') AS hits,
            list({'k': k, 'w': w} ORDER BY k) FILTER (WHERE kind = 'misses') AS misses,
            list({'k': k, 'w': w} ORDER BY k) FILTER (WHERE kind = 'tries') AS tries
          FROM tails GROUP BY entity)""",
        f"""steps AS (
          SELECT entity, 0 AS i, CAST(1 AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS b, CAST(1 AS DOUBLE) AS moved FROM packed
          UNION ALL
          SELECT entity, i + 1, na, nb, greatest(abs(na - a), abs(nb - b)) FROM (
            SELECT s.entity, s.i, s.a, s.b,
              s.a * list_sum([x.w / (s.a + x.k) for x in p.hits]) / list_sum([x.w / (s.a + s.b + x.k) for x in p.tries]) AS na,
              s.b * list_sum([x.w / (s.b + x.k) for x in p.misses]) / list_sum([x.w / (s.a + s.b + x.k) for x in p.tries]) AS nb
            FROM steps s JOIN packed p USING (entity) WHERE s.moved >= {TOLERANCE} AND s.i < {STEPS}))""",
    ]
    return ("WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT entity, round(arg_max(a, i), 4) AS alpha, round(arg_max(b, i), 4) AS beta, min(moved) < {TOLERANCE} AS converged
FROM steps GROUP BY entity""")


@query("a8_prior_fit", prior_sql())
def a8_prior_fit(spark, sf):
    """Beta priors of users, items and shops over label rows, run to the tolerance."""
    priors = fit_beta_priors(family(spark, sf, RATES), ENTITIES, max_iter=STEPS, tolerance=TOLERANCE)
    fits = [(entity, p.alpha, p.beta, p.converged) for entity, p in priors.items()]
    table = spark.createDataFrame(fits, "entity string, alpha double, beta double, converged boolean")
    return table.select("entity", F.round("alpha", 4).alias("alpha"), F.round("beta", 4).alias("beta"), "converged")


@query("a11_global_mean", with_log("SELECT round(avg(is_trade), 9) AS mean_trade, count(*) AS n_rows FROM click_log"))
def a11(spark, sf):
    return prepared(spark, sf).agg(F.round(F.avg("is_trade"), 9).alias("mean_trade"), F.count(F.lit(1)).alias("n_rows"))


NUMERIC = (
    "user_id", "item_id", "item_city_id", "shop_id", "context_id", "item_price_level", "item_sales_level",
    "item_collected_level", "item_pv_level", "user_gender_id", "user_age_level", "user_occupation_id",
    "user_star_level", "context_page_id", "shop_review_num_level", "shop_star_level", "day", "hour", "minute", "is_trade",
)


def correlation_sql() -> str:
    pairs = list(itertools.product(NUMERIC, NUMERIC))
    wide = ", ".join(f"corr({a}::DOUBLE, {b}::DOUBLE) AS c{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN isnan(c{i}) THEN NULL ELSE round(c{i}, 6) END AS corr FROM w" for i, (a, b) in enumerate(pairs)
    )
    return with_log(rows, f"w AS MATERIALIZED (SELECT {wide} FROM click_log)")


@query("a14_correlation_matrix", correlation_sql())
def a14(spark, sf):
    matrix = correlation_matrix(prepared(spark, sf), NUMERIC)
    return matrix.select("column_a", "column_b", F.round("corr", 6).alias("corr"))


@query("a15_slice_sizes", with_slices("""
SELECT 'label' AS part, slice, count(*) AS n_rows, 3 AS n_columns FROM l GROUP BY slice
UNION ALL SELECT 'history', slice, count(*), 3 FROM h GROUP BY slice
"""))
def a15(spark, sf):
    log = prepared(spark, sf, SLICES_END).select("instance_id", "event_date")
    parts = {"label": label_rows(log, SLICES), "history": history_rows(log, SLICES)}
    sizes = [slice_sizes(df).select(F.lit(name).alias("part"), "*") for name, df in parts.items()]
    return sizes[0].unionAll(sizes[1])
