"""TF-IDF on real prose and on the log's own lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, sliced
from clickloom.operators.text import tfidf_table
from clickloom.sources import table
from oracle.click_log import with_slices


def tfidf_sql(docs: str, text: str, ids: str) -> str:
    """CTEs from ``docs`` to the table ``weights``."""
    first = ids.split(",")[0].strip()
    return f"""
tok AS (SELECT {ids}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {docs}),
tf AS (SELECT {ids}, term, count(*) AS tf FROM tok GROUP BY {ids}, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT {ids}, term, tf, df,
          tf * (ln(((SELECT count(*) FROM {docs}) + 1)::DOUBLE / (df + 1)::DOUBLE) + 1) AS raw
        FROM tf JOIN df USING (term)),
weights AS (SELECT {ids}, term, tf, df, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY {ids})), 6) AS weight FROM raw)
"""


@query("m1_tfidf_documents", "WITH " + tfidf_sql("documents", "text", "doc_id") + "SELECT * FROM weights")
def m1_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tfidf_table(docs, "text", ["doc_id"]).withColumn("weight", F.round("weight", 6))


@query("m1_d5_tfidf_fitted_jointly", with_slices(
    "SELECT slice, instance_id, term, tf, df, weight FROM weights WHERE part = 'label'",
    """both_parts AS (
      SELECT 'history' AS part, slice, instance_id, item_property_list FROM h
      UNION ALL SELECT 'label', slice, instance_id, item_property_list FROM l)""",
    tfidf_sql("both_parts", "item_property_list", "part, slice, instance_id")))
def m1_joint(spark, sf):
    """Property lists of history and label rows weighted together, label rows split back."""
    labels, history = sliced(spark, sf, ["item_property_list"])
    columns = ["slice", "instance_id", "item_property_list"]
    both = history.select(F.lit("history").alias("part"), *columns).unionAll(
        labels.select(F.lit("label").alias("part"), *columns))
    weights = tfidf_table(both, "item_property_list", ["part", "slice", "instance_id"])
    return weights.filter("part = 'label'").drop("part").withColumn("weight", F.round("weight", 6))
