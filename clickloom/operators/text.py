"""TF-IDF of delimited or free text, as an exact long table and as vectors for models.

Default vectoriser rules: lower case, tokens of two or more word characters, raw term counts,
smooth idf ``ln((1 + n) / (1 + df)) + 1``, rows scaled to length one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, Normalizer, VectorSlicer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from clickloom.sources.stage import spread, stage

# Runs of word characters in any script, two at least.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens_of(text: str) -> Column:
    """Array of the lower-case tokens of a text; empty for NULL."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def term_counts(docs: DataFrame, text: str, ids: Sequence[str]) -> DataFrame:
    """(ids, term, tf). Terms are counted where the text lies before anything is shuffled."""
    return docs.select(*ids, F.explode(tokens_of(text)).alias("term")).groupBy(*ids, "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def document_frequencies(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf_table(docs: DataFrame, text: str, ids: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(ids, term, tf, df, weight) with rows of unit length; documents are not collected anywhere.

    Texts go to their id once, where they are split and counted; a stored row holds the distinct terms of one id, so never
    more than the vocabulary. Lengths come from partial sums where those rows lie, one row per id, and join them whole:
    single terms are not shuffled unless the frequencies are too many for a broadcast.
    """
    ids = list(ids)
    counted = term_counts(docs.select(*ids, text).repartition(*ids), text, ids)
    lists = stage(counted.groupBy(*ids).agg(F.collect_list(F.struct("term", "tf")).alias("_terms")), "terms")

    def counts(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*ids, *more, F.inline("_terms"))

    frequencies = broadcast_if_small(stage(document_frequencies(counts(lists)), "frequencies"), broadcast_bytes)
    n_docs = docs.count()
    raw = F.col("tf") * (F.log(F.lit(n_docs + 1.0) / (F.col("df") + 1)) + 1)
    norms = stage(counts(lists).join(frequencies, "term").groupBy(*ids).agg(F.sqrt(F.sum(raw * raw)).alias("_norm")), "norms")
    same = " AND ".join(f"{c} <=> _of_{c}" for c in ids)
    whole = lists.join(norms.withColumnsRenamed({c: f"_of_{c}" for c in ids}), F.expr(same))
    return counts(whole, "_norm").join(frequencies, "term").select(*ids, "term", "tf", "df", (raw / F.col("_norm")).alias("weight"))


def fit_tfidf(
    docs: DataFrame, tokens: str, output: str = "text_vector", width: int = 1 << 14, places: DataFrame | None = None,
    weight: str | None = None,
) -> PipelineModel:
    """Vectors of token arrays: every term is hashed to one of ``width`` places, whatever the size of the vocabulary.

    Terms that share a place add up. The width is a parameter and never follows from the data. The IDF stage lacks the
    ``+ 1`` of the smooth idf; since ``tf * (idf + 1)`` is an elementwise product with a fixed vector, the fitted
    weights are folded into one ``ElementwiseProduct``. With ``places`` (see ``occupied_places``) the unit-length
    vectors are cut to these places in the end, place 0..n-1 being the n listed ones in ascending order. A row counts
    as ``weight`` documents where that column is given; distinct token arrays are then hashed once.
    """
    tf = HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=width)
    if weight is None:
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(tf.transform(docs)).idf.toArray()
    else:
        idf = weighted_idf(docs.groupBy(tokens).agg(F.sum(weight).alias("_n")), tf, width)
    weights = Vectors.dense(idf + 1.0)
    stages = [
        tf,
        ElementwiseProduct(scalingVec=weights, inputCol="_tf", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol=output if places is None else "_whole", p=2.0),
    ]
    if places is not None:
        # At most ``width`` numbers. Without any term the first place stands in, where all vectors are 0.
        listed = [r["place"] for r in places.orderBy("code").collect()]
        stages.append(VectorSlicer(inputCol="_whole", outputCol=output, indices=listed or [0]))
    return PipelineModel(stages=stages)


def places_of(vector: str) -> Column:
    """The places of a sparse vector's entries: a vector shows them in its JSON form only."""
    return F.from_json(F.to_json(F.struct(vector)), f"{vector} struct<indices array<int>>")[vector]["indices"]


def weighted_idf(counted: DataFrame, tf: HashingTF, width: int) -> np.ndarray:
    """``ln((1 + n) / (1 + df))`` of every place over token arrays that stand for ``_n`` documents each.

    At most ``width`` numbers reach the driver.
    """
    n_docs = counted.agg(F.sum("_n")).first()[0] or 0
    found = tf.transform(counted).select(F.explode(places_of("_tf")).alias("place"), "_n").groupBy("place").agg(F.sum("_n").alias("df"))
    df = np.zeros(width)
    for r in found.collect():
        df[r["place"]] = r["df"]
    return np.log((n_docs + 1.0) / (df + 1.0))


def occupied_places(docs: DataFrame, tokens: str, width: int = 1 << 14) -> DataFrame:
    """Stored map (place, code) of the hash places that any token of ``docs`` falls into, coded 0..n-1 in ascending order.

    Trees can only split where their rows differ, so a place that is empty in all of them is a column to skip. Every
    distinct term is hashed once; the table has at most ``width`` rows.
    """
    terms = docs.select(F.explode(tokens).alias("term")).distinct().select(F.array("term").alias("_term"))
    hashed = HashingTF(inputCol="_term", outputCol="_place", numFeatures=width).transform(terms)
    places = hashed.select(F.explode(places_of("_place")).alias("place")).distinct()
    # A window over at most ``width`` rows.
    code = F.row_number().over(Window.orderBy("place")) - 1
    return stage(places.select("place", code.alias("code")), "places")
