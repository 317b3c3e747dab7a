"""The corpus pipeline: quality filter, near-dedup, repeat removal, source mixing and BPE encoding and decoding of the
documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the docs of
the next stage. All but the last return the columns of ``documents``.

In every stage repeated rows are treated alike or as said there, an empty table gives an empty table, long texts are
read whole, and further columns pass through, but for the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import bpe, minhash, mixing, quality, suffix_dedup
from clickloom.llm.common import fold_of, table
from clickloom.llm.queries import vocabulary
from clickloom.sources.stage import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; a score equal to the threshold stays.

    Null and empty texts are scored like others. Rows are judged one by one, whether or not they have an id.
    """
    model = quality.fit(docs.where(fold_of("doc_id", 4) != 2), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8 or more.

    The least id of a group stays, and one of the rows that repeat id and text. Rows without an id, without a text or
    without words are in no group and stay.
    """
    return minhash.keep_one(docs, width=5, percent=80)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier too are cut out of the texts; all rows stay.

    Earlier is a smaller id, then an earlier place; a null id is the least, and rows of one id take nothing from each
    other. Null texts stay null; a character that lost a byte goes.
    """
    return suffix_dedup.without_repeats(docs, width=100)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null and empty texts take no words and stay once. A null source is a source. Rows that agree in id, source and size
    are rounded as one unit; documents of one size are taken in hashed order.
    """
    return mixing.taken(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the SHA-256 of what they decode to; documents without a text have no ids.

    Rows are encoded one by one, so repeated rows repeat. Returned are doc_id and source, either may be null, and the results.
    """
    return bpe.Bpe(vocabulary()).encoded(docs, ("doc_id", "source"))


STAGES = [
    ("quality classifier", quality_filter),
    ("near dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("source mixing", source_mix),
    ("BPE encoding", encode),
]

# Fitted models, hashing and rounding have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
