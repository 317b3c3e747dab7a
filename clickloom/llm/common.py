"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed pattern of the word rule: what lies between spaces and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(id_col: str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def crc_fold(doc_id: int, folds: int) -> int:
    """The same in plain Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % folds
