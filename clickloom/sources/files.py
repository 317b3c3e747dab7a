"""Text sources and sinks: space-separated logs and scores, comma-separated feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.sizing import broadcast_if_small
from clickloom.sources.schema import PREDICTION_SCHEMA, click_schema
from clickloom.sources.stage import stage


def _read(spark: SparkSession, path, schema: T.StructType, sep: str) -> DataFrame:
    # FAILFAST: a malformed row stops the job instead of turning into NULLs.
    return (
        spark.read.schema(schema)
        .option("header", True).option("sep", sep)
        .option("enforceSchema", False).option("mode", "FAILFAST")
        .csv(path)
    )


def read_space_text(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return _read(spark, path, schema, " ")


def read_comma_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return _read(spark, path, schema, ",")


def write_space_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("sep", " ").csv(path)


def write_comma_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_predictions(spark: SparkSession, path, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    return read_space_text(spark, path, schema)


def read_click_logs(
    spark: SparkSession,
    labeled: dict[str, str],
    unlabeled: dict[str, str],
    overrides: dict[str, T.DataType] | None = None,
) -> DataFrame:
    """Stack labeled and unlabeled logs by column name.

    Labeled files are freed of exact duplicate rows first, as training logs carry them; the
    ``source`` column keeps the name each file was given, so that a prediction for one file can be
    cut out by name instead of by row position.
    """
    frames = []
    for source, path in labeled.items():
        log = read_space_text(spark, path, click_schema(True, overrides)).dropDuplicates()
        frames.append(log.withColumn("source", F.lit(source)))
    for source, path in unlabeled.items():
        log = read_space_text(spark, path, click_schema(False, overrides))
        frames.append(log.withColumn("source", F.lit(source)))
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def with_file_rows(rows: DataFrame, name: str = "file_row") -> DataFrame:
    """Number the rows of freshly read text files 0..n-1 in file order: by path, and within a file by place.

    Spark reads a file in blocks, each by one task from its first row to its last. A row's number is that of its block's
    first row, a prefix sum over the blocks' sizes (one row per block), plus its place in the block; no data row is sorted.
    ``rows`` must still know the files it was read from, so number before joins and aggregates.
    """
    placed = stage(rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place")), "file-rows")
    blocks = stage(placed.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size")), "file-blocks")
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(broadcast_if_small(stage(starts, "file-starts")), F.expr("_file = _f AND _block = _b")).withColumn(
        name, F.col("_start") + F.col("_place") - F.col("_first")).drop("_file", "_block", "_place", "_f", "_b", "_first", "_start")


def cut_by_position(numbered: DataFrame, first: int, name: str = "file_row") -> tuple[DataFrame, DataFrame]:
    """The first ``first`` rows in file order, and the rest, without their numbers."""
    return tuple(numbered.where(c).drop(name) for c in (F.col(name) < first, F.col(name) >= first))
