"""Distinct rows of wide tables by digest: what moves is narrow unless it repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from clickloom.sources.stage import stage


def digests(columns: list[str]) -> tuple[Column, Column]:
    """128 bits of a row. The hash skips nulls, so which columns are null is hashed as well."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(1), nulls, *columns), F.xxhash64(nulls, *reversed(columns), F.lit(2))


def distinct_rows(rows: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One of each set of equal rows, the first as stored; nulls equal each other.

    ``rows`` is a stored table, read three times. Only (digest, row number) is grouped. Rows whose digest repeats are compared
    in full, so a chance collision drops nothing; all others stay where they are. The numbers of the rows to leave out are
    broadcast if few enough; beyond that the tables meet by row number.
    """
    columns = rows.columns
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    a, b = digests(columns)
    marked = numbered.select("_row", a.alias("_a"), b.alias("_b"))
    repeated = stage(marked.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        F.col("_a").alias("_x"), F.col("_b").alias("_y")), "digests")
    if repeated.isEmpty():
        return rows
    suspects = marked.join(broadcast_if_small(repeated, broadcast_bytes), F.expr("_a = _x AND _b = _y")).select(F.col("_row").alias("_s"))
    found = stage(numbered.join(broadcast_if_small(stage(suspects, "suspects"), broadcast_bytes), F.expr("_row = _s")).drop("_s"), "repeats")
    kept = found.groupBy(*columns).agg(F.min("_row").alias("_k")).select("_k")
    lost = stage(found.select("_row").join(kept, F.expr("_row = _k"), "left_anti").select(F.col("_row").alias("_l")), "lost")
    return numbered.join(broadcast_if_small(lost, broadcast_bytes), F.expr("_row = _l"), "left_anti").drop("_row")
