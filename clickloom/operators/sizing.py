"""Size checks behind every broadcast of a table that grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def row_bytes(n_fields: int, text_bytes: int = 0) -> int:
    """Upper bound of a row in a hashed relation: one word per field, texts at their longest, overhead."""
    return 32 + 8 * n_fields + text_bytes


def fits(rows: int, n_fields: int, text_bytes: int = 0, limit: int = BROADCAST_BYTES) -> bool:
    return rows * row_bytes(n_fields, text_bytes) <= limit


def shuffled_join(side: DataFrame) -> DataFrame:
    """Mark the side of a join that grows with the data, so that it never passes through the driver.

    Spark judges a stored table by the bytes of its files: a few MB of well compressed rows are a hashed relation of some
    hundred MB, and one join after the other sends such a relation to the driver. Hot keys are split as in any shuffle join.
    """
    return side.hint("merge")


def broadcast_if_small(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a *stored* lookup for broadcast if its counted rows, at their widest, stay within ``limit``.

    Anything larger becomes a shuffle join, with hot keys split by adaptive execution.
    """
    texts = [F.coalesce(F.max(F.octet_length(c)), F.lit(0)).alias(c) for c, kind in lookup.dtypes if kind == "string"]
    row = lookup.agg(F.count(F.lit(1)).alias("_rows"), *texts).first().asDict()
    small = fits(row.pop("_rows"), len(lookup.columns), sum(row.values()), limit)
    return F.broadcast(lookup) if small else shuffled_join(lookup)
