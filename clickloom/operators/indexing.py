"""Global row numbers, ordinal codes and folds without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import hash_unit
from clickloom.operators.sizing import BROADCAST_BYTES, fits, shuffled_join
from clickloom.sources.stage import stage


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index") -> DataFrame:
    """Number rows 0..n-1 in the given order.

    Rows are range-partitioned, sorted and numbered per partition, then written once, which fixes
    the numbering; only the partition sizes (one row per partition) are summed up globally.
    """
    mono = F.monotonically_increasing_id()
    numbered = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
            "_part": F.shiftright(mono, 33), "_local": mono.bitwiseAND(F.lit((1 << 33) - 1)),
        }),
        "index",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        # One row per partition of the numbered table: bounded by the partition count.
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_part", "_local", "_offset")
    )


@dataclass(frozen=True)
class Dictionary:
    """Ordinal codes of several columns: rows (column, value, code), with each column's size and longest value."""

    codes: DataFrame
    sizes: dict[str, int]
    widths: dict[str, int]


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """Codes 0..n-1 of the sorted distinct values of every column; numbers sort as numbers.

    All columns are done in one distinct and one sort. NULL gets no code.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def entry(c: str) -> Column:
        number = F.col(c).cast("decimal(38,10)") if isinstance(types[c], T.NumericType) else F.lit(None)
        return F.struct(
            F.lit(c).alias("column"), number.cast("decimal(38,10)").alias("number"),
            F.col(c).cast("string").alias("value"),
        )

    values = (
        df.select(F.explode(F.array(*[entry(c) for c in columns])).alias("e")).select("e.*")
        .dropna(subset=["value"]).distinct()
    )
    indexed = global_index(values, ["column", "number", "value"], "position")
    # One row per encoded column.
    spans = indexed.groupBy("column").agg(
        F.min("position").alias("start"), F.count(F.lit(1)).alias("size"), F.max(F.octet_length("value")).alias("width")
    )
    found = {r["column"]: r for r in spans.collect()}
    spans = spans.select("column", "start")
    codes = indexed.join(F.broadcast(spans), "column").select(
        "column", "value", (F.col("position") - F.col("start")).alias("code")
    )
    # A column of NULLs only has no entry.
    return Dictionary(
        codes,
        {c: found[c]["size"] if c in found else 0 for c in columns},
        {c: found[c]["width"] if c in found else 0 for c in columns},
    )


def encode(
    df: DataFrame, dictionary: Dictionary, columns: dict[str, str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the code of ``column`` as the new ``columns[column]``; dictionaries of small counted size are broadcast."""
    for column, target in sorted(columns.items(), key=lambda c: dictionary.sizes[c[0]]):
        lookup = dictionary.codes.where(f"column = '{column}'").selectExpr(
            f"value AS _value_{column}", f"code AS {target}"
        )
        small = fits(dictionary.sizes[column], 2, dictionary.widths[column], broadcast_bytes)
        lookup = F.broadcast(lookup) if small else shuffled_join(lookup)
        df = df.join(lookup, F.expr(f"cast({column} AS string) = _value_{column}"), "left")
    return df.drop(*[f"_value_{c}" for c in columns])


def shuffled(df: DataFrame, id_col: str = "instance_id", seed: str = "", name: str = "row_index") -> DataFrame:
    """Number the rows in a random but repeatable order: by the hash of their id."""
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(seed)).cast("binary"))
    return global_index(df.withColumn("_key", key), ["_key", id_col], name).drop("_key")


def equal_folds(df: DataFrame, n: int = 10, id_col: str = "instance_id", seed: str = "", name: str = "fold"):
    """``n`` random folds of equal size, the remainder going to the last one."""
    numbered = shuffled(df, id_col, seed, "_row")
    step = max(numbered.count() // n, 1)
    fold = F.least(F.floor(F.col("_row") / F.lit(step)), F.lit(n - 1)).cast("int")
    return numbered.withColumn(name, fold).drop("_row")


def hash_folds(df: DataFrame, n: int = 10, id_col: str = "instance_id", salt: str = "", name: str = "fold"):
    """``n`` random folds by id hash: no shuffle, sizes equal in expectation."""
    return df.withColumn(name, F.floor(hash_unit(id_col, salt=salt) * n).cast("int"))


def holdout(df: DataFrame, share: float = 0.3, id_col: str = "instance_id", salt: str = "holdout"):
    """Split into (rest, held out) by id hash."""
    unit = hash_unit(id_col, salt=salt)
    return df.filter(unit >= F.lit(share)), df.filter(unit < F.lit(share))
