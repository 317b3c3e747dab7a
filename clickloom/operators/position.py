"""Position, gap, repeat and re-click features.

None of them opens a window over a whole key: a key that holds a large share of all rows would end
up in one task. First and last rows come from partial aggregates joined back; running counts are
built from per-second counts, in chunks of bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.sizing import shuffled_join
from clickloom.sources.stage import stage

ORDER = ("context_timestamp", "instance_id")
CHUNK_SECONDS = 86_400

# Output prefix -> key set of the four position features.
POSITION_KEYS = {
    "": ("user_id", "item_id", "shop_id"),
    "u": ("user_id",),
    "b": ("user_id", "item_brand_id"),
    "c": ("user_id", "last_category_id"),
}
SINGLE, MIDDLE, FIRST, LAST = 0, 1, 2, 3
NO_GAP = -1


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join in which NULL keys are equal to each other; key columns are kept once."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(shuffled_join(renamed), match, how).drop(*[f"_r_{k}" for k in keys])


def add_positions(
    rows: DataFrame,
    keys: Sequence[str],
    prefix: str = "",
    scope: Sequence[str] = ("slice",),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Flag each row as the single, first, middle or last of its key, with seconds to both ends.

    Rows are ordered by ``order``, whose first column is the time; gaps of single rows are -1.
    """
    time, mark = F.col(order[0]), F.struct(*order)
    on = [*scope, *keys]
    ends = rows.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_n"), F.min(mark).alias("_first"), F.max(mark).alias("_last")
    )
    joined = _same_key(rows, ends, on, "left")
    single = F.col("_n") == 1
    flag = (
        F.when(single, SINGLE).when(mark == F.col("_first"), FIRST).when(mark == F.col("_last"), LAST)
        .otherwise(MIDDLE)
    )
    return joined.withColumns({
        f"{prefix}maybe": flag,
        f"{prefix}diffTime_first": F.when(single, NO_GAP).otherwise(time - F.col(f"_first.{order[0]}")),
        f"{prefix}diffTime_last": F.when(single, NO_GAP).otherwise(F.col(f"_last.{order[0]}") - time),
    }).drop("_n", "_first", "_last")


def position_table(
    rows: DataFrame,
    carry: Sequence[str] = ("slice", "instance_id"),
    scope: Sequence[str] = ("slice",),
    key_sets: dict[str, tuple[str, ...]] = POSITION_KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    keys = [k for ks in key_sets.values() for k in ks]
    out = rows.select(*dict.fromkeys([*carry, *scope, *keys, *order]))
    names = []
    for prefix, key_set in key_sets.items():
        out = add_positions(out, key_set, prefix, scope, order)
        names += [f"{prefix}maybe", f"{prefix}diffTime_first", f"{prefix}diffTime_last"]
    return out.select(*carry, *names)


def running_count(
    rows: DataFrame, keys: Sequence[str], time: str, name: str, direction: str = "before", single_day: bool = False
) -> DataFrame:
    """Per (keys, time): rows of the key with a time up to this one (``before``) or from it (``after``).

    Counts are first reduced to one row per key and second. They are summed within chunks of a
    day, and the chunk totals across chunks, so that no window holds more rows than a day has
    seconds, however hot the key. ``single_day`` says that no key spans more than a day: one chunk.
    """
    keys = list(keys)
    step = (lambda c: F.col(c).desc()) if direction == "after" else (lambda c: F.col(c).asc())
    per_second = rows.dropna(subset=keys).groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"))
    if single_day:
        running = F.sum("_n").over(Window.partitionBy(*keys).orderBy(step(time)))
        return per_second.select(*keys, time, running.alias(name))

    # Read twice below, so stored.
    per_second = stage(per_second.withColumn("_chunk", F.floor(F.col(time) / CHUNK_SECONDS)), "seconds")
    inside = F.sum("_n").over(Window.partitionBy(*keys, "_chunk").orderBy(step(time)))
    earlier = F.sum("_total").over(
        Window.partitionBy(*keys).orderBy(step("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = (
        per_second.groupBy(*keys, "_chunk").agg(F.sum("_n").alias("_total"))
        .select(*keys, "_chunk", F.coalesce(earlier, F.lit(0)).alias("_carried"))
    )
    return (
        per_second.withColumn("_inside", inside)
        .join(shuffled_join(chunks), [*keys, "_chunk"])
        .select(*keys, time, (F.col("_inside") + F.col("_carried")).alias(name))
    )


def reclick_table(
    rows: DataFrame,
    keys: Sequence[str] = ("user_id", "item_id"),
    carry: Sequence[str] = ("slice", "instance_id"),
    scope: Sequence[str] = ("slice",),
    time: str = ORDER[0],
    name: str = "leak_user_final_cat_reclick",
    direction: str = "before",
) -> DataFrame:
    """Other rows of the same key at or before (``after``: at or after) the time of each row.

    A scope column (a label slice, a date) is taken to confine rows to one day; without one, the
    whole log counts.
    """
    on = [*scope, *keys]
    out = rows.select(*dict.fromkeys([*carry, *on, time]))
    counts = running_count(out, on, time, "_count", direction, single_day=bool(scope))
    return out.join(shuffled_join(counts), [*on, time], "left").select(*carry, (F.col("_count") - 1).alias(name))


def keep_end(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, last: bool = False) -> DataFrame:
    """The first (or last) row of every key, NULL keys counting as equal."""
    pick = F.max_by if last else F.min_by
    whole = pick(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(whole).select("_row.*")


def drop_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """All rows but the latest of each key; keys with one row vanish, as do rows with a NULL key."""
    ends = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"))
    # Stored, so that a join on a hot key can be split.
    ends = stage(ends, "ends")
    return rows.join(ends, list(keys)).filter(F.struct(*order) < F.col("_last")).drop("_last")


def repeated_groups(rows: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """Groups with at least that many rows (a HAVING), with their row count."""
    return (
        rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("same_user_click_times"))
        .filter(F.col("same_user_click_times") >= at_least)
    )


def repeat_clicks(
    rows: DataFrame,
    group: Sequence[str] = ("user_id", "item_id", "shop_id"),
    within: Sequence[str] = ("event_date", "hour"),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Rows clicked repeatedly within an hour, without the latest such row of each user, item and shop.

    Group sizes and latest marks come from one aggregate, so the rows are joined once.
    """
    group, fine = list(group), [*group, *within]
    # The window runs over groups, not rows: at most one per hour of the log and key.
    latest = F.max("_end").over(Window.partitionBy(*group))
    marked = (
        rows.dropna(subset=fine).groupBy(*fine)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*order)).alias("_end"))
        .filter("_n > 1").select(*fine, latest.alias("_last"))
    )
    return rows.join(marked, fine).filter(F.struct(*order) < F.col("_last")).drop("_last")


def scale_scores(
    scores: DataFrame, ids: DataFrame, id_col: str = "instance_id", score: str = "predicted_score",
    divisor: float = 5.0,
) -> DataFrame:
    """Divide the score of every row whose id is in ``ids``; other rows keep theirs."""
    flagged = ids.select(id_col).distinct().withColumn("_hit", F.lit(True))
    scaled: Column = F.when(F.col("_hit"), F.col(score) / F.lit(divisor)).otherwise(F.col(score))
    return scores.join(flagged, id_col, "left").withColumn(score, scaled).drop("_hit")
