"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Each source gets a target number of words. Document rates stay as close to 1 as they can (least Kullback-Leibler
divergence) while every source meets its target and no rate passes ``most``: ``rate = min(most, exp(theta * size))``,
one ``theta`` per source. All thetas are found together by Newton steps on the dual, safeguarded by brackets; a step
is one aggregate over the histogram of sizes.

Rates are rounded to whole copies on that histogram, as documents of one size share a rate: whole copies of a size are
the steps of the cumulated rates, longest documents first, so the first pass misses a source's words by half its
longest document at most. What is missing or too much then moves the rates of the source's shortest documents, ten
times as many words as are due if there are so many, which are rounded anew; passes go on while they bring a source
nearer. With short documents enough, a source misses by a few words. The copies of a size are dealt evenly over its
documents in hashed order, in blocks with a prefix over the blocks. A window here holds the distinct sizes of a source,
at most the root of twice its words, and never its documents.

Defined results: a null or empty text has size 0, takes no words and keeps one copy; a null source is a source of
its own, the last. Rows that agree in id, source and size are repeated rows: they are rounded as one unit and share
their copies. Null ids are ids like any other. An empty table gives an empty table. Only id, source and text are
read, under names of this module's own, so clashing names don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import WORD
from clickloom.operators.indexing import global_index
from clickloom.sources.stage import stage

BLOCK_ROWS = 512
PASSES = 8


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """(source, source_size, n, target): weights repeat over the sources in code point order, nulls last.

    Targets share the total by weight; one above ``most`` times its source's size stops there, and the excess is
    shared again by weight until none is above.
    """
    per_source = stage(
        sizes.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"),
            F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
            F.try_divide(F.sum(F.col("size").cast("double") * F.col("size")), F.sum("size")).alias("typical"),
        ),
        "mix-sources",
    )
    ranked = global_index(per_source, [F.col("source").isNull(), "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight), "mix-weights")
    limit = F.col("source_size") * F.lit(float(most))
    level = 0.0
    while True:
        stopped = limit < F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(stopped, limit).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        raised = (row["total"] - row["stopped"]) / row["weight"] if row["weight"] else level
        if raised <= level:
            break
        level = raised
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def tilts(sizes: DataFrame, targets: DataFrame, most: float = 3.0, tolerance: float = 1e-10, steps: int = 60) -> DataFrame:
    """``targets`` with the tilt ``theta`` of each source; a rate is ``least(most, exp(theta * size / typical))``."""
    histogram = stage(
        sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram"
    ).withColumnsRenamed({"source": "h_source", "n": "h_n"})
    share = F.try_divide("target", "source_size")
    reach = F.try_divide("typical", "least")  # here even the shortest document is beyond its bound
    state = targets.withColumns({
        "theta": F.lit(0.0),
        "low": F.when(share < 1, F.log(share) * reach).otherwise(0.0),
        "high": F.when(share > 1, F.lit(math.log(most)) * reach).otherwise(0.0),
        "solved": F.coalesce(F.col("source_size"), F.lit(0)) == 0,
    })
    state = state.withColumns({
        # At the bound all rates are ``most``.
        "solved": F.col("solved") | (share >= most * (1 - 1e-12)),
        "theta": F.when(share >= most * (1 - 1e-12), F.col("high")).otherwise(0.0),
    })
    state = stage(state, "mix-tilt")
    for _ in range(steps):
        tilted = F.exp(F.col("theta") * F.col("size") / F.col("typical"))
        words = F.col("h_n") * F.col("size") * F.least(F.lit(float(most)), tilted)
        slope = F.when(tilted < most, words * F.col("size") / F.col("typical")).otherwise(0.0)
        open_ones = state.where("NOT solved").select("source", "theta", "typical")
        sums = (
            histogram.join(open_ones, F.col("h_source").eqNullSafe(F.col("source")))
            .groupBy(F.col("source").alias("s_source")).agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        )
        moved = state.join(stage(sums, "mix-sums"), F.col("source").eqNullSafe(F.col("s_source")), "left")
        # Newton on the logarithm of the sum; a step out of the bracket becomes its middle.
        above = F.col("words") > F.col("target")
        low = F.when(F.col("words") < F.col("target"), F.col("theta")).otherwise(F.col("low"))
        high = F.when(above, F.col("theta")).otherwise(F.col("high"))
        newton = F.col("theta") - F.log(F.try_divide("words", "target")) * F.try_divide("words", "slope")
        done = F.col("solved") | (F.abs(F.try_divide("words", "target") - 1) < tolerance)
        moved = moved.withColumns({"low": low, "high": high, "next": newton, "solved": F.coalesce(done, F.lit(True))})
        inside = (F.col("next") > F.col("low")) & (F.col("next") < F.col("high"))
        theta = F.when(F.col("solved"), F.col("theta")).when(inside, F.col("next")).otherwise((F.col("low") + F.col("high")) / 2)
        state = stage(moved.withColumn("theta", theta).drop("next", "words", "slope", "s_source"), "mix-tilt")
        if state.where("NOT solved").isEmpty():
            break
    # Rounded, so that the order of sums leaves no trace in the copies.
    return state.withColumn("theta", F.round("theta", 9)).drop("low", "high", "solved")


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, id_col: str = "doc_id", source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(id, source, size, rows, source_size, target, rate, copies): one row per distinct (id, source, size).

    ``rows`` counts the repeated rows; every one of them is to be taken ``copies`` times.
    """
    sizes = stage(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")), "mix-sizes"
    )
    solved = tilts(sizes, source_targets(sizes, weights, most), most)
    solved = stage(solved.select(F.col("source").alias("t_source"), "source_size", "target", "theta", "typical"), "mix-solved")
    units = stage(sizes.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    tilt = F.exp(F.col("theta") * F.try_divide("size", "typical"))
    bins = units.groupBy("source", "size", "rows").agg(F.count(F.lit(1)).alias("n")).join(
        solved, F.col("source").eqNullSafe(F.col("t_source"))
    ).select(
        "source", "source_size", "target", "size", "rows", "n", (F.col("size") * F.col("rows")).alias("words"),
        F.when(F.col("size") > 0, F.least(F.lit(float(most)), tilt)).otherwise(1.0).alias("rate"),
    )
    return dealt(units, whole_copies(stage(bins, "mix-bins"), most))


def whole_copies(bins: DataFrame, most: int = 3) -> DataFrame:
    """``bins`` (source, size, rows, n units of so many words each, rate, target) with the ``total`` copies of its units."""
    source = Window.partitionBy("source")
    falling = source.orderBy(F.desc("words"), "size").rowsBetween(Window.unboundedPreceding, 0)
    rising = source.orderBy("words", "size").rowsBetween(Window.unboundedPreceding, 0)

    def steps(rate: Column, member: Column) -> Column:
        # Decimals, so that sums are exact.
        quota = F.when(member, F.round(F.col("n") * rate, 9)).otherwise(0.0).cast("decimal(28,9)")
        upto = F.sum(quota).over(falling)
        half = F.lit("0.5").cast("decimal(2,1)")
        return (F.floor(upto + half) - F.floor(upto - quota + half)).cast("long")

    weight = F.col("n") * F.col("words")
    rooms = {"more": weight * (most - F.col("rate")), "less": weight * F.col("rate")}
    state = stage(bins.withColumn("total", steps(F.col("rate"), F.lit(True))), "mix-total")
    for _ in range(PASSES):
        passed = state.withColumn("taken", F.sum(F.col("total") * F.col("words")).over(source))
        passed = passed.withColumn("due", F.col("target") - F.col("taken"))
        room = F.when(F.col("due") > 0, rooms["more"]).otherwise(rooms["less"])
        passed = passed.withColumn("before", F.sum(room).over(rising) - room)
        size = F.abs("due")
        # A unit of more than twice the words due can only make it worse.
        passed = passed.withColumn("member", (F.col("words") > 0) & (F.col("words") <= 2 * size) & (F.col("before") < 10 * size))
        passed = passed.withColumns({
            "had": F.sum(F.when(F.col("member"), F.col("total") * F.col("words")).otherwise(0)).over(source),
            "expected": F.sum(F.when(F.col("member"), weight * F.col("rate")).otherwise(0.0)).over(source),
            **{k: F.sum(F.when(F.col("member"), r).otherwise(0.0)).over(source) for k, r in rooms.items()},
        })
        passed = passed.withColumn("change", F.col("due") + F.col("had") - F.col("expected"))
        share = {k: F.least(F.lit(1.0), F.coalesce(F.try_divide(F.abs("change"), k), F.lit(0.0))) for k in rooms}
        moved = F.when(F.col("change") > 0, F.col("rate") + share["more"] * (most - F.col("rate"))) \
            .otherwise(F.col("rate") * (1 - share["less"]))
        passed = passed.withColumn("anew", steps(moved, F.col("member")))
        left = F.col("due") + F.col("had") - F.sum(F.col("anew") * F.col("words")).over(source)
        passed = passed.withColumn("nearer", F.abs(left) < F.abs("due"))
        state = stage(
            passed.withColumn("total", F.when(F.col("nearer") & F.col("member"), F.col("anew")).otherwise(F.col("total")))
            .select(*bins.columns, "total", "nearer"),
            "mix-total",
        )
        if state.where("nearer").isEmpty():
            break
        state = state.drop("nearer")
    return state.drop("nearer")


def dealt(units: DataFrame, bins: DataFrame) -> DataFrame:
    """``units`` with their copies: the total of a bin, dealt evenly in hashed order."""
    names = {"source": "b_source", "size": "b_size", "rows": "b_rows"}
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    found = stage(
        units.join(
            bins.withColumnsRenamed(names),
            F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size")) & (F.col("rows") == F.col("b_rows")),
        ).drop(*names.values()).withColumn("block", F.pmod(F.xxhash64("id", "size"), blocks)),
        "mix-found",
    )
    keys = ("source", "size", "rows", "block")
    counts = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("here"))
    prefix = Window.partitionBy("source", "size", "rows").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    starts = stage(counts.select(*[F.col(k).alias(f"p_{k}") for k in keys], (F.sum("here").over(prefix) - F.col("here")).alias("start")), "mix-starts")
    order = Window.partitionBy(*keys).orderBy(F.xxhash64("size", "id"), "id")
    placed = found.withColumn("place", F.row_number().over(order)).join(
        starts,
        F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")) & (F.col("rows") == F.col("p_rows"))
        & (F.col("block") == F.col("p_block")),
    ).withColumn("place", F.col("place") + F.col("start"))
    copies = F.expr("cast((place * total) div n - ((place - 1) * total) div n AS int)")
    return placed.select(
        "id", "source", "size", "rows", "source_size", "target", "rate",
        F.when(F.col("size") > 0, copies).otherwise(1).cast("int").alias("copies"),
    )


def taken(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with every row as often as the mix takes it. Documents without words stay."""
    names = {c: f"_mix_{c}" for c in ("id", "source", "size", "copies")}
    copies = mixed.select(*[F.col(c).alias(n) for c, n in names.items()])
    joined = docs.withColumn("_mix_words", word_count(text_col)).join(
        copies,
        F.col(id_col).eqNullSafe(F.col("_mix_id")) & F.col(source_col).eqNullSafe(F.col("_mix_source"))
        & (F.col("_mix_words") == F.col("_mix_size")),
    )
    repeated = joined.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies"))))
    return repeated.select(*docs.columns)
