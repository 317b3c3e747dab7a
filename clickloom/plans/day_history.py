"""History at the grain of days: aggregated once per key set, then summed for any window.

Tagging log rows with the slices they serve copies a row once per slice. Here a log row counts once, in the partial result
of its keys and its day. A slice sums the days of its window, so its cost follows the number of (keys, day) pairs; a further
slice reads no log, and a further day only reads its own rows.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.features import (
    LABEL, Family, JoinPolicy, Measure, base_name, fitting, grouped, join_lookups, measure_source, partials,
)
from clickloom.plans.slices import TimeSlice, history_rows
from clickloom.sources.stage import stage

DAY = "event_date"
Grain = tuple[str, ...]


@dataclass(frozen=True)
class DayHistory:
    """Stored partial results: one row per (keys, day) of every grain, laid out by day."""

    tables: dict[Grain, DataFrame]
    rows: dict[Grain, dict[dt.date, int]]  # how many rows each day has
    text_bytes: dict[str, int]  # longest value of every text column

    @property
    def days(self) -> set[dt.date]:
        return {day for counts in self.rows.values() for day in counts}

    def bound(self, grain: Grain, slices: Sequence[TimeSlice]) -> int:
        """Upper bound of the groups of all slices: the partial rows in their windows."""
        return sum(
            n for s in slices for day, n in self.rows[grain].items()
            if day < s.label_date and (s.history_start is None or day >= s.history_start)
        )

    def extended(self, later: DayHistory) -> DayHistory:
        """This history and that of other days. A day may be in one of them only: means over days count it once."""
        if both := self.days & later.days:
            raise ValueError(f"days in both histories: {sorted(both)}")
        if self.tables.keys() != later.tables.keys():
            raise ValueError("the histories are not of the same families")
        return DayHistory(
            {g: t.unionByName(later.tables[g]) for g, t in self.tables.items()},
            {g: n | later.rows[g] for g, n in self.rows.items()},
            {c: max(self.text_bytes.get(c, 0), later.text_bytes.get(c, 0)) for c in self.text_bytes | later.text_bytes},
        )


def grain_of(keys: Sequence[str], kind: str) -> Grain:
    """Keys of the partial results that a measure needs: different items can't be summed, so they stay apart."""
    return tuple(dict.fromkeys([*keys, "item_id"] if kind == "distinct_items" else keys))


def _kinds(families: Sequence[Family]) -> dict[Grain, list[Measure]]:
    """The measures to be counted at every grain; one of each kind."""
    out: dict[Grain, dict[str, Measure]] = defaultdict(dict)
    for m in (m for f in families if f.over == "history" for m in f.measures):
        if m.kind == "distinct_items":
            m = Measure(m.name, m.keys + ("item_id",), "rows")
        out[grain_of(m.keys, m.kind)].setdefault(m.kind, m)
    return {grain: list(measures.values()) for grain, measures in out.items()}


def _stored(table: DataFrame, *sort: str) -> DataFrame:
    """By day, in files of even size: a busy day is split, and small ones share a task."""
    return stage(table.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, *sort), "days", (DAY,))


def day_history(log: DataFrame, families: Sequence[Family], policy: JoinPolicy = JoinPolicy()) -> DayHistory:
    """Partial results of all history families over a stored log.

    Grains with far fewer groups than the log has rows come out of one scan with grouping sets, whose partial aggregates
    leave little to shuffle. Any other grain has an aggregate of its own, which reads and shuffles its few columns only.
    Rows with a null key form groups too and are left out of lookups; rows without a day serve no window.
    """
    kinds = _kinds(families)
    used = dict.fromkeys([DAY, "item_id", LABEL, *[k for grain in kinds for k in grain]])
    log = log.select(*[c for c in used if c in log.columns]).filter(F.col(DAY).isNotNull())

    by_day = {grain: tuple(dict.fromkeys([*grain, DAY])) for grain in kinds}
    found = measure_source(log, list(dict.fromkeys(by_day.values())))
    few = [g for g in kinds if found.groups[by_day[g]] * policy.estimate_margin <= policy.rollup_ratio * found.rows]

    tables, rows = {}, {}
    if few:
        columns = list(dict.fromkeys(k for g in few for k in by_day[g]))
        everything = [m for g in few for m in kinds[g]]
        shared = _stored(
            log.groupingSets([list(by_day[g]) for g in few], *columns)
            .agg(F.grouping_id().alias("_set"), *partials(everything, False)), "_set")
        counts = defaultdict(dict)
        for code, day, n in shared.groupBy("_set", DAY).count().collect():
            counts[code][day] = n
        for g in few:
            code = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in by_day[g])
            tables[g] = shared.where(f"_set = {code}").select(*by_day[g], *_bases(kinds[g]))
            rows[g] = counts[code]

    def own(g: Grain) -> tuple[DataFrame, dict[dt.date, int]]:
        table = _stored(log.groupBy(*by_day[g]).agg(*partials(kinds[g], False)))
        return table, dict(map(tuple, table.groupBy(DAY).count().collect()))

    many = [g for g in kinds if g not in tables]
    with ThreadPoolExecutor(max_workers=4) as pool:
        for g, (table, counted) in zip(many, pool.map(own, many)):
            tables[g], rows[g] = table, counted
    return DayHistory(tables, rows, found.text_bytes)


def _bases(measures: Sequence[Measure]) -> list[str]:
    return list(dict.fromkeys(base_name(m.kind) for m in measures))


def _value(m: Measure):
    if m.kind == "distinct_items":
        return F.count_distinct("item_id")
    return (F.avg if m.daily else F.sum)(base_name(m.kind))


def day_lookup(
    history: DayHistory, keys: Sequence[str], measures: Sequence[Measure], slices: Sequence[TimeSlice]
) -> DataFrame:
    """One row per slice and key: the sums, means or different items of its window's days."""
    parts = defaultdict(list)
    for m in measures:
        parts[grain_of(keys, m.kind)].append(m)
    out = None
    for grain, members in parts.items():
        rows = history_rows(history.tables[grain].dropna(subset=list(keys)), slices)
        part = rows.groupBy("slice", *keys).agg(*[_value(m).alias(m.name) for m in members])
        # Both grains hold the same keys: they were counted over the same rows.
        out = part if out is None else out.join(part, ["slice", *keys])
    return out


def day_family_table(
    target: DataFrame,
    history: DayHistory,
    family: Family,
    slices: Sequence[TimeSlice],
    carry: Sequence[str] = ("slice", "instance_id"),
    keep_counts: bool = False,
    policy: JoinPolicy = JoinPolicy(),
) -> DataFrame:
    """The rows that ``family_table`` gives over the tagged log, from partial results by day.

    A lookup is broadcast if the partial rows in its windows, an upper bound of its groups, fit the policy.
    """
    groups = grouped(family, ("slice",))
    bounds = {g[0]: min(history.bound(grain_of(g[0][1:], m.kind), slices) for m in ms) for g, ms in groups.items()}
    small = fitting(groups, bounds, history.text_bytes, policy)
    lookups = {}
    for g, measures in groups.items():
        lookup = day_lookup(history, g[0][1:], measures, slices)
        # Stored for the reason that family_table stores its large lookups: hot keys are split between bare exchanges only.
        lookups[g] = lookup if g in small else stage(lookup, f"{family.name}-lookup")
    return join_lookups(target, family, lookups, small, carry, ("slice",), keep_counts)
