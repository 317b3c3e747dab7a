"""Spec-driven aggregate features: one aggregate and one left join per key set.

A family lists measures (key set, what to count) and rates (quotients of measures). Before any
join is planned, one pass over the source estimates the number of groups of every key set and the
length of its texts. From these sizes follow two decisions:

* lookups proven small come out of one scan with grouping sets and are broadcast, within a budget
  per lookup and in total; all others are aggregated on their own, stored and joined by shuffle,
  where adaptive execution splits hot keys (it does so between stored tables only);
* if the combination of all coarse keys has far fewer groups than the source has rows, the source
  is first reduced to that grain, and the lookups are rolled up from the reduced table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.sizing import BROADCAST_BYTES, row_bytes, shuffled_join
from clickloom.sources.stage import stage

LABEL = "is_trade"


@dataclass(frozen=True)
class Measure:
    """One aggregate per key. ``daily`` averages the per-day value over the days with activity."""

    name: str
    keys: tuple[str, ...]
    kind: str = "rows"  # rows | label_sum | ones | items | distinct_items
    fill: int | None = None
    daily: bool = False


@dataclass(frozen=True)
class Rate:
    """Quotient of two measures, or the beta-smoothed one when a prior is given."""

    name: str
    hits: str
    tries: str
    prior: tuple[float, float] | None = None


@dataclass(frozen=True)
class Conversion:
    """The usual triple: clicks, buys and their rate over one key set."""

    keys: tuple[str, ...]
    clicks: str
    buys: str
    rate: str
    prior: tuple[float, float] | None = None
    keep: bool = False
    hits: str = "label_sum"


@dataclass(frozen=True)
class Family:
    name: str
    measures: tuple[Measure, ...]
    rates: tuple[Rate, ...] = ()
    kept: tuple[str, ...] = ()
    over: str = "history"  # history | label: which rows are aggregated

    @classmethod
    def of_conversions(
        cls, name: str, conversions: Sequence[Conversion], extra: Sequence[Measure] = ()
    ) -> Family:
        measures, rates, kept = list(extra), [], [m.name for m in extra]
        for c in conversions:
            fill = 0 if c.prior else None
            measures.append(Measure(c.clicks, c.keys, "rows", fill))
            measures.append(Measure(c.buys, c.keys, c.hits, fill))
            rates.append(Rate(c.rate, c.buys, c.clicks, c.prior))
            kept += [c.clicks, c.buys, c.rate] if c.keep else [c.rate]
        return cls(name, tuple(measures), tuple(rates), tuple(kept))

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(k for m in self.measures for k in m.keys))

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures) + tuple(r.name for r in self.rates)

    def outputs(self, keep_counts: bool = False) -> tuple[str, ...]:
        return self.columns if keep_counts or not self.kept else self.kept


@dataclass(frozen=True)
class JoinPolicy:
    """Size bounds for the choice of plan."""

    broadcast_bytes: int = BROADCAST_BYTES  # per lookup
    total_broadcast_bytes: int = 8 * BROADCAST_BYTES  # all lookups of a family together
    estimate_margin: float = 1.25  # over the error of the distinct-count sketch
    rollup_ratio: float = 0.2  # reduce the source first if that leaves at most this share of rows
    fine_keys: frozenset[str] = field(default=frozenset({"user_id", "context_id", "minute"}))


def _primitive(kind: str):
    """Row-level aggregate of a kind, and the way its partial results merge."""
    return {
        "rows": F.count(F.lit(1)),
        "label_sum": F.coalesce(F.sum(F.col(LABEL).cast("bigint")), F.lit(0).cast("bigint")),
        "ones": F.count_if(F.col(LABEL) == 1),
        "items": F.count("item_id"),
    }[kind]


def base_name(kind: str) -> str:
    return f"base_{kind}"


@dataclass(frozen=True)
class SourceSizes:
    rows: int
    groups: dict[tuple[str, ...], int]  # estimated, by key set
    text_bytes: dict[str, int]  # longest value of every text column


def measure_source(source: DataFrame, key_sets: Sequence[tuple[str, ...]]) -> SourceSizes:
    """Rows, groups per key set and the longest texts: one pass, one result row."""
    # Expressions as text: hundreds of small column calls would cost more than the job on small data.
    sketches = [
        f"hll_sketch_estimate(hll_sketch_agg(xxhash64({', '.join(ks)}), 12)) AS g{i}" for i, ks in enumerate(key_sets)
    ]
    texts = [c for c, kind in source.dtypes if kind == "string"]
    longest = [f"max(octet_length({c})) AS len_{c}" for c in texts]
    row = source.selectExpr("count(1) AS n", *sketches, *longest).first()
    return SourceSizes(
        row["n"], {ks: row[f"g{i}"] for i, ks in enumerate(key_sets)}, {c: row[f"len_{c}"] or 0 for c in texts}
    )


def source_sizes(
    source: DataFrame, families: Sequence[Family], scope: Sequence[str] = ("slice",), policy: JoinPolicy | None = None
) -> SourceSizes:
    """Sizes for all families over one source, in one pass."""
    key_sets = dict.fromkeys(ks for f in families for ks in _key_sets(grouped(f, tuple(scope)), tuple(scope), policy or JoinPolicy()))
    columns = dict.fromkeys(c for ks in key_sets for c in ks)
    return measure_source(source.select(*columns), list(key_sets))


def grouped(family: Family, scope: tuple[str, ...]) -> dict[tuple, list[Measure]]:
    groups: dict[tuple, list[Measure]] = defaultdict(list)
    for m in family.measures:
        groups[(scope + m.keys, m.daily)].append(m)
    return groups


def _base_keys(groups: dict[tuple, list[Measure]], policy: JoinPolicy) -> tuple[set[tuple], tuple[str, ...]]:
    """The groups that can be rolled up from a common base, and the keys of that base."""
    coarse = {g for g, ms in groups.items() if _is_additive(ms) and not policy.fine_keys & set(g[0])}
    return coarse, tuple(dict.fromkeys(k for g in groups if g in coarse for k in g[0]))


def _key_sets(groups: dict[tuple, list[Measure]], scope: tuple[str, ...], policy: JoinPolicy) -> list[tuple[str, ...]]:
    return [*[keys for keys, _ in groups], _base_keys(groups, policy)[1] or scope]


def _is_additive(measures: Sequence[Measure]) -> bool:
    return not any(m.daily or m.kind == "distinct_items" for m in measures)


def _aggregate(source: DataFrame, keys: tuple[str, ...], measures: Sequence[Measure], merged: bool) -> DataFrame:
    """The lookup of one key set. ``merged`` sources carry partial results instead of log rows."""
    source = source.dropna(subset=list(keys))
    if measures[0].daily:
        kinds = dict.fromkeys(m.kind for m in measures)
        per_day = source.groupBy(*keys, "event_date").agg(*[_primitive(k).alias(base_name(k)) for k in kinds])
        return per_day.groupBy(*keys).agg(*[F.avg(base_name(m.kind)).alias(m.name) for m in measures])
    aggregates = []
    for m in measures:
        if m.kind == "distinct_items":
            expr = F.count_distinct("item_id")
        else:
            expr = F.sum(base_name(m.kind)) if merged else _primitive(m.kind)
        aggregates.append(expr.alias(m.name))
    return source.groupBy(*keys).agg(*aggregates)


def partials(measures: Sequence[Measure], merged: bool):
    for kind in dict.fromkeys(m.kind for m in measures):
        name = base_name(kind)
        yield (F.sum(name) if merged else _primitive(kind)).alias(name)


def _small_lookups(
    source: DataFrame, groups: dict[tuple[str, ...], list[Measure]], merged: bool, label: str
) -> dict[tuple[str, ...], DataFrame]:
    """Lookups of several small key sets from one scan: grouping sets, stored once, then split."""
    columns = list(dict.fromkeys(k for keys in groups for k in keys))
    everything = [m for measures in groups.values() for m in measures]
    table = stage(
        source.groupingSets([list(keys) for keys in groups], *columns)
        .agg(F.grouping_id().alias("_set"), *partials(everything, merged)),
        label,
    )
    out = {}
    for keys, measures in groups.items():
        # The grouping id has a bit for every column that is not part of the set.
        code = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        present = " AND ".join([f"_set = {code}", *[f"{k} IS NOT NULL" for k in keys]])
        out[keys] = table.where(present).selectExpr(*keys, *[f"{base_name(m.kind)} AS {m.name}" for m in measures])
    return out


def fitting(
    groups: dict[tuple, list[Measure]], counts: dict[tuple[str, ...], int], text_bytes: dict[str, int], policy: JoinPolicy
) -> set[tuple]:
    """The lookups that may be broadcast, smallest first, within the budgets for one and for all of them."""
    budget = policy.total_broadcast_bytes
    small = set()
    for size, g in sorted(((counts[g[0]], g) for g in groups), key=lambda pair: pair[0]):
        width = row_bytes(len(g[0]) + len(groups[g]), sum(text_bytes.get(k, 0) for k in g[0]))
        total = int(size * policy.estimate_margin + 1) * width
        if total <= policy.broadcast_bytes and total <= budget:
            small.add(g)
            budget -= total
    return small


def join_lookups(
    target: DataFrame, family: Family, lookups: dict[tuple, DataFrame], small: set[tuple], carry: Sequence[str],
    scope: Sequence[str], keep_counts: bool,
) -> DataFrame:
    """Every target row with its match in each lookup, reduced to ``carry`` and the family's outputs."""
    out = target.select(*dict.fromkeys([*carry, *scope, *family.keys]))
    # Broadcast joins first: they need no shuffle, and the shuffles that follow stay next to each other.
    for g in sorted(lookups, key=lambda g: g not in small):
        out = out.join(F.broadcast(lookups[g]) if g in small else shuffled_join(lookups[g]), list(g[0]), "left")
    return out.selectExpr(*carry, *_finish(family, keep_counts))


def family_table(
    target: DataFrame,
    source: DataFrame,
    family: Family,
    carry: Sequence[str] = ("slice", "instance_id"),
    scope: Sequence[str] = ("slice",),
    keep_counts: bool = False,
    policy: JoinPolicy = JoinPolicy(),
    sizes: SourceSizes | None = None,
) -> DataFrame:
    """``carry`` columns of every target row, followed by the family's features.

    ``scope`` columns are part of every key set: a slice only sees its own history. ``sizes`` of the source can be
    handed in where several families share one.
    """
    scope = tuple(scope)
    groups = grouped(family, scope)

    used = list(dict.fromkeys([*scope, *family.keys, "event_date", "item_id", LABEL]))
    source = source.select(*[c for c in used if c in source.columns])

    additive = {g for g, ms in groups.items() if _is_additive(ms)}
    coarse, base_keys = _base_keys(groups, policy)
    found = sizes or measure_source(source, list(dict.fromkeys(_key_sets(groups, scope, policy))))
    base_size = found.groups[base_keys or scope]

    base = None
    if len(coarse) > 1 and base_size * policy.estimate_margin <= policy.rollup_ratio * found.rows:
        measures = [m for g in coarse for m in groups[g]]
        base = stage(source.groupBy(*base_keys).agg(*partials(measures, False)), f"{family.name}-base")

    small = fitting(groups, found.groups, found.text_bytes, policy)

    lookups = {}
    for rolled in (True, False):
        members = {
            g[0]: groups[g] for g in groups
            if g in small and g in additive and (base is not None and g in coarse) == rolled
        }
        if members:
            split = _small_lookups(base if rolled else source, members, rolled, f"{family.name}-lookups")
            lookups.update({(keys, False): lookup for keys, lookup in split.items()})
    for g, measures in groups.items():
        if g not in lookups:
            rolled = base is not None and g in coarse
            lookup = _aggregate(base if rolled else source, g[0], measures, rolled)
            # Stored: fresh off its aggregate it would be partitioned by the join keys already, and a join with such a
            # side is not split where a key is hot.
            lookups[g] = lookup if g in small else stage(lookup, f"{family.name}-lookup")

    return join_lookups(target, family, lookups, small, carry, scope, keep_counts)


def _finish(family: Family, keep_counts: bool) -> list[str]:
    """SQL expressions of the outputs: filled measures and their quotients."""
    measures = {m.name: m for m in family.measures}
    rates = {r.name: r for r in family.rates}

    def value(name: str) -> str:
        fill = measures[name].fill
        return name if fill is None else f"coalesce({name}, {fill}L)"

    def quotient(r: Rate) -> str:
        hits, tries = (f"cast({value(n)} AS double)" for n in (r.hits, r.tries))
        if r.prior is None:
            return f"try_divide({hits}, {tries})"
        alpha, beta = (f"{v!r}D" for v in r.prior)
        return f"({hits} + {alpha}) / ({tries} + {alpha} + {beta})"

    return [
        f"{value(n) if n in measures else quotient(rates[n])} AS {n}" for n in family.outputs(keep_counts)
    ]
