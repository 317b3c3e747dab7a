"""Feature families and the full feature table."""

from __future__ import annotations

import datetime as dt

from catalog.registry import SLICES, SLICES_END, family, prepared, query
from clickloom.operators.features import Conversion, Family, Measure, family_table
from clickloom.plans import specs
from clickloom.plans.day_history import day_family_table, day_history
from clickloom.plans.feature_table import RAW_LISTS, feature_table
from clickloom.plans.slices import TimeSlice, history_rows, label_rows
from clickloom.plans.prepare import prepare_log
from clickloom.sources import click_log, stage
from oracle.click_log import with_slices
from oracle.families import family_sql
from oracle.windows import positions_sql, reclick_sql

FAMILIES = {
    "same_day_counts": specs.SAME_DAY,
    "one_key_history": specs.one_key(),
    "two_key_history": specs.TWO_KEY,
    "three_key_history": specs.THREE_KEY,
    "daily_average_history": specs.DAILY_AVERAGE,
    "shop_brand_shares": specs.shop_share(),
    "legacy_same_day_counts": specs.LEGACY_SAME_DAY,
    "legacy_history": specs.LEGACY_HISTORY,
    "a10_shares_distinct_items": specs.shop_share(distinct=True),
}

for _name, _spec in FAMILIES.items():
    query(_name, family_sql(_spec))(lambda spark, sf, spec=_spec: family(spark, sf, spec))


def _single(name: str, spec: Family, sql: str | None = None) -> None:
    query(name, sql or family_sql(spec))(lambda spark, sf: family(spark, sf, spec))


def _measures(name: str, *measures: Measure, over: str = "history") -> Family:
    return Family(name, measures, over=over)


# Joins and aggregates of the inventory, each in its plainest form.
_single("j1_one_key_lookup", _measures("j1", Measure("item_brand_click_total_times", (specs.BRAND,))))
_single("j2_two_key_lookup", _measures("j2", Measure("user_click_same_item_times", (specs.USER, specs.ITEM))))
_single("j3_three_key_lookup", _measures(
    "j3", Measure("gender_age_click_item_times", (specs.GENDER, specs.AGE, specs.ITEM))))
_single("j4_many_key_lookup", _measures(
    "j4",
    Measure("this_day_user_constant_click_times", (specs.USER, specs.DATE, specs.HOUR, specs.MINUTE)),
    Measure("same_user_click_times", (specs.USER, specs.ITEM, specs.SHOP, specs.DATE, specs.HOUR)),
    over="label"))
_single("j5_count_joined_back", _measures(
    "j5", Measure("this_day_item_is_click_times", (specs.ITEM, specs.DATE)), over="label"))
_single("a5_mean_over_active_days", _measures(
    "a5", Measure("user_day_avg_click_times", (specs.USER,), daily=True)))
_single("a6_conversion_rate", Family.of_conversions("a6", (
    Conversion((specs.CITY,), "item_city_click_total_times", "item_city_trade_total_times", "city_transfer_rate"),)))
_single("a9_daily_rate", specs.daily_family(
    (specs.BRAND, "brand_day_avg_click_times", "brand_day_avg_trade_times", "brand_day_transfer_rate")))

USER_RATE = Family.of_conversions("user_rate", (
    Conversion((specs.USER,), "user_click_total_times", "user_buy_times", "user_transfer_rate", specs.USER_PRIOR),))
LAST_SLICE = (TimeSlice(3, SLICES[-1].label_date, 5),)


@query("a7_smoothed_user_rate", family_sql(USER_RATE))
def smoothed_user_rate(spark, sf):
    """Smoothed conversion rate of the user of every label row over its history window."""
    return family(spark, sf, USER_RATE)


def flagship(spark, sf):
    """Label day 25: smoothed rate of each row's user over the five days before."""
    start, end = LAST_SLICE[0].history_start, SLICES_END

    log = prepare_log(click_log(spark, sf, start, end)).select("instance_id", "user_id", "event_date", "is_trade")
    log = stage(log, "log")
    return family_table(label_rows(log, LAST_SLICE), history_rows(log, LAST_SLICE), USER_RATE, keep_counts=True)


def feature_table_sql() -> str:
    parts = [family_sql(f, keep_counts=False) for f in specs.EXECUTED]
    parts.append(positions_sql())
    parts.append(reclick_sql())
    ctes = ",\n".join(f"part{i} AS ({sql})" for i, sql in enumerate(parts))
    joins = "\n".join(f"JOIN part{i} USING (slice, instance_id)" for i in range(len(parts)))
    base = with_slices(f"SELECT * EXCLUDE ({', '.join(c for c in RAW_LISTS if c != 'item_category_list_1')}) FROM l")
    return f"WITH base AS ({base}),\n{ctes}\nSELECT * FROM base\n{joins}"


@query("e1_feature_table", feature_table_sql())
def e1_feature_table(spark, sf):
    """All counting, rate, position and re-click features of the three label days."""
    return feature_table(stage(prepared(spark, sf, SLICES_END), "log"), SLICES)


# Six label days, each with the five days before it as its window.
SLIDING = tuple(
    TimeSlice(i, SLICES_END - dt.timedelta(days=6 - i), 5) for i in range(6)
)
SLIDING_SQL = tuple((s.name, f"{s.label_date}", f"{s.history_start}") for s in SLIDING)


def _sliding(name: str, spec: Family) -> None:
    """Windows that slide over partial results by day; the last four days are added to the history of the others."""

    @query(name, family_sql(spec, slices=SLIDING_SQL))
    def sliding(spark, sf):
        log = stage(prepared(spark, sf, SLICES_END).select(
            *dict.fromkeys(["instance_id", "event_date", "is_trade", "item_id", *spec.keys])), "log")
        added = log.event_date >= SLICES_END - dt.timedelta(days=4)
        days = day_history(log.filter(~added), [spec]).extended(day_history(log.filter(added), [spec]))
        return day_family_table(label_rows(log, SLIDING), days, spec, SLIDING, keep_counts=True)


_sliding("a1_a6_sliding_history", specs.one_key())
_sliding("a9_sliding_daily_history", specs.DAILY_AVERAGE)
_sliding("a10_sliding_distinct_items", specs.shop_share(distinct=True))
