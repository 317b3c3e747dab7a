"""Registration and the inputs most queries share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.features import Conversion, Family, family_table
from clickloom.plans import specs
from clickloom.plans.prepare import prepare_log
from clickloom.plans.slices import history_rows, label_rows, month_slices
from clickloom.session import ship, tune
from clickloom.sources import click_log, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SLICES = month_slices(2024, 1)
# The first day no slice needs any more.
SLICES_END = max(s.label_date for s in SLICES) + dt.timedelta(days=1)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        assert name not in QUERIES, name

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship(tune(spark)), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def prepared(spark: SparkSession, sf_dir: str, until: dt.date | None = None) -> DataFrame:
    return prepare_log(click_log(spark, sf_dir, until=until))


def sliced(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(label rows, history rows) of the three slices, off one stored copy of the needed columns."""
    log = prepared(spark, sf_dir, SLICES_END)
    if columns is not None:
        log = log.select(*dict.fromkeys(["instance_id", "event_date", "is_trade", *columns]))
    log = stage(log, "log")
    return label_rows(log, SLICES), history_rows(log, SLICES)


def family(spark: SparkSession, sf_dir: str, spec: Family, keep_counts: bool = True) -> DataFrame:
    labels, history = sliced(spark, sf_dir, [*spec.keys, "item_id"])
    return family_table(labels, labels if spec.over == "label" else history, spec, keep_counts=keep_counts)


# Three smoothed rates: the scores that blends, metrics and small models are run on.
RATES = Family.of_conversions("rates", (
    Conversion((specs.USER,), "user_click_total_times", "user_buy_times", "user_transfer_rate", specs.USER_PRIOR),
    Conversion((specs.ITEM,), "item_is_click_total_times", "item_is_trade_times", "item_quality", specs.ITEM_PRIOR),
    Conversion((specs.SHOP,), "shop_is_click_total_times", "shop_is_trade_times", "shop_quality", specs.SHOP_PRIOR),
))
