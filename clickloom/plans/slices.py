"""Label days and their history windows.

Several slices are handled in one plan: each log row is tagged with every slice it serves, and
``slice`` becomes one more grouping key. One scan and one set of lookups then serve all of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TimeSlice:
    """Rows of ``label_date`` are labelled; history is the ``history_days`` days before it (None: all)."""

    name: int
    label_date: dt.date
    history_days: int | None = None

    @property
    def history_start(self) -> dt.date | None:
        return None if self.history_days is None else self.label_date - dt.timedelta(days=self.history_days)

    def is_label(self) -> Column:
        return F.col("event_date") == F.lit(self.label_date)

    def is_history(self) -> Column:
        before = F.col("event_date") < F.lit(self.label_date)
        return before if self.history_start is None else before & (F.col("event_date") >= F.lit(self.history_start))


def month_slices(year: int, month: int) -> tuple[TimeSlice, ...]:
    """Train, validate and test slices: label days 23, 24, 25, the last two with five days of history."""
    return (
        TimeSlice(1, dt.date(year, month, 23)),
        TimeSlice(2, dt.date(year, month, 24), 5),
        TimeSlice(3, dt.date(year, month, 25), 5),
    )


def _tag(log: DataFrame, slices: Sequence[TimeSlice], member) -> DataFrame:
    names = F.array(*[F.when(member(s), F.lit(s.name)) for s in slices])
    return log.withColumn("slice", F.explode(F.array_compact(names)))


def label_rows(log: DataFrame, slices: Sequence[TimeSlice]) -> DataFrame:
    days = [s.label_date for s in slices]
    return _tag(log.filter(F.col("event_date").isin(days)), slices, TimeSlice.is_label)


def history_rows(log: DataFrame, slices: Sequence[TimeSlice]) -> DataFrame:
    log = log.filter(F.col("event_date") < F.lit(max(s.label_date for s in slices)))
    starts = [s.history_start for s in slices]
    if all(starts):
        log = log.filter(F.col("event_date") >= F.lit(min(starts)))
    return _tag(log, slices, TimeSlice.is_history)
