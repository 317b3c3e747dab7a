"""From the prepared log to the final feature table of every slice."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.distinct import distinct_rows
from clickloom.operators.features import Family, JoinPolicy, family_table, source_sizes
from clickloom.operators.models import PREDICT_TEXT, PROPERTY_TEXT, Boosting, text_score
from clickloom.operators.position import position_table, reclick_table
from clickloom.operators.sizing import shuffled_join
from clickloom.plans import specs
from clickloom.plans.day_history import DayHistory, day_family_table
from clickloom.plans.slices import TimeSlice, history_rows, label_rows
from clickloom.sources.stage import dealt, stage

ROW = "row_id"
# Text column -> score column.
TEXT_SCORES = {"item_property_list": "property_prob", "predict_category_property": "predict_prob"}
# Raw lists that end with the text scores; the array copy is only an intermediate of the last category.
RAW_LISTS = ("item_category_list", "item_property_list", "predict_category_property", "item_category_list_1")


def run_stages(jobs: Sequence[Callable[[], DataFrame]], parallel: int = 4) -> list[DataFrame]:
    """Stage independent tables from driver threads, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(lambda job: stage(job(), "features"), jobs))


def text_score_table(
    labels: DataFrame, history: DataFrame, slices: Sequence[TimeSlice], text: str, name: str, boosting: Boosting,
    keep: Sequence[str] = (ROW,),
) -> DataFrame:
    """Text scores of all slices, one model per slice."""
    def one(s: TimeSlice) -> DataFrame:
        mine = F.col("slice") == s.name
        return text_score(history.filter(mine), labels.filter(mine), text, name, boosting, keep)

    with ThreadPoolExecutor(max_workers=len(slices)) as pool:
        parts = list(pool.map(one, slices))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def feature_table(
    prepared: DataFrame,
    slices: Sequence[TimeSlice],
    families: Sequence[Family] = specs.EXECUTED,
    text_models: dict[str, Boosting] | None = None,
    keep_counts: bool = False,
    policy: JoinPolicy = JoinPolicy(),
    days: DayHistory | None = None,
) -> DataFrame:
    """Label rows of all slices with every feature.

    ``prepared`` should be a stored table, since each family reads its own few columns of it. Exact
    copies of a label row count as clicks of their day, but only one of them is in the result.
    Families are computed on narrow projections and staged on their own; they meet once, by a row
    number given to the stored label rows, so duplicate instance ids stay harmless and no wide row is
    shuffled on a feature key. ``text_models`` adds the text scores (text column -> settings).
    Where ``days`` holds partial results of the same log by day, history families sum those and read no log rows.
    The broadcasts of all families together stay within ``policy.total_broadcast_bytes``, as each passes through the driver.
    """
    policy = replace(policy, total_broadcast_bytes=policy.total_broadcast_bytes // max(len(families), 1))
    # All families join and all models score these rows, so they are laid out for all cores.
    clicks = stage(dealt(label_rows(prepared, slices)), "clicks")
    labels = stage(distinct_rows(clicks).withColumn(ROW, F.monotonically_increasing_id()), "labels")
    history = history_rows(prepared, slices)

    sources = {"label": clicks, "history": history}
    # One pass over each source tells the sizes for all families that read it.
    by_log = [f for f in families if days is None or f.over != "history"]
    sizes = {over: source_sizes(sources[over], [f for f in by_log if f.over == over], policy=policy)
             for over in dict.fromkeys(f.over for f in by_log)}

    def family_job(family: Family):
        if family not in by_log:
            return lambda: day_family_table(labels, days, family, slices, (ROW,), keep_counts=keep_counts, policy=policy)
        return lambda: family_table(
            labels, sources[family.over], family, (ROW,), keep_counts=keep_counts, policy=policy, sizes=sizes[family.over])

    jobs = [family_job(f) for f in families]
    jobs.append(lambda: position_table(labels, carry=(ROW,)))
    jobs.append(lambda: reclick_table(labels, carry=(ROW,)))
    for text, boosting in (text_models or {}).items():
        jobs.append(lambda text=text, boosting=boosting: text_score_table(
            labels, history, slices, text, TEXT_SCORES[text], boosting))
    out = labels.drop(*[c for c in RAW_LISTS if c in labels.columns])
    for part in run_stages(jobs):
        out = out.join(shuffled_join(part), ROW, "left")
    return out.drop(ROW)


DEFAULT_TEXT_MODELS = {"item_property_list": PROPERTY_TEXT, "predict_category_property": PREDICT_TEXT}
