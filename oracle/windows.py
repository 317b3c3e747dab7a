"""DuckDB twins of the position, re-click and repeat operators, by plain window functions."""

from __future__ import annotations

from oracle.click_log import with_log, with_slices

POSITIONS = {
    "": "user_id, item_id, shop_id",
    "u": "user_id",
    "b": "user_id, item_brand_id",
    "c": "user_id, last_category_id",
}
ORDER = "context_timestamp, instance_id"


def _position_columns(prefix: str, keys: str, scope: str) -> str:
    part = f"PARTITION BY {scope}, {keys}"
    n = f"count(*) OVER ({part})"
    first = f"min(context_timestamp) OVER ({part})"
    last = f"max(context_timestamp) OVER ({part})"
    place = f"row_number() OVER ({part} ORDER BY {ORDER})"
    return (
        f"CASE WHEN {n} = 1 THEN 0 WHEN {place} = 1 THEN 2 WHEN {place} = {n} THEN 3 ELSE 1 END AS {prefix}maybe,\n"
        f"CASE WHEN {n} = 1 THEN -1 ELSE context_timestamp - {first} END AS {prefix}diffTime_first,\n"
        f"CASE WHEN {n} = 1 THEN -1 ELSE {last} - context_timestamp END AS {prefix}diffTime_last"
    )


def positions_sql(prefixes=tuple(POSITIONS), scope: str = "slice", whole_log: bool = False) -> str:
    columns = ",\n".join(_position_columns(p, POSITIONS[p], scope) for p in prefixes)
    body = f"SELECT {scope}, instance_id, {columns} FROM "
    return with_log(body + "click_log") if whole_log else with_slices(body + "l")


def reclick_sql(scope: str = "slice", whole_log: bool = False, after: bool = False) -> str:
    sign = ">=" if after else "<="
    rows = "click_log" if whole_log else "l"
    same = " AND ".join(f"o.{c} = r.{c}" for c in (scope, "user_id", "item_id"))
    body = (
        f"SELECT r.{scope}, r.instance_id, count(*) - 1 AS leak_user_final_cat_reclick FROM {rows} r "
        f"JOIN {rows} o ON {same} AND o.context_timestamp {sign} r.context_timestamp "
        f"GROUP BY r.{scope}, r.instance_id"
    )
    return with_log(body) if whole_log else with_slices(body)
