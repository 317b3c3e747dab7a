"""DuckDB twin of a feature family, one sub-query per key set, straight from the definitions."""

from __future__ import annotations

from oracle.click_log import SLICES, with_slices

AGGREGATE = {
    "rows": "count(*)",
    "label_sum": "CAST(coalesce(sum(is_trade), 0) AS BIGINT)",
    "ones": "count(*) FILTER (WHERE is_trade = 1)",
    "items": "count(item_id)",
    "distinct_items": "count(DISTINCT item_id)",
}


def family_sql(family, keep_counts: bool = True, slices=SLICES) -> str:
    rows = "l" if family.over == "label" else "h"
    key_sets = list(dict.fromkeys((m.keys, m.daily) for m in family.measures))
    ctes, joins, column = [], [], {}
    for i, (keys, daily) in enumerate(key_sets):
        measures = [m for m in family.measures if (m.keys, m.daily) == (keys, daily)]
        names = ", ".join(keys)
        if daily:
            inner = ", ".join(f"{AGGREGATE[m.kind]} AS {m.name}" for m in measures)
            outer = ", ".join(f"avg({m.name}) AS {m.name}" for m in measures)
            ctes.append(
                f"k{i} AS (SELECT slice, {names}, {outer} FROM (SELECT slice, {names}, event_date AS d, {inner} "
                f"FROM {rows} GROUP BY slice, {names}, event_date) GROUP BY slice, {names})"
            )
        else:
            agg = ", ".join(f"{AGGREGATE[m.kind]} AS {m.name}" for m in measures)
            ctes.append(f"k{i} AS (SELECT slice, {names}, {agg} FROM {rows} GROUP BY slice, {names})")
        on = " AND ".join(f"l.{k} = k{i}.{k}" for k in ("slice", *keys))
        joins.append(f"LEFT JOIN k{i} ON {on}")
        for m in measures:
            ref = f"k{i}.{m.name}"
            column[m.name] = ref if m.fill is None else f"coalesce({ref}, {m.fill})"
    for r in family.rates:
        hits, tries = column[r.hits], column[r.tries]
        if r.prior:
            a, b = (f"CAST({v!r} AS DOUBLE)" for v in r.prior)
            column[r.name] = f"({hits}::DOUBLE + {a}) / ({tries}::DOUBLE + {a} + {b})"
        else:
            column[r.name] = f"{hits}::DOUBLE / nullif({tries}, 0)::DOUBLE"
    select = ",\n  ".join(f"{column[n]} AS {n}" for n in family.outputs(keep_counts))
    return with_slices(f"SELECT l.slice, l.instance_id,\n  {select}\nFROM l\n" + "\n".join(joins), *ctes, slices=slices)
