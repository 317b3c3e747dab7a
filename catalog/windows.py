"""Position flags, gaps, running counts, repeat clicks, first / last rows."""

from __future__ import annotations

from catalog.registry import prepared, query
from clickloom.operators.position import (
    POSITION_KEYS, drop_latest, keep_end, position_table, reclick_table, repeat_clicks, repeated_groups,
)
from clickloom.sources import stage
from oracle.click_log import with_log
from oracle.windows import positions_sql, reclick_sql

DAY = ("event_date",)
CARRY = ("event_date", "instance_id")
NAMES = {"": "user_item_shop", "u": "user", "b": "user_brand", "c": "user_category"}

for _prefix, _label in NAMES.items():
    @query(f"w1_w4_positions_{_label}", positions_sql((_prefix,), "event_date", whole_log=True))
    def _positions(spark, sf, prefix=_prefix):
        """Every day of the log is its own scope, as the original frames hold one day."""
        columns = [*CARRY, *POSITION_KEYS[prefix], "context_timestamp"]
        log = stage(prepared(spark, sf).select(*columns), "log")
        return position_table(log, CARRY, DAY, {prefix: POSITION_KEYS[prefix]})


def _reclick(spark, sf, direction):
    log = stage(prepared(spark, sf).select(*CARRY, "user_id", "item_id", "context_timestamp"), "log")
    return reclick_table(log, carry=CARRY, scope=DAY, direction=direction)


@query("w5_reclick_before", reclick_sql("event_date", whole_log=True))
def reclick_before(spark, sf):
    return _reclick(spark, sf, "before")


@query("w5_reclick_after", reclick_sql("event_date", whole_log=True, after=True))
def reclick_after(spark, sf):
    return _reclick(spark, sf, "after")


@query("w5_reclick_whole_log", with_log("""
SELECT r.instance_id, count(*) - 1 AS leak_user_final_cat_reclick
FROM click_log r JOIN click_log o
  ON o.user_id = r.user_id AND o.item_id = r.item_id AND o.context_timestamp <= r.context_timestamp
GROUP BY r.instance_id
"""))
def reclick_whole_log(spark, sf):
    """The same over the whole month, so that counts carry over from day to day."""
    log = stage(prepared(spark, sf).select("instance_id", "user_id", "item_id", "context_timestamp"), "log")
    return reclick_table(log, carry=("instance_id",), scope=())


@query("w6_drop_latest", with_log("""
SELECT instance_id, user_id, item_id, shop_id, context_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id, shop_id
                               ORDER BY context_timestamp DESC, instance_id DESC) AS place
  FROM click_log) WHERE place > 1
"""))
def w6_drop_latest(spark, sf):
    log = prepared(spark, sf).select("instance_id", "user_id", "item_id", "shop_id", "context_timestamp")
    return drop_latest(log, ["user_id", "item_id", "shop_id"])


for _last in (False, True):
    _way = "DESC" if _last else "ASC"

    @query(f"w7_keep_{'last' if _last else 'first'}", with_log(f"""
    SELECT instance_id, user_id, item_id, context_timestamp FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id
                                   ORDER BY context_timestamp {_way}, instance_id {_way}) AS place
      FROM click_log) WHERE place = 1
    """))
    def _keep(spark, sf, last=_last):
        log = prepared(spark, sf).select("instance_id", "user_id", "item_id", "context_timestamp")
        return keep_end(log, ["user_id"], last=last)


REPEATED = """
rep AS (
  SELECT user_id, item_id, shop_id, event_date, hour, count(*) AS same_user_click_times FROM click_log
  GROUP BY ALL HAVING count(*) > 1
)"""


@query("p16_repeated_groups", with_log("SELECT * FROM rep", REPEATED))
def p16_repeated_groups(spark, sf):
    return repeated_groups(prepared(spark, sf), ["user_id", "item_id", "shop_id", "event_date", "hour"])


@query("j6_rows_of_repeated_groups", with_log("""
SELECT c.instance_id, c.user_id, c.item_id, c.shop_id, c.event_date, c.hour, r.same_user_click_times
FROM rep r JOIN click_log c USING (user_id, item_id, shop_id, event_date, hour)
""", REPEATED))
def j6_rows_of_repeated_groups(spark, sf):
    keys = ["user_id", "item_id", "shop_id", "event_date", "hour"]
    log = stage(prepared(spark, sf).select("instance_id", *keys), "log")
    return log.join(stage(repeated_groups(log, keys), "groups"), keys).select("instance_id", *keys, "same_user_click_times")


REPEAT_ROWS = REPEATED + """,
rows_in AS (SELECT c.* FROM rep JOIN click_log c USING (user_id, item_id, shop_id, event_date, hour)),
down AS (
  SELECT instance_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id, shop_id
                                 ORDER BY context_timestamp DESC, instance_id DESC) AS place
    FROM rows_in) WHERE place > 1)
"""


@query("t1_m18_repeat_clicks", with_log("SELECT instance_id FROM down", REPEAT_ROWS))
def repeat_click_rows(spark, sf):
    """Rows clicked repeatedly within an hour, in time order, without the latest one of each group."""
    columns = ["instance_id", "user_id", "item_id", "shop_id", "event_date", "hour", "context_timestamp"]
    log = stage(prepared(spark, sf).select(*columns), "log")
    return repeat_clicks(log).select("instance_id")
