"""DuckDB twin of the prepared click log and of the label / history slices."""

CLICK_LOG = """
raw_log AS (
  SELECT e.event_id AS instance_id, e.user_id,
    CAST(json_extract_string(e.props, '$.k') AS INT) AS item_id,
    concat(p.p_type, ';', p.p_brand) AS item_category_list,
    replace(p.p_name, ' ', ';') AS item_property_list,
    concat(p.p_type, ':', replace(p.p_name, ' ', ','), ';', p.p_brand) AS predict_category_property,
    p.p_brand AS item_brand_id,
    CAST(json_extract_string(e.props, '$.k') AS INT) % 7 AS item_city_id,
    CAST(floor(p.p_retailprice / 100) AS INT) AS item_price_level,
    p.p_size % 18 AS item_sales_level, p.p_size % 17 AS item_collected_level, p.p_size % 22 AS item_pv_level,
    c.c_nationkey % 3 AS user_gender_id,
    CAST(1000 + c.c_custkey % 8 AS INT) AS user_age_level,
    2002 + c.c_nationkey % 4 AS user_occupation_id,
    CAST(3000 + c.c_custkey % 11 AS INT) AS user_star_level,
    e.event_id % 500 AS context_id,
    CAST(4001 + e.event_id % 20 AS INT) AS context_page_id,
    CAST(floor(epoch(e.ts)) AS BIGINT) AS context_timestamp,
    CAST(json_extract_string(e.props, '$.k') AS INT) % 10 AS shop_id,
    CAST(json_extract_string(e.props, '$.k') AS INT) % 25 AS shop_review_num_level,
    5000 + CAST(json_extract_string(e.props, '$.k') AS INT) % 22 AS shop_star_level,
    CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS is_trade
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS INT)
),
click_log AS (
  SELECT r.* EXCLUDE (m),
    strftime(m, '%Y-%m-%d %H:%M:%S') AS "time",
    CAST(m AS DATE) AS event_date,
    CAST(day(m) AS INT) AS day, CAST(hour(m) AS INT) AS hour, CAST(minute(m) AS INT) AS minute,
    CAST(len(string_split(item_category_list, ';')) AS INT) AS len_item_category,
    CAST(len(string_split(item_property_list, ';')) AS INT) AS len_item_property,
    coalesce(string_split(item_category_list, ';')[2], '') AS item_category_list1,
    coalesce(string_split(item_category_list, ';')[3], '') AS item_category_list2,
    string_split(item_category_list, ';')[-1] AS last_category_id,
    CASE WHEN user_occupation_id IN (-1, 2003) THEN 1 WHEN user_occupation_id = 2002 THEN 2 ELSE 3 END AS occupation0,
    CASE WHEN user_star_level IN (-1, 3000) THEN 1 WHEN user_star_level IN (3009, 3010) THEN 2 ELSE 3 END AS star0
  FROM (SELECT *, make_timestamp(context_timestamp * 1000000) AS m FROM raw_log) r
)
"""

# (slice, label date, first history date or none)
SLICES = (
    (1, "2024-01-23", None),
    (2, "2024-01-24", "2024-01-19"),
    (3, "2024-01-25", "2024-01-20"),
)


def _slice_ctes(slices=SLICES) -> str:
    label = " UNION ALL ".join(
        f"SELECT {s} AS slice, * FROM click_log WHERE event_date = DATE '{d}'" for s, d, _ in slices
    )
    history = " UNION ALL ".join(
        f"SELECT {s} AS slice, * FROM click_log WHERE event_date < DATE '{d}'"
        + (f" AND event_date >= DATE '{start}'" if start else "")
        for s, d, start in slices
    )
    return f"l AS ({label}), h AS ({history})"


def with_log(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([CLICK_LOG, *ctes]) + "\n" + body


def with_slices(body: str, *ctes: str, slices=SLICES) -> str:
    return with_log(body, _slice_ctes(slices), *ctes)
