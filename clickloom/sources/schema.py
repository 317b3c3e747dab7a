"""Declared schemas; nothing here is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG = ("instance_id", "item_id", "item_brand_id", "item_city_id", "user_id", "shop_id", "context_id")
_LISTS = ("item_category_list", "item_property_list", "predict_category_property")
_LEVELS = (
    "item_price_level", "item_sales_level", "item_collected_level", "item_pv_level",
    "user_gender_id", "user_age_level", "user_occupation_id", "user_star_level",
    "context_page_id", "shop_review_num_level", "shop_star_level",
)


def click_schema(labeled: bool = True, overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    """Schema of a click-log file. Unlabeled (test) files have no ``is_trade``."""
    overrides = overrides or {}
    fields = [(name, T.LongType()) for name in _LONG]
    fields += [(name, T.StringType()) for name in _LISTS]
    fields += [(name, T.IntegerType()) for name in _LEVELS]
    fields.append(("context_timestamp", T.LongType()))
    if labeled:
        fields.append(("is_trade", T.IntegerType()))
    return T.StructType([T.StructField(n, overrides.get(n, t)) for n, t in fields])


PREDICTION_SCHEMA = T.StructType([
    T.StructField("instance_id", T.LongType()),
    T.StructField("predicted_score", T.DoubleType()),
])
