"""Log preparation: derived columns every later step relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import (
    OCCUPATION_BUCKETS, STAR_BUCKETS, code_bucket, last_element, list_element, list_length, local_time, time_parts,
)


def prepare_log(log: DataFrame) -> DataFrame:
    """Add time parts, list columns and bucketed codes. Raw columns stay, as features use both."""
    return log.withColumns({
        "time": local_time("context_timestamp"),
        **time_parts("context_timestamp"),
        "len_item_category": list_length("item_category_list"),
        "len_item_property": list_length("item_property_list"),
        "item_category_list1": list_element("item_category_list", 1),
        "item_category_list2": list_element("item_category_list", 2),
        "item_category_list_1": F.split("item_category_list", ";"),
        "last_category_id": last_element("item_category_list"),
        "occupation0": code_bucket("user_occupation_id", OCCUPATION_BUCKETS),
        "star0": code_bucket("user_star_level", STAR_BUCKETS),
    })
