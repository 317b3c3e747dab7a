"""Feature families as data. Names are fixed: they are the column names of the final table."""

from __future__ import annotations

from clickloom.operators.features import Conversion, Family, Measure, Rate

USER, ITEM, SHOP, BRAND, CITY = "user_id", "item_id", "shop_id", "item_brand_id", "item_city_id"
CATEGORY, LAST_CATEGORY = "item_category_list1", "last_category_id"
GENDER, AGE, OCCUPATION, STAR = "user_gender_id", "user_age_level", "user_occupation_id", "user_star_level"
OCCUPATION_CLASS, STAR_CLASS = "occupation0", "star0"
PRICE, COLLECTED, PV, SALES = "item_price_level", "item_collected_level", "item_pv_level", "item_sales_level"
SHOP_STAR, SHOP_REVIEW, PAGE = "shop_star_level", "shop_review_num_level", "context_page_id"
DATE, HOUR, MINUTE = "event_date", "hour", "minute"

# Fitted beta priors (alpha, beta) of the three smoothed rates.
USER_PRIOR = (0.0769474405685425, 9.12774893416997)
ITEM_PRIOR = (1.4270011322449327, 71.27269357067141)
SHOP_PRIOR = (1.4222251297828883, 72.27949407200967)


def _same_day(*rows: tuple) -> Family:
    measures = tuple(Measure(name, (*keys, DATE)) for name, *keys in rows)
    return Family("same_day", measures, kept=tuple(m.name for m in measures), over="label")


SAME_DAY = _same_day(
    ("this_day_user_click_times", USER),
    ("this_day_hour_click_times", USER, HOUR),
    ("this_day_user_click_same_item_times", USER, ITEM),
    ("this_day_user_click_same_shop_times", USER, SHOP),
    ("this_day_user_click_same_brand_times", USER, BRAND),
    ("this_day_user_click_same_category_times", USER, CATEGORY),
    ("this_day_user_constant_click_times", USER, HOUR, MINUTE),
    ("this_day_gender_click_category_times", GENDER, CATEGORY),
    ("this_day_age_click_item_times", AGE, ITEM),
    ("this_day_age_click_brand_times", AGE, BRAND),
    ("this_day_age_click_category_times", AGE, CATEGORY),
    ("this_day_occupation_click_item_times", OCCUPATION_CLASS, ITEM),
    ("this_day_occupation_click_brand_times", OCCUPATION_CLASS, BRAND),
    ("this_day_star_click_item_times", STAR_CLASS, ITEM),
    ("this_day_star_click_brand_times", STAR_CLASS, BRAND),
    ("this_day_star_click_shop_times", STAR_CLASS, SHOP),
    ("this_day_item_is_click_times", ITEM),
    ("this_day_hour_item_is_click_times", HOUR, ITEM),
    ("this_day_occupation_hour_click_times", OCCUPATION_CLASS, HOUR),
)


def one_key(user_prior=USER_PRIOR, item_prior=ITEM_PRIOR, shop_prior=SHOP_PRIOR) -> Family:
    return Family.of_conversions("one_key", (
        Conversion((USER,), "user_click_total_times", "user_buy_times", "user_transfer_rate", prior=user_prior),
        Conversion((GENDER,), "user_gender_click_times", "user_gender_trade_times", "user_gender_transfer_rate"),
        Conversion((AGE,), "user_age_click_times", "user_age_trade_times", "user_age_transfer_rate", hits="ones"),
        Conversion((STAR_CLASS,), "user_star_click_times", "user_star_trade_times", "user_star_transfer_rate"),
        Conversion((ITEM,), "item_is_click_total_times", "item_is_trade_times", "item_quality", prior=item_prior),
        Conversion((CATEGORY,), "same_category_is_click_times", "same_category_is_buy_times", "category_transfer_rate"),
        Conversion((BRAND,), "item_brand_click_total_times", "item_brand_trade_total_times", "brand_transfer_rate"),
        Conversion((CITY,), "item_city_click_total_times", "item_city_trade_total_times", "city_transfer_rate"),
        Conversion((PRICE,), "item_price_click_total_times", "item_price_trade_total_times", "price_transfer_rate"),
        Conversion((COLLECTED,), "item_collected_click_total_times", "item_collected_trade_total_times",
                   "collected_transfer_rate"),
        Conversion((PV,), "item_pv_click_total_times", "item_pv_trade_total_times", "pv_transfer_rate"),
        Conversion((SHOP,), "shop_is_click_total_times", "shop_is_trade_times", "shop_quality", prior=shop_prior),
        Conversion((SHOP_STAR,), "shop_star_click_total_times", "shop_star_trade_total_times",
                   "shop_star_transfer_rate"),
    ))


def _repeat(who: str, what: str, *keys: str, tail: str = "", keep: bool = False) -> Conversion:
    """Names of the two-key pattern ``<who>_repeat_{click,buy}_<tail>_times`` and its rate."""
    tail = tail or f"same_{what}"
    return Conversion(keys, f"{who}_repeat_click_{tail}_times", f"{who}_repeat_buy_{tail}_times",
                      f"{who}_{what}_transfer_rate", keep=keep)


TWO_KEY = Family.of_conversions("two_key", (
    _repeat("gender", "category", GENDER, LAST_CATEGORY),
    _repeat("gender", "item", GENDER, ITEM),
    _repeat("gender", "brand", GENDER, BRAND),
    _repeat("gender", "price", GENDER, PRICE),
    _repeat("occupation", "item", OCCUPATION, ITEM),
    _repeat("occupation", "brand", OCCUPATION, BRAND),
    _repeat("occupation", "price", OCCUPATION, PRICE),
    Conversion((OCCUPATION, HOUR), "occupation_hour_click_times", "occupation_hour_buy_times",
               "occupation_hour_transfer_rate", keep=True),
    _repeat("age", "category", AGE, LAST_CATEGORY),
    _repeat("age", "item", AGE, ITEM),
    _repeat("age", "brand", AGE, BRAND),
    _repeat("age", "price", AGE, PRICE),
    _repeat("star", "brand", STAR, BRAND),
    _repeat("star", "price", STAR, PRICE),
    _repeat("star", "review_num", STAR, SHOP_REVIEW, tail="review_num"),
    _repeat("star", "star", STAR, SHOP_STAR, tail="star"),
), extra=(
    Measure("user_click_same_item_times", (USER, ITEM)),
    Measure("user_hour_click_times", (USER, HOUR)),
))


def _pair(who: str, what: str, *keys: str, keep: bool = False) -> Conversion:
    """Names of the three-key pattern ``<who>_{click,buy}_<what>_times`` and its rate."""
    return Conversion(keys, f"{who}_click_{what}_times", f"{who}_buy_{what}_times",
                      f"{who}_{what}_transfer_rate", keep=keep)


THREE_KEY = Family.of_conversions("three_key", (
    _pair("gender_age", "brand", GENDER, AGE, BRAND),
    _pair("gender_age", "category", GENDER, AGE, CATEGORY),
    _pair("gender_age", "item", GENDER, AGE, ITEM),
    _pair("gender_age", "price", GENDER, AGE, PRICE),
    _pair("gender_occupation", "item", GENDER, OCCUPATION, ITEM),
    _pair("gender_occupation", "price", GENDER, OCCUPATION, PRICE),
    _pair("gender_star", "brand", GENDER, STAR, BRAND),
    _pair("gender_star", "item", GENDER, STAR, ITEM),
    _pair("gender_star", "price", GENDER, STAR, PRICE),
    _pair("age_star", "brand", AGE, STAR, BRAND),
    _pair("age_star", "category", AGE, STAR, CATEGORY),
    _pair("age_star", "item", AGE, STAR, ITEM, keep=True),
    _pair("age_star", "price", AGE, STAR, PRICE),
    _pair("age_occupation", "item", AGE, OCCUPATION, ITEM),
    _pair("age_occupation", "price", AGE, OCCUPATION, PRICE, keep=True),
    _pair("star_occupation", "price", STAR, OCCUPATION, PRICE),
))


def daily_family(*rows: tuple) -> Family:
    measures, rates = [], []
    for key, clicks, trades, rate in rows:
        if clicks:
            measures.append(Measure(clicks, (key,), "rows", daily=True))
        measures.append(Measure(trades, (key,), "ones", daily=True))
        if rate:
            rates.append(Rate(rate, trades, clicks))
    measures.append(Measure("hour_trade_times", (HOUR,), "label_sum"))
    kept = tuple(m.name for m in measures) + tuple(r.name for r in rates)
    return Family("daily_average", tuple(measures), tuple(rates), kept)


DAILY_AVERAGE = daily_family(
    (ITEM, "item_day_avg_click_times", "item_day_avg_trade_times", "item_day_avg_transfer_rate"),
    (USER, "user_day_avg_click_times", "user_day_avg_trade_times", "user_day_transfer_rate"),
    (LAST_CATEGORY, None, "category_day_avg_trade_times", None),
    (BRAND, "brand_day_avg_click_times", "brand_day_avg_trade_times", "brand_day_transfer_rate"),
    (CITY, "city_day_avg_click_times", "city_day_avg_trade_times", "city_day_transfer_rate"),
)


def shop_share(distinct: bool = False) -> Family:
    """Shares of a shop in its brand and of a brand in its shop.

    Item numbers count click rows, as the original does; ``distinct`` counts different items.
    """
    items = "distinct_items" if distinct else "items"
    measures = (
        Measure("shop_brand_item_num_Nmb", (BRAND, SHOP), items),
        Measure("shop_item_num_Nm", (SHOP,), items),
        Measure("brand_item_num_Nb", (BRAND,), items),
        Measure("shop_brand_trade_times_Umb", (BRAND, SHOP), "ones"),
        Measure("shop_trade_times_Um", (SHOP,), "ones"),
        Measure("brand_trade_times_Ub", (BRAND,), "ones"),
    )
    rates = (
        Rate("shop_market_share_on_brand", "shop_brand_item_num_Nmb", "brand_item_num_Nb"),
        Rate("shop_user_share_on_brand", "shop_brand_trade_times_Umb", "brand_trade_times_Ub"),
        Rate("brand_market_share_with_shop", "shop_brand_item_num_Nmb", "shop_item_num_Nm"),
        Rate("brand_user_share_with_shop", "shop_brand_trade_times_Umb", "shop_trade_times_Um"),
    )
    dropped = {"shop_trade_times_Um", "brand_trade_times_Ub"}
    kept = tuple(m.name for m in measures if m.name not in dropped) + tuple(r.name for r in rates)
    return Family("shop_share", measures, rates, kept)


# Names an older feature table still lists; their key sets follow from the names.
LEGACY_SAME_DAY = _same_day(
    ("this_day_city_click_times", CITY),
    ("this_day_brand_click_times", BRAND),
    ("this_day_category_click_times", CATEGORY),
    ("this_day_context_page_click_times", PAGE),
    ("this_day_gender_click_item_times", GENDER, ITEM),
    ("this_day_gender_click_brand_times", GENDER, BRAND),
    ("this_day_gender_click_shop_times", GENDER, SHOP),
    ("this_day_age_click_shop_times", AGE, SHOP),
    ("this_day_occupation_click_category_times", OCCUPATION_CLASS, CATEGORY),
    ("this_day_occupation_click_shop_times", OCCUPATION_CLASS, SHOP),
    ("this_day_user_click_same_city_times", USER, CITY),
    ("this_day_user_click_same_page_times", USER, PAGE),
    ("this_day_user_one_minute_click_times", USER, ITEM, SHOP, HOUR, MINUTE),
)


def _rate_only(name: str, *keys: str) -> Conversion:
    return Conversion(keys, f"{name}_click_times", f"{name}_buy_times", f"{name}_transfer_rate")


LEGACY_HISTORY = Family.of_conversions("legacy_history", (
    _rate_only("sales", SALES),
    _rate_only("shop_review_num", SHOP_REVIEW),
    _rate_only("context_page", PAGE),
    _rate_only("gender_shop", GENDER, SHOP),
    _rate_only("gender_city", GENDER, CITY),
    _rate_only("gender_pv", GENDER, PV),
    _rate_only("gender_sales", GENDER, SALES),
    _rate_only("gender_collected", GENDER, COLLECTED),
    _rate_only("gender_shop_star", GENDER, SHOP_STAR),
    _rate_only("age_city", AGE, CITY),
    _rate_only("age_sales", AGE, SALES),
    _rate_only("occupation_sales", OCCUPATION, SALES),
    _rate_only("occupation_pv", OCCUPATION, PV),
    _rate_only("occupation_star", OCCUPATION, STAR),
    _rate_only("star_collected", STAR, COLLECTED),
    _rate_only("star_category", STAR, CATEGORY),
    _rate_only("gender_occupation_category", GENDER, OCCUPATION, CATEGORY),
    _rate_only("star_occupation_item", STAR, OCCUPATION, ITEM),
    _rate_only("star_occupation_shop", STAR, OCCUPATION, SHOP),
), extra=(
    Measure("user_click_brand_times", (USER, BRAND)),
    Measure("user_click_city_times", (USER, CITY)),
    Measure("user_click_category_times", (USER, CATEGORY)),
    Measure("user_click_price_times", (USER, PRICE)),
    Measure("user_click_same_shop_times", (USER, SHOP)),
    Measure("user_click_same_shop_item_times", (USER, SHOP, ITEM)),
    Measure("user_day_hour_click_times", (USER, "day", HOUR)),
    Measure("user_day_hour_minute_click_times", (USER, "day", HOUR, MINUTE)),
    Measure("user_context_page_buy_times", (USER, PAGE), "label_sum"),
    Measure("item_hour_is_tarde_times", (ITEM, HOUR), "label_sum"),
))

# Families of the path that builds the final table, in output order.
EXECUTED = (SAME_DAY, one_key(), TWO_KEY, THREE_KEY)
# Defined as well, but not part of that path.
OPTIONAL = (DAILY_AVERAGE, shop_share(), LEGACY_SAME_DAY, LEGACY_HISTORY)
