"""Column expressions: time parts, delimited lists, code buckets, ratios, digamma."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code sets of the two bucketed user attributes, class 3 being "any other code".
STAR_BUCKETS = {1: (-1, 3000), 2: (3009, 3010)}
OCCUPATION_BUCKETS = {1: (-1, 2003), 2: (2002,)}
OTHER_BUCKET = 3
# The literal behaviour of the original conditions, which never match most codes.
STAR_BUCKETS_LITERAL: dict[int, tuple[int, ...]] = {}
OCCUPATION_BUCKETS_LITERAL = {2: (2002,)}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(epoch_seconds: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return F.date_format(F.timestamp_seconds(_col(epoch_seconds)), "yyyy-MM-dd HH:mm:ss")


def time_parts(epoch_seconds: Column | str) -> dict[str, Column]:
    moment = F.timestamp_seconds(_col(epoch_seconds))
    return {
        "event_date": F.to_date(moment),
        "day": F.dayofmonth(moment),
        "hour": F.hour(moment),
        "minute": F.minute(moment),
    }


def list_length(c: Column | str, sep: str = ";") -> Column:
    return F.size(F.split(_col(c), sep))


def list_element(c: Column | str, index: int, sep: str = ";") -> Column:
    """Zero-based element, or the empty string where the list is shorter."""
    return F.coalesce(F.get(F.split(_col(c), sep), F.lit(index)), F.lit(""))


def last_element(c: Column | str, sep: str = ";") -> Column:
    return F.element_at(F.split(_col(c), sep), -1)


def code_bucket(c: Column | str, buckets: Mapping[int, Iterable[int]], other: int = OTHER_BUCKET) -> Column:
    """Class of a code: the first bucket that lists it, ``other`` for the rest (NULL included)."""
    expr = F.lit(other)
    for cls, codes in reversed(buckets.items()):
        expr = F.when(_col(c).isin(*codes), cls).otherwise(expr)
    return expr


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient of two columns; NULL for a zero or missing denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def smoothed_rate(hits: Column | str, tries: Column | str, alpha: float, beta: float) -> Column:
    """Posterior mean of a beta-binomial rate; a key never seen gets the prior mean."""
    h = F.coalesce(_col(hits), F.lit(0)).cast("double")
    n = F.coalesce(_col(tries), F.lit(0)).cast("double")
    return (h + F.lit(alpha)) / (n + F.lit(alpha) + F.lit(beta))


def digamma(x: Column, shift: int = 8) -> Column:
    """Digamma for x > 0: climb ``shift`` steps by the recurrence, then the asymptotic series."""
    steps = sum((1 / (x + F.lit(float(k))) for k in range(1, shift)), 1 / x)
    y = x + F.lit(float(shift))
    inv2 = 1 / (y * y)
    # Bernoulli-number coefficients B_2k / 2k of the series.
    series = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return F.log(y) - 1 / (2 * y) - series - steps


def hash_unit(*columns: Column | str, salt: str = "") -> Column:
    """Uniform number in [0, 1) from the md5 of the values: stable across runs and engines."""
    text = F.concat_ws("|", *[_col(c).cast("string") for c in columns], F.lit(salt))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(2 ** 32))
