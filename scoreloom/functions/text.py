"""Labels and other texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.fixed_values import BASELINE_RATE, ICON_URL_PREFIX, ICON_URL_SUFFIX

# Scaled by this power of two, the part of a double below its units is a whole number from 1/64
# up, and its tenfold fits 64 bits. Anything smaller is 0.0 to one decimal either way.
BITS = 58
LONG_END = 2.0**63


def _tenths(rest: Column) -> Column:
    """Tenths of a number from 0 to below 1, exact halves to even."""
    tenfold = (rest * F.lit(float(2**BITS))).cast("long") * 10
    whole = F.shiftright(tenfold, BITS)
    over = tenfold - F.shiftleft(whole, BITS)
    half = F.lit(2 ** (BITS - 1))
    up = (over > half) | ((over == half) & (whole % 2 == 1))
    return whole + up.cast("long")


def fixed_1(x: Column) -> Column:
    """Text with one decimal, rounded from the binary value, exact halves to even.

    The JVM's ``%.1f`` rounds the shortest decimal text half up instead, which differs for
    values like 2.25. Units are split off first, which is exact, so one rule serves all
    numbers that fit 64 bits; what lies beyond has no decimals and is the JVM's text, as are
    infinities.
    """
    size = F.abs(x.cast("double"))
    inside = F.when(size < LONG_END, size)
    units = F.floor(inside)
    tenths = _tenths(inside - units)
    sign = F.when(x < 0, "-").otherwise("")
    exact = F.concat(
        sign,
        (units + F.when(tenths == 10, 1).otherwise(0)).cast("string"),
        F.lit("."),
        (tenths % 10).cast("string"),
    )
    return F.coalesce(exact, F.when(x.isNotNull(), F.format_string("%.1f", x.cast("double"))))


def signed_1(x: Column) -> Column:
    """``fixed_1`` with an explicit plus sign."""
    return F.concat(F.when(x < 0, "").otherwise("+"), fixed_1(x))


def percent_1(x: Column) -> Column:
    return F.concat(fixed_1(x), F.lit("%"))


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)


def trend_symbol(delta: Column) -> Column:
    return F.when(delta >= 0, "▲").otherwise("▼")


def trend_label(delta: Column) -> Column:
    """Such as ``▲ 2.1``."""
    return F.concat(trend_symbol(delta), F.lit(" "), fixed_1(F.abs(delta)))


def baseline_delta(rate: Column) -> Column:
    """Points above the baseline, to one decimal, halves to even."""
    return F.bround(rate - BASELINE_RATE, 1)


def rate_label(rate: Column) -> Column:
    """Such as ``  52.3%  ▲2.3``."""
    delta = baseline_delta(rate)
    return F.concat(
        F.lit("  "), percent_1(rate), F.lit("  "), trend_symbol(delta), fixed_1(F.abs(delta))
    )


def tier_label(mean_rate: Column, n: Column) -> Column:
    return F.concat(
        F.lit("Avg WR: "), percent_1(mean_rate), F.lit("  ·  "), n.cast("string"), F.lit(" champs")
    )


def option_label(champion: Column, tier: Column) -> Column:
    return F.format_string("%s  [%s]", champion, tier)


def icon_url(champion: Column) -> Column:
    key = F.translate(champion, " '.", "")
    return F.concat(F.lit(ICON_URL_PREFIX), key, F.lit(ICON_URL_SUFFIX))


def sync_label(moment: Column) -> Column:
    return F.concat(F.lit("Last sync: "), F.date_format(moment, "dd MMM yyyy  HH:mm"))
