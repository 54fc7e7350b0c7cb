"""Column -> Column expressions: parsing, calendar parts, bands and labels.

All of them are built-ins, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Credit scores start at 300 and one band is 69 points wide.
CREDIT_FLOOR = 300
CREDIT_BAND_WIDTH = 69

# Day numbers count from Sunday = 0.
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]

# Fixed value: stands for a missing category.
MISSING_CATEGORY = "__missing__"


def money(amount: Column) -> Column:
    """``'$-1,234.50'`` -> ``-1234.5``; text that is not an amount fails the query."""
    return F.translate(amount, "$,", "").cast("double")


def lenient_date(text: Column) -> Column:
    """Full ``y-m-d`` or ``y/m/d`` text as a date, NULL for anything else.

    A bare ``try_cast`` would accept ``2002`` and ``2002-09`` as dates.
    """
    whole = text.rlike(r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}\s*$")
    return F.when(whole, F.trim(F.translate(text, "/", "-")).try_cast("date"))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("long")


def month_of_year(ts: Column) -> Column:
    return F.month(ts).cast("long")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def weekend_flag(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7).cast("int")


def night_flag(ts: Column) -> Column:
    return F.hour(ts).between(0, 5).cast("int")


def day_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), day.cast("int") + 1)


def time_flags_label(is_night: Column, is_weekend: Column) -> Column:
    return F.concat(
        F.when(is_night == 1, "night").otherwise("day"),
        F.lit(" · "),
        F.when(is_weekend == 1, "weekend").otherwise("weekday"),
    )


def class_label(is_fraud: Column) -> Column:
    return F.when(is_fraud == 0, "legitimate").when(is_fraud == 1, "fraud")


def yes_no(is_fraud: Column) -> Column:
    return F.when(is_fraud == 0, "No").when(is_fraud == 1, "Yes")


def region(state: Column) -> Column:
    """Two letters are a US state; any other text is taken for a country."""
    return (
        F.when(state.isNull(), "unknown")
        .when(F.length(state) == 2, "US state")
        .otherwise("international")
    )


def credit_band(score: Column) -> Column:
    """Nearest band number; the odd width means a half never occurs."""
    return F.round((score - CREDIT_FLOOR) / CREDIT_BAND_WIDTH).cast("int")


def band_label(low: Column, high: Column) -> Column:
    return F.concat_ws("–", low.cast("string"), high.cast("string"))


def merchant_label(city: Column, category: Column) -> Column:
    return F.concat(city, F.lit(" · "), F.substring(category, 1, 22))


def naive_instant(at: datetime) -> Column:
    """Constant naive timestamp; by text, as Python's own zone plays no part in it."""
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fraction, by naive timestamps (no time zone enters)."""
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(20,6)").cast("double")


def epoch_seconds(ts: Column) -> Column:
    """Naive timestamp as a double that keeps single microseconds apart."""
    return seconds_between(naive_instant(datetime(1970, 1, 1)), ts)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL on a zero denominator; ANSI division would raise."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_ratio(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def numeric_or_null(value: Column) -> Column:
    """Number if it reads as one, else NULL."""
    return value.try_cast("double")


def finite_or_zero(value: Column) -> Column:
    """Missing, NaN and both infinities -> 0."""
    number = value.try_cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(usable, number).otherwise(0.0)


def category_or_missing(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(MISSING_CATEGORY))
