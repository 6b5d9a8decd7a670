"""Time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import clip, col


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Full 24-hour units between two times, rounded down (also below zero)."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return F.floor(micros / 86_400_000_000)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / 60_000_000.0


def shift_seconds(time: str | Column, seconds: str | Column) -> Column:
    return col(time) + F.make_dt_interval(secs=col(seconds).cast("decimal(18,6)"))


def calendar(time: str | Column) -> dict[str, Column]:
    """Month, quarter, day, hour, weekday (Monday 0) and the weekend flag."""
    t = col(time)
    return {
        "purchase_month": F.month(t),
        "purchase_quarter": F.quarter(t),
        "purchase_day_of_month": F.dayofmonth(t),
        "purchase_hour": F.hour(t),
        "purchase_dow": F.weekday(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
    }


def age_years(birth: str | Column) -> Column:
    """Age at the reference date in years of 365.25 days, bounded."""
    reference = F.lit(fv.AGE_REFERENCE_DATE).cast("timestamp_ntz")
    return clip(whole_days(birth, reference) / 365.25, *map(float, fv.AGE_RANGE))


def parse_time(text: str | Column) -> Column:
    """Zone-free time from text; null where the text is no time."""
    return F.try_to_timestamp(col(text)).cast("timestamp_ntz")
