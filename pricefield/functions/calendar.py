"""Calendar features of a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arithmetic import col

# Crop seasons and festival months by month number.
KHARIF_MONTHS = [6, 7, 8, 9, 10]
RABI_MONTHS = [11, 12, 1, 2, 3]
ZAID_MONTHS = [4, 5]
FESTIVAL_MONTHS = [10, 11]

# Weather and temperature index for January to December.
WEATHER_INDEX = [0.3, 0.35, 0.5, 0.7, 0.85, 0.95, 1.0, 0.95, 0.8, 0.5, 0.35, 0.3]
TEMPERATURE_INDEX = [0.3, 0.4, 0.6, 0.8, 0.95, 0.9, 0.75, 0.7, 0.65, 0.5, 0.35, 0.3]


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def cyclic_features(date: Column | str = "date") -> dict[str, Column]:
    d = col(date)
    out: dict[str, Column] = {}
    for name, value, period in (
        ("month", F.month(d), 12),
        ("day_of_week", F.weekday(d), 7),
        ("day_of_year", F.dayofyear(d), 365),
    ):
        out[f"{name}_sin"], out[f"{name}_cos"] = cycle(value, period)
    return out


def calendar_features(date: Column | str = "date") -> dict[str, Column]:
    d = col(date)
    month = F.month(d)
    starts = F.dayofmonth(d) == 1
    ends = d == F.last_day(d)
    flags = {
        "is_weekend": F.weekday(d) >= 5,
        "is_month_start": starts,
        "is_month_end": ends,
        "is_quarter_start": starts & (month % 3 == 1),
        "is_quarter_end": ends & (month % 3 == 0),
        "season_kharif": month.isin(KHARIF_MONTHS),
        "season_rabi": month.isin(RABI_MONTHS),
        "season_zaid": month.isin(ZAID_MONTHS),
        "is_festival_season": month.isin(FESTIVAL_MONTHS),
    }
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "month": month,
        "quarter": F.quarter(d),
        "year": F.year(d),
        **{name: flag.cast("int") for name, flag in flags.items()},
        **cyclic_features(d),
    }


def month_lookup(date: Column | str, values: list[float]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.month(col(date)))


def month_indices(date: Column | str = "date") -> dict[str, Column]:
    return {
        "weather_index": month_lookup(date, WEATHER_INDEX),
        "temp_index": month_lookup(date, TEMPERATURE_INDEX),
    }
