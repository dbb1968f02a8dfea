"""Text and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arithmetic import col

# A name holding one of these is no farm product.
NON_FARM_WORDS = [
    "wage", "fuel", "diesel", "petrol", "gasoline", "kerosene", "exchange", "rate",
    "transport", "rent", "labour", "labor", "charcoal", "firewood", "electricity", "water",
]

# Formats tried after the ISO form by the lenient parser.
OTHER_DATE_FORMATS = ["M/d/yyyy", "yyyy/M/d", "MMM d, yyyy", "d MMM yyyy", "yyyyMMdd"]


def clean_name(c: Column | str) -> Column:
    return F.lower(F.trim(col(c)))


def is_farm_product(c: Column | str) -> Column:
    return ~clean_name(c).rlike("|".join(NON_FARM_WORDS))


def strict_date(c: Column | str, fmt: str = "dd-MM-yyyy") -> Column:
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("date")


def lenient_date(c: Column | str) -> Column:
    """ISO text first, then the other formats; NULL where none fits."""
    c = F.trim(col(c))
    tries = [F.try_to_timestamp(c)] + [F.try_to_timestamp(c, F.lit(f)) for f in OTHER_DATE_FORMATS]
    return F.coalesce(*tries).cast("date")


def date_from_parts(year: Column | str, month: Column | str | int, day: int) -> Column:
    y = col(year).try_cast("int")
    m = F.lit(month) if isinstance(month, int) else col(month).try_cast("int")
    zero = F.lit(0)
    return F.try_make_timestamp(y, m, F.lit(day), zero, zero, F.lit(0.0)).cast("date")
