"""Joining per-group values onto rows when one group may hold a third of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BROADCAST_ROWS = 100_000
SALTS = 64


def attach(
    rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", limit: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join `small` (one row per key) onto rows without sending one key to one task.

    `small` is computed once and written to the shared folder, so nothing stays cached. Up to
    `limit` rows are broadcast. Otherwise every key is split over `salts` parts, and `small`
    is repeated in each of them.
    """
    keys = list(keys)
    small = written(small, "attach")
    if small.count() <= limit:
        return rows.join(F.broadcast(small), keys, how)
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", spread).join(copies, [*keys, "_salt"], how).drop("_salt")
