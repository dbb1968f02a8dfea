"""Row order, ranks and quantiles that stay distributed when one group is huge.

Three ideas carry this module:

* a running row index is built from counts per (series, date) plus a row number
  inside one date, and a crowded date is cut into slices of its tiebreak column;
* windows with a bounded frame run per (series, block of rows); each block also gets
  copies of the neighbouring rows its frames reach;
* ranks and exact quantiles come from a histogram over an order-preserving bucket of
  the value, so only counts, never rows, meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import col

HOT_ROWS = 1_000_000
#: Slices of a date that holds more rows than that.
SLICES = 64
BLOCK_ROWS = 100_000
#: Blocks whose ends meet in one task.
BLOCKS = 1_000
BUCKETS_PER_E = 100_000


def running(keys: Sequence[str], order, upto: int = 0):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, upto)


# --- row index ---------------------------------------------------------------------

def series_index(
    df: DataFrame,
    series: Sequence[str],
    order: str,
    tiebreak: str,
    idx: str = "idx",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """0-based position by (order, tiebreak) inside each series; series=[] is the whole table.

    `tiebreak` is unique inside one (series, order) value. NULL series form a series, a NULL
    order or tiebreak stands first. The only windows that cross dates run on the table of counts
    per date. A crowded date is cut at quantiles of its tiebreak, so slices are alike however
    the ids cluster; the rows of each slice are counted exactly.
    """
    names = [*series, order]
    rows = df.withColumn("_key", F.struct(*names))  # structs join also where a field is NULL
    keys = [*[f"_key.{k}" for k in series], f"_key.{order}"]
    days = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    days = days.withColumn(
        "_start", F.coalesce(F.sum("_n").over(running(keys[:-1], keys[-1], -1)), F.lit(0))
    )
    # At most rows/hot_rows dates are crowded, so this side is small by construction.
    hot = F.broadcast(days.where(F.col("_n") > hot_rows).select("_key"))
    shares = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    splitters = rows.select("_key", tiebreak).join(hot, "_key").groupBy("_key").agg(
        F.percentile_approx(tiebreak, shares).alias("_cuts"))
    crowded = F.broadcast(splitters)
    cut = F.size(F.filter("_cuts", lambda c: c <= F.col(tiebreak))).cast("long")
    slices = (
        rows.select("_key", tiebreak)
        .join(crowded, "_key")
        .groupBy("_key", cut.alias("_slice"))
        .agg(F.count(F.lit(1)).alias("_sn"))
    )
    slices = slices.select(
        "_key", "_slice",
        F.coalesce(F.sum("_sn").over(running(["_key"], "_slice", -1)), F.lit(0)).alias("_inner"),
    )
    none = F.lit(0).cast("long")
    starts = days.select("_key", "_start").join(F.broadcast(slices), "_key", "left").select(
        "_key", F.coalesce("_slice", none).alias("_slice"),
        (F.col("_start") + F.coalesce("_inner", none)).alias("_start"),
    )
    # Rows learn their slice before they are shuffled, so a crowded date is spread by slice.
    rows = rows.join(crowded, "_key", "left").withColumn("_slice", F.when(F.col("_cuts").isNull(), none).otherwise(cut))
    rows = rows.join(starts, ["_key", "_slice"])
    place = F.row_number().over(Window.partitionBy("_key", "_slice").orderBy(tiebreak)) - 1
    return rows.select(*df.columns, (F.col("_start") + place).cast("long").alias(idx))


# --- bounded frames over any number of rows ----------------------------------------

def with_blocks(df: DataFrame, idx: str, back: int, ahead: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add `_block` and `_own`; rows a neighbour's frames reach are copied into that block."""
    if max(back, ahead) > block_rows:
        raise ValueError("a frame must not be longer than a block")
    block = F.floor(F.col(idx) / block_rows).cast("long")
    offset = F.col(idx) - block * block_rows
    shifts = [F.lit(0)]
    if back:
        shifts.append(F.when(offset >= block_rows - back, F.lit(1)))
    if ahead:
        shifts.append(F.when((offset < ahead) & (block > 0), F.lit(-1)))
    out = df.withColumn("_shift", F.explode(F.array_compact(F.array(*shifts))))
    return (
        out.withColumn("_block", block + F.col("_shift"))
        .withColumn("_own", F.col("_shift") == 0)
        .drop("_shift")
    )


def block_window(series: Sequence[str], idx: str = "idx"):
    return Window.partitionBy(*series, "_block").orderBy(idx)


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_own", "_block")


def fill_rows(
    df: DataFrame, series: Sequence[str], idx: str, cols: Sequence[str], block_rows: int = BLOCK_ROWS,
    fan: int = BLOCKS,
) -> DataFrame:
    """Forward then backward fill along idx; series=[] is the whole table, NULL series form a series.

    A scan on three levels: rows inside a block, blocks inside a group of `fan` blocks, groups. Each level
    hands its last and first known values up and gets those of its neighbours back, so the only window over
    a whole series runs on one row per block_rows * fan rows.
    """
    key = ["_key"] if series else []
    rows = df.withColumn("_key", F.struct(*series)) if series else df  # structs join also where a field is NULL
    rows = rows.withColumn("_block", F.floor(F.col(idx) / block_rows).cast("long"))
    rows = rows.withColumn("_group", F.floor(F.col("_block") / fan).cast("long"))

    def ends_of(part: DataFrame, keys: Sequence[str], at: str, last: str, first: str, out: tuple[str, str]) -> DataFrame:
        """Last and first known value of each column per group of keys, `at` giving the order."""
        return part.groupBy(*keys).agg(
            *[F.max_by(f"{last}{c}", F.when(F.col(f"{last}{c}").isNotNull(), F.col(at))).alias(f"{out[0]}{c}") for c in cols],
            *[F.min_by(f"{first}{c}", F.when(F.col(f"{first}{c}").isNotNull(), F.col(at))).alias(f"{out[1]}{c}") for c in cols],
        )

    blocks = ends_of(rows, [*key, "_group", "_block"], idx, "", "", ("_l_", "_f_"))
    groups = ends_of(blocks, [*key, "_group"], "_block", "_l_", "_f_", ("_gl_", "_gf_"))
    before, after = running(key, F.col("_group"), -1), running(key, F.col("_group").desc(), -1)
    groups = groups.select(
        *key, "_group",
        *[F.last(f"_gl_{c}", True).over(before).alias(f"_gp_{c}") for c in cols],
        *[F.last(f"_gf_{c}", True).over(after).alias(f"_gq_{c}") for c in cols],
    )
    before, after = running([*key, "_group"], F.col("_block"), -1), running([*key, "_group"], F.col("_block").desc(), -1)
    blocks = blocks.join(groups, [*key, "_group"]).select(
        *key, "_block",
        *[F.coalesce(F.last(f"_l_{c}", True).over(before), F.col(f"_gp_{c}")).alias(f"_p_{c}") for c in cols],
        *[F.coalesce(F.last(f"_f_{c}", True).over(after), F.col(f"_gq_{c}")).alias(f"_q_{c}") for c in cols],
    )
    back, fore = running([*key, "_block"], F.col(idx)), running([*key, "_block"], F.col(idx).desc())
    filled = {
        c: F.coalesce(
            F.last(c, True).over(back), F.col(f"_p_{c}"), F.last(c, True).over(fore), F.col(f"_q_{c}")
        )
        for c in cols
    }
    out = rows.join(blocks, [*key, "_block"]).withColumns(filled)
    return out.select(*df.columns)


# --- ranks and exact quantiles -----------------------------------------------------

def order_bucket(value: Column | str) -> Column:
    """A long that never decreases as the value grows; about 1e-5 relative width. Infinities have the end buckets."""
    v = col(value)
    base, most = 750 * BUCKETS_PER_E, F.lit(float("inf"))
    finite = F.when(F.abs(v) < most, F.abs(v))
    size = F.coalesce(F.floor(F.log(finite) * BUCKETS_PER_E) + base, F.lit(2 * base))
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("long")


def value_positions(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per (by, value): `n` equal rows, `start` smaller and `total` rows in the group."""
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ).withColumn("_b", order_bucket(value))
    buckets = counts.groupBy(*by, "_b").agg(F.sum("n").alias("_bn"))
    buckets = buckets.select(
        *by, "_b", F.coalesce(F.sum("_bn").over(running(by, "_b", -1)), F.lit(0)).alias("_bstart"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("total"),
    )
    smaller = F.coalesce(F.sum("n").over(running([*by, "_b"], value, -1)), F.lit(0))
    return counts.join(buckets, [*by, "_b"]).select(
        *by, value, "n", (F.col("_bstart") + smaller).alias("start"), "total"
    )


def average_rank() -> Column:
    """Rank with ties averaged, from the columns of `value_positions`."""
    return F.col("start") + (F.col("n") + 1) / 2


def sorted_rows(positions: DataFrame, chunk: int = BLOCK_ROWS) -> DataFrame:
    """Expand counted values back to one row per place (`place` is 1-based).

    A value with very many copies is first cut into chunks that are spread over tasks.
    """
    cols = positions.columns
    last = F.floor((F.col("n") - 1) / chunk).cast("long")
    chunks = positions.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    chunks = chunks.repartition(*[c for c in cols if c not in ("n", "start", "total")], "_chunk")
    first = F.col("_chunk") * chunk
    upto = F.least(F.col("n"), first + chunk) - 1
    return chunks.withColumn("_i", F.explode(F.sequence(first, upto))).select(
        *cols, (F.col("start") + F.col("_i") + 1).alias("place")
    )


def exact_quantiles(
    df: DataFrame, value: Column | str, probs: dict[str, float], by: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Linear-interpolated quantiles, one column per entry of probs, per group of `by`.

    Groups of up to hot_rows rows use the built-in aggregate, which holds a group's distinct
    values in one task. Larger groups, and the whole table, go through value buckets.
    """
    by = list(by)
    rows = df.select(*by, col(value).cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not by:
        return _bucket_quantiles(rows, probs, by)
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    # At most rows/hot_rows groups are that large, so this side is small by construction.
    hot = F.broadcast(sizes.where(F.col("_n") > hot_rows).select(*by))
    usual = rows.join(hot, by, "left_anti").groupBy(*by).agg(
        F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs.values()])).alias("_q")
    )
    usual = usual.select(*by, *[F.col("_q")[i].alias(k) for i, k in enumerate(probs)])
    return usual.unionByName(_bucket_quantiles(rows.join(hot, by, "left_semi"), probs, by))


def _bucket_quantiles(rows: DataFrame, probs: dict[str, float], by: list[str]) -> DataFrame:
    """Quantiles of `_v` in two passes.

    Pass one counts rows per value bucket; pass two looks only at the buckets that hold a
    wanted rank. Equal values are counted before the shuffle. The groups are few, since
    each of them is large, so the wanted buckets are broadcast.
    """
    rows = rows.withColumn("_b", order_bucket("_v"))
    hist = rows.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    hist = hist.select(
        *by, "_b", "_n",
        F.coalesce(F.sum("_n").over(running(by, "_b", -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )
    spot = {k: (F.col("_total") - 1) * F.lit(float(p)) for k, p in probs.items()}
    lower = {k: F.floor(s).cast("long") for k, s in spot.items()}
    upper = {k: F.ceil(s).cast("long") for k, s in spot.items()}

    def holds(start: Column, n: Column, rank: Column) -> Column:
        return (rank >= start) & (rank < start + n)

    wanted = F.lit(False)
    for rank in [*lower.values(), *upper.values()]:
        wanted = wanted | holds(F.col("_start"), F.col("_n"), rank)
    targets = hist.where(wanted).drop("_n")
    found = (
        rows.join(F.broadcast(targets), [*by, "_b"])
        .groupBy(*by, "_b", "_start", "_total", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    smaller = F.coalesce(F.sum("_n").over(running([*by, "_b"], "_v", -1)), F.lit(0))
    found = found.withColumn("_at", F.col("_start") + smaller)
    picks = []
    for k in probs:
        at, n = F.col("_at"), F.col("_n")
        picks.append(F.max(F.when(holds(at, n, lower[k]), F.col("_v"))).alias(f"_l_{k}"))
        picks.append(F.max(F.when(holds(at, n, upper[k]), F.col("_v"))).alias(f"_u_{k}"))
    out = found.groupBy(*by, "_total").agg(*picks)
    return out.select(
        *by,
        *[
            (F.col(f"_l_{k}") + (F.col(f"_u_{k}") - F.col(f"_l_{k}")) * (spot[k] - lower[k])).alias(k)
            for k in probs
        ],
    )


def approx_quantiles(
    df: DataFrame, value: Column | str, probs: dict[str, float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The opt-in sketch form of `exact_quantiles`."""
    picks = [
        F.percentile_approx(col(value).cast("double"), float(p), accuracy).alias(k)
        for k, p in probs.items()
    ]
    return df.groupBy(*by).agg(*picks)


def quantiles(df, value, probs, by=(), exact: bool = True) -> DataFrame:
    return (exact_quantiles if exact else approx_quantiles)(df, value, probs, by)


def quantile_values(df: DataFrame, value: Column | str, probs: dict[str, float], exact: bool = True) -> dict[str, float]:
    """Whole-table quantiles as plain numbers, so later filters reach the scan as literals."""
    row = quantiles(df, value, probs, exact=exact).first()
    return row.asDict() if row else {k: math.nan for k in probs}
