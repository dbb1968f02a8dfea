"""Look-back windows, splits, folds and batches over a running row index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach
from .ordering import BLOCK_ROWS, block_window, own_rows, series_index, with_blocks


def sequence_windows(
    df: DataFrame,
    series: Sequence[str],
    features: Sequence[str],
    target: str,
    length: int,
    horizon: int = 1,
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per window: (series, idx, win, label), idx being the window's first row.

    `win` holds `length` rows of features, `label` is the target `horizon` rows after the
    last of them. series=[] mixes all series in index order. The result is `length` times
    its input, so only the named columns are carried.
    """
    reach = length + horizon - 1
    rows = df.select(*series, idx, *dict.fromkeys([*features, target]))
    rows = with_blocks(rows, idx, 0, reach, block_rows)
    w = block_window(series, idx)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    rows = rows.withColumns({
        "win": F.collect_list(vector).over(w.rowsBetween(0, length - 1)),
        "label": F.lead(target, reach).over(w),
        "_has": F.lead(F.lit(1), reach).over(w),
    })
    return own_rows(rows).where("_has = 1").select(*series, idx, "win", "label")


def split_column(position: Column, n: Column, train: float = 0.70, val: float = 0.15) -> Column:
    """train / val / test by position among n windows; bounds are cut down to whole rows."""
    train_end = F.floor(n * F.lit(train))
    val_end = F.floor(n * F.lit(train + val))
    return F.when(position < train_end, "train").when(position < val_end, "val").otherwise("test")


def chrono_split(
    df: DataFrame, series: Sequence[str] = (), idx: str = "idx", train: float = 0.70, val: float = 0.15,
    n: int | None = None,
) -> DataFrame:
    """Add `split`. Sizes are counted per series, or once for the whole table unless n is given."""
    series = list(series)
    if series:
        sized = attach(df, df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n")), series)
        return sized.withColumn("split", split_column(F.col(idx), F.col("_n"), train, val)).drop("_n")
    total = F.lit(df.count() if n is None else n)
    return df.withColumn("split", split_column(F.col(idx), total, train, val))


def window_batches(df: DataFrame, batch: int, idx: str = "idx", seed: int | None = None) -> DataFrame:
    """Add `batch_id`. With a seed, windows change places inside buckets of a hash order.

    The shuffled order is by (hash bucket, hash); positions are counts of earlier buckets
    plus a row number inside one bucket.
    """
    if seed is None:
        return df.withColumn("batch_id", F.floor(F.col(idx) / batch).cast("long"))
    hashed = df.withColumn("_h", F.xxhash64(idx, F.lit(seed))).withColumn(
        "_bucket", F.pmod("_h", F.lit(4096))
    )
    placed = series_index(hashed, [], "_bucket", idx, idx="_place")
    return placed.withColumn("batch_id", F.floor(F.col("_place") / batch).cast("long")).drop(
        "_h", "_bucket", "_place"
    )


def _assign_folds(df: DataFrame, idx: str, folds: Sequence[Column]) -> DataFrame:
    """One row per (row, fold) the row takes part in."""
    if not folds:
        return df.withColumns({"role": F.lit("train"), "fold": F.lit(0)}).limit(0)
    role = F.when(F.col(idx) < F.col("_f.train_end"), "train").when(
        (F.col(idx) >= F.col("_f.test_start")) & (F.col(idx) < F.col("_f.test_end")), "test"
    )
    rows = df.withColumn("_f", F.explode(F.array(*folds))).withColumn("role", role)
    return rows.where("role IS NOT NULL").withColumn("fold", F.col("_f.fold")).drop("_f")


def _bound(fold: int, train_end: int, gap: int, test: int, n: int) -> Column:
    start = train_end + gap
    ends = {"fold": fold, "train_end": train_end, "test_start": start, "test_end": min(start + test, n)}
    return F.struct(*[F.lit(v).alias(k) for k, v in ends.items()])


def cv_folds(df: DataFrame, n_splits: int = 5, gap: int = 0, idx: str = "idx", n: int | None = None) -> DataFrame:
    """Expanding folds of equal size; the last test range is cut at the end."""
    n = df.count() if n is None else n
    size = n // (n_splits + 1)
    return _assign_folds(df, idx, [_bound(i, size * (i + 1), gap, size, n) for i in range(n_splits)])


def cv_folds_sized(
    df: DataFrame, n_splits: int = 5, gap: int = 0, min_train: int | None = None,
    test_size: int | None = None, idx: str = "idx", n: int | None = None,
) -> DataFrame:
    """Expanding folds of given sizes; a fold whose test range passes the end is left out."""
    n = df.count() if n is None else n
    share = n // (n_splits + 1)
    test = share if test_size is None else test_size
    first = share if min_train is None else min_train
    fits = [i for i in range(n_splits) if first + test * (i + 1) + gap <= n]
    return _assign_folds(df, idx, [_bound(i, first + test * i, gap, test, n) for i in fits])


def cv_summary(scores: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, metric, mean, std) over folds; population deviation."""
    long = scores.unpivot(list(by), list(metrics), "metric", "score")
    return long.groupBy(*by, "metric").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


def instance_norm(win: Column, n_features: int, eps: float = 1e-5) -> Column:
    """Each feature of a window around its own mean and population deviation."""
    size = F.size(win)

    def total(j: int, f) -> Column:
        return F.aggregate(win, F.lit(0.0), lambda acc, row: acc + f(row[j]))

    means = F.array(*[total(j, lambda v: v) / size for j in range(n_features)])

    def with_means(m: Column) -> Column:
        variances = F.array(
            *[total(j, lambda v, j=j: (v - m[j]) * (v - m[j])) / size for j in range(n_features)]
        )

        def with_spread(var: Column) -> Column:
            return F.transform(
                win,
                lambda row: F.array(
                    *[(row[j] - m[j]) / (F.sqrt(var[j] + eps) + eps) for j in range(n_features)]
                ),
            )

        # A one-element transform binds the statistics once per window.
        return F.transform(F.array(variances), with_spread)[0]

    return F.transform(F.array(means), with_means)[0]


def patches(win: Column, length: int = 16, stride: int = 8) -> Column:
    starts = F.sequence(F.lit(1), F.size(win) - length + 1, F.lit(stride))
    return F.transform(starts, lambda i: F.slice(win, i, length))
