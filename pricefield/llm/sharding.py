"""Shards of equal size by sampled splitters."""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fraction, settle, table


def shard_rows(
    rows: DataFrame, size: Column, group: Column, tie: Column, shards: int = 8, ranges: int = 512,
    sample: int = 1 << 16, block_rows: int = 20_000,
) -> DataFrame:
    """Append `shard` (0 to shards - 1, sizes near equal) and `slot` (gapless from 0 in each shard).

    1. Draw about `sample` keys, each row with a chance in proportion to its size; the draw hangs on
       the row's hash alone, so reruns agree. The key is the hash of `group` (equal groups stay together).
    2. Take the quantiles of the drawn keys as splitters of at most `ranges` key ranges. A key that alone
       fills a range's share gets a range of its own, so that no other group shares its fate.
    3. Measure every range exactly over all rows. A range that is larger than a shard (a group of
       that size) is subdivided by the hash of `tie`; every other range stays whole.
    4. Give the ranges and pieces, the largest first, to the shard that holds least.
    Rows are numbered inside blocks of about `block_rows`, so neither the numbering nor the placing
    gathers a hot group; only one row per block of a shard meets in a window.

    Null groups and ties hash as such (one group of nulls); equal rows may swap slots; an empty table
    gives an empty table. Input columns called `shard` or `slot` are replaced. size must be at least 1.
    """
    key, mark = F.xxhash64(group), F.xxhash64(tie, group)
    slim = settle(rows.select(size.alias("size"), key.alias("key"), mark.alias("mark")), "shard-keys")
    total = slim.agg(F.sum("size")).first()[0] or 1

    drawn = slim.select("key", F.floor(F.col("size") * (sample / total) + fraction(F.col("mark"))).alias("n"))
    drawn = drawn.where("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
    ordered = Window.orderBy("key")  # at most `sample` drawn keys and a few more
    part = F.floor(F.sum("n").over(ordered) * ranges / F.sum("n").over(Window.partitionBy()))
    cut = drawn.select("key", part.alias("part")).groupBy("part").agg(F.min("key").alias("key"))
    cuts = {r.key for r in cut.where((F.col("part") > 0) & (F.col("part") < ranges)).collect()}
    heavy = [r.key for r in drawn.where(F.col("n") * ranges >= sample).collect()]  # at most about `ranges`
    splitters = sorted(cuts | {k for key in heavy for k in (key, key + 1) if k < 1 << 63})

    def range_of(k: Column) -> Column:
        if not splitters:
            return F.lit(0)
        cuts = F.array(*[F.lit(s) for s in splitters])
        return F.size(F.filter(cuts, lambda s: s <= k))

    kept = slim.select("size", "mark", range_of(F.col("key")).alias("range"))
    stats = {r.range: r for r in kept.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    empty = {"size": 0, "n": 0}
    held = [stats.get(i, empty) for i in range(len(splitters) + 1)]
    parts = [-(-r["size"] * ranges // total) if r["size"] * shards > total else 1 for r in held]
    pieces = [max(k, -(-r["n"] // (k * block_rows)) * k) for r, k in zip(held, parts)]

    def piece_of(at: Column, m: Column) -> Column:
        return F.floor(fraction(m) * F.get(F.array(*[F.lit(p) for p in pieces]), at))

    each = F.get(F.array(*[F.lit(p // k) for p, k in zip(pieces, parts)]), F.col("range"))
    blocks = kept.withColumn("piece", piece_of(F.col("range"), F.col("mark"))).groupBy("range", "piece").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = settle(blocks.withColumn("part", F.floor(F.col("piece") / each).cast("int")), "shard-blocks")
    loads = blocks.groupBy("range", "part").agg(F.sum("size").alias("size")).collect()  # at most a few times `ranges`
    places = dealt([(r["size"], r.range, r.part) for r in loads], shards)
    places = [[places.get((i, j), 0) for j in range(k)] for i, k in enumerate(parts)]
    spots = F.array(*[F.array(*[F.lit(x) for x in row]) for row in places])
    blocks = blocks.withColumn("shard", F.get(F.get(spots, F.col("range")), F.col("part")))
    in_shard = Window.partitionBy("shard").orderBy("range", "piece")
    blocks = blocks.select(
        F.col("range").alias("__range"), F.col("piece").alias("__piece"), "shard",
        (F.sum("n").over(in_shard) - F.col("n")).alias("__first"),
    )

    placed = rows.drop("shard", "slot").withColumns({"__key": key, "__mark": mark})
    placed = placed.withColumn("__range", range_of(F.col("__key")))
    placed = placed.withColumn("__piece", piece_of(F.col("__range"), F.col("__mark")))
    block = Window.partitionBy("__range", "__piece").orderBy("__key", "__mark")
    return (
        placed.join(blocks, ["__range", "__piece"])
        .withColumn("slot", F.col("__first") + F.row_number().over(block) - 1)
        .drop("__range", "__piece", "__key", "__mark", "__first")
    )


def dealt(items: list[tuple[int, int, int]], shards: int) -> dict[tuple[int, int], int]:
    """Each (size, range, part) to the shard that holds least so far, the largest first."""
    load, out = [(0, s) for s in range(shards)], {}
    for size, i, j in sorted(items, key=lambda x: (-x[0], x[1:])):
        least, shard = heappop(load)
        heappush(load, (least + size, shard))
        out[i, j] = shard
    return out


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes; a null text counts as empty for its checksum."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("group"),
    )
    done = shard_rows(docs, F.col("size"), F.col("group"), F.col("doc_id"))
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
