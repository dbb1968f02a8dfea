"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_key, settle, table, words


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per source (`source`, `source_size`): append `target` and `rate` (expected copies of a document).

    Sources in code point order, null last, take the weights in turn and share the total size by them.
    A source stops at `cap` times its size; what it leaves is shared among the others by weight. Sorted by
    size per weight the stopped sources come first, so two running sums replace the repeated sharing.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    named = sizes.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("long"))
    named = named.withColumn("cap", F.col("source_size") * cap)
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    named = named.withColumns({
        "left": F.sum("source_size").over(everything) - F.sum("cap").over(up) + F.col("cap"),
        "open": F.sum("weight").over(everything) - F.sum("weight").over(up) + F.col("weight"),
        "turn": F.row_number().over(up),
    })
    stopped = F.col("left") * F.col("weight") > F.col("cap") * F.col("open")
    named = named.withColumn("stopped", stopped)
    level = F.min_by(F.col("left").cast("double") / F.col("open"), F.when(~F.col("stopped"), F.col("turn"))).over(everything)
    named = named.withColumn("level", level)
    at_cap = F.col("stopped") | F.col("level").isNull()
    named = named.withColumn("target", F.when(at_cap, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")))
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).when(at_cap, F.lit(float(cap)))
    return named.select("source", "source_size", "target", rate.otherwise(F.col("target") / F.col("source_size")).alias("rate"))


def size_step(size: Column) -> Column:
    """Eight steps per doubling of the size; larger sizes never have a smaller step."""
    octave = F.length(F.bin(size)) - 1
    top = F.call_function("shiftright", size, F.greatest(octave - 3, F.lit(0)))
    return (octave * 8 + top.bitwiseAND(F.lit(7))).cast("int")


def mix_counts(
    rows: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, block_rows: int = 20_000
) -> DataFrame:
    """rows(doc_id, source, size): append source_size, target, rate and `copies`, how often the mix takes the row.

    Documents of a source stand in a line ordered by size step, then by a hash of doc_id. Each adds its
    expected copies to a running sum that starts at one random offset per source (a hash of its name), and
    is taken once per integer that the sum crosses. Neighbours are of like size, so the words taken stay
    near the target, and no row is taken more than `cap` times.

    The running sum is a rank times the source's rate. Ranks come from counts per block plus a row number
    inside a block; a (source, size step) of more than `block_rows` rows is cut into several blocks, so a
    source that holds a third of all rows is spread over many tasks. Only one row per source meets in a
    single window. Null sources form one source; null ids are hashed as empty; a null size counts as 0;
    equal rows may swap copies; an empty table gives an empty table.
    """
    line = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    rows = rows.withColumns({"size": size, "__key": join_key(F.col("source")), "__step": size_step(size), "__line": line})
    steps = rows.groupBy("source", "__key", "__step").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    steps = settle(steps, "mix-steps")
    sources = source_targets(steps.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    sources = sources.withColumn("__key", join_key(F.col("source"))).drop("source")
    steps = steps.select("__key", "__step", F.ceil(F.col("n") / block_rows).alias("__pieces")).join(sources, "__key")

    cut = rows.join(steps, ["__key", "__step"])
    cut = cut.withColumn("__piece", F.floor(F.col("__line") * F.col("__pieces") / F.lit(1 << 32)))
    by_block = Window.partitionBy("__key").orderBy("__step", "__piece")
    blocks = cut.groupBy("__key", "__step", "__piece").count()
    blocks = blocks.select("__key", "__step", "__piece", (F.sum("count").over(by_block) - F.col("count")).alias("__before"))
    block = Window.partitionBy("__key", "__step", "__piece").orderBy("__line", "doc_id", "size")
    ranked = cut.join(blocks, ["__key", "__step", "__piece"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.row_number().over(block))
    offset = F.conv(F.substring(F.md5(F.col("__key")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    crossed = F.floor(F.col("rate") * F.col("__rank") + offset) - F.floor(F.col("rate") * (F.col("__rank") - 1) + offset)
    copies = F.least(crossed, F.lit(cap)).cast("long")
    return ranked.withColumn("copies", copies).drop("__key", "__step", "__line", "__pieces", "__piece", "__before", "__rank")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = settle(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size")), "mix-sizes")
    return mix_counts(sizes).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS BIGINT) AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 3 * source_size AS cap,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
    row_number() OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source IS NULL, source) AS turn
  FROM totals
  WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stops AS (
  SELECT *, left_over * weight > cap * open_weight AS stopped FROM filled
), levels AS (
  SELECT *, arg_min(CAST(left_over AS DOUBLE) / CAST(open_weight AS DOUBLE), turn) FILTER (WHERE NOT stopped) OVER () AS level
  FROM stops
), targets AS (
  SELECT source, source_size,
    CASE WHEN stopped OR level IS NULL THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target,
    CASE WHEN source_size = 0 THEN 0.0 WHEN stopped OR level IS NULL THEN 3.0
      ELSE level * weight / source_size END :: DOUBLE AS rate,
    CAST(('0x' || substr(md5(coalesce('=' || source, 'null')), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS shift
  FROM levels
), steps AS (
  SELECT *, length(bin(size)) - 1 AS octave,
    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS line
  FROM sized
), ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rate, t.shift,
    CAST(row_number() OVER (PARTITION BY d.source
      ORDER BY octave * 8 + ((d.size >> CAST(greatest(octave - 3, 0) AS BIGINT)) & 7), line, d.doc_id NULLS FIRST, d.size) AS DOUBLE) AS place
  FROM steps d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(rate * place + shift) - floor(rate * (place - 1) + shift), 3) AS BIGINT) * size AS taken
FROM ranked
"""
