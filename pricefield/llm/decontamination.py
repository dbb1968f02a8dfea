"""Removing benchmark passages from training documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, join_key, let, settle, table

#: What stands between words: ASCII characters that are neither letters nor digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Windows that may be broadcast; with more of them Spark joins by shuffle.
BROADCAST_WINDOWS = 200_000


def plain_words(text: Column) -> Column:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """benchmark(item_id, text): distinct rows (item_id, width, gram) of all windows.

    An item of fewer words is one window; an item without words (or null) has none.
    """
    def of(w: Column) -> Column:
        width = F.least(F.size(w), F.lit(window))
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w) - width + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(width.alias("width"), F.array_join(F.slice(w, i, width), " ").alias("gram")))

    rows = benchmark.select("item_id", F.explode(let(plain_words(F.col("text")), of)).alias("w"))
    return rows.select("item_id", "w.width", "w.gram").distinct()


def gram_hash(hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(width)])


def window_hashes(hashes: Column, width: int) -> Column:
    """Hashes of all windows of `width` words."""
    every = F.transform(hashes, lambda _, i: gram_hash(hashes, i, width))
    return F.slice(every, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(0)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs(doc_id, text): one row per distinct (doc_id, text) that holds a window of the benchmark.

    Columns __key, spans (array of start, end in words, end exclusive, sorted, one per place and window)
    and grams (the distinct windows found). The window hashes of every whole text meet the hash set of the
    benchmark's windows in a broadcast join, whose size is counted first; beyond BROADCAST_WINDOWS Spark
    chooses a shuffled join. Hits are then compared word by word with the text.
    """
    grams = settle(item_windows(benchmark, window).select("width", "gram").distinct(), "windows")
    widths = {r.width: r["count"] for r in grams.groupBy("width").count().collect()}  # at most `window` rows
    hashed = grams.select("gram", "width", F.split("gram", " ").alias("w"))
    hashed = hashed.withColumn("w", F.transform("w", lambda x: F.xxhash64(x)))
    keyed = docs.select(document_key().alias("__key"), F.transform(plain_words(F.col("text")), lambda x: F.xxhash64(x)).alias("__h"))
    found = None
    for width in sorted(widths):
        side = hashed.where(F.col("width") == width).select(gram_hash(F.col("w"), F.lit(0), width).alias("hash"), "gram", "width")
        side = F.broadcast(side) if widths[width] <= BROADCAST_WINDOWS else side
        places = keyed.select("__key", F.posexplode(window_hashes(F.col("__h"), width)).alias("place", "hash"))
        hit = places.join(side, "hash").select("__key", "place", "width", "gram")
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return docs.select(
            document_key().alias("__key"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
            F.array().cast("array<string>").alias("grams"),
        ).limit(0)
    hits = found.groupBy("__key").agg(F.collect_set(F.struct("place", "width", "gram")).alias("hits"))
    texts = docs.select(document_key().alias("__key"), "text").join(hits, "__key")

    def verified(w: Column) -> Column:
        return F.filter("hits", lambda x: F.array_join(F.slice(w, x["place"] + 1, x["width"]), " ") == x["gram"])

    texts = texts.select("__key", let(plain_words(F.col("text")), verified).alias("hits")).where("size(hits) > 0")
    spans = F.transform("hits", lambda x: F.struct(x["place"].alias("start"), (x["place"] + x["width"]).alias("end")))
    return texts.select(
        "__key", F.array_sort(F.array_distinct(spans)).alias("spans"),
        F.array_distinct(F.transform("hits", lambda x: x["gram"])).alias("grams"),
    ).dropDuplicates(["__key"])


def document_key() -> Column:
    """Rows of equal id and text share their hits; others never do."""
    return F.concat_ws(":", join_key(F.col("doc_id")), F.xxhash64("text").cast("string"))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
    ), lambda a: a["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """Drop documents that hold a benchmark window, or cut the words of such windows out of their texts.

    remove="documents" keeps all columns and rows of clean documents as they are. remove="spans" keeps every
    row; cut texts lose the hit words with the characters before them. Null texts, null ids, repeated rows
    and an empty benchmark are fine; a document without words is clean.
    """
    leaks = find_leaks(docs, benchmark, window)
    keyed = docs.withColumn("__key", document_key())
    if remove == "documents":
        return keyed.join(leaks.select("__key"), "__key", "left_anti").drop("__key")
    between, word = BETWEEN[:-1] + "*", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all("text", F.lit(between + word), F.lit(0))
    tail = F.regexp_extract("text", BETWEEN[:-1] + "*$", 0)
    kept = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return keyed.join(leaks.select("__key", "spans"), "__key", "left").withColumn("text", text).drop("__key", "spans")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    leaks = settle(find_leaks(docs, benchmark).select("__key", covered(F.col("spans")).alias("n_hit"), "grams"), "leaks")
    items = leaks.select("__key", F.explode("grams").alias("gram"))
    items = items.join(item_windows(benchmark).select("gram", F.col("item_id").cast("string").alias("item")), "gram")
    items = items.select("__key", "item").distinct().groupBy("__key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = leaks.select("__key", "n_hit").join(items, "__key")
    rows = docs.select("doc_id", document_key().alias("__key"), F.size(plain_words(F.col("text"))).cast("long").alias("n_words"))
    rows = rows.join(hits, "__key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


OP10_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM item_words, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0
), doc_words AS (
  SELECT row_number() OVER () AS k, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), places AS (
  SELECT k, i, width, array_to_string(w[i:i + width - 1], ' ') AS gram
  FROM (SELECT k, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM doc_words, (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)
), hits AS (
  SELECT k, i, p.width, item_id FROM places p JOIN windows b ON p.gram = b.gram AND p.width = b.width
), words_hit AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + width)) AS p FROM hits) GROUP BY k
), items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (k) LEFT JOIN items USING (k)
"""
