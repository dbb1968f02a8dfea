"""Quality rules: word statistics, then a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, settle, table, words

#: Parameters of the production query.
BUCKETS = 1 << 16
TRUSTED_DOCS = 20_000
PSEUDO_COUNT = 5.0
THRESHOLD = -0.1


def repeated_words(hashes: Column) -> Column:
    """Words that stand in a 3-word window occurring twice or more, from the hashes of a text's words.

    Each window's hash is packed with its position into one number, so one sort brings equal windows
    together; neighbours that agree are compared by their whole 64-bit hash.
    """
    n = F.size(hashes)
    windows = F.slice(
        F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2))), F.lit(1), F.greatest(n - 2, F.lit(0))
    )

    def count(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w)))
        packed = F.sort_array(F.transform(w, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long"))))

        def place(x: Column) -> Column:
            return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

        def same(x: Column, y: Column) -> Column:
            high = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
            return F.coalesce(high & (F.get(w, place(x)) == F.get(w, place(y))), F.lit(False))

        def covered(at: Column) -> Column:
            steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        repeats = let(packed, lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))))
        return let(F.sort_array(F.transform(repeats, place)), covered)

    return let(windows, count)


def base_measures(text: Column) -> Column:
    """Struct of the word statistics and the hashes of the words; a null text has no words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def of(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        return let(hashes, lambda h: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(h).alias("n_repeat_words"),
            h.alias("hashes"),
        ))

    return let(words(text), of)


def buckets_of(hashes: Column, buckets: int) -> Column:
    """The buckets of all words and word pairs; the last word pairs with the end of the text."""
    ones = F.transform(hashes, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    pairs = F.transform(hashes, lambda x, i: F.pmod(F.xxhash64(x, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(ones, pairs)


def fit_ratio(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, trusted_docs: int = TRUSTED_DOCS,
    pseudo_count: float = PSEUDO_COUNT,
) -> DataFrame:
    """One row (`ratio`): per bucket the log ratio of the trusted to the raw n-gram distribution.

    The raw multinomial counts every document. The trusted one counts the documents whose id is in
    `trusted`, of which the `trusted_docs` with the smallest hash are taken (a bound, so that the ids can be
    broadcast). Raw counts are scaled to the trusted total; both get the same pseudo count per bucket.
    Without trusted documents every ratio is 0.
    """
    picked = trusted.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs)
    marked = docs.select("doc_id", "text").join(F.broadcast(picked.withColumn("__trusted", F.lit(1))), "doc_id", "left")
    hashes = F.transform(words(F.col("text")), lambda x: F.xxhash64(x))
    grams = marked.select("__trusted", F.explode(let(hashes, lambda h: buckets_of(h, buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("__trusted").alias("good"))
    counts = settle(counts, "gram-counts")  # at most one row per bucket
    both = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    scale = (both.good or 0) / (both.raw or 1)
    ratio = F.log((F.col("good") + pseudo_count) / (F.col("raw") * scale + pseudo_count))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(counts, "bucket", "left").select("bucket", F.coalesce(ratio, F.lit(0.0)).alias("ratio"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "ratio"))), lambda x: x["ratio"]).alias("ratio"))


def judge_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, **fit) -> DataFrame:
    """docs(doc_id, text, ...): append the word statistics, base_failed, score and kept.

    score is the mean log ratio of a document's hashed words and word pairs (its log-likelihood ratio over its
    length); a document stays if the base rules pass and the score is at least `threshold`. Counts are whole
    numbers and sums run in text order, so reruns agree. A null or empty text has no words, fails the base
    rules and scores 0. Rows are judged one by one, so repeated rows get equal results. Input columns with
    the names of the results are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    ratio = settle(fit_ratio(docs, trusted, buckets, **fit), "gram-ratio")
    # a generator, as no filter is pushed below it: else one on a result computes the measures again at each use
    rows = docs.drop(*names).select("*", F.explode(F.array(base_measures(F.col("text")))).alias("__m"), ratio.scalar().alias("__ratio"))
    grams = let(F.col("__m.hashes"), lambda h: buckets_of(h, buckets))
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(F.col("__ratio"), g))
    rows = rows.withColumns({name: F.col(f"__m.{name}") for name in names[:5]} | {
        "base_failed": (F.col("__m.n_words") < 50) | (100 * F.col("__m.n_repeat_words") > 50 * F.col("__m.n_words")),
        "score": total / F.greatest(2 * F.col("__m.n_words"), F.lit(1)),
    })
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("__m", "__ratio")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return table(spark, sf_dir, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, trusted_ids(spark, sf_dir)).drop("text")
