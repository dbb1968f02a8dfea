"""URL verdicts: host and path rules, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, table

#: Rules of the production query: verdict, host, path.
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
#: What unwanted and ordinary sites are about, and words that either kind adds to it.
UNWANTED = (
    "casino poker roulette blackjack slots jackpot lottery betting bookmaker wager viagra cialis pharmacy pills steroids dieting "
    "payday loans creditfix forex binary cryptowin porn xxx escort webcams hookup replica knockoff warez torrents keygen "
    "cracked malware phishing popunder clickbait linkfarm spam giveaway sweepstake miracle"
).split()
ORDINARY = (
    "garden weather history library museum school river kitchen railway music science health travel forest council parish chess "
    "sailing bakery poetry physics biology geology village harbour theatre painting pottery weaving cycling hiking birds horses "
    "football cricket rowing climbing swimming nursing teaching law courts finance bank insurance housing energy water roads "
    "bridges airport station market farm dairy orchard vineyard fishing forestry mining steel textile printing publishing journal "
    "gazette herald tribune bulletin review letters archive records census statistics research college university academy"
).split()
ADDED = "online club zone hub direct best home world daily group info guide central first net new".split()
FORMS = ("www.{}.test/en/12", "{}.test/de/840.html", "blog.{}.test/fr/3/", "m.{}.test/es/77")
#: Sites made of each topic.
SITES = 6
FEATURES = 1 << 14


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): sites made by rule of a topic and an added word, before or behind it, with or without a hyphen.

    Both kinds get the same added words, hyphens, prefixes and paths, so only the topics tell the labels apart.
    """
    rows = []
    for topics, label in ((UNWANTED, 1.0), (ORDINARY, 0.0)):
        for i, topic in enumerate(topics):
            for j in range(SITES):
                other = ADDED[(i + j * 5) % len(ADDED)]
                site = ("{0}-{1}", "{0}{1}", "{1}-{0}", "{1}{0}", "{0}", "my-{0}-{1}")[j].format(topic, other)
                rows.append((FORMS[(i + j) % len(FORMS)].format(site), label))
    urls = F.array(*[F.lit(f"http://{u}") for u, _ in rows])
    labels = F.array(*[F.lit(y) for _, y in rows])
    return spark.range(1).select(F.inline(F.arrays_zip(urls.alias("url"), labels.alias("label"))))


def host_of(url: Column) -> Column:
    """From behind the first :// to the next /, ? or #, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; the rules are a short list of constants."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def char_ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of host (its ends marked) and path; digits count as 0. The last host label is left out."""
    name = F.regexp_replace(host, r"\.[^.]*$", "")
    text = F.regexp_replace(F.concat(F.lit("^"), name, F.lit("$"), path), "[0-9]+", "0")

    def grams(chars: Column, n: int) -> Column:
        """Each character put together with those behind it; the work is linear in the length of the name."""
        whole = F.transform(chars, lambda c, i: F.concat(c, *[F.get(chars, i + j) for j in range(1, n)]))
        return F.when(F.size(chars) < n, F.array(text)).otherwise(F.slice(whole, F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(0))))

    characters = F.array_remove(F.split(text, ""), "")
    return let(characters, lambda chars: F.concat(*[grams(chars, n) for n in sizes]))


def featured(urls: DataFrame, features: int) -> DataFrame:
    grams = urls.withColumn("__grams", char_ngrams(host_of(F.col("url")), path_of(F.col("url"))))
    return HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__features").transform(grams)


def fit_urls(labelled: DataFrame, features: int = FEATURES) -> LogisticRegressionModel:
    """Logistic regression on a small table (url, label: 1 unwanted); one partition, so that reruns agree."""
    rows = featured(labelled.select("url", F.col("label").cast("double").alias("label")).dropna(), features).coalesce(1)
    learner = LogisticRegression(featuresCol="__features", labelCol="label", regParam=0.001, maxIter=50, standardization=False)
    return learner.fit(rows)


def judge_urls(urls: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """urls(url, ...): append host, path, rule, verdict and score (the probability of being unwanted).

    A rule's verdict goes before the model's. A null url, or one without ://, has an empty host and path; no
    rule fits it and the model judges the empty name. A very long url is read whole, in linear time. Repeated rows get equal results; input columns with
    the names of the results are replaced.
    """
    names = ["host", "path", "rule", "verdict", "score"]
    model = fit_urls(labelled)
    model = model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__probability")
    rows = model.transform(featured(urls.drop(*names), FEATURES))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    score = F.get(vector_to_array("__probability"), F.lit(1))
    return rows.withColumns({
        "rule": F.col("__rule.rule"), "score": score,
        "verdict": F.coalesce("__rule.verdict", F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))),
    }).drop("__grams", "__features", "__probability", "__rule")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_urls(spark)).select("page_id", "host", "path", "rule", "verdict", "score")
