"""From raw documents to a sharded training mix, in five stages of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefield.llm.common import settle, words
from pricefield.llm.decontamination import decontaminate
from pricefield.llm.jaccard import link_documents, one_of_each
from pricefield.llm.mixing import mix_counts
from pricefield.llm.quality import judge_quality, trusted_ids
from pricefield.llm.sharding import shard_rows, text_size


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    judged = judge_quality(packed(docs, "doc_id", "text"), trusted_ids(spark, sf_dir))
    return unpacked(judged.where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return one_of_each(docs, link_documents(docs, k=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    sized = packed(docs, "doc_id", "source").withColumn("size", F.size(words(F.col("__row.text"))).cast("long"))
    taken = mix_counts(sized).select("__row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return unpacked(taken)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes; appends shard and slot."""
    return shard_rows(docs, text_size(F.col("text")), F.col("text"), F.col("doc_id"))


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns beside the whole row, so that no other column can clash with an operator's own."""
    return docs.select(*needed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("__row.*")


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]
#: SQL has neither the hashes of the quality stage nor those of the sharding stage; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written to the shared folder and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
