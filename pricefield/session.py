"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "pricefield", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="pricefield-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; an own one only in local mode, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or _own_folder()


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table of its own in the shared folder; the files go when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
