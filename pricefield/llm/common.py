"""Helpers of the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space between words, as a Java pattern.
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; a plain repeated column would be computed at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text (runs without ASCII white space); none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    `lower` does that too where it leaves the characters beyond ASCII alone.
    """
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(rest == F.lower(rest), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fraction(bits: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))


def join_key(value: Column) -> Column:
    """A text key that is never null, so that plain equality also joins the nulls."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the cluster's shared folder and read it back.

    Cuts the lineage and computes the table once. The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
