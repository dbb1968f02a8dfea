"""File scans and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.profile import rank_results
from ..session import shared_folder
from .adapters import ADAPTERS
from .layouts import read_csv_by_header
from .schemas import RESULTS


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the schema's types; a text that is none of its type is NULL."""
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of the schema by the names in each file's header, whatever their order there."""
    return typed(read_csv_by_header(spark, path, schema.names), schema)


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As read_csv, of a file that may not be there (an empty frame).

    Short rows are padded with NULL, rows with more cells than the header dropped; the encoding (UTF-8, UTF-16,
    else Latin-1) and the delimiter are found for each file.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema)


def load_sources(spark: SparkSession, found: Sequence[tuple[str, str]]) -> list[DataFrame]:
    """(adapter name, path) pairs to unified frames; each adapter looks its columns up by name, absent paths are skipped."""
    return [
        ADAPTERS[name](read_csv_by_header(spark, path))
        for name, path in found
        if path_exists(spark, path)
    ]


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).csv(path, header=True)


def read_results(spark: SparkSession, path_glob: str, schema: T.StructType = RESULTS) -> DataFrame:
    """Results of files with one object over several lines, with an array of objects, or with an object per line.

    A whole result file is one small text; lines that start an object after a closed one begin a new element.
    """
    whole = spark.read.text(path_glob, wholetext=True).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"))
    listed = F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(
        F.concat(F.lit("["), F.regexp_replace("value", r"\}\s*\n\s*\{", "},{"), F.lit("]")))
    return whole.where("value <> ''").select(F.inline(F.from_json(listed, T.ArrayType(schema))))


def write_results(df: DataFrame, path: str) -> None:
    """One flat JSON object per model."""
    df.write.mode("overwrite").json(path)


def append_results(spark: SparkSession, old_path: str, new_rows: DataFrame, new_path: str) -> DataFrame:
    """Read the results table, add rows, sort by r2, write under another path."""
    if old_path == new_path:
        raise ValueError("write the new results to another path than the old ones")
    old = spark.read.schema(RESULTS).csv(old_path, header=True)
    out = rank_results(old, new_rows)
    write_csv(out, new_path)
    return out


def _entry(number: int) -> str:
    return f"{number:010d}"


def result_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published versions of a results table, in rising order."""
    listing = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    fs = listing.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(listing):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(listing)]
    return sorted(int(name) for name in names if name.isdigit())


def read_published(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of one version of a results table, by default of the last one.

    A version's files never change, so a reader keeps its rows whatever is published later.
    """
    known = result_versions(spark, folder)
    wanted = version if version is not None else (known[-1] if known else None)
    if wanted not in known:
        raise ValueError(f"no version {version or ''} of results in {folder}; known: {known}")
    place = spark.read.text(f"{folder}/manifest/{_entry(wanted)}").first()["value"]
    return spark.read.parquet(f"{folder}/data/{place}")


def publish_results(spark: SparkSession, folder: str, rows: DataFrame, after: int) -> int:
    """Write rows as version after + 1; FileExistsError if another writer published that version first.

    The rows go to files of their own. The version exists from the moment its manifest entry, written aside, is
    renamed to its number; the rename never replaces an entry. A writer that fails before leaves no version.
    """
    from py4j.protocol import Py4JJavaError

    name, number = uuid.uuid4().hex, after + 1
    rows.write.parquet(f"{folder}/data/{name}")
    hadoop, settings = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    aside, entry = hadoop.Path(f"{folder}/manifest/.{name}"), hadoop.Path(f"{folder}/manifest/{_entry(number)}")
    out = aside.getFileSystem(settings).create(aside, False)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    keep = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(aside.getFileSystem(settings).getUri(), settings).rename(aside, entry, keep)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        raise FileExistsError(f"version {number} of {folder} was published by another writer") from None
    return number


def append_published(spark: SparkSession, folder: str, new_rows: DataFrame, attempts: int = 5) -> int:
    """Add rows to the last version, rank by r2 and publish; starts anew when another writer was faster."""
    for _ in range(attempts):
        known = result_versions(spark, folder)
        last = known[-1] if known else 0
        rows = rank_results(read_published(spark, folder, last), new_rows) if known else new_rows.orderBy(F.desc("r2"), "model")
        try:
            return publish_results(spark, folder, rows, last)
        except FileExistsError:
            continue
    raise FileExistsError(f"{folder}: other writers were faster {attempts} times")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to a new table in the shared folder and read it back: a cut of a long lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
