"""CSV files read by their headers: encoding and delimiter found per file, files grouped by layout, columns by name."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import header_name

#: Delimiters that are tried; of the equally frequent ones the first wins.
DELIMITERS = ",;\t|"
_OVERFLOW = "_overflow"


def csv_heads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, head, utf8) per file: the bytes of its first line with content, and whether all its lines are UTF-8.

    One pass over lines, without parsing; a file's first line comes from the task that reads its first block.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    head = F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("value").cast("binary"))
    return lines.groupBy("path").agg(
        F.first(head, ignorenulls=True).alias("head"), F.bool_and(F.call_function("is_valid_utf8", F.col("value"))).alias("utf8"))


def header_of(head: bytes, utf8: bool) -> tuple[str, str, list[str]]:
    """Encoding (UTF-16 by its mark, UTF-8, else Latin-1), delimiter and cells of a first line."""
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        encoding, text = "UTF-16", head[: len(head) // 2 * 2].decode("utf-16", "replace")
    else:
        encoding = "UTF-8" if utf8 else "ISO-8859-1"
        text = head.decode(encoding).removeprefix("\ufeff")
    bare = "".join(text.split('"')[::2])
    delimiter = max(DELIMITERS, key=bare.count)
    return encoding, delimiter, next(csv.reader([text.strip("\r\n")], delimiter=delimiter))


def read_layout(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str, header: Sequence[str]) -> DataFrame:
    """Files of one layout, all cells as text; short rows are padded with NULL, rows with more cells than the header dropped."""
    names = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _OVERFLOW]])
    rows = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, mode="PERMISSIVE", sep=delimiter, encoding=encoding, multiLine=encoding == "UTF-16")
        .csv(list(paths))
    )
    return rows.where(F.col(_OVERFLOW).isNull()).drop(_OVERFLOW)


def read_csv_by_header(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All files as one table of texts, its columns found by name and not by place.

    Names are compared as `header_name` writes them (trimmed, lower case, blanks as _). Without `columns` the
    result has every name of any file, in order of name; a file without a column has NULL there. With `columns`
    it has these, written as they are given. Of equal names in a header the first counts. Files with the same
    first line and encoding are read in one scan; a first line per layout and the paths come to the driver.
    """
    found = csv_heads(spark, paths).where("head IS NOT NULL").groupBy("head", "utf8").agg(F.collect_list("path").alias("paths"))
    layouts = [(header_of(bytes(r["head"]), r["utf8"]), [unquote(p) for p in r["paths"]]) for r in found.collect()]
    layouts.sort()
    wanted = {header_name(c): c for c in columns} if columns is not None else {
        n: n for n in sorted({header_name(h) for (_, _, header), _ in layouts for h in header} - {""})}
    parts = []
    for (encoding, delimiter, header), files in layouts:
        place = {header_name(h): i for i, h in reversed(list(enumerate(header)))}
        rows = read_layout(spark, files, delimiter, encoding, header)
        parts.append(rows.select(*[
            (F.col(f"c{place[n]}") if n in place else F.lit(None).cast("string")).alias(shown) for n, shown in wanted.items()]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in wanted.values()]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
