"""Delimited text sources and sinks.

Delimited files are read with an explicit all-string schema (no inference).
Line numbers come from ``monotonically_increasing_id`` plus an offset table
with one row per input split, i.e. a DataFrame form of ``zipWithIndex`` per
file that never funnels rows through one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(cols: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_delimited(spark: SparkSession, path: str, sep: str = ";", cols: Sequence[str] | None = None,
                   header: bool = True) -> DataFrame:
    """A2: header CSV with separator ``sep``; every column is a string."""
    reader = spark.read.option("header", str(header).lower()).option("sep", sep).option("inferSchema", "false")
    if cols is not None:
        reader = reader.schema(string_schema(cols))
    return reader.csv(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of the text files under ``path``: 1-based line
    numbers in each file, however many splits it is read in."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))
    tagged = text.withColumn("_mid", F.monotonically_increasing_id())
    sizes = tagged.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + (F.col("_mid") - F.col("_first")) + 1
    return tagged.join(offsets, ["file", "_block"]).select("file", number.cast("bigint").alias("line_no"), "value")


def split_fields(value: Column, sep: str = ";") -> Column:
    """The fields of a line: separators between double quotes belong to their field,
    but for lines with a quote that is never closed; quotes and surrounding blanks go."""
    outside = rf'{re.escape(sep)}(?=(?:[^"]*+"[^"]*+")*+[^"]*+\z)'  # an even number of quotes follows
    plain = F.split(value, re.escape(sep), -1)
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"')))
    fields = F.when((quotes > 0) & (quotes % 2 == 0), F.split(value, outside, -1)).otherwise(plain)
    return F.transform(fields, lambda f: F.trim(F.replace(f, F.lit('"'))))


def load_registry(spark: SparkSession, path: str, column: str, pattern: str, sep: str = ";"
                  ) -> tuple[DataFrame, DataFrame]:
    """A3: registry codes from delimited text files, each with a header of its own.

    ``column`` is looked up in the header of each file, so files may order
    their columns differently; a file without it is an error. Quoted fields
    may hold the separator. Header and values are stripped of double quotes
    and surrounding blanks. Returns (distinct valid codes, rejects(file,
    line_no, value, reason)); line numbers count a file's header as line 1. A
    row too short to hold the column is rejected as "missing column", a value
    not matching ``pattern`` as "invalid format".
    """
    lines = numbered_lines(spark, path)
    heads = lines.where(F.col("line_no") == 1).select("file", F.array_position(split_fields(F.col("value"), sep), column).alias("_at"))
    without = heads.where(F.col("_at") == 0).first()
    if without is not None or heads.isEmpty():
        raise ValueError(f"column {column!r} not in the header of {without.file if without else path}")
    rows = lines.where(F.col("line_no") > 1).join(heads, "file").withColumn("_f", split_fields(F.col("value"), sep))
    parsed = rows.select("file", "line_no", (F.size("_f") >= F.col("_at")).alias("_present"), F.get("_f", (F.col("_at") - 1).cast("int")).alias("code"))
    valid = parsed.where(F.col("_present") & F.col("code").rlike(pattern)).select("code").distinct()
    rejects = parsed.where(~F.col("_present") | ~F.col("code").rlike(pattern)).select(
        "file", "line_no",
        F.when(F.col("_present"), F.col("code")).otherwise(F.lit("N/D")).alias("value"),
        F.when(F.col("_present"), F.lit("invalid format")).otherwise(F.lit("missing column")).alias("reason"))
    return valid, rejects


def export_csv(df: DataFrame, path: str, sep: str = ";", single: bool = False, sort: Sequence[str] = ()) -> None:
    """A10: header CSV export, one file per range partition. ``single=True``,
    for a report of few rows, writes one file: the heavy upstream work keeps
    its parallelism and only the final rows are moved into one task
    (``repartition(1)``, not ``coalesce(1)``, which would pull the whole
    upstream stage into one task)."""
    out = df
    if single:
        out = out.repartition(1)
        if sort:
            out = out.sortWithinPartitions(*sort)
    elif sort:
        out = out.repartitionByRange(*sort).sortWithinPartitions(*sort)
    out.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)
