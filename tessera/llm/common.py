"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialise, scratch_dir  # noqa: F401  used by all operators

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` begins with, for names beside its own."""
    p = "__"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    return p


def columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [df[f"`{c}`"] for c in df.columns]


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`materialise`, compressed harder, for packed counts and places; the job's shuffle files go when it ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(key, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def drop_scratch(table: DataFrame) -> None:
    """Remove what :func:`scratch_table` wrote, once no table still to be computed reads it."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
