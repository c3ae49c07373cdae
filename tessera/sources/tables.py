"""Catalog/parquet table scans and the JDBC source (A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import configure


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: a driver table (``<sf_dir>/<name>.parquet``) or, when ``sf_dir`` is
    empty, a catalog table; only ``cols`` are read (column pruning reaches the
    parquet scan's ReadSchema)."""
    configure(spark)
    if not sf_dir:
        df = spark.table(name)
        return df.select(*cols) if cols else df
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def read_jdbc(spark: SparkSession, url: str, query: str, part_col: str, lo: int, hi: int, n: int,
              props: dict[str, str] | None = None) -> DataFrame:
    """A4: a relational query read in ``n`` parallel ranges of ``part_col``.

    The query goes in as a derived table, since Spark takes no ``query`` option
    together with a partition column. No database is started in this
    repository, so this has not been run; the parquet stand-ins replace the
    source tables in every registered query."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
              .option("partitionColumn", part_col).option("lowerBound", lo).option("upperBound", hi)
              .option("numPartitions", n))
    for k, v in (props or {}).items():
        reader = reader.option(k, v)
    return reader.load()
