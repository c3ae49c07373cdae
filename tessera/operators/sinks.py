"""Table sinks.

``MERGE INTO`` needs a catalog format that supports row-level updates; the
portable upsert here builds the new table version as a DataFrame
(``target ⋈̸ updates ∪ latest updates``), writes it to a fresh versioned
folder and only then points readers at it — a path being read is never
overwritten, and a failed write leaves the previous version intact. Each
step is a whole-table shuffle job that scales with the table and survives
executor loss (tasks are recomputed from the last completed stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialise, scratch_dir
from .windows import latest_per_key

def _described(spark: SparkSession, table: str, what: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == what).first()["data_type"]


def _provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Provider").lower()


def create_or_merge(df: DataFrame, table: str, keys: Sequence[str], order_col: str, fmt: str = "parquet",
                    location: str | None = None) -> str:
    """Create ``table`` from ``df`` if it does not exist, else merge ``df``
    into it by ``keys`` (:func:`upsert`: a new version of the table is written
    and the table then points to it). A table of another format is refused. A
    concurrent creator turns the create into a merge. If another load has
    pointed the table elsewhere while the new version was written, the merge
    is done again on that version, so neither load is lost; only the moment
    between this look and the swap is unguarded, as a catalog without row-level
    commits has no compare-and-set. Returns "created" or "merged"."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        try:
            df.writeTo(table).using(fmt).option("path", location or scratch_dir(spark, "table")).create()
            return "created"
        except AnalysisException as e:  # raced with another creator
            if "TABLE_OR_VIEW_ALREADY_EXISTS" not in str(e):
                raise
    if _provider(spark, table) != fmt.lower():
        raise ValueError(f"{table} is stored as {_provider(spark, table)}, not as {fmt}")
    new_path, read = None, None
    while new_path is None or _described(spark, table, "Location") != read:
        new_path, read = scratch_dir(spark, "table-version"), _described(spark, table, "Location")
        spark.catalog.refreshTable(table)
        upsert_frame(spark.table(table), df, keys, order_col).write.format(fmt).save(new_path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new_path}'")
    spark.catalog.refreshTable(table)
    return "merged"


def create_or_append(df: DataFrame, table: str, fmt: str = "parquet", location: str | None = None) -> str:
    """Create ``table`` from ``df`` if it does not exist, else append.
    A concurrent creator (TABLE_OR_VIEW_ALREADY_EXISTS) turns the create into
    an append. Returns "created" or "appended"."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.writeTo(table).using(fmt)
        if location:
            writer = writer.option("path", location)
        try:
            writer.create()
            return "created"
        except AnalysisException as e:  # raced with another creator
            if "TABLE_OR_VIEW_ALREADY_EXISTS" not in str(e):
                raise
    df.writeTo(table).append()
    return "appended"


def stage_append(df: DataFrame, path: str, null_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Append rows to a staging table, adding the given columns as nulls."""
    out = df
    for c in null_cols:
        out = out.withColumn(c, F.lit(None).cast("string"))
    out.write.mode("append").format(fmt).save(path)


def upsert_frame(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """A8 (plan): latest update per key replaces the target row; other target
    rows are kept; new keys are inserted."""
    latest = latest_per_key(updates, keys, order_col).select(*target.columns)
    kept = target.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest)


def upsert(spark: SparkSession, target_path: str, updates: DataFrame, keys: Sequence[str], order_col: str,
           fmt: str = "parquet") -> str:
    """Write the upserted table as a new version next to the old one and
    return the new version's path (the caller publishes it, e.g. by updating
    the table location). The old version is only read."""
    target = spark.read.format(fmt).load(target_path)
    new_path = scratch_dir(spark, "upsert-version")
    upsert_frame(target, updates, keys, order_col).write.mode("errorifexists").format(fmt).save(new_path)
    return new_path


def upsert_partitions(path: str, updates: DataFrame, keys: Sequence[str], order_col: str,
                      part: Column, part_col: str = "part") -> DataFrame:
    """A8 on a partitioned table: only the partitions that hold updates are
    read and rewritten; files of the others are not touched.

    ``part`` is a function of the ``keys`` alone (a key, its month, or a hash
    bucket of the keys), so a key never changes its partition; it is stored as
    the text column ``part_col``. A path without data is created. The affected
    partitions are written beside the table first and then put in place by a
    dynamic partition overwrite, so a failed or repeated load can be run
    again. One load at a time may write a partition. Returns the table."""
    spark = updates.sparkSession
    schema = StructType([*updates.schema.fields, StructField(part_col, StringType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    latest = materialise(latest_per_key(updates, keys, order_col).select(*updates.columns).withColumn(
        part_col, F.coalesce(part.cast("string"), F.lit("none"))), "upsert-latest")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        held = [r[0] for r in latest.select(part_col).distinct().collect()]  # one value per partition
        target = spark.read.schema(schema).parquet(path).where(F.col(part_col).isin(held))
        kept = target.join(latest.select(*keys), list(keys), "left_anti")
        latest = materialise(kept.unionByName(latest), "upsert-partitions")
    # AQE splits large partitions into files of its advisory size and leaves one file in small ones
    (latest.hint("rebalance", part_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path))
    return spark.read.schema(schema).parquet(path)


def emit_events(events: DataFrame, path: str | None = None, servers: str | None = None,
                topic: str | None = None, batch: str | None = None) -> None:
    """(key, value) JSON events to a Kafka topic when a broker and the
    connector are configured, else to JSON files under ``path``. A ``topic``
    column routes every event to its own topic (a sub-folder of ``path``). Files
    are gzipped, as the names of the fields are most of an event. Executors write their partitions in parallel; nothing passes through the
    driver. Files of a ``batch`` go to a folder of its own, which a repeated
    batch replaces, so nothing is sent twice; a broker gets every repeat."""
    mode = "append"
    if path is not None and batch is not None:
        path, mode = f"{path}/batch={batch}", "overwrite"
    if "topic" in events.columns:
        if servers:
            events.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        elif path is None:
            raise ValueError("either a broker or a path is required")
        else:
            events.select("topic", "key", "value").write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("topic").json(path, compression="gzip")
        return
    if servers and topic:
        (events.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
        return
    if path is None:
        raise ValueError("either a broker and topic or a path is required")
    events.select("key", "value").write.mode(mode).json(path, compression="gzip")


def build_chunk_table(chunks: DataFrame, path: str) -> DataFrame:
    """Vector collection (id, embedding, document, source, start_index),
    one row and one vector per chunk, written as parquet and read back."""
    table = chunks.select(F.col("chunk_id").alias("id"), "embedding", F.col("chunk").alias("document"), "source", "start_index")
    table.write.mode("errorifexists").parquet(path)
    return table.sparkSession.read.parquet(path)


def metrics_json(df: DataFrame, title: str | None = None) -> DataFrame:
    """One metrics row rendered as one JSON document (optionally titled)."""
    doc = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    if title is not None:
        doc = F.to_json(F.struct(F.lit(title).alias("title"), F.from_json(doc, df.schema).alias("metrics")))
    return df.select(doc.alias("report"))
