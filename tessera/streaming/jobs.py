"""Incremental jobs as Structured Streaming queries.

Every job reads a folder that keeps receiving files, runs with
``trigger(availableNow=True)`` (process what is there, then stop), and keeps
offsets, state and results under paths that the caller names, on storage that
all executors share. The next run of a job with the same paths goes on where
the last one ended: files already read are not read again, open windows are
still open, the watermark stands where it stood. Sinks are idempotent per
micro-batch: batch ``N`` writes its own ``batch_id=N`` folder with overwrite,
so a batch replayed after a failure replaces its output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cdc import cdc_json, to_cdc
from ..operators.windows import latest_per_key
from ..session import configure, materialise

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

STORE_SCHEMA = "blob_key string, batch_id int, day string"


def event_stream(spark: SparkSession, source: str, max_files: int = 64) -> DataFrame:
    """The event files of a folder as a stream; ``max_files`` bounds a batch."""
    configure(spark)
    raw = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source)
    # watermarks need a zoned timestamp; the session zone is UTC
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    q = (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def six_hour_counts(spark: SparkSession, source: str, out: str, checkpoint: str, late: str = "1 day") -> DataFrame:
    """Events per (6-hour window, type). Events whose window ended ``late``
    or more before the newest event of earlier runs are dropped by the
    watermark, which also frees the state. Update-mode batches are folded to
    the last value per window."""
    ev = event_stream(spark, source).withWatermark("ts", late)
    counts = ev.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    _run(counts, _batch_sink(out), checkpoint, "update")
    rows = spark.read.parquet(out).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                                          "event_type", "n", "batch_id")
    return latest_per_key(rows, ["window_start", "event_type"], "batch_id").drop("batch_id")


def ledgered_daily_load(spark: SparkSession, source: str, history: str, ledger: str, checkpoint: str,
                        late: str = "2 days") -> DataFrame:
    """Daily totals per type, each day loaded once. ``history`` (day,
    event_type, total) and ``ledger`` (day) are stored tables of batches that
    earlier loads have begun (``batch_id=-1``) and every run extends.

    Days in the ledger are skipped. A day is complete when the watermark
    passes its end: its totals are written to the history first and its entry
    to the ledger after, so a run that fails between the two is repeated by
    the replayed batch. State holds the open days only. Returns the history."""
    done = spark.read.parquet(ledger).select(F.col("day").alias("_done")).distinct()
    ev = event_stream(spark, source).withWatermark("ts", late)
    fresh = ev.join(done, F.to_date("ts") == F.col("_done"), "left_anti")
    totals = fresh.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("total"))
    totals = totals.select(F.to_date("w.start").alias("day"), "event_type", "total")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
        written = spark.read.parquet(f"{history}/batch_id={batch_id}")
        written.select("day").distinct().write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")

    _run(totals, write, checkpoint)
    return spark.read.parquet(history).drop("batch_id")


def save_once_stream(spark: SparkSession, source: str, store: str, checkpoint: str) -> DataFrame:
    """I4: keys stored once. Every batch is reduced to its distinct keys and
    anti-joined with those stored by other batches (``batch_id=-1``: by earlier
    loads), so a duplicate is not stored twice however late it comes. A key
    holds its day and the store is laid out by day (``batch_id=N/day=D``), so a
    batch reads the days it brings, not the store. Returns the keys that the
    stream has stored."""
    day = F.date_format("ts", "yyyy-MM-dd")
    keyed = event_stream(spark, source).select(
        F.concat_ws("##", day, F.col("user_id").cast("string"), "event_type").alias("blob_key"), day.alias("day"))

    def stored() -> DataFrame:
        return spark.read.schema(STORE_SCHEMA).parquet(store)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = materialise(batch.distinct(), "save-once-batch")
        days = [r.day for r in fresh.select("day").distinct().collect()]  # one value per day of the batch
        others = stored().where((F.col("batch_id") != batch_id) & F.col("day").isin(days)).select("blob_key")
        new = fresh.join(others, "blob_key", "left_anti")
        new.repartition("day", F.pmod(F.xxhash64("blob_key"), F.lit(32))).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(
            f"{store}/batch_id={batch_id}")

    _run(keyed, write, checkpoint)
    return stored().where(F.col("batch_id") >= 0).select("blob_key")


def cdc_stream(spark: SparkSession, source: str, schema: str, cols: Sequence[str], now_us: int, sink: str,
               checkpoint: str) -> DataFrame:
    """Rows of a folder replayed as CDC create events into JSON files."""
    rows = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{sink}/batch_id={batch_id}")

    _run(cdc_json(to_cdc(rows, cols, now_us=now_us)), write, checkpoint)
    return spark.read.schema("key string, value string").json(sink).select("key", "value")
