"""Streaming jobs over the events table, with their batch twins as oracles.

Every query delivers the events in two sets of files and runs its job once
after each, with the same paths: the second run resumes the first. The second
set also brings events of the first set's days that come late.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.fixtures import fixture, with_fixtures
from ..sources.tables import read_table
from ..streaming import jobs

LOADED_BEFORE = "2024-01-08"
SECOND_SET = "2024-01-16 00:00:00"
EMIT_US = 1_704_067_200_000_000
_LATE = "event_id % 50 = 0"


def _twice(events, job):
    """``job`` after each of two deliveries of ``events`` into one folder."""
    spark = events.sparkSession
    source = scratch_dir(spark, "event-files")
    first = (F.col("ts") < F.lit(SECOND_SET).cast("timestamp_ntz")) & ~F.expr(_LATE)
    events.where(first).write.mode("append").parquet(source)
    job(source)
    events.where(~first).write.mode("append").parquet(source)
    return job(source)


def _all_events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])


def _loaded(spark, sf_dir):
    """Events of the days that an earlier load has stored."""
    ev = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type"]).withColumn("day", F.to_date("ts"))
    return ev.where(F.col("day") < F.lit(LOADED_BEFORE).cast("date"))


def q_stream_six_hour(spark, sf_dir):
    out, ckpt = scratch_dir(spark, "six-hour"), scratch_dir(spark, "six-hour-ckpt")
    return _twice(_all_events(spark, sf_dir), lambda source: jobs.six_hour_counts(spark, source, out, ckpt))


def q_stream_ledger(spark, sf_dir):
    """Days before LOADED_BEFORE were loaded by an earlier run (history + ledger)."""
    history, ledger, ckpt = (scratch_dir(spark, f"ledger-{x}") for x in ("history", "days", "ckpt"))
    done = _loaded(spark, sf_dir).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("total"))
    done.write.parquet(f"{history}/batch_id=-1")
    done.select("day").distinct().write.parquet(f"{ledger}/batch_id=-1")
    out = _twice(_all_events(spark, sf_dir), lambda source: jobs.ledgered_daily_load(spark, source, history, ledger, ckpt))
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "total")


def q_stream_save_once(spark, sf_dir):
    """Keys of days before LOADED_BEFORE are already in the store."""
    store, ckpt = scratch_dir(spark, "store"), scratch_dir(spark, "store-ckpt")
    _loaded(spark, sf_dir).select(F.concat_ws("##", F.date_format("day", "yyyy-MM-dd"), F.col("user_id").cast("string"),
                                              "event_type").alias("blob_key"), F.date_format("day", "yyyy-MM-dd").alias("day")).distinct().write.partitionBy(
        "day").parquet(f"{store}/batch_id=-1")
    return _twice(_all_events(spark, sf_dir), lambda source: jobs.save_once_stream(spark, source, store, ckpt))


def q_stream_cdc(spark, sf_dir):
    source, sink, ckpt = (scratch_dir(spark, f"cdc-{x}") for x in ("source", "events", "ckpt"))
    rows = fixture(spark, sf_dir, "payment_position").select("id", "iupd", "status", "inserted_date")
    for part in (F.col("id") % 2 == 0, F.col("id") % 2 != 0):
        rows.where(part).write.mode("append").parquet(source)
        events = jobs.cdc_stream(spark, source, "id bigint, iupd string, status string, inserted_date bigint",
                                 ["id", "iupd", "status", "inserted_date"], EMIT_US, sink, ckpt)
    env = F.from_json("value", "after struct<id: bigint, iupd: string, status: string, inserted_date: bigint>, "
                               "op string, ts_us bigint")
    return events.select("key", env.alias("e")).select(
        "key", "e.after.id", "e.after.iupd", "e.after.status", "e.after.inserted_date", "e.op", "e.ts_us")


QUERIES = {
    "stream_six_hour": q_stream_six_hour,
    "stream_ledger": q_stream_ledger,
    "stream_save_once": q_stream_save_once,
    "stream_cdc": q_stream_cdc,
}

# ---------------------------------------------------------------- DuckDB oracle
# Watermarks stand, in whole milliseconds, behind the newest event of the runs
# before; a late event counts while the end of its window is after the watermark.
_FIRST = f"(ts < TIMESTAMP '{SECOND_SET}' AND NOT {_LATE})"


def _mark(days, which="TRUE"):
    return f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL {days} DAY FROM events WHERE {which})"


_WINDOW = "make_timestamp(epoch_us(ts) // 21600000000 * 21600000000)"
_DAY = "cast(cast(ts AS DATE) AS TIMESTAMP)"

ORACLE = {
    "stream_six_hour": (
        f"SELECT strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events "
        f"WHERE {_FIRST} OR {_WINDOW} + INTERVAL 6 HOUR > {_mark(1, _FIRST)} GROUP BY 1, 2"),
    "stream_ledger": (
        f"SELECT strftime(cast(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS total FROM events "
        f"WHERE cast(ts AS DATE) < DATE '{LOADED_BEFORE}' OR ({_DAY} + INTERVAL 1 DAY <= {_mark(2)} AND "
        f"({_FIRST} OR {_DAY} + INTERVAL 1 DAY > {_mark(2, _FIRST)})) GROUP BY 1, 2"),
    "stream_save_once": (
        "SELECT DISTINCT concat_ws('##', strftime(cast(ts AS DATE), '%Y-%m-%d'), cast(user_id AS VARCHAR), event_type) "
        f"AS blob_key FROM events WHERE cast(ts AS DATE) >= DATE '{LOADED_BEFORE}'"),
    "stream_cdc": with_fixtures(
        f"SELECT cast(id AS VARCHAR) AS key, id, iupd, status, inserted_date, 'c' AS op, cast({EMIT_US} AS BIGINT) AS ts_us "
        "FROM payment_position", "payment_position"),
}
