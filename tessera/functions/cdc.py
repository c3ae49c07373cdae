"""CDC envelopes: ``{after: {...}, op: 'c', ts_ms, ts_us, ts_ns}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def date_to_epoch_us(col: Column, is_text: bool, compat: bool = False) -> Column:
    """Date/timestamp (or ISO text) → epoch µs, UTC. Text years above 9999 are
    clamped to 9999; null stays null. Text that is no date, also a clamped
    29 February, which 9999 lacks, fails the job as it does the source.
    ``compat=True`` reproduces the source's doubled sub-second part (it adds
    the microseconds once more)."""
    if is_text:
        year = F.regexp_extract(col, r"^(\d+)-", 1)
        clamped = F.when(year.cast("int") > 9999, F.regexp_replace(col, r"^\d+", "9999")).otherwise(col)
        parsed = F.try_to_timestamp(F.regexp_replace(clamped, "T", " "))
        bad = F.raise_error(F.concat(F.lit("not a date: "), col)).cast("timestamp")
        ts = F.when(col.isNull() | parsed.isNotNull(), parsed).otherwise(bad)
    else:
        ts = col.cast("timestamp")
    micros = F.unix_micros(ts)
    if compat:
        micros = micros + F.pmod(micros, F.lit(1_000_000))
    return micros


def to_cdc(df: DataFrame, cols: Sequence[str], date_cols: Sequence[str] = (), now_us: int = 0,
           compat: bool = False) -> DataFrame:
    """Wrap rows into create-events. ``now_us`` is the (fixed) emission time."""
    types = dict(df.dtypes)
    fields = []
    for c in cols:
        if c in date_cols and types[c] not in ("bigint", "int"):
            fields.append(date_to_epoch_us(F.col(c), types[c] == StringType().simpleString(), compat).alias(c))
        else:
            fields.append(F.col(c))
    return df.select(
        F.struct(*fields).alias("after"),
        F.lit("c").alias("op"),
        F.lit(now_us // 1000).cast("bigint").alias("ts_ms"),
        F.lit(now_us).cast("bigint").alias("ts_us"),
        (F.lit(now_us).cast("bigint") * F.lit(1000)).alias("ts_ns"),
    )


def cdc_json(df: DataFrame, key_col: str = "after.id") -> DataFrame:
    """Envelope → (key, value JSON) rows, the shape every event sink takes."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
