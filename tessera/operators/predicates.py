"""Projections and filters.

All are lazy DataFrame → DataFrame functions whose predicates are plain
Catalyst expressions, so they reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import outcome


def unwrap_after(df: DataFrame, cols: Sequence[str], prefix: str = "", struct: str = "after") -> DataFrame:
    """B1: flatten ``after.<c>`` of a CDC image table into ``<prefix><c>``.

    Only the requested fields are selected, so nested-schema pruning reads just
    those leaves. No latest-image dedupe is done (the source does none).
    """
    return df.select(*[F.col(f"{struct}.{c}").alias(f"{prefix}{c}") for c in cols])


def kpi_guard(df: DataFrame, start: str | None = None, end: str | None = None,
              start_col: str = "period_start", end_col: str = "period_end") -> DataFrame:
    """B2: exact period match plus value guards (perc not null/NaN, counts not null)."""
    cond = (
        F.col("perc_kpi").isNotNull() & ~F.isnan("perc_kpi")
        & F.col("total_kpi_sample").isNotNull() & F.col("total_kpi_fault").isNotNull()
    )
    if start is not None:
        cond = cond & (F.col(start_col) == F.lit(start))
    if end is not None:
        cond = cond & (F.col(end_col) == F.lit(end))
    return df.where(cond)


def prefix_filter(df: DataFrame, col: str, prefix: str, negate: bool = False, escaped: bool = False) -> DataFrame:
    """``LIKE prefix%``. With ``escaped=False`` a ``_`` in the prefix is a
    wildcard (as written in the source); ``escaped=True`` matches it literally.
    ``NOT LIKE`` drops null values, as SQL does."""
    pattern = prefix.replace("_", "\\_") if escaped else prefix
    cond = F.col(col).like(pattern + "%")
    return df.where(~cond if negate else cond)


def in_list(df: DataFrame, col: str, values: Iterable, negate: bool = False) -> DataFrame:
    """IN-list filter."""
    cond = F.col(col).isin(list(values))
    return df.where(~cond if negate else cond)


def regex_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Regular-expression filter (RE2-compatible subset)."""
    return df.where(F.col(col).rlike(pattern))


def time_range(df: DataFrame, col: str, lo: str | None, hi: str | None, after: bool = False) -> DataFrame:
    """Half-open ``[lo, hi)`` on a timestamp column, ``(lo, hi)`` with
    ``after``; either bound optional."""
    cond = F.lit(True)
    if lo is not None:
        bound = F.to_timestamp(F.lit(lo))
        cond = cond & (F.col(col) > bound if after else F.col(col) >= bound)
    if hi is not None:
        cond = cond & (F.col(col) < F.to_timestamp(F.lit(hi)))
    return df.where(cond)


def epoch_micros(ts: str) -> int:
    """Epoch microseconds of a UTC timestamp literal (driver-side constant)."""
    parsed = dt.datetime.fromisoformat(ts)
    if parsed.tzinfo is None:
        parsed = parsed.replace(tzinfo=dt.timezone.utc)
    delta = parsed - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def epoch_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Closed ``BETWEEN`` on an epoch-µs column with UTC bounds."""
    return df.where(F.col(col).between(F.lit(epoch_micros(lo)), F.lit(epoch_micros(hi))))


def has_tag(df: DataFrame, col: str, tag: str) -> DataFrame:
    """Keep rows whose tag array contains ``tag``."""
    return df.where(F.array_contains(F.col(col), tag))


def clean_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim key columns; drop rows whose key is null, blank or the text 'nan'."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.trim(F.col(c).cast("string")))
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != "") & (F.lower(F.col(c)) != "nan")
    return out.where(cond)


def previous_month(today: dt.date) -> tuple[str, str]:
    """``[first of previous month, first of this month)`` as period strings."""
    first_this = today.replace(day=1)
    first_prev = (first_this - dt.timedelta(days=1)).replace(day=1)
    return f"{first_prev.isoformat()}T00:00:00Z", f"{first_this.isoformat()}T00:00:00Z"


def day_range(start: str | None, end: str | None, today: dt.date) -> tuple[dt.date, dt.date] | None:
    """Day window ``[start, end + 1 day)``. ``'yesterday'``, a missing or
    malformed date → yesterday; ``'all'`` → no window (None)."""
    if start == "all" or end == "all":
        return None
    yesterday = today - dt.timedelta(days=1)

    def parse(text: str | None) -> dt.date:
        if not text or text == "yesterday":
            return yesterday
        try:
            return dt.date.fromisoformat(text)
        except ValueError:
            return yesterday

    return parse(start), parse(end) + dt.timedelta(days=1)


def with_outcome(df: DataFrame, perc: str = "perc_kpi", threshold: str = "kpi_threshold",
                 name: str = "kpi_outcome") -> DataFrame:
    """Add the OK/KO outcome column."""
    return df.withColumn(name, outcome(perc, threshold))


def conform(df: DataFrame, schema: Sequence[tuple[str, str]], consts: dict[str, Column] | None = None) -> DataFrame:
    """Cast + alias to a fixed output schema, append constant columns, fixed order."""
    cols = [F.col(name).cast(dtype).alias(name) for name, dtype in schema]
    cols += [value.alias(name) for name, value in (consts or {}).items()]
    return df.select(*cols)


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Deterministic ``LIMIT n`` (ordered first); ``n <= 0`` means no limit."""
    if n <= 0:
        return df
    return df.orderBy(*order).limit(n)


def drop_sentinel(df: DataFrame, col: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows without the sentinel value, and a one-row count of removed rows."""
    kept = df.where(F.col(col).isNull() | (F.col(col) != value))
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(col) == value).alias("rows_removed"),
    )
    return kept, counts


def nested_export(df: DataFrame, fields: dict[str, str], pred: Column | None = None) -> DataFrame:
    """A5: filter on (nested) fields and flatten the chosen leaves to named
    columns; only those leaves are read (nested schema pruning)."""
    out = df.where(pred) if pred is not None else df
    return out.select(*[F.col(path).alias(name) for name, path in fields.items()])
