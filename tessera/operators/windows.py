"""Window, top-k and keep-last operators.

Ties are always broken by an explicit total order so results are
deterministic. Per-group top-k uses ``row_number() <= k``, which Spark plans
as a ``WindowGroupLimit`` before the shuffle (partial) and after it (final):
each map task ships at most k rows per group, so a hot group costs no more
than a cold one. Keep-last uses ``max_by`` aggregation, which is map-side
combinable, instead of a full window sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The row with the greatest ``order_col`` per key (rows tied on it:
    the greatest full row, so the choice is deterministic)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(F.col(order_col), *[F.col(c) for c in rest]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group by ``order`` (which must end in a unique tie-breaker)."""
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    if rank_col:
        return ranked.withColumnRenamed("_rn", rank_col)
    return ranked.drop("_rn")


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """global top-N (planned as ``TakeOrderedAndProject``: per-task top-N, one merge)."""
    return df.orderBy(*_cols(order)).limit(n)


def keep_last(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Last row per key by ``order_col`` ("last write wins")."""
    return latest_per_key(df, keys, order_col)


def first_example(df: DataFrame, group: Sequence[str], order_col: str, cols: Sequence[str]) -> DataFrame:
    """E5: one example row per group: the one with the smallest ``order_col``."""
    ex = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col))
    return df.groupBy(*group).agg(ex.alias("_ex")).select(*group, *[F.col(f"_ex.{c}").alias(c) for c in cols])
