"""Configuration-registry operators.

Per-key choices are aggregates (``max_by`` with a total order), not windows:
they combine map-side, so a key holding a third of all rows costs one partial
row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iban_priority(ibans: DataFrame, institutions: DataFrame, preferred_attr: str = "0201138TS") -> DataFrame:
    """Per institution, the IBAN carrying ``preferred_attr`` if any, else the
    newest IBAN (by insertion date, then id). Among several preferred IBANs the
    newest wins (the source keeps an unordered last row)."""
    order = F.struct("inserted_date", "iban_id")
    pick = F.struct("iban", "attribute_name")
    per_pa = ibans.groupBy("fk_pa").agg(
        F.max_by(pick, order).alias("_newest"),
        F.max_by(pick, F.when(F.col("attribute_name") == preferred_attr, order)).alias("_preferred"),
    )
    joined = institutions.join(per_pa, institutions.pa_key == per_pa.fk_pa, "left")
    return joined.select(
        "row_key", "company_name",
        F.coalesce(F.col("_preferred.iban"), F.col("_newest.iban")).alias("iban"),
        F.coalesce(F.col("_preferred.attribute_name"), F.col("_newest.attribute_name")).alias("label"),
    )


def usable(col: Column, sentinels: Sequence[str] = ("",)) -> Column:
    """The value, or null when it is null or one of the sentinel values."""
    return F.when(col.isNull() | col.isin(list(sentinels)), F.lit(None).cast("string")).otherwise(col)


def fallback(candidates: Sequence[Column], sentinels: Sequence[str] = ("",)) -> Column:
    """C17: first candidate that is neither null nor a sentinel, else ''."""
    return F.coalesce(*[usable(c, sentinels) for c in candidates], F.lit(""))


def entity_merge(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """Keyed upsert in MERGE mode: matched rows take the update's non-null
    values and keep the rest; unmatched rows on either side are kept. Updates
    of one key are one entity, as if written one after the other: of each column the last
    non-null value by ``order_col`` stays, without it the largest."""
    cols = [c for c in target.columns if c not in keys]
    last = lambda c: F.max(c) if order_col is None else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col)))
    given = [last(c).alias(c) for c in cols if c in updates.columns]
    updates = updates.groupBy(*keys).agg(*given) if given else updates.select(*keys).distinct()
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols])
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols if c in updates.columns])
    merged = t.join(u, list(keys), "full_outer")
    out = []
    for c in cols:
        if c in updates.columns:
            out.append(F.coalesce(F.col(f"_u_{c}"), F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return merged.select(*keys, *out)
