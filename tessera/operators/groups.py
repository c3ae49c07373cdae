"""Provider-group mapping and KPI rollups.

Scale notes: the KPI source is the large side. It is pre-aggregated once per
(kpi, period, provider) with map-side partial aggregation before it meets the
group mapping, so a provider holding a third of all rows collapses to one row
per period inside each map task; sums and max are decomposable, so the
re-aggregation per group is exact. Groups go by a 64-bit id of their member
list; the list itself, which grows with the group, is attached to the finished
rows only, and never stands on a member's row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import member_array, outcome, percent_half_up
from ..session import materialise


def crm_members(crm: DataFrame, list_col: str = "provider_names") -> DataFrame:
    """Registry rows with a non-blank list, plus the trimmed non-empty member array."""
    return (
        crm.select(list_col, "contract_id")
        .where(F.col(list_col).isNotNull() & (F.trim(F.col(list_col)) != ""))
        .withColumn("members", member_array(list_col))
    )


def member_contract(crm: DataFrame) -> DataFrame:
    """Every listed provider → smallest contract id (groups of one included)."""
    return (
        crm_members(crm)
        .select("contract_id", F.explode("members").alias("psp_member"))
        .groupBy("psp_member")
        .agg(F.min("contract_id").alias("contract_id"))
    )


def provider_groups(crm: DataFrame, count_groups_of_one: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, groups), both written once.

    members (psp_member, contract_id, group_id): every listed provider with
    its smallest contract and the group with the smallest sorted member list
    among those it is in (null for none). groups (group_id, group_key,
    group_contract): the list and the smallest contract of each group.
    Duplicates inside one list are kept when sizing the group (``size > 1``)
    and when building the key, as the source does. Member lists are compared
    only for providers that are in several groups.
    """
    key = F.array_join(F.array_sort("members"), ",")
    is_group = F.size("members") > (0 if count_groups_of_one else 1)
    lists = crm_members(crm).select("contract_id", "members", key.alias("group_key"), F.when(is_group, F.xxhash64(key)).alias("group_id"))
    lists = materialise(lists, "provider-lists")
    groups = lists.where(F.col("group_id").isNotNull()).groupBy("group_id").agg(
        F.min("group_key").alias("group_key"), F.min("contract_id").alias("group_contract"))
    groups = materialise(groups, "provider-groups")
    listed = lists.select("contract_id", "group_id", F.explode("members").alias("psp_member"))
    contracts = listed.groupBy("psp_member").agg(F.min("contract_id").alias("contract_id"), F.min("group_id").alias("one"),
                                                 F.max("group_id").alias("other"))
    shared = contracts.where("one <> other").select(F.col("psp_member").alias("_m"))
    several = listed.where(F.col("group_id").isNotNull()).join(shared, F.col("psp_member") == F.col("_m"), "left_semi")
    first = several.join(groups, "group_id").groupBy("psp_member").agg(F.min_by("group_id", "group_key").alias("first"))
    members = contracts.join(first, "psp_member", "left").select(
        "psp_member", "contract_id", F.coalesce("first", "one").alias("group_id"))
    return materialise(members, "provider-members"), groups


def group_mapping(crm: DataFrame, count_groups_of_one: bool = False) -> DataFrame:
    """Provider → canonical group key and that group's smallest contract."""
    members, groups = provider_groups(crm, count_groups_of_one)
    return members.select("psp_member", "group_id").join(groups, "group_id").select(
        "group_key", "psp_member", F.col("group_contract").alias("contract_id"))


_GOLD_SCHEMA = (
    ("kpi_id", "string"), ("psp_id", "string"), ("contract_id", "string"),
    ("kpi_threshold", "double"), ("perc_kpi", "double"), ("kpi_outcome", "string"),
    ("period_start", "string"), ("period_end", "string"),
)


def provider_totals(src: DataFrame, keys: Sequence[str] = ("kpi_id", "period_start", "period_end", "psp_id")) -> DataFrame:
    """Partial rollup per provider: sums of faults/samples, max threshold."""
    return src.groupBy(*keys).agg(
        F.sum(F.col("total_kpi_fault").cast("long")).alias("sum_fault"),
        F.sum(F.col("total_kpi_sample").cast("long")).alias("sum_sample"),
        F.max(F.col("kpi_threshold").cast("double")).alias("kpi_threshold"),
    )


def _finish(df: DataFrame) -> DataFrame:
    perc = percent_half_up("sum_fault", "sum_sample")
    return df.select(
        F.col("kpi_id").cast("string").alias("kpi_id"),
        F.col("psp_id").cast("string").alias("psp_id"),
        F.col("contract_id").cast("string").alias("contract_id"),
        F.col("kpi_threshold").cast("double").alias("kpi_threshold"),
        perc.alias("perc_kpi"),
        outcome(perc, F.col("kpi_threshold")).alias("kpi_outcome"),
        F.col("period_start").cast("string").alias("period_start"),
        F.col("period_end").cast("string").alias("period_end"),
    )


_ROLLED = (("sum_fault", F.sum), ("sum_sample", F.sum), ("kpi_threshold", F.max))


def _rollup(joined: DataFrame, groups: DataFrame) -> DataFrame:
    """Provider totals with group_id (null: a single) and the provider's contract
    → one row per group or single; the group's list joins the finished rows."""
    single = F.when(F.col("group_id").isNull(), F.col("psp_id"))
    own = F.when(F.col("group_id").isNull(), F.col("contract_id"))
    rolled = joined.groupBy("kpi_id", "period_start", "period_end", "group_id", single.alias("single"), own.alias("own")).agg(
        *[f(c).alias(c) for c, f in _ROLLED])
    named = rolled.join(groups, "group_id", "left").withColumns({
        "psp_id": F.coalesce("group_key", "single"), "contract_id": F.coalesce("group_contract", "own")})
    return _finish(named)


def _with_group(totals: DataFrame, members: DataFrame) -> DataFrame:
    return totals.join(members, totals.psp_id == members.psp_member, "left").drop("psp_member")


def kpi_grouped(totals: DataFrame, crm: DataFrame, count_groups_of_one: bool = False) -> DataFrame:
    """D1 (groups): providers in a group are rolled up under the group key."""
    members, groups = provider_groups(crm, count_groups_of_one)
    return _rollup(_with_group(totals, members).where(F.col("group_id").isNotNull()), groups)


def kpi_singles(totals: DataFrame, crm: DataFrame, count_groups_of_one: bool = False) -> DataFrame:
    """D1 (singles): providers in no group (C6), contract looked up (C5 left join)."""
    members, groups = provider_groups(crm, count_groups_of_one)
    return _rollup(_with_group(totals, members).where(F.col("group_id").isNull()), groups)


def kpi_gold(src: DataFrame, crm: DataFrame, batch_ts_ms: int, count_groups_of_one: bool = False) -> DataFrame:
    """G1: groups ∪ singles with the batch timestamp, in the gold schema: one
    left join and one aggregation, by group id or by the single provider."""
    members, groups = provider_groups(crm, count_groups_of_one)
    gold = _rollup(_with_group(provider_totals(src), members), groups)
    return gold.withColumn("_ts", F.lit(batch_ts_ms).cast("bigint"))
