"""Provider KPI gold job: guard → group mapping → rollups → union."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import normalise_list, outcome
from ..operators import groups, predicates, windows
from ..sources.fixtures import fixture, with_fixtures

# Fixed batch timestamp (1996-01-01T00:00:00Z in ms) so reruns are comparable.
BATCH_TS_MS = 820_454_400_000
GUARD_PERIOD = ("1995-03-01T00:00:00Z", "1995-04-01T00:00:00Z")


def _src(spark, sf_dir):
    return predicates.kpi_guard(fixture(spark, sf_dir, "kpi_silver"))


def q_kpi_guard(spark, sf_dir):
    return predicates.kpi_guard(fixture(spark, sf_dir, "kpi_silver"), *GUARD_PERIOD)


def q_kpi_outcome(spark, sf_dir):
    silver = fixture(spark, sf_dir, "kpi_silver")
    return silver.select("kpi_id", "psp_id", "period_start", "perc_kpi", "kpi_threshold",
                         outcome("perc_kpi", "kpi_threshold").alias("kpi_outcome"))


def q_list_normalise(spark, sf_dir):
    crm = fixture(spark, sf_dir, "crm")
    members = groups.crm_members(crm)
    return members.select(
        "contract_id",
        normalise_list("provider_names").alias("group_key"),
        F.size("members").alias("n_members"),
    )


def q_group_mapping(spark, sf_dir):
    return groups.group_mapping(fixture(spark, sf_dir, "crm"))


def q_member_contract(spark, sf_dir):
    return groups.member_contract(fixture(spark, sf_dir, "crm"))


def q_kpi_grouped(spark, sf_dir):
    return groups.kpi_grouped(groups.provider_totals(_src(spark, sf_dir)), fixture(spark, sf_dir, "crm"))


def q_kpi_singles(spark, sf_dir):
    return groups.kpi_singles(groups.provider_totals(_src(spark, sf_dir)), fixture(spark, sf_dir, "crm"))


def q_kpi_gold(spark, sf_dir):
    return groups.kpi_gold(_src(spark, sf_dir), fixture(spark, sf_dir, "crm"), BATCH_TS_MS)


def q_latest_per_key(spark, sf_dir):
    """Latest gold row per (kpi, provider, period) across two loads."""
    src = _src(spark, sf_dir)
    crm = fixture(spark, sf_dir, "crm")
    first = groups.kpi_gold(src, crm, BATCH_TS_MS)
    second = groups.kpi_gold(src.where(F.col("kpi_id") != "N"), crm, BATCH_TS_MS + 1).withColumn(
        "kpi_outcome", F.lit("RERUN"))
    return windows.latest_per_key(first.unionByName(second),
                                  ["kpi_id", "psp_id", "period_start", "period_end"], "_ts")


QUERIES = {
    "kpi_guard": q_kpi_guard,
    "kpi_outcome": q_kpi_outcome,
    "list_normalise": q_list_normalise,
    "group_mapping": q_group_mapping,
    "member_contract": q_member_contract,
    "kpi_grouped": q_kpi_grouped,
    "kpi_singles": q_kpi_singles,
    "kpi_gold": q_kpi_gold,
    "latest_per_key": q_latest_per_key,
}

# ---------------------------------------------------------------- DuckDB oracle
_GUARD = ("perc_kpi IS NOT NULL AND NOT isnan(perc_kpi) AND total_kpi_sample IS NOT NULL "
          "AND total_kpi_fault IS NOT NULL")
_MEMBERS = ("list_filter(list_transform(string_split(provider_names, ','), lambda x: trim(x)), "
            "lambda x: x <> '')")
_PERC = "CASE WHEN sum_sample > 0 THEN cast((20000 * sum_fault + sum_sample) // (2 * sum_sample) AS DOUBLE) / 100 END"

_GOLD_CTES = f"""
src AS (SELECT * FROM kpi_silver WHERE {_GUARD}),
totals AS (SELECT kpi_id, period_start, period_end, psp_id, cast(sum(total_kpi_fault) AS BIGINT) AS sum_fault,
  cast(sum(total_kpi_sample) AS BIGINT) AS sum_sample, max(kpi_threshold) AS kpi_threshold FROM src GROUP BY ALL),
crm_n AS (SELECT contract_id, {_MEMBERS} AS members FROM crm WHERE provider_names IS NOT NULL AND trim(provider_names) <> ''),
grp AS (SELECT contract_id, members, array_to_string(list_sort(members), ',') AS group_key FROM crm_n WHERE len(members) > 1),
member_group AS (SELECT psp_member, min(group_key) AS group_key FROM (SELECT unnest(members) AS psp_member, group_key FROM grp) GROUP BY 1),
group_contract AS (SELECT group_key, min(contract_id) AS contract_id FROM grp GROUP BY 1),
mapping AS (SELECT m.psp_member, m.group_key, g.contract_id FROM member_group m LEFT JOIN group_contract g USING (group_key)),
lookup AS (SELECT psp_member, min(contract_id) AS contract_id FROM (SELECT unnest(members) AS psp_member, contract_id FROM crm_n) GROUP BY 1),
g_roll AS (SELECT kpi_id, period_start, period_end, group_key, contract_id, cast(sum(sum_fault) AS BIGINT) AS sum_fault,
  cast(sum(sum_sample) AS BIGINT) AS sum_sample, max(kpi_threshold) AS kpi_threshold
  FROM totals JOIN mapping ON totals.psp_id = mapping.psp_member GROUP BY ALL),
grouped AS (SELECT kpi_id, group_key AS psp_id, contract_id, kpi_threshold, {_PERC} AS perc_kpi, period_start, period_end FROM g_roll),
singles AS (SELECT t.kpi_id, t.psp_id, l.contract_id, t.kpi_threshold,
  CASE WHEN sum_sample > 0 THEN cast((20000 * sum_fault + sum_sample) // (2 * sum_sample) AS DOUBLE) / 100 END AS perc_kpi,
  t.period_start, t.period_end
  FROM totals t LEFT JOIN lookup l ON t.psp_id = l.psp_member
  WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.psp_member = t.psp_id))
"""

_OUT = ("kpi_id, psp_id, contract_id, kpi_threshold, perc_kpi, "
        "CASE WHEN perc_kpi <= kpi_threshold THEN 'OK' ELSE 'KO' END AS kpi_outcome, period_start, period_end")

ORACLE = {
    "kpi_guard": with_fixtures(
        f"SELECT * FROM kpi_silver WHERE {_GUARD} AND period_start = '{GUARD_PERIOD[0]}' "
        f"AND period_end = '{GUARD_PERIOD[1]}'", "kpi_silver"),
    "kpi_outcome": with_fixtures(
        "SELECT kpi_id, psp_id, period_start, perc_kpi, kpi_threshold, "
        "CASE WHEN perc_kpi <= kpi_threshold THEN 'OK' ELSE 'KO' END AS kpi_outcome FROM kpi_silver", "kpi_silver"),
    "list_normalise": with_fixtures(
        f"SELECT contract_id, array_to_string(list_sort(members), ',') AS group_key, cast(len(members) AS INTEGER) AS n_members "
        f"FROM (SELECT contract_id, {_MEMBERS} AS members FROM crm "
        f"WHERE provider_names IS NOT NULL AND trim(provider_names) <> '')", "crm"),
    "group_mapping": with_fixtures(f"WITH {_GOLD_CTES} SELECT group_key, psp_member, contract_id FROM mapping",
                                   "kpi_silver", "crm"),
    "member_contract": with_fixtures(f"WITH {_GOLD_CTES} SELECT psp_member, contract_id FROM lookup",
                                     "kpi_silver", "crm"),
    "kpi_grouped": with_fixtures(f"WITH {_GOLD_CTES} SELECT {_OUT} FROM grouped", "kpi_silver", "crm"),
    "kpi_singles": with_fixtures(f"WITH {_GOLD_CTES} SELECT {_OUT} FROM singles", "kpi_silver", "crm"),
    "kpi_gold": with_fixtures(
        f"WITH {_GOLD_CTES} SELECT {_OUT}, cast({BATCH_TS_MS} AS BIGINT) AS _ts "
        f"FROM (SELECT * FROM grouped UNION ALL SELECT * FROM singles)", "kpi_silver", "crm"),
    "latest_per_key": with_fixtures(
        f"WITH {_GOLD_CTES}, gold AS (SELECT {_OUT}, cast({BATCH_TS_MS} AS BIGINT) AS _ts "
        f"FROM (SELECT * FROM grouped UNION ALL SELECT * FROM singles)), "
        f"both_loads AS (SELECT * FROM gold UNION ALL SELECT * REPLACE ('RERUN' AS kpi_outcome, _ts + 1 AS _ts) "
        f"FROM gold WHERE kpi_id <> 'N') "
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY kpi_id, psp_id, period_start, period_end "
        f"ORDER BY _ts DESC) AS rn FROM both_loads) WHERE rn = 1", "kpi_silver", "crm"),
}
