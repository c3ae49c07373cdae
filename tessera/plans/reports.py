"""Operational reports: position counters, broker totals, station transactions, debtor metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import joins, predicates, reports, windows
from ..operators.predicates import epoch_micros
from ..sources.fixtures import fixture, with_fixtures

HISTORY = ("1995-01-01 00:00:00", "1997-07-01 00:00:00")
CURRENT = ("1997-07-01 00:00:00", "2000-01-01 00:00:00")
TRX_WINDOW = ("1995-01-01 00:00:00", "1996-01-01 00:00:00")
TODAY = dt.date(1995, 4, 15)
# The stand-in broker registry links even organisation codes only, which the
# GPD positions carry; ACA positions (odd order keys) would never be enriched.
SERVICE = "GPD"
KEYS = ["broker_id", "station_id", "organization_fiscal_code", "segregation_code"]


def _counts(spark, sf_dir, window):
    po = fixture(spark, sf_dir, "payment_option")
    pp = fixture(spark, sf_dir, "payment_position")
    return reports.prefix_counts(po, pp, epoch_micros(window[0]), epoch_micros(window[1]), SERVICE)


def _enriched_load(spark, sf_dir, window):
    """One load: counts → config enrichment → drop 'RF' and not-enriched rows."""
    enriched = reports.enrich_counts(_counts(spark, sf_dir, window), fixture(spark, sf_dir, "broker_cfg"))
    kept, _ = predicates.drop_sentinel(enriched, "segregation_code", "RF")
    return kept.where(F.col("broker_id").isNotNull())


def _history(spark, sf_dir):
    """Stored totals as text (the entity store is schemaless); organisations
    ending in 7 carry a non-numeric total that must count as 0."""
    h = _enriched_load(spark, sf_dir, HISTORY)
    return h.withColumn("total", F.when(F.col("organization_fiscal_code").endswith("7"), F.lit("n/a"))
                        .otherwise(F.col("total").cast("string")))


def accumulated(spark, sf_dir):
    return reports.accumulate(_history(spark, sf_dir), _enriched_load(spark, sf_dir, CURRENT), KEYS)


def q_position_counters(spark, sf_dir):
    return reports.position_counters(fixture(spark, sf_dir, "payment_position"))


def q_prefix_counts(spark, sf_dir):
    return _counts(spark, sf_dir, CURRENT)


def q_broker_config(spark, sf_dir):
    return reports.broker_config(reports.broker_links(*[fixture(spark, sf_dir, f"cfg_{t}") for t in ("broker", "station", "link", "institution")]))


def q_drop_sentinel(spark, sf_dir):
    enriched = reports.enrich_counts(_counts(spark, sf_dir, CURRENT), fixture(spark, sf_dir, "broker_cfg"))
    return predicates.drop_sentinel(enriched, "segregation_code", "RF")[1]


def q_history_accumulate(spark, sf_dir):
    return accumulated(spark, sf_dir)


def q_top5_brokers(spark, sf_dir):
    per_broker = accumulated(spark, sf_dir).groupBy("broker_id", "broker_name").agg(F.sum("total").alias("total"))
    return windows.top_n(per_broker, [F.desc("total"), F.asc("broker_id")], 5)


def q_station_trx(spark, sf_dir):
    return reports.station_trx(fixture(spark, sf_dir, "payment_event"), fixture(spark, sf_dir, "broker_cfg"),
                               *TRX_WINDOW)


def q_prefix_residual(spark, sf_dir):
    """C8 alone: events ⋈ config on organisation with the IUV-prefix residual."""
    ev = fixture(spark, sf_dir, "payment_event")
    cfg = fixture(spark, sf_dir, "broker_cfg").where(F.col("segregazione").isNotNull())
    j = joins.prefix_residual_join(ev, cfg, "id_pa", "organization_fiscal_code", "iuv", "segregazione")
    return j.select(ev.id, "station_id", "iuv")


def q_station_top10(spark, sf_dir):
    per_station = q_station_trx(spark, sf_dir).groupBy("stazione").agg(F.sum("trx").alias("total_trx"))
    return windows.top_n(per_station, [F.desc("total_trx"), F.asc("stazione")], 10)


def q_code_validity(spark, sf_dir):
    pp = fixture(spark, sf_dir, "payment_position")
    return reports.code_validity(pp).select("id", "type", "fiscal_code", "valid_fiscal_code")


def q_debtor_metrics(spark, sf_dir):
    return reports.debtor_metrics(fixture(spark, sf_dir, "payment_position"))


def q_period_default(spark, sf_dir):
    start, end = predicates.previous_month(TODAY)
    return predicates.kpi_guard(fixture(spark, sf_dir, "kpi_silver"), start, end)


QUERIES = {
    "position_counters": q_position_counters,
    "prefix_counts": q_prefix_counts,
    "broker_config": q_broker_config,
    "drop_sentinel": q_drop_sentinel,
    "history_accumulate": q_history_accumulate,
    "top5_brokers": q_top5_brokers,
    "station_trx": q_station_trx,
    "prefix_residual": q_prefix_residual,
    "station_top10": q_station_top10,
    "code_validity": q_code_validity,
    "debtor_metrics": q_debtor_metrics,
    "period_default": q_period_default,
}

# ---------------------------------------------------------------- DuckDB oracle
_FX = ("payment_position", "payment_option", "broker_cfg", "payment_event", "kpi_silver")


def _counts_sql(window):
    lo, hi = epoch_micros(window[0]), epoch_micros(window[1])
    return (f"SELECT po.organization_fiscal_code, substr(po.iuv, 1, 2) AS segregation_code, count(*) AS total "
            f"FROM payment_option po WHERE po.payment_position_id IN (SELECT id FROM payment_position "
            f"WHERE service_type = '{SERVICE}' AND inserted_date >= {lo} AND inserted_date < {hi}) GROUP BY 1, 2")


_CTES = f"""
cfg AS (SELECT broker_id, broker_name, station_id, organization_fiscal_code,
  lpad(cast(segregazione AS VARCHAR), 2, '0') AS segregation_code FROM broker_cfg WHERE segregazione IS NOT NULL),
cur_counts AS ({_counts_sql(CURRENT)}),
hist_counts AS ({_counts_sql(HISTORY)}),
cur AS (SELECT c.*, g.broker_id, g.broker_name, g.station_id FROM cur_counts c
  LEFT JOIN cfg g USING (organization_fiscal_code, segregation_code)),
cur_load AS (SELECT * FROM cur WHERE (segregation_code IS NULL OR segregation_code <> 'RF') AND broker_id IS NOT NULL),
hist_load AS (SELECT c.*, g.broker_id, g.broker_name, g.station_id FROM hist_counts c
  LEFT JOIN cfg g USING (organization_fiscal_code, segregation_code)
  WHERE (segregation_code IS NULL OR segregation_code <> 'RF') AND broker_id IS NOT NULL),
hist AS (SELECT broker_id, station_id, organization_fiscal_code, segregation_code, broker_name,
  CASE WHEN organization_fiscal_code LIKE '%7' THEN 'n/a' ELSE cast(total AS VARCHAR) END AS total FROM hist_load),
acc AS (SELECT broker_id, station_id, organization_fiscal_code, segregation_code, cast(sum(total) AS BIGINT) AS total,
  min(broker_name) AS broker_name FROM (
    SELECT broker_id, station_id, organization_fiscal_code, segregation_code, broker_name,
      coalesce(TRY_CAST(TRY_CAST(total AS DOUBLE) AS BIGINT), 0) AS total FROM hist
    UNION ALL SELECT broker_id, station_id, organization_fiscal_code, segregation_code, broker_name, total FROM cur_load)
  WHERE broker_id IS NOT NULL AND station_id IS NOT NULL AND organization_fiscal_code IS NOT NULL
    AND segregation_code IS NOT NULL GROUP BY 1, 2, 3, 4),
trx AS (SELECT station_id AS stazione, id_pa AS ec, count(*) AS trx FROM payment_event e
  JOIN broker_cfg c ON e.id_pa = c.organization_fiscal_code AND c.segregazione IS NOT NULL
   AND starts_with(e.iuv, cast(c.segregazione AS VARCHAR))
  WHERE e.payment_ts >= TIMESTAMP '{TRX_WINDOW[0]}' AND e.payment_ts < TIMESTAMP '{TRX_WINDOW[1]}' GROUP BY 1, 2)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CTES} {sql}", *_FX)


def _vat_sql(code):
    terms = []
    for i in range(10):
        d = f"TRY_CAST(substr({code}, {i + 1}, 1) AS INTEGER)"
        terms.append(d if i % 2 == 0 else f"(CASE WHEN {d} * 2 > 9 THEN {d} * 2 - 9 ELSE {d} * 2 END)")
    total = " + ".join(terms)
    return (f"coalesce(regexp_matches({code}, '{reports.VAT_PATTERN}') AND (10 - ({total}) % 10) % 10 = "
            f"TRY_CAST(substr({code}, 11, 1) AS INTEGER), FALSE)")


def _fiscal_sql(code):
    odd = "[" + ", ".join(str(v) for v in reports.FISCAL_ODD_VALUES) + "]"
    terms = []
    for i in range(15):
        pos = f"instr('{reports.FISCAL_ALPHABET}', substr({code}, {i + 1}, 1))"
        terms.append(f"{odd}[{pos}]" if i % 2 == 0 else f"(CASE WHEN {pos} <= 10 THEN {pos} - 1 ELSE {pos} - 11 END)")
    total = " + ".join(terms)
    return (f"coalesce(regexp_matches({code}, '{reports.FISCAL_CODE_PATTERN}') AND "
            f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', ({total}) % 26 + 1, 1) = substr({code}, 16, 1), FALSE)")


_VALID = (f"CASE WHEN type = 'F' THEN {_fiscal_sql('upper(fiscal_code)')} "
          f"WHEN type = 'G' THEN {_vat_sql('upper(fiscal_code)')} END")
_METRICS = ["both_equal", "both_different", "fiscal_code_empty", "org_fiscal_code_empty",
            "type_f", "type_g", "valid_fiscal_f", "valid_fiscal_g"]
_PERIOD = predicates.previous_month(TODAY)

ORACLE = {
    "position_counters": _o(
        "SELECT count(*) AS total, count_if(service_type = 'GPD') AS gpd, "
        "count_if(service_type = 'GPD' AND status IN ('VALID', 'PARTIALLY_PAID')) AS gpd_payable, "
        "count_if(service_type = 'WISP') AS wisp, count_if(NOT iupd LIKE 'ACA_%' AND service_type = 'ACA') AS gpd4aca, "
        "count_if(NOT iupd LIKE 'ACA_%' AND service_type = 'ACA' AND status IN ('VALID', 'PARTIALLY_PAID')) "
        "AS aca_gpd4aca_payable, count_if(iupd LIKE 'ACA_%' AND service_type = 'ACA') AS pa_create_position, "
        "count_if(iupd LIKE 'ACA_%' AND service_type = 'ACA' AND status IN ('VALID', 'PARTIALLY_PAID')) "
        "AS aca_gpd_create_position_payable FROM payment_position"),
    "prefix_counts": _o("SELECT * FROM cur_counts"),
    "broker_config": with_fixtures(
        "SELECT b.broker_id, b.broker_name, s.station_id, i.id_dominio AS organization_fiscal_code, lpad(cast(l.segregazione AS VARCHAR), 2, '0') "
        "AS segregation_code FROM cfg_link l, cfg_station s, cfg_broker b, cfg_institution i WHERE l.fk_station = s.obj_id AND s.fk_broker = b.obj_id "
        "AND l.fk_pa = i.obj_id AND l.segregazione IS NOT NULL", "cfg_broker", "cfg_station", "cfg_link", "cfg_institution"),
    "drop_sentinel": _o("SELECT count(*) AS rows_in, count_if(segregation_code = 'RF') AS rows_removed FROM cur"),
    "history_accumulate": _o("SELECT * FROM acc"),
    "top5_brokers": _o("SELECT broker_id, broker_name, cast(sum(total) AS BIGINT) AS total FROM acc GROUP BY 1, 2 "
                       "ORDER BY total DESC, broker_id LIMIT 5"),
    "station_trx": _o("SELECT * FROM trx"),
    "prefix_residual": _o(
        "SELECT e.id, c.station_id, e.iuv FROM payment_event e JOIN broker_cfg c ON e.id_pa = c.organization_fiscal_code "
        "AND c.segregazione IS NOT NULL AND starts_with(e.iuv, cast(c.segregazione AS VARCHAR))"),
    "station_top10": _o("SELECT stazione, cast(sum(trx) AS BIGINT) AS total_trx FROM trx GROUP BY 1 "
                        "ORDER BY total_trx DESC, stazione LIMIT 10"),
    "code_validity": _o(f"SELECT id, type, fiscal_code, {_VALID} AS valid_fiscal_code FROM payment_position"),
    "debtor_metrics": _o(
        "SELECT total, " + ", ".join(_METRICS) + ", "
        + ", ".join(f"{m} / total * 100 AS pct_{m}" for m in _METRICS)
        + " FROM (SELECT *, total - both_equal AS both_different FROM (SELECT count(*) AS total, "
        "count_if(fiscal_code = organization_fiscal_code) AS both_equal, count_if(fiscal_code IS NULL) AS fiscal_code_empty, "
        "count_if(organization_fiscal_code IS NULL) AS org_fiscal_code_empty, count_if(type = 'F') AS type_f, "
        "count_if(type = 'G') AS type_g, count_if(type = 'F' AND valid) AS valid_fiscal_f, "
        f"count_if(type = 'G' AND valid) AS valid_fiscal_g FROM (SELECT *, {_VALID} AS valid FROM payment_position)))"),
    "period_default": _o(
        "SELECT * FROM kpi_silver WHERE perc_kpi IS NOT NULL AND NOT isnan(perc_kpi) AND total_kpi_sample IS NOT NULL "
        f"AND total_kpi_fault IS NOT NULL AND period_start = '{_PERIOD[0]}' AND period_end = '{_PERIOD[1]}'"),
}
