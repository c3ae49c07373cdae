"""Institution configuration registry, maintenance notices and incident sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import origin_code
from ..operators import joins, predicates, registry, status
from ..sources.fixtures import fixture, with_fixtures

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _institutions(spark, sf_dir):
    return fixture(spark, sf_dir, "institution").withColumn("pa_key", F.col("row_key").cast("bigint"))


def q_iban_priority(spark, sf_dir):
    return registry.iban_priority(fixture(spark, sf_dir, "iban_rank"), _institutions(spark, sf_dir))


def referent_data(spark, sf_dir):
    """C17 + H12: catasto, ISTAT and referent e-mail from the first usable source."""
    inst = fixture(spark, sf_dir, "institution").withColumn("catasto_primary", origin_code("origin_id"))
    hist = fixture(spark, sf_dir, "ec_config")
    lookup = (inst.where(F.col("catasto_primary").isNotNull() & ~F.col("istat").isin("", "ITA"))
              .groupBy(F.col("catasto_primary").alias("lk_catasto")).agg(F.min("istat").alias("lk_istat")))
    j = inst.join(hist, "row_key", "left")
    catasto = registry.fallback([F.col("catasto_primary"), F.col("hist_catasto")], ("", "CL"))
    j = j.withColumn("pa_id_catasto", catasto)
    j = j.join(lookup, j.pa_id_catasto == lookup.lk_catasto, "left")
    return j.select(
        "row_key", "category", "pa_id_catasto",
        registry.fallback([F.col("istat"), F.col("lk_istat"), F.col("hist_istat")], ("", "ITA")).alias("pa_id_istat"),
        registry.fallback([F.col("referent_email"), F.col("hist_email")]).alias("pa_referent_email"),
        F.col("referent_email").alias("primary_email"),
    )


def q_fallback_chain(spark, sf_dir):
    return referent_data(spark, sf_dir).select("row_key", "pa_id_catasto", "pa_id_istat", "pa_referent_email")


def q_entity_merge(spark, sf_dir):
    inst = fixture(spark, sf_dir, "institution").where(F.col("category").isin("L5", "L6"))
    target = inst.select(F.lit("org").alias("partition_key"), "row_key", "company_name", "istat", "referent_email")
    upd = referent_data(spark, sf_dir).where(F.col("category").isin("L6", "L9")).select(
        F.lit("org").alias("partition_key"), "row_key", F.col("pa_id_istat").alias("istat"),
        F.col("primary_email").alias("referent_email"))
    return registry.entity_merge(target, upd, ["partition_key", "row_key"])


def _inst_by_station(spark, sf_dir):
    cfg = fixture(spark, sf_dir, "broker_cfg")
    return cfg.select("broker_id", F.col("broker_name").alias("broker_company_name"), "station_id",
                      F.col("organization_fiscal_code").alias("tax_code"),
                      F.concat(F.lit("Ente "), F.col("organization_fiscal_code")).alias("company_name"))


def _groups(spark, sf_dir):
    return status.maintenance_groups(fixture(spark, sf_dir, "maintenance"))


def _fmt(df):
    return (df.withColumn("starts_at", F.date_format("starts_at", TS_FMT))
            .withColumn("ends_at", F.date_format("ends_at", TS_FMT)))


def q_maintenance_groups(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return _fmt(g.select("broker_code", "starts_at", "ends_at", F.array_join("stations", ",").alias("stations")))


def q_impacted_entities(spark, sf_dir):
    return _fmt(status.impacted_entities(_groups(spark, sf_dir), _inst_by_station(spark, sf_dir)))


def q_maintenance_messages(spark, sf_dir):
    """H13 + C6: messages for groups not already published (same title and window)."""
    msgs = _fmt(status.maintenance_messages(_groups(spark, sf_dir), _inst_by_station(spark, sf_dir)))
    existing = _fmt(fixture(spark, sf_dir, "maintenance_report"))
    return joins.exclude_existing(msgs, existing, ["title", "starts_at", "ends_at"])


def _incidents(spark, sf_dir):
    return fixture(spark, sf_dir, "incident").withColumn("tags", status.tag_list("tags_csv")).drop("tags_csv")


def q_tag_filter(spark, sf_dir):
    return predicates.has_tag(_incidents(spark, sf_dir), "tags", status.STATUS_PAGE_TAG).select("id", "status")


def q_match_by_title(spark, sf_dir):
    m = status.match_by_title(_incidents(spark, sf_dir), fixture(spark, sf_dir, "status_report"))
    return m.select("id", "report_id", "report_state")


def q_match_by_title_compat(spark, sf_dir):
    m = status.match_by_title(_incidents(spark, sf_dir), fixture(spark, sf_dir, "status_report"), compat=True)
    return m.select("id", "report_id", "report_state")


def q_incident_actions(spark, sf_dir):
    return status.incident_actions(_incidents(spark, sf_dir), fixture(spark, sf_dir, "status_report"))


QUERIES = {
    "iban_priority": q_iban_priority,
    "fallback_chain": q_fallback_chain,
    "entity_merge": q_entity_merge,
    "maintenance_groups": q_maintenance_groups,
    "impacted_entities": q_impacted_entities,
    "maintenance_messages": q_maintenance_messages,
    "tag_filter": q_tag_filter,
    "match_by_title": q_match_by_title,
    "match_by_title_compat": q_match_by_title_compat,
    "incident_actions": q_incident_actions,
}

# ---------------------------------------------------------------- DuckDB oracle
_FX = ("iban_rank", "institution", "ec_config", "maintenance", "broker_cfg", "incident", "status_report", "maintenance_report")


def _u(expr, sentinels=("",)):
    s = ", ".join(f"'{x}'" for x in sentinels)
    return f"CASE WHEN {expr} IS NULL OR {expr} IN ({s}) THEN NULL ELSE {expr} END"


_ORIGIN = "upper(CASE WHEN strpos(origin_id, '_') > 0 THEN substr(origin_id, strpos(origin_id, '_') + 1) ELSE origin_id END)"
_CTES = f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY fk_pa ORDER BY inserted_date DESC, iban_id DESC) AS rn,
  row_number() OVER (PARTITION BY fk_pa, attribute_name = '0201138TS' ORDER BY inserted_date DESC, iban_id DESC) AS rn_attr
  FROM iban_rank),
inst AS (SELECT *, CASE WHEN {_ORIGIN} IN ('', 'CL') THEN NULL ELSE {_ORIGIN} END AS catasto_primary FROM institution),
lk AS (SELECT catasto_primary AS lk_catasto, min(istat) AS lk_istat FROM inst
  WHERE catasto_primary IS NOT NULL AND istat NOT IN ('', 'ITA') GROUP BY 1),
ref1 AS (SELECT i.*, h.hist_catasto, h.hist_istat, h.hist_email,
  coalesce({_u('i.catasto_primary', ('', 'CL'))}, {_u('h.hist_catasto', ('', 'CL'))}, '') AS pa_id_catasto
  FROM inst i LEFT JOIN ec_config h USING (row_key)),
ref AS (SELECT row_key, category, pa_id_catasto,
  coalesce({_u('istat', ('', 'ITA'))}, {_u('lk_istat', ('', 'ITA'))}, {_u('hist_istat', ('', 'ITA'))}, '') AS pa_id_istat,
  coalesce({_u('referent_email')}, {_u('hist_email')}, '') AS pa_referent_email, referent_email AS primary_email
  FROM ref1 LEFT JOIN lk ON ref1.pa_id_catasto = lk.lk_catasto),
inst_st AS (SELECT broker_id, broker_name AS broker_company_name, station_id, organization_fiscal_code AS tax_code,
  concat('Ente ', organization_fiscal_code) AS company_name FROM broker_cfg),
grp AS (SELECT broker_code, starts_at, ends_at, list_sort(list(DISTINCT station_code)) AS stations FROM maintenance GROUP BY ALL),
imp AS (SELECT DISTINCT g.broker_code, g.starts_at, g.ends_at, i.company_name, i.tax_code
  FROM (SELECT broker_code, starts_at, ends_at, unnest(stations) AS station_id FROM grp) g
  JOIN inst_st i ON g.broker_code = i.broker_id AND g.station_id = i.station_id),
inc AS (SELECT id, status, message, string_split(tags_csv, ',') AS tags FROM incident),
rep AS (SELECT rid, arg_min(report_id, report_id) AS report_id, arg_min(aggregate_state, report_id) AS report_state
  FROM (SELECT regexp_extract(title, 'ID: ([0-9A-Za-z_-]+)', 1) AS rid, * FROM status_report) WHERE rid <> '' GROUP BY 1),
rep_manual AS (SELECT rid, arg_min(report_id, report_id) AS report_id, arg_min(aggregate_state, report_id) AS report_state
  FROM (SELECT regexp_extract(title, 'ID: ([0-9A-Za-z_-]+)', 1) AS rid, * FROM status_report
  WHERE report_type = 'manual') WHERE rid <> '' GROUP BY 1)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CTES} {sql}", *_FX)


_TSF = "'%Y-%m-%d %H:%M:%S'"
_MSG = ("concat('{b}', ' ha pianificato una manutenzione programmata nella fascia oraria indicata.\n\n"
        "Non sarà possibile effettuare pagamenti verso i seguenti Enti Creditori:\n', "
        "coalesce(pa_lines, ''), '\nDi seguito le stazioni impattate:\n', st_lines)")

ORACLE = {
    "iban_priority": _o(
        "SELECT i.row_key, i.company_name, coalesce(p.iban, n.iban) AS iban, "
        "coalesce(p.attribute_name, n.attribute_name) AS label FROM institution i "
        "LEFT JOIN ranked p ON p.fk_pa = cast(i.row_key AS BIGINT) AND p.attribute_name = '0201138TS' AND p.rn_attr = 1 "
        "LEFT JOIN ranked n ON n.fk_pa = cast(i.row_key AS BIGINT) AND n.rn = 1"),
    "fallback_chain": _o("SELECT row_key, pa_id_catasto, pa_id_istat, pa_referent_email FROM ref"),
    "entity_merge": _o(
        "SELECT 'org' AS partition_key, coalesce(t.row_key, u.row_key) AS row_key, t.company_name, "
        "coalesce(u.istat, t.istat) AS istat, coalesce(u.referent_email, t.referent_email) AS referent_email "
        "FROM (SELECT row_key, company_name, istat, referent_email FROM institution WHERE category IN ('L5', 'L6')) t "
        "FULL OUTER JOIN (SELECT row_key, pa_id_istat AS istat, primary_email AS referent_email FROM ref "
        "WHERE category IN ('L6', 'L9')) u ON t.row_key = u.row_key"),
    "maintenance_groups": _o(
        f"SELECT broker_code, strftime(starts_at, {_TSF}) AS starts_at, strftime(ends_at, {_TSF}) AS ends_at, "
        "array_to_string(stations, ',') AS stations FROM grp"),
    "impacted_entities": _o(
        f"SELECT broker_code, strftime(starts_at, {_TSF}) AS starts_at, strftime(ends_at, {_TSF}) AS ends_at, "
        "company_name, tax_code FROM imp"),
    "maintenance_messages": _o(
        "SELECT g.broker_code, strftime(g.starts_at, " + _TSF + ") AS starts_at, strftime(g.ends_at, " + _TSF
        + ") AS ends_at, concat(coalesce(n.broker_name, ''), ' - Manutenzione Programmata') AS title, "
        + _MSG.replace("'{b}'", "coalesce(n.broker_name, '')")
        + " AS message FROM (SELECT *, array_to_string(list_transform(stations, lambda s: concat('- ', replace(s, '_', ' '), "
        "chr(10))), '') AS st_lines FROM grp) g LEFT JOIN (SELECT broker_code, starts_at, ends_at, "
        "array_to_string(list_transform(list_sort(list({'company_name': company_name, 'tax_code': tax_code})), "
        "lambda p: concat('- ', p.company_name, ' - ', p.tax_code, chr(10))), '') AS pa_lines FROM imp GROUP BY ALL) p "
        "USING (broker_code, starts_at, ends_at) LEFT JOIN (SELECT broker_id, min(broker_company_name) AS broker_name "
        "FROM inst_st GROUP BY 1) n ON g.broker_code = n.broker_id WHERE NOT EXISTS (SELECT 1 FROM maintenance_report m WHERE "
        "m.starts_at = g.starts_at AND m.ends_at = g.ends_at AND m.title = concat(coalesce(n.broker_name, ''), ' - Manutenzione Programmata'))"),
    "tag_filter": _o("SELECT id, status FROM inc WHERE list_contains(tags, 'toStatusPage')"),
    "match_by_title": _o("SELECT i.id, r.report_id, r.report_state FROM inc i LEFT JOIN rep r "
                         "ON cast(i.id AS VARCHAR) = r.rid"),
    "match_by_title_compat": _o(
        "SELECT i.id, arg_min(s.report_id, s.report_id) AS report_id, arg_min(s.aggregate_state, s.report_id) "
        "AS report_state FROM inc i LEFT JOIN status_report s ON contains(s.title, 'ID: ' || cast(i.id AS VARCHAR)) "
        "GROUP BY i.id"),
    "incident_actions": _o(
        "SELECT id, status, report_id, report_state, CASE WHEN report_id IS NULL THEN 'CREATE' "
        "WHEN report_state = status THEN 'NOOP' WHEN report_state = 'Resolved' THEN 'NOOP' "
        "WHEN status = 'resolved' THEN 'RESOLVE' ELSE 'NOOP' END AS action FROM (SELECT i.id, i.status, r.report_id, "
        "r.report_state FROM inc i LEFT JOIN rep_manual r ON cast(i.id AS VARCHAR) = r.rid "
        "WHERE list_contains(i.tags, 'toStatusPage'))"),
}
