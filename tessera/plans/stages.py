"""Sources, sinks and small predicates used by the jobs, each as its own query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.cdc import cdc_json, to_cdc
from ..operators import groups, joins, predicates, sinks
from ..session import materialise, scratch_dir
from ..sources.delimited import export_csv, read_delimited
from ..sources.fixtures import fixture, with_fixtures
from ..sources.tables import read_table
from . import config, kpi, reconcile, reports

SCAN_SINCE = "1997-03-01 00:00:00"
TIME_RANGE = ("1995-01-01 00:00:00", "1995-07-01 00:00:00")
NESTED_RANGE = ("1995-01-01 00:00:00", "1996-01-01 00:00:00")
PREVIEW = 10
GOLD_KEYS = ("kpi_id", "psp_id", "period_start", "period_end")


def q_scan_project(spark, sf_dir):
    """A1: three columns of lineitem with a pushed-down date filter."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    return li.where(F.col("l_shipdate") >= F.lit(SCAN_SINCE).cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "l_quantity")


def q_time_range(spark, sf_dir):
    """Half-open timestamp window on payment events."""
    ev = fixture(spark, sf_dir, "payment_event")
    return predicates.time_range(ev, "payment_ts", *TIME_RANGE).select("id", "iuv")


def q_clean_keys(spark, sf_dir):
    """Institutions whose keys (row key, origin id) are present and not blank."""
    inst = fixture(spark, sf_dir, "institution")
    return predicates.clean_keys(inst, ["row_key", "origin_id"]).select("row_key", "origin_id")


def q_preview_limit(spark, sf_dir):
    """Deterministic preview (ordered, then LIMIT)."""
    pp = fixture(spark, sf_dir, "payment_position")
    return predicates.preview(pp.select("id", "iupd", "status"), PREVIEW, [F.asc("id")])


def q_anti_singles(spark, sf_dir):
    """Providers with KPI rows that belong to no provider group."""
    src = kpi._src(spark, sf_dir)
    mapping = groups.group_mapping(fixture(spark, sf_dir, "crm"))
    return joins.exclude_existing(src.select("psp_id").distinct(),
                                  mapping.select(F.col("psp_member").alias("psp_id")), ["psp_id"])


def q_lookup_left(spark, sf_dir):
    """Per-provider totals with the provider's contract (left lookup)."""
    totals = groups.provider_totals(kpi._src(spark, sf_dir))
    lookup = groups.member_contract(fixture(spark, sf_dir, "crm")).withColumnRenamed("psp_member", "psp_id")
    return joins.lookup_left(totals, lookup, ["psp_id"]).select(
        "kpi_id", "period_start", "period_end", "psp_id", "sum_fault", "sum_sample", "contract_id")


def q_conform_schema(spark, sf_dir):
    """Referent data conformed to the entity-store schema with type markers."""
    ref = config.referent_data(spark, sf_dir)
    shaped = ref.select(F.col("row_key").alias("RowKey"), F.col("pa_id_catasto").alias("PaIdCatasto"),
                        F.col("pa_id_istat").alias("PaIdIstat"), F.col("pa_referent_email").alias("PaReferentEmail"))
    schema = [("RowKey", "string"), ("PaIdCatasto", "string"), ("PaIdIstat", "string"), ("PaReferentEmail", "string")]
    consts = {"PartitionKey": F.lit("org")}
    consts.update({f"{c}@type": F.lit("Edm.String") for c, _ in schema[1:]})
    return predicates.conform(shaped, schema, consts)


def q_completeness_counters(spark, sf_dir):
    """Institutions whose referent data was not found in any source."""
    ref = config.referent_data(spark, sf_dir)
    return ref.agg(
        F.count(F.lit(1)).alias("institutions"),
        F.count_if(F.col("pa_id_catasto") == "").alias("catasto_not_found"),
        F.count_if(F.col("pa_id_istat") == "").alias("istat_not_found"),
        F.count_if(F.col("primary_email").isNull()).alias("referent_from_fallback"),
    )


def q_nested_export(spark, sf_dir):
    """A5: nested payment documents filtered on a nested timestamp and flattened to two columns."""
    docs = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        F.struct(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("paymentToken"),
                 F.col("o_orderdate").alias("paymentDateTime")).alias("paymentInfo"),
        F.struct(F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("noticeNumber")).alias("debtorPosition"))
    lo, hi = NESTED_RANGE
    ts = F.col("paymentInfo.paymentDateTime")
    pred = (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))
    return predicates.nested_export(docs, {"payment_token": "paymentInfo.paymentToken",
                                           "notice_number": "debtorPosition.noticeNumber"}, pred)


def q_csv_export(spark, sf_dir):
    """A10: a report exported as range-partitioned `;` CSV files, read back."""
    path = scratch_dir(spark, "station-trx-csv")
    export_csv(reports.q_station_trx(spark, sf_dir), path, sep=";", sort=["stazione", "ec"])
    return read_delimited(spark, path, sep=";", cols=["stazione", "ec", "trx"])


def q_stage_append(spark, sf_dir):
    """Enriched POS rows plus the unmatched file rows staged with an empty payment id."""
    path = scratch_dir(spark, "pos-stage")
    rows = materialise(reconcile.q_enrich_left(spark, sf_dir), "pos-enriched")
    rows.where(F.col("payment_id").isNotNull()).write.mode("overwrite").parquet(path)
    unmatched = rows.where(F.col("payment_id").isNull()).drop("payment_id")
    sinks.stage_append(unmatched, path, ["payment_id"])
    return spark.read.parquet(path)


def q_gold_create(spark, sf_dir):
    """The gold table created from the KPI load (or appended to if it exists)."""
    name = "gold_kpi_" + scratch_dir(spark, "g").rsplit("/", 1)[-1].replace("-", "_")
    sinks.create_or_append(kpi.q_kpi_gold(spark, sf_dir), name, location=scratch_dir(spark, "gold-table"))
    return spark.table(name)


def q_gold_upsert(spark, sf_dir):
    """A second load upserted into the stored gold table, month by month of its periods."""
    src = kpi._src(spark, sf_dir)
    crm = fixture(spark, sf_dir, "crm")
    path = scratch_dir(spark, "gold")
    second = groups.kpi_gold(src.where(F.col("kpi_id") != "N"), crm, kpi.BATCH_TS_MS + 1).withColumn(
        "kpi_outcome", F.lit("RERUN"))
    for load in (groups.kpi_gold(src, crm, kpi.BATCH_TS_MS), second):
        gold = sinks.upsert_partitions(path, load, GOLD_KEYS, "_ts", F.substring("period_start", 1, 7), "period")
    return gold.drop("period")


def q_gold_upsert_version(spark, sf_dir):
    """A8 without partitions: the second load upserted into a new version of the whole table."""
    src = kpi._src(spark, sf_dir)
    crm = fixture(spark, sf_dir, "crm")
    base = scratch_dir(spark, "gold-v1")
    groups.kpi_gold(src, crm, kpi.BATCH_TS_MS).write.mode("errorifexists").parquet(base)
    second = groups.kpi_gold(src.where(F.col("kpi_id") != "N"), crm, kpi.BATCH_TS_MS + 1).withColumn(
        "kpi_outcome", F.lit("RERUN"))
    return spark.read.parquet(sinks.upsert(spark, base, second, GOLD_KEYS, "_ts"))


DAY_TODAY = dt.date(1996, 3, 2)
DAY_REQUESTS = (("range", "1996-01-10", "1996-01-12"), ("yesterday", "yesterday", None), ("malformed", "10/01/1996", "1996-13-01"), ("all", "all", None))


def q_day_range(spark, sf_dir):
    """Payments per requested day window, one pass for all requests."""
    ev = fixture(spark, sf_dir, "payment_event")
    counts = []
    for name, start, end in DAY_REQUESTS:
        window = predicates.day_range(start, end, DAY_TODAY)
        inside = F.lit(True) if window is None else (
            (F.col("payment_ts") >= F.lit(window[0]).cast("timestamp_ntz")) & (F.col("payment_ts") < F.lit(window[1]).cast("timestamp_ntz")))
        counts.append(F.count_if(inside).alias(name))
    return ev.agg(*counts)


def q_gold_merge(spark, sf_dir):
    """The gold table created by one load, and a second load merged into it."""
    src, crm = kpi._src(spark, sf_dir), fixture(spark, sf_dir, "crm")
    second = groups.kpi_gold(src.where(F.col("kpi_id") != "N"), crm, kpi.BATCH_TS_MS + 1).withColumn("kpi_outcome", F.lit("RERUN"))
    name = "gold_merge_" + scratch_dir(spark, "g").rsplit("-", 1)[-1]
    for load in (groups.kpi_gold(src, crm, kpi.BATCH_TS_MS), second):
        sinks.create_or_merge(load, name, GOLD_KEYS, "_ts")
    return spark.table(name)


def q_event_topics(spark, sf_dir):
    """The create events of three tables routed to a topic each, a batch per
    table, sent twice as a repeated job does, and read back."""
    path = scratch_dir(spark, "event-topics")
    for topic, table, key in (("positions", "payment_position", "id"), ("options", "payment_option", "id"), ("transfers", "transfer", "payment_option_id")):
        rows = fixture(spark, sf_dir, table)
        events = cdc_json(to_cdc(rows, rows.columns, now_us=0), f"after.{key}").withColumn("topic", F.lit(topic))
        for _ in range(2):
            sinks.emit_events(events, path, batch=table)
    back = spark.read.schema("key string, value string, topic string").json(path)
    return back.groupBy("topic").agg(F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"),
                                     F.count_if(F.get_json_object("value", "$.op") == "c").alias("n_create"))


QUERIES = {
    "day_range": q_day_range,
    "gold_merge": q_gold_merge,
    "event_topics": q_event_topics,
    "scan_project": q_scan_project,
    "time_range": q_time_range,
    "clean_keys": q_clean_keys,
    "preview_limit": q_preview_limit,
    "anti_singles": q_anti_singles,
    "lookup_left": q_lookup_left,
    "conform_schema": q_conform_schema,
    "completeness_counters": q_completeness_counters,
    "nested_export": q_nested_export,
    "csv_export": q_csv_export,
    "stage_append": q_stage_append,
    "gold_create": q_gold_create,
    "gold_upsert": q_gold_upsert,
    "gold_upsert_version": q_gold_upsert_version,
}

# ---------------------------------------------------------------- DuckDB oracle
_KPI = kpi._GOLD_CTES
ORACLE = {
    "scan_project": f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SCAN_SINCE}'",
    "time_range": with_fixtures(
        f"SELECT id, iuv FROM payment_event WHERE payment_ts >= TIMESTAMP '{TIME_RANGE[0]}' "
        f"AND payment_ts < TIMESTAMP '{TIME_RANGE[1]}'", "payment_event"),
    "clean_keys": with_fixtures(
        "SELECT trim(row_key) AS row_key, trim(origin_id) AS origin_id FROM institution WHERE row_key IS NOT NULL "
        "AND trim(row_key) <> '' AND lower(trim(row_key)) <> 'nan' AND origin_id IS NOT NULL AND trim(origin_id) <> '' "
        "AND lower(trim(origin_id)) <> 'nan'", "institution"),
    "preview_limit": with_fixtures(
        f"SELECT id, iupd, status FROM payment_position ORDER BY id LIMIT {PREVIEW}", "payment_position"),
    "anti_singles": with_fixtures(
        f"WITH {_KPI} SELECT DISTINCT psp_id FROM src WHERE psp_id NOT IN (SELECT psp_member FROM mapping)",
        "kpi_silver", "crm"),
    "lookup_left": with_fixtures(
        f"WITH {_KPI} SELECT t.kpi_id, t.period_start, t.period_end, t.psp_id, t.sum_fault, t.sum_sample, l.contract_id "
        "FROM totals t LEFT JOIN lookup l ON t.psp_id = l.psp_member", "kpi_silver", "crm"),
    "conform_schema": config.ORACLE["fallback_chain"].replace(
        "SELECT row_key, pa_id_catasto, pa_id_istat, pa_referent_email FROM ref",
        "SELECT row_key AS RowKey, pa_id_catasto AS PaIdCatasto, pa_id_istat AS PaIdIstat, "
        "pa_referent_email AS PaReferentEmail, 'org' AS PartitionKey, 'Edm.String' AS \"PaIdCatasto@type\", "
        "'Edm.String' AS \"PaIdIstat@type\", 'Edm.String' AS \"PaReferentEmail@type\" FROM ref"),
    "completeness_counters": config.ORACLE["fallback_chain"].replace(
        "SELECT row_key, pa_id_catasto, pa_id_istat, pa_referent_email FROM ref",
        "SELECT count(*) AS institutions, count_if(pa_id_catasto = '') AS catasto_not_found, "
        "count_if(pa_id_istat = '') AS istat_not_found, count_if(primary_email IS NULL) AS referent_from_fallback FROM ref"),
    "nested_export": (
        "SELECT concat('T', cast(o_orderkey AS VARCHAR)) AS payment_token, concat('N', cast(o_custkey AS VARCHAR)) "
        f"AS notice_number FROM orders WHERE o_orderdate >= TIMESTAMP '{NESTED_RANGE[0]}' "
        f"AND o_orderdate < TIMESTAMP '{NESTED_RANGE[1]}'"),
    "csv_export": reports.ORACLE["station_trx"].replace(
        "SELECT * FROM trx", "SELECT stazione, ec, cast(trx AS VARCHAR) AS trx FROM trx"),
    "stage_append": reconcile.ORACLE["enrich_left"],
    "gold_create": kpi.ORACLE["kpi_gold"],
    "gold_upsert": kpi.ORACLE["latest_per_key"],
    "gold_upsert_version": kpi.ORACLE["latest_per_key"],
    "gold_merge": kpi.ORACLE["latest_per_key"],
    "day_range": with_fixtures(
        "SELECT count_if(payment_ts >= TIMESTAMP '1996-01-10' AND payment_ts < TIMESTAMP '1996-01-13') AS \"range\", "
        "count_if(payment_ts >= TIMESTAMP '1996-03-01' AND payment_ts < TIMESTAMP '1996-03-02') AS yesterday, "
        "count_if(payment_ts >= TIMESTAMP '1996-03-01' AND payment_ts < TIMESTAMP '1996-03-02') AS malformed, count(*) AS \"all\" FROM payment_event",
        "payment_event"),
    "event_topics": with_fixtures(
        " UNION ALL ".join(f"SELECT '{topic}' AS topic, count(*) AS n, min(cast({key} AS VARCHAR)) AS first_key, max(cast({key} AS VARCHAR)) AS last_key, "
                           f"count(*) AS n_create FROM {table}" for topic, table, key in
                           (("positions", "payment_position", "id"), ("options", "payment_option", "id"), ("transfers", "transfer", "payment_option_id"))),
        "payment_position", "payment_option", "transfer"),
}
