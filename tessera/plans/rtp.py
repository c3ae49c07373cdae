"""Partner KPIs over debt positions.

Inputs arrive as CDC image tables (payload in struct ``after``); the job
unwraps the needed leaves, runs the semi-join waterfall, joins the partner
registry on the derived two-character key and reports distinct counts, sums
and per-partner top-k.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import to_cdc
from ..functions.columns import from_epoch_us, prefix2
from ..operators import joins, predicates, windows
from ..session import materialise
from ..sources.fixtures import fixture, with_fixtures

CATEGORY_PATTERN = r"^9/.+/$"
EXCLUDED_IUPD = "ACA_%"
OPEN_STATUSES = ("VALID", "PARTIALLY_PAID")
EMIT_US = 820_454_400_000_000


def cdc_image(spark, sf_dir, name, cols):
    """A stand-in table in the silver CDC layout (one create event per row)."""
    return to_cdc(fixture(spark, sf_dir, name), cols, now_us=EMIT_US)


def inputs(spark, sf_dir):
    pp = predicates.unwrap_after(
        cdc_image(spark, sf_dir, "payment_position", ["id", "iupd", "status", "organization_fiscal_code"]),
        ["id", "iupd", "status", "organization_fiscal_code"]).withColumnRenamed("id", "pp_id")
    po = predicates.unwrap_after(
        cdc_image(spark, sf_dir, "payment_option", ["id", "payment_position_id", "iuv"]),
        ["id", "payment_position_id", "iuv"]).withColumnRenamed("id", "po_id")
    t = predicates.unwrap_after(
        cdc_image(spark, sf_dir, "transfer", ["payment_option_id", "category", "amount"]),
        ["payment_option_id", "category", "amount"])
    return pp, po, t


def waterfall(spark, sf_dir):
    pp, po, t = inputs(spark, sf_dir)
    return joins.semi_waterfall(pp, po, t, CATEGORY_PATTERN, EXCLUDED_IUPD, OPEN_STATUSES)


def final_options(spark, sf_dir):
    """Final options with their positions and IUV prefix, and the qualifying
    transfers (one pass over each input)."""
    final, t_ok = joins.waterfall_options(*inputs(spark, sf_dir), CATEGORY_PATTERN, EXCLUDED_IUPD, OPEN_STATUSES)
    return final.withColumn("iuv_prefix", prefix2("iuv")), t_ok


def partners(spark, sf_dir):
    return joins.partner_prefixes(fixture(spark, sf_dir, "partner_report"))


def q_cdc_unwrap(spark, sf_dir):
    return inputs(spark, sf_dir)[0]


def q_like_wild(spark, sf_dir):
    pp = inputs(spark, sf_dir)[0]
    return predicates.prefix_filter(pp, "iupd", "ACA_", negate=True).select("pp_id", "iupd")


def q_like_escaped(spark, sf_dir):
    pp = inputs(spark, sf_dir)[0]
    return predicates.prefix_filter(pp, "iupd", "ACA_", negate=True, escaped=True).select("pp_id", "iupd")


def q_in_list(spark, sf_dir):
    pp = inputs(spark, sf_dir)[0]
    return predicates.in_list(pp, "status", OPEN_STATUSES).select("pp_id", "status")


def q_rlike_filter(spark, sf_dir):
    return predicates.regex_filter(inputs(spark, sf_dir)[2], "category", CATEGORY_PATTERN)


def q_position_option_transfer(spark, sf_dir):
    pp, po, t = inputs(spark, sf_dir)
    return joins.position_option_transfer(pp, po, t).select("pp_id", "iupd", "po_id", "iuv", "category", "amount")


def q_semi_waterfall(spark, sf_dir):
    pp_final, po_final, t_final = waterfall(spark, sf_dir)
    return (pp_final.select(F.lit("pp").alias("level"), F.col("pp_id").alias("id"))
            .unionByName(po_final.select(F.lit("po").alias("level"), F.col("po_id").alias("id")))
            .unionByName(t_final.select(F.lit("t").alias("level"), F.col("payment_option_id").alias("id"))))


CORE = ("id_intermediario_pa", "id_dominio", "po_id", "iuv", "pp_id", "iupd", "organization_fiscal_code")


def q_partner_join(spark, sf_dir):
    final, _ = final_options(spark, sf_dir)
    return joins.partner_match(final, fixture(spark, sf_dir, "partner_report")).select(*CORE)


def q_partner_join_domain(spark, sf_dir):
    """C2 with ``match='prefix+domain'``: the registry row must also belong to
    the position's organisation (no fan-out across organisations)."""
    final, _ = final_options(spark, sf_dir)
    return joins.partner_match(final, fixture(spark, sf_dir, "partner_report"), match="prefix+domain").select(*CORE)


def position_counts(spark, sf_dir, *keys):
    """D3: distinct positions per partner and ``keys``, see :func:`joins.distinct_by_registry`."""
    final, _ = final_options(spark, sf_dir)
    return joins.distinct_by_registry(final, partners(spark, sf_dir), "iuv_prefix", "iupd", keys, "id_intermediario_pa", "num_posizioni")


def q_partner_distinct(spark, sf_dir):
    return position_counts(spark, sf_dir, "organization_fiscal_code")


def q_partner_distinct_sketch(spark, sf_dir):
    """D3 from stored sketches: one per (option day, prefix, organisation) is
    written once, and those of a partner's prefixes and days are merged. The
    estimate must lie within five standard errors of the exact count."""
    final, _ = final_options(spark, sf_dir)
    days = fixture(spark, sf_dir, "payment_position").select(
        F.col("id").alias("pp_id"), F.to_date(from_epoch_us("inserted_date")).alias("day"))
    daily = joins.distinct_sketches(final.join(days, "pp_id"), "iupd", ["day", "iuv_prefix", "organization_fiscal_code"])
    stored = materialise(daily, "position-sketches").join(partners(spark, sf_dir), "iuv_prefix")
    estimate = joins.merge_sketches(stored, ["id_intermediario_pa", "organization_fiscal_code"], "estimate")
    both = q_partner_distinct(spark, sf_dir).join(estimate, ["id_intermediario_pa", "organization_fiscal_code"], "full")
    off = F.abs(F.col("estimate") - F.col("num_posizioni")) <= 5 * joins.SKETCH_ERROR * F.col("num_posizioni")
    return both.select("id_intermediario_pa", "organization_fiscal_code", "num_posizioni",
                       F.coalesce(off, F.lit(False)).alias("estimate_holds"))


def q_top10_partners(spark, sf_dir):
    return windows.top_n(position_counts(spark, sf_dir), [F.desc("num_posizioni"), F.asc("id_intermediario_pa")], 10)


def q_top2_orgs(spark, sf_dir):
    return windows.top_k_per_group(q_partner_distinct(spark, sf_dir), ["id_intermediario_pa"],
                                   [F.desc("num_posizioni"), F.asc("organization_fiscal_code")], 2, "rank")


def service_totals(spark, sf_dir, weighted):
    """Transfer amounts per (partner, category), summed per prefix before
    the registry is joined. ``weighted`` multiplies by the registry rows of
    the prefix and partner, as the source's fan-out does."""
    final, t_ok = final_options(spark, sf_dir)
    # every final option has a qualifying transfer, so the source's left join is an inner one
    sums = final.select("po_id", "iuv_prefix").join(t_ok, F.col("po_id") == t_ok.payment_option_id).groupBy(
        "iuv_prefix", "category").agg(F.sum("amount").alias("amount"))
    times = F.col("n_rows") if weighted else F.lit(1)
    return sums.join(partners(spark, sf_dir), "iuv_prefix").groupBy("id_intermediario_pa", "category").agg(
        F.sum(F.col("amount") * times).alias("totale_importi"))


def q_service_amounts(spark, sf_dir):
    return service_totals(spark, sf_dir, weighted=True)


def q_service_amounts_dedup(spark, sf_dir):
    """D4 corrected: each transfer counted once per partner, however many
    registry rows share its IUV prefix (the faithful version multiplies)."""
    return service_totals(spark, sf_dir, weighted=False)


def q_top3_services(spark, sf_dir):
    return windows.top_k_per_group(service_totals(spark, sf_dir, weighted=True), ["id_intermediario_pa"],
                                   [F.desc("totale_importi"), F.asc_nulls_last("category")], 3, "rank")


QUERIES = {
    "cdc_unwrap": q_cdc_unwrap,
    "like_wild": q_like_wild,
    "like_escaped": q_like_escaped,
    "in_list": q_in_list,
    "rlike_filter": q_rlike_filter,
    "position_option_transfer": q_position_option_transfer,
    "semi_waterfall": q_semi_waterfall,
    "partner_join": q_partner_join,
    "partner_join_domain": q_partner_join_domain,
    "partner_distinct": q_partner_distinct,
    "partner_distinct_sketch": q_partner_distinct_sketch,
    "top10_partners": q_top10_partners,
    "top2_orgs": q_top2_orgs,
    "service_amounts": q_service_amounts,
    "service_amounts_dedup": q_service_amounts_dedup,
    "top3_services": q_top3_services,
}

_FX = ("payment_position", "payment_option", "transfer", "partner_report")
_CORE = f"""
pp AS (SELECT id AS pp_id, iupd, status, organization_fiscal_code FROM payment_position),
po AS (SELECT id AS po_id, payment_position_id, iuv FROM payment_option),
t AS (SELECT payment_option_id, category, amount FROM transfer),
t_ok AS (SELECT * FROM t WHERE regexp_matches(category, '{CATEGORY_PATTERN}')),
po_cand AS (SELECT * FROM po WHERE po_id IN (SELECT payment_option_id FROM t_ok)),
pp_final AS (SELECT * FROM pp WHERE NOT iupd LIKE 'ACA_%' AND status IN ('VALID', 'PARTIALLY_PAID')
  AND pp_id IN (SELECT payment_position_id FROM po_cand)),
po_final AS (SELECT * FROM po_cand WHERE payment_position_id IN (SELECT pp_id FROM pp_final)),
t_final AS (SELECT * FROM t_ok WHERE payment_option_id IN (SELECT po_id FROM po_final)),
core AS (SELECT r.id_intermediario_pa, r.id_dominio, po.po_id, po.iuv, pp.pp_id, pp.iupd, pp.organization_fiscal_code
  FROM po_final po JOIN partner_report r ON substr(po.iuv, 1, 2) = lpad(cast(r.segregazione AS VARCHAR), 2, '0')
  JOIN pp_final pp ON po.payment_position_id = pp.pp_id),
org_counts AS (SELECT id_intermediario_pa, organization_fiscal_code, count(DISTINCT iupd) AS num_posizioni FROM core GROUP BY ALL),
svc AS (SELECT id_intermediario_pa, category, cast(sum(amount) AS BIGINT) AS totale_importi
  FROM core LEFT JOIN t_final ON core.po_id = t_final.payment_option_id GROUP BY ALL)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CORE} {sql}", *_FX)


ORACLE = {
    "cdc_unwrap": _o("SELECT * FROM pp"),
    "like_wild": _o("SELECT pp_id, iupd FROM pp WHERE NOT iupd LIKE 'ACA_%'"),
    "like_escaped": _o("SELECT pp_id, iupd FROM pp WHERE NOT iupd LIKE 'ACA\\_%' ESCAPE '\\'"),
    "in_list": _o("SELECT pp_id, status FROM pp WHERE status IN ('VALID', 'PARTIALLY_PAID')"),
    "rlike_filter": _o("SELECT * FROM t_ok"),
    "position_option_transfer": _o(
        "SELECT pp.pp_id, pp.iupd, po.po_id, po.iuv, t.category, t.amount FROM pp "
        "JOIN po ON pp.pp_id = po.payment_position_id JOIN t ON t.payment_option_id = po.po_id"),
    "semi_waterfall": _o(
        "SELECT 'pp' AS level, pp_id AS id FROM pp_final UNION ALL SELECT 'po', po_id FROM po_final "
        "UNION ALL SELECT 't', payment_option_id FROM t_final"),
    "partner_join": _o("SELECT * FROM core"),
    "partner_join_domain": _o("SELECT * FROM core WHERE id_dominio = organization_fiscal_code"),
    "partner_distinct": _o("SELECT * FROM org_counts"),
    "partner_distinct_sketch": _o("SELECT *, TRUE AS estimate_holds FROM org_counts"),
    "top10_partners": _o(
        "SELECT id_intermediario_pa, count(DISTINCT iupd) AS num_posizioni FROM core GROUP BY 1 "
        "ORDER BY num_posizioni DESC, id_intermediario_pa LIMIT 10"),
    "top2_orgs": _o(
        "SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY id_intermediario_pa "
        "ORDER BY num_posizioni DESC, organization_fiscal_code) AS INTEGER) AS rank FROM org_counts) WHERE rank <= 2"),
    "service_amounts": _o("SELECT * FROM svc"),
    "service_amounts_dedup": _o(
        "SELECT p.id_intermediario_pa, t.category, cast(sum(t.amount) AS BIGINT) AS totale_importi FROM "
        "(SELECT DISTINCT id_intermediario_pa, po_id FROM core) p JOIN t_final t ON p.po_id = t.payment_option_id "
        "GROUP BY ALL"),
    "top3_services": _o(
        "SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY id_intermediario_pa "
        "ORDER BY totale_importi DESC, category NULLS LAST) AS INTEGER) AS rank FROM svc) WHERE rank <= 3"),
}
