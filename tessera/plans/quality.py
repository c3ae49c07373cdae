"""Debt-position data-quality report as one lazy plan.

Base rows: open positions of the analysed window ⋈ options ⋈ transfers, with
the taxonomy registry as the semantic reference. Report rows are the only
thing that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import predicates, quality, windows
from ..operators.predicates import epoch_micros
from ..sources.fixtures import fixture, with_fixtures

WINDOW = ("1993-03-02 00:00:01", "1997-04-10 00:00:00")
AS_OF = "1996-01-01 00:00:00"
AS_OF_US = epoch_micros(AS_OF)
LO_US, HI_US = epoch_micros(WINDOW[0]), epoch_micros(WINDOW[1])


def base(spark, sf_dir):
    pp = fixture(spark, sf_dir, "payment_position")
    pp = predicates.epoch_range(pp.where(F.col("inserted_date").isNotNull()), "inserted_date", *WINDOW)
    pp = predicates.prefix_filter(pp.where(F.col("status") == "VALID"), "iupd", "ACA_", negate=True, escaped=True)
    pp = predicates.in_list(pp, "service_type", ["GPD", "ACA"])
    po = fixture(spark, sf_dir, "payment_option")
    t = fixture(spark, sf_dir, "transfer")
    j = pp.select("id", "iupd", "company_name").join(
        po.select(F.col("id").alias("po_id"), "payment_position_id", "description", "due_date"),
        F.col("id") == F.col("payment_position_id"))
    j = j.join(t.select("payment_option_id", "category"), F.col("payment_option_id") == F.col("po_id"))
    return j.select("category", "description", "id", "iupd", "due_date", "company_name")


def codes(spark, sf_dir):
    return quality.registry_codes(fixture(spark, sf_dir, "taxonomy"), "code")


def flags(spark, sf_dir):
    return quality.taxonomy_flags(base(spark, sf_dir), "category", codes(spark, sf_dir))


def q_epoch_range(spark, sf_dir):
    pp = fixture(spark, sf_dir, "payment_position")
    return predicates.epoch_range(pp, "inserted_date", *WINDOW).select("id", "inserted_date")


def q_taxonomy_flags(spark, sf_dir):
    return flags(spark, sf_dir).select("id", "category", "category_clean", "is_syntax_correct",
                                       "is_secondary_syntax", "is_semantically_correct", "is_specific_prefix")


def q_taxonomy_legacy(spark, sf_dir):
    t = fixture(spark, sf_dir, "transfer")
    return quality.taxonomy_legacy(t, "category").select("payment_option_id", "category", "valid_taxonomy")


def q_semantic_flag(spark, sf_dir):
    from ..functions.columns import clean_code
    from ..operators.joins import membership_flag

    t = fixture(spark, sf_dir, "transfer").select("payment_option_id", clean_code("category").alias("code_clean"))
    return membership_flag(t, "code_clean", codes(spark, sf_dir), "code", "is_semantically_correct")


def q_taxonomy_totals(spark, sf_dir):
    return quality.taxonomy_totals(flags(spark, sf_dir))


def q_company_quality(spark, sf_dir):
    return quality.company_quality(flags(spark, sf_dir))


def q_company_quality_valid(spark, sf_dir):
    return quality.company_quality(flags(spark, sf_dir), valid_only=True)


def q_top50_companies(spark, sf_dir):
    stats = quality.company_quality(flags(spark, sf_dir))
    return windows.top_n(stats, [F.desc("total"), F.asc("company_name")], 50)


def q_company_codes(spark, sf_dir):
    return quality.company_codes(flags(spark, sf_dir))


def q_length_histogram(spark, sf_dir):
    return quality.length_histogram(base(spark, sf_dir), "description")


def q_length_histogram_contiguous(spark, sf_dir):
    """D11 with the bin gaps closed (every positive length in exactly one bin)."""
    return quality.length_histogram(base(spark, sf_dir), "description", contiguous=True)


def _horizon(preset):
    def q(spark, sf_dir):
        return quality.horizon_clusters(base(spark, sf_dir), "due_date", AS_OF_US, preset)
    return q


def q_horizon_13(spark, sf_dir):
    return quality.horizon_split(base(spark, sf_dir), "due_date", AS_OF_US)


def q_horizon_control(spark, sf_dir):
    return quality.horizon_control(base(spark, sf_dir), "due_date", AS_OF_US)


def q_due_year_hist(spark, sf_dir):
    return quality.year_distribution(base(spark, sf_dir), "due_date")


def q_due_year_outliers(spark, sf_dir):
    return quality.year_outlier_companies(base(spark, sf_dir), "due_date")


def q_date_counts(spark, sf_dir):
    return quality.date_counts(base(spark, sf_dir), "due_date", AS_OF_US)


def q_top_company_per_cluster(spark, sf_dir):
    return quality.top_companies_per_cluster(base(spark, sf_dir), "due_date", AS_OF_US)


def q_case_examples(spark, sf_dir):
    return quality.case_examples(flags(spark, sf_dir)).withColumnRenamed("case", "quality_case")


def q_case_examples_company(spark, sf_dir):
    named = flags(spark, sf_dir).where(F.col("company_name").isNotNull())
    return quality.case_examples(named, ["company_name"]).withColumnRenamed("case", "quality_case")


def q_date_counts_future(spark, sf_dir):
    return quality.date_counts_by_cluster(base(spark, sf_dir), "due_date", AS_OF_US)


QUERIES = {
    "case_examples_company": q_case_examples_company,
    "date_counts_future": q_date_counts_future,
    "epoch_range": q_epoch_range,
    "taxonomy_flags": q_taxonomy_flags,
    "taxonomy_legacy": q_taxonomy_legacy,
    "semantic_flag": q_semantic_flag,
    "taxonomy_totals": q_taxonomy_totals,
    "company_quality": q_company_quality,
    "company_quality_valid": q_company_quality_valid,
    "top50_companies": q_top50_companies,
    "company_codes": q_company_codes,
    "length_histogram": q_length_histogram,
    "length_histogram_contiguous": q_length_histogram_contiguous,
    "horizon_4": _horizon("h4"),
    "horizon_6": _horizon("h6"),
    "horizon_6_vec": _horizon("h6_vec"),
    "horizon_13": q_horizon_13,
    "horizon_control": q_horizon_control,
    "due_year_hist": q_due_year_hist,
    "due_year_outliers": q_due_year_outliers,
    "date_counts": q_date_counts,
    "top_company_per_cluster": q_top_company_per_cluster,
    "case_examples": q_case_examples,
}

# ---------------------------------------------------------------- DuckDB oracle
_FX = ("payment_position", "payment_option", "transfer", "taxonomy")
_CLEAN = "regexp_replace(replace(coalesce(category, 'None'), '\"', ''), '^\\s+|\\s+$', '', 'g')"
_YEARS = "((due_date - {as_of}) / cast(1000000 AS DOUBLE) / cast({days} * 86400 AS DOUBLE))"
_CTES = f"""
base AS (SELECT t.category, po.description, pp.id, pp.iupd, po.due_date, pp.company_name
  FROM payment_position pp JOIN payment_option po ON pp.id = po.payment_position_id
  JOIN transfer t ON t.payment_option_id = po.id
  WHERE pp.inserted_date IS NOT NULL AND pp.inserted_date BETWEEN {LO_US} AND {HI_US} AND pp.status = 'VALID'
    AND NOT pp.iupd LIKE 'ACA\\_%' ESCAPE '\\' AND pp.service_type IN ('GPD', 'ACA')),
codes AS (SELECT DISTINCT trim(replace(code, '"', '')) AS code FROM taxonomy
  WHERE regexp_matches(trim(replace(code, '"', '')), '{quality.TAXONOMY_REGISTRY_PREFIX}')),
cleaned AS (SELECT *, {_CLEAN} AS category_clean FROM base),
flags AS (SELECT *, regexp_matches(category_clean, '{quality.TAXONOMY_PRIMARY}') AS is_syntax_correct,
  regexp_matches(category_clean, '{quality.TAXONOMY_SECONDARY}') AS is_secondary_syntax,
  category_clean IN (SELECT code FROM codes) AS is_semantically_correct,
  category_clean IN (SELECT code FROM codes) AND regexp_matches(category_clean, '{quality.TAXONOMY_SPECIFIC_PREFIX}')
    AS is_specific_prefix FROM cleaned),
stats AS (SELECT company_name, count_if(is_syntax_correct) AS syntax_ok, count_if(is_secondary_syntax) AS syntax_alt,
  count_if(is_semantically_correct) AS semantic_ok, count_if(is_specific_prefix) AS prefix_678, count(category) AS total
  FROM flags WHERE company_name IS NOT NULL GROUP BY 1)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CTES} {sql}", *_FX)


def _bucket_sql(label_expr, labels, den_expr="count(*)", where="TRUE"):
    arms = " UNION ALL ".join(f"SELECT {i} AS bucket_order, '{lbl}' AS bucket" for i, lbl in enumerate(labels))
    return (f"SELECT l.bucket_order, l.bucket, coalesce(c.n, 0) AS n, "
            f"CASE WHEN d.den > 0 THEN coalesce(c.n, 0) / d.den * 100 END AS pct "
            f"FROM ({arms}) l LEFT JOIN (SELECT {label_expr} AS bucket, count(*) AS n FROM base WHERE {where} GROUP BY 1) c "
            f"USING (bucket), (SELECT {den_expr} AS den FROM base) d")


def _len_label(bins=quality.LENGTH_BINS):
    parts = []
    for lbl, lo, hi in bins:
        cond = f"length(description) > {lo}" + ("" if hi is None else f" AND length(description) <= {hi}")
        parts.append(f"WHEN {cond} THEN '{lbl}'")
    return "CASE " + " ".join(parts) + " END"


def _horizon_label(preset, usable=None):
    buckets, days, rule = quality.HORIZON_PRESETS[preset]
    y = _YEARS.format(as_of=AS_OF_US, days=days)
    parts, lo = [], 0.0
    for name, hi in buckets:
        if rule == "le_first":
            cond = "TRUE" if hi is None else f"{y} <= {float(hi)}"
        elif rule == "open_closed":
            cond = f"{y} > {lo}" if hi is None else f"{y} > {lo} AND {y} <= {float(hi)}"
        else:
            cond = "TRUE" if hi is None else f"{y} < {float(hi)}"
        parts.append(f"WHEN {cond} THEN '{name}'")
        lo = float(hi) if hi is not None else lo
    usable = usable or "due_date IS NOT NULL"
    return f"CASE WHEN {usable} THEN CASE {' '.join(parts)} END END"


def _horizon_oracle(preset):
    names = [b[0] for b in quality.HORIZON_PRESETS[preset][0]]
    return _o(_bucket_sql(_horizon_label(preset), names))


_H13_NAMES = [b[0] for b in quality.HORIZON_PRESETS["h13"][0]]
_APPROX_YEAR = "cast(trunc(1970.0 + due_date / cast(1000000 AS DOUBLE) / cast(365.25 * 86400 AS DOUBLE)) AS INTEGER)"

ORACLE = {
    "epoch_range": with_fixtures(
        f"SELECT id, inserted_date FROM payment_position WHERE inserted_date BETWEEN {LO_US} AND {HI_US}",
        "payment_position"),
    "taxonomy_flags": _o("SELECT id, category, category_clean, is_syntax_correct, is_secondary_syntax, "
                         "is_semantically_correct, is_specific_prefix FROM flags"),
    "taxonomy_legacy": with_fixtures(
        f"SELECT payment_option_id, category, coalesce(regexp_matches(category, '{quality.TAXONOMY_LEGACY}'), FALSE) "
        f"AS valid_taxonomy FROM transfer", "transfer"),
    "semantic_flag": _o(f"SELECT payment_option_id, {_CLEAN} AS code_clean, {_CLEAN} IN (SELECT code FROM codes) "
                        f"AS is_semantically_correct FROM transfer"),
    "taxonomy_totals": _o(
        "SELECT total, syntax_ok, total - syntax_ok AS syntax_ko, recoverable, total - syntax_ok - recoverable "
        "AS unrecoverable, semantic_ok, prefix_ok, CASE WHEN total - syntax_ok > 0 THEN "
        "cast((20000 * recoverable + (total - syntax_ok)) // (2 * (total - syntax_ok)) AS DOUBLE) / 100 END "
        "AS pct_recoverable FROM (SELECT count(*) AS total, count_if(is_syntax_correct) AS syntax_ok, "
        "count_if(NOT is_syntax_correct AND is_secondary_syntax) AS recoverable, "
        "count_if(is_semantically_correct) AS semantic_ok, count_if(is_specific_prefix) AS prefix_ok FROM flags)"),
    "company_quality": _o(
        "SELECT company_name, syntax_ok, total - syntax_ok AS syntax_ko, syntax_alt, semantic_ok, prefix_678, "
        "coalesce(CASE WHEN semantic_ok <> 0 THEN prefix_678 / semantic_ok END, 0.0) * 100 AS pct_prefix_678, total "
        "FROM stats"),
    "company_quality_valid": _o(
        "SELECT company_name, count_if(is_syntax_correct) AS syntax_ok, count_if(is_semantically_correct) AS semantic_ok, "
        "count_if(is_specific_prefix) AS prefix_678, coalesce(CASE WHEN count_if(is_semantically_correct) <> 0 THEN "
        "count_if(is_specific_prefix) / count_if(is_semantically_correct) END, 0.0) * 100 AS pct_prefix_678 "
        "FROM flags WHERE company_name IS NOT NULL AND is_semantically_correct GROUP BY 1"),
    "top50_companies": _o(
        "SELECT company_name, syntax_ok, total - syntax_ok AS syntax_ko, syntax_alt, semantic_ok, prefix_678, "
        "coalesce(CASE WHEN semantic_ok <> 0 THEN prefix_678 / semantic_ok END, 0.0) * 100 AS pct_prefix_678, total "
        "FROM stats ORDER BY total DESC, company_name LIMIT 50"),
    "company_codes": _o(
        "SELECT company_name, category_clean, occurrences, cast(sum(occurrences) OVER (PARTITION BY company_name) "
        "AS BIGINT) AS company_records, count(*) OVER (PARTITION BY company_name) AS company_distinct_codes FROM "
        "(SELECT company_name, category_clean, count(*) AS occurrences FROM flags WHERE is_specific_prefix GROUP BY ALL)"),
    "length_histogram": _o(_bucket_sql(_len_label(), [b[0] for b in quality.LENGTH_BINS])),
    "length_histogram_contiguous": _o(_bucket_sql(_len_label(quality.LENGTH_BINS_CONTIGUOUS),
                                                  [b[0] for b in quality.LENGTH_BINS_CONTIGUOUS])),
    "horizon_4": _horizon_oracle("h4"),
    "horizon_6": _horizon_oracle("h6"),
    "horizon_6_vec": _horizon_oracle("h6_vec"),
    "horizon_13": _o(_bucket_sql(_horizon_label("h13", f"due_date > {AS_OF_US}"), _H13_NAMES,
                                 den_expr=f"count_if(due_date > {AS_OF_US})")),
    "horizon_control": _o(
        f"SELECT initial_valid, future, past_or_today, errors, future + past_or_today + errors AS check_sum, "
        f"future + past_or_today + errors = initial_valid AS check_ok FROM (SELECT count(due_date) AS initial_valid, "
        f"count_if(due_date > {AS_OF_US}) AS future, count_if(due_date <= {AS_OF_US}) AS past_or_today, "
        f"cast(0 AS BIGINT) AS errors FROM base)"),
    "due_year_hist": _o(
        f"SELECT {_APPROX_YEAR} AS approx_year, count(*) AS n, {_APPROX_YEAR} BETWEEN {quality.YEAR_LO} AND "
        f"{quality.YEAR_HI} AS in_range FROM base WHERE due_date IS NOT NULL GROUP BY 1"),
    "due_year_outliers": _o(
        f"SELECT company_name, count(*) AS n FROM base WHERE due_date IS NOT NULL AND NOT ({_APPROX_YEAR} BETWEEN "
        f"{quality.YEAR_LO} AND {quality.YEAR_HI}) AND company_name IS NOT NULL GROUP BY 1 "
        f"ORDER BY n DESC, company_name LIMIT 20"),
    "date_counts": _o(
        f"SELECT strftime(d, '%d/%m/%Y') AS data, conteggio FROM (SELECT cast(make_timestamp(due_date) AS DATE) AS d, "
        f"count(*) AS conteggio FROM base WHERE due_date <= {AS_OF_US} GROUP BY 1)"),
    "top_company_per_cluster": _o(
        f"SELECT cluster, company_name, n, cast(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY cluster ORDER BY n DESC, company_name) AS rank FROM (SELECT {_horizon_label('h6_vec')} AS cluster, "
        f"company_name, count(*) AS n FROM base WHERE company_name IS NOT NULL GROUP BY ALL) WHERE cluster IS NOT NULL) "
        f"WHERE rank <= 50"),
    "date_counts_future": _o(
        f"SELECT cluster, strftime(d, '%d/%m/%Y') AS data, conteggio FROM (SELECT {_horizon_label('h6_vec')} AS cluster, "
        f"cast(make_timestamp(due_date) AS DATE) AS d, count(*) AS conteggio FROM base WHERE due_date > {AS_OF_US} GROUP BY 1, 2)"),
    "case_examples_company": _o(
        "SELECT company_name, quality_case, category, id, iupd FROM (SELECT *, row_number() OVER (PARTITION BY company_name, quality_case "
        "ORDER BY id, category_clean) AS rn FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS quality_case, * FROM flags WHERE company_name IS NOT NULL AND "
            + ("NOT is_syntax_correct" if flag == "is_syntax_wrong" else flag)
            for name, flag in quality.QUALITY_CASES)
        + ")) WHERE rn = 1"),
    "case_examples": _o(
        "SELECT quality_case, category, id, iupd FROM (SELECT *, row_number() OVER (PARTITION BY quality_case "
        "ORDER BY id, category_clean) AS rn FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS quality_case, * FROM flags WHERE "
            + ("NOT is_syntax_correct" if flag == "is_syntax_wrong" else flag)
            for name, flag in quality.QUALITY_CASES)
        + ")) WHERE rn = 1"),
}
