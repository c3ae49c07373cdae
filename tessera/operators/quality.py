"""Data-quality operators: taxonomy codes, text lengths, due-date horizons.

Everything is a native expression or a small aggregation. Per-bucket reports
are one global aggregate holding a ``count_if`` per fixed label (partial
aggregation in every task, one tiny final merge), unpacked into one row per
label so empty buckets still appear. Only report rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clean_code, from_epoch_us, percent_half_up, years_to
from .joins import membership_flag
from .windows import first_example, top_k_per_group

# ---------------------------------------------------------------- fixed values
# Taxonomy code syntax (must equal the source's patterns).
TAXONOMY_PRIMARY = r"^(9|6|7|8)/\d{7}(IM|TS|SP|SA|AP)/?$"
TAXONOMY_SECONDARY = r"^\d{7}(IM|TS|SP|SA|AP)$"
TAXONOMY_SPECIFIC_PREFIX = r"^[6-8]/"
TAXONOMY_REGISTRY_PREFIX = r"^[6-9]/"
TAXONOMY_LEGACY = r"^\d{1,2}/?\d{2}\d{2}\d{3}(IM|TS|SP|SA|AP)/?$"

# Description-length bins: (label, low, high) meaning low < length <= high.
LENGTH_BINS = (
    ("> 1 e <= 30 car.", 1, 30),
    ("> 30 e <= 50 car.", 31, 50),
    ("> 50 e <= 70 car.", 51, 70),
    ("> 70 e <= 100 car.", 71, 100),
    ("> 100 e <= 140 car.", 101, 140),
    ("> 140 car.", 141, None),
)
# Contiguous variant: every positive length falls in exactly one bin.
LENGTH_BINS_CONTIGUOUS = (
    ("> 1 e <= 30 car.", 0, 30),
    ("> 30 e <= 50 car.", 30, 50),
    ("> 50 e <= 70 car.", 50, 70),
    ("> 70 e <= 100 car.", 70, 100),
    ("> 100 e <= 140 car.", 100, 140),
    ("> 140 car.", 140, None),
)

# Horizon presets: (labels with upper edges in years, year length in days,
# edge rule, past handling).
#   "le_first": first bucket whose edge >= years (past lands in the first bucket)
#   "open_closed": lo < years <= hi, lower edge of first bucket is 0 (past dropped)
#   "closed_open": lo <= years < hi (past lands in the first bucket)
HORIZON_PRESETS = {
    "h4": ((("Entro 10 anni", 10), ("Tra 10 e 20 anni", 20), ("Tra 20 e 30 anni", 30),
            ("Oltre 30 anni", None)), 365.0, "le_first"),
    "h6": ((("Entro 1 anno", 1), ("Tra 1 e 2 anni", 2), ("Tra 2 e 10 anni", 10), ("Tra 10 e 20 anni", 20),
            ("Tra 20 e 30 anni", 30), ("Oltre 30 anni", None)), 365.0, "open_closed"),
    "h6_vec": ((("Entro 1 anno", 1), ("Tra 1 e 2 anni", 2), ("Tra 2 e 10 anni", 10), ("Tra 10 e 20 anni", 20),
                ("Tra 20 e 30 anni", 30), ("Oltre 30 anni", None)), 365.0, "closed_open"),
    "h13": ((("Entro 1 anno", 1), ("Entro 2 anni", 2), ("Entro 3 anni", 3), ("Entro 4 anni", 4),
             ("Entro 5 anni", 5), ("Entro 6 anni", 6), ("Entro 7 anni", 7), ("Entro 8 anni", 8),
             ("Entro 9 anni", 9), ("Entro 10 anni", 10), ("Entro 20 anni", 20), ("Entro 30 anni", 30),
             ("Oltre 30 anni", None)), 365.25, "le_first"),
}
# Pandas' datetime range: seconds outside were dropped by the source's vectorised report.
PANDAS_SECONDS_LIMIT = 9.2e9
YEAR_LO, YEAR_HI = 2000, 2100

QUALITY_CASES = (
    ("Sintassi OK", "is_syntax_correct"),
    ("Sintassi Errata", "is_syntax_wrong"),
    ("Sintassi Alt.", "is_secondary_syntax"),
    ("Semantica OK", "is_semantically_correct"),
    ("Prefisso 6/7/8", "is_specific_prefix"),
)
# ------------------------------------------------------------------------------


def registry_codes(df: DataFrame, col: str, pattern: str = TAXONOMY_REGISTRY_PREFIX) -> DataFrame:
    """Distinct valid codes of a registry column (quotes and blanks removed)."""
    clean = F.trim(F.regexp_replace(F.col(col), '"', ""))
    return df.select(clean.alias("code")).where(F.col("code").rlike(pattern)).distinct()


def taxonomy_flags(df: DataFrame, col: str, codes: DataFrame) -> DataFrame:
    """H3/H4/C14: cleaned code plus syntax, alternative-syntax, semantic and prefix flags."""
    flagged = df.withColumn("category_clean", clean_code(col))
    flagged = membership_flag(flagged, "category_clean", codes, "code", "is_semantically_correct")
    return (
        flagged.withColumn("is_syntax_correct", F.col("category_clean").rlike(TAXONOMY_PRIMARY))
        .withColumn("is_secondary_syntax", F.col("category_clean").rlike(TAXONOMY_SECONDARY))
        .withColumn("is_specific_prefix",
                    F.col("is_semantically_correct") & F.col("category_clean").rlike(TAXONOMY_SPECIFIC_PREFIX))
    )


def taxonomy_legacy(df: DataFrame, col: str) -> DataFrame:
    """H4 legacy check: full match of the older pattern; null → invalid."""
    return df.withColumn("valid_taxonomy", F.coalesce(F.col(col).rlike(TAXONOMY_LEGACY), F.lit(False)))


def taxonomy_totals(flags: DataFrame) -> DataFrame:
    """One row of totals; recoverable = alternative syntax among syntax failures."""
    agg = flags.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_syntax_correct").alias("syntax_ok"),
        F.count_if(~F.col("is_syntax_correct") & F.col("is_secondary_syntax")).alias("recoverable"),
        F.count_if("is_semantically_correct").alias("semantic_ok"),
        F.count_if("is_specific_prefix").alias("prefix_ok"),
    )
    return agg.select(
        "total", "syntax_ok", (F.col("total") - F.col("syntax_ok")).alias("syntax_ko"), "recoverable",
        (F.col("total") - F.col("syntax_ok") - F.col("recoverable")).alias("unrecoverable"),
        "semantic_ok", "prefix_ok",
        percent_half_up("recoverable", F.col("total") - F.col("syntax_ok")).alias("pct_recoverable"),
    )


def company_quality(flags: DataFrame, valid_only: bool = False) -> DataFrame:
    """Per-company flag sums (null company dropped); % prefix over semantic (0/0 → 0)."""
    src = flags.where(F.col("company_name").isNotNull())
    if valid_only:
        src = src.where("is_semantically_correct")
    stats = src.groupBy("company_name").agg(
        F.count_if("is_syntax_correct").alias("syntax_ok"),
        F.count_if("is_secondary_syntax").alias("syntax_alt"),
        F.count_if("is_semantically_correct").alias("semantic_ok"),
        F.count_if("is_specific_prefix").alias("prefix_678"),
        F.count("category").alias("total"),
    )
    pct = F.coalesce(F.try_divide(F.col("prefix_678"), F.col("semantic_ok")), F.lit(0.0)) * F.lit(100)
    if valid_only:
        return stats.select("company_name", "syntax_ok", "semantic_ok", "prefix_678", pct.alias("pct_prefix_678"))
    return stats.select("company_name", "syntax_ok", (F.col("total") - F.col("syntax_ok")).alias("syntax_ko"),
                        "syntax_alt", "semantic_ok", "prefix_678", pct.alias("pct_prefix_678"), "total")


def company_codes(flags: DataFrame) -> DataFrame:
    """Occurrences per (company, specific-prefix code) with company totals.

    The window runs over the already aggregated (company, code) rows, whose
    count per company is bounded by the registry size."""
    detail = (flags.where("is_specific_prefix").groupBy("company_name", "category_clean")
              .agg(F.count(F.lit(1)).alias("occurrences")))
    w = Window.partitionBy("company_name")
    return detail.select("company_name", "category_clean", "occurrences",
                         F.sum("occurrences").over(w).alias("company_records"),
                         F.count(F.lit(1)).over(w).alias("company_distinct_codes"))


def _bucket_report(df: DataFrame, label: Column, labels: Sequence[str], denominator: Column | None) -> DataFrame:
    """Counts per bucket label (every label present, in order) and % of the
    ``denominator`` (default: all rows). One partial+final aggregate, then the
    one-row result is unpacked into one row per label."""
    buckets = F.array(*[
        F.struct(F.lit(i).alias("bucket_order"), F.lit(lbl).alias("bucket"),
                 F.count_if(label == F.lit(lbl)).cast("bigint").alias("n"))
        for i, lbl in enumerate(labels)
    ])
    den = denominator if denominator is not None else F.count(F.lit(1))
    counted = df.agg(buckets.alias("_b"), den.alias("_den"))
    rows = counted.select(F.inline("_b"), "_den")
    return rows.select("bucket_order", "bucket", "n",
                       F.when(F.col("_den") > 0, F.col("n") / F.col("_den") * F.lit(100)).alias("pct"))


def length_histogram(df: DataFrame, col: str, contiguous: bool = False) -> DataFrame:
    """Labelled description-length bins, % of all rows (nulls included)."""
    bins = LENGTH_BINS_CONTIGUOUS if contiguous else LENGTH_BINS
    length = F.length(F.col(col))
    label = None
    for lbl, lo, hi in bins:
        cond = length > lo if hi is None else (length > lo) & (length <= hi)
        label = F.when(cond, F.lit(lbl)) if label is None else label.when(cond, F.lit(lbl))
    return _bucket_report(df, label, [b[0] for b in bins], None)


def horizon_label(years: Column, preset: str) -> Column:
    buckets, _, rule = HORIZON_PRESETS[preset]
    label = None
    lo = 0.0
    for name, hi in buckets:
        if rule == "le_first":
            cond = F.lit(True) if hi is None else years <= F.lit(float(hi))
        elif rule == "open_closed":
            cond = years > F.lit(lo) if hi is None else (years > F.lit(lo)) & (years <= F.lit(float(hi)))
        else:  # closed_open, past in the first bucket
            cond = F.lit(True) if hi is None else years < F.lit(float(hi))
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
        lo = float(hi) if hi is not None else lo
    return label


def horizon_years(col: str, as_of_us: int, preset: str) -> Column:
    return years_to(col, as_of_us, HORIZON_PRESETS[preset][1])


def with_horizon(df: DataFrame, col: str, as_of_us: int, preset: str, limit_seconds: float | None = None) -> DataFrame:
    """Bucket label per row (null when the date is null or dropped by the rule).
    ``limit_seconds`` drops dates further from 1970 than that
    (``PANDAS_SECONDS_LIMIT`` reproduces the source's vectorised report)."""
    usable = F.col(col).isNotNull()
    if limit_seconds is not None:
        usable = usable & (F.col(col) / F.lit(1_000_000.0)).between(-limit_seconds, limit_seconds)
    label = F.when(usable, horizon_label(horizon_years(col, as_of_us, preset), preset))
    return df.withColumn("cluster", label)


def horizon_clusters(df: DataFrame, col: str, as_of_us: int, preset: str, limit_seconds: float | None = None) -> DataFrame:
    """Counts per horizon bucket and % of all rows (null dates included)."""
    labelled = with_horizon(df, col, as_of_us, preset, limit_seconds)
    names = [b[0] for b in HORIZON_PRESETS[preset][0]]
    return _bucket_report(labelled, F.col("cluster"), names, None)


def horizon_split(df: DataFrame, col: str, as_of_us: int) -> DataFrame:
    """Future dates in 13 buckets (365.25-day years), % of future rows."""
    future = F.col(col) > F.lit(as_of_us)
    labelled = df.withColumn("cluster", F.when(future, horizon_label(horizon_years(col, as_of_us, "h13"), "h13")))
    names = [b[0] for b in HORIZON_PRESETS["h13"][0]]
    return _bucket_report(labelled, F.col("cluster"), names, F.count_if(future))


def horizon_control(df: DataFrame, col: str, as_of_us: int) -> DataFrame:
    """D13 control sum: future + past/today + errors must equal non-null input."""
    agg = df.agg(
        F.count(col).alias("initial_valid"),
        F.count_if(F.col(col) > F.lit(as_of_us)).alias("future"),
        F.count_if(F.col(col) <= F.lit(as_of_us)).alias("past_or_today"),
        F.lit(0).cast("bigint").alias("errors"),
    )
    total = F.col("future") + F.col("past_or_today") + F.col("errors")
    return agg.select("*", total.alias("check_sum"), (total == F.col("initial_valid")).alias("check_ok"))


def approx_year(col: str) -> Column:
    """int(1970 + seconds / (365.25 days)), truncated toward zero."""
    return (F.lit(1970.0) + F.col(col) / F.lit(1_000_000.0) / F.lit(365.25 * 86400)).cast("int")


def year_distribution(df: DataFrame, col: str) -> DataFrame:
    """Records per approximate year, flagged in or out of [2000, 2100]."""
    yr = approx_year(col)
    return (df.where(F.col(col).isNotNull()).groupBy(yr.alias("approx_year")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("in_range", F.col("approx_year").between(YEAR_LO, YEAR_HI)))


def year_outlier_companies(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """Top companies among records whose approximate year is out of range."""
    yr = approx_year(col)
    out = df.where(F.col(col).isNotNull() & ~yr.between(YEAR_LO, YEAR_HI) & F.col("company_name").isNotNull())
    counts = out.groupBy("company_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("company_name")).limit(k)


def date_counts(df: DataFrame, col: str, as_of_us: int) -> DataFrame:
    """Past-or-today due dates per day (dd/MM/yyyy), ordered by the real date."""
    past = df.where(F.col(col) <= F.lit(as_of_us))
    day = F.to_date(from_epoch_us(col))
    counted = past.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("conteggio"))
    return counted.orderBy("_day").select(F.date_format("_day", "dd/MM/yyyy").alias("data"), "conteggio")


def top_companies_per_cluster(df: DataFrame, col: str, as_of_us: int, preset: str = "h6_vec",
                              k: int = 50, limit_seconds: float | None = None) -> DataFrame:
    """Top-k companies by record count inside every horizon bucket."""
    labelled = with_horizon(df, col, as_of_us, preset, limit_seconds).where(
        F.col("cluster").isNotNull() & F.col("company_name").isNotNull())
    counts = labelled.groupBy("cluster", "company_name").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, ["cluster"], [F.desc("n"), F.asc("company_name")], k, "rank")


def date_counts_by_cluster(df: DataFrame, col: str, as_of_us: int, preset: str = "h6_vec") -> DataFrame:
    """Future due dates per horizon bucket and day (dd/MM/yyyy), ordered by
    the real date."""
    future = with_horizon(df.where(F.col(col) > F.lit(as_of_us)), col, as_of_us, preset)
    day = F.to_date(from_epoch_us(col))
    counted = future.groupBy("cluster", day.alias("_day")).agg(F.count(F.lit(1)).alias("conteggio"))
    return counted.orderBy("_day", "cluster").select("cluster", F.date_format("_day", "dd/MM/yyyy").alias("data"), "conteggio")


def case_examples(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E5: one example per quality case, and per value of ``by`` (smallest
    position id, then code)."""
    flags = flags.withColumn("is_syntax_wrong", ~F.col("is_syntax_correct"))
    cases = F.array(*[F.when(F.col(flag), F.lit(name)) for name, flag in QUALITY_CASES])
    exploded = flags.select(F.explode(F.filter(cases, lambda x: x.isNotNull())).alias("case"),
                            "id", "iupd", "category", "category_clean", *by)
    exploded = exploded.withColumn("_order", F.struct("id", "category_clean"))
    return first_example(exploded, [*by, "case"], "_order", ["category", "id", "iupd"])
