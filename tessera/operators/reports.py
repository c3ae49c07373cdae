"""Operational report operators.

Counters are single-pass conditional aggregates (``count_if``), so a report
over the whole position table is one scan with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pad2, prefix2, to_long_or_zero

PAYABLE = ("VALID", "PARTIALLY_PAID")

# ---------------------------------------------------------------- fixed values
# Italian personal tax code: shape and check-character tables.
FISCAL_CODE_PATTERN = r"^[A-Z]{6}[0-9LMNPQRSTUV]{2}[ABCDEHLMPRST][0-9LMNPQRSTUV]{2}[A-Z][0-9LMNPQRSTUV]{3}[A-Z]$"
FISCAL_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Value of a character in an odd (1st, 3rd, ...) position, in FISCAL_ALPHABET order.
FISCAL_ODD_VALUES = (1, 0, 5, 7, 9, 13, 15, 17, 19, 21,
                     1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23)
VAT_PATTERN = r"^[0-9]{11}$"
# ------------------------------------------------------------------------------


def position_counters(pp: DataFrame) -> DataFrame:
    """Total plus conditional counts by service, status and IUPD prefix."""
    payable = F.col("status").isin(list(PAYABLE))
    svc = F.col("service_type")
    aca_prefix = F.col("iupd").like("ACA_%")
    return pp.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(svc == "GPD").alias("gpd"),
        F.count_if((svc == "GPD") & payable).alias("gpd_payable"),
        F.count_if(svc == "WISP").alias("wisp"),
        F.count_if(~aca_prefix & (svc == "ACA")).alias("gpd4aca"),
        F.count_if(~aca_prefix & (svc == "ACA") & payable).alias("aca_gpd4aca_payable"),
        F.count_if(aca_prefix & (svc == "ACA")).alias("pa_create_position"),
        F.count_if(aca_prefix & (svc == "ACA") & payable).alias("aca_gpd_create_position_payable"),
    )


def prefix_counts(po: DataFrame, pp: DataFrame, lo_us: int, hi_us: int, service: str = "ACA") -> DataFrame:
    """Options per (organisation, IUV prefix) for positions of one service
    inserted in ``[lo, hi)`` (epoch µs)."""
    pos = pp.where((F.col("service_type") == service) & (F.col("inserted_date") >= lo_us)
                   & (F.col("inserted_date") < hi_us)).select(F.col("id").alias("pp_id"))
    j = po.join(pos, po.payment_position_id == pos.pp_id, "left_semi")
    return j.groupBy("organization_fiscal_code", prefix2("iuv").alias("segregation_code")).agg(
        F.count(F.lit(1)).alias("total"))


def broker_links(brokers: DataFrame, stations: DataFrame, links: DataFrame, institutions: DataFrame) -> DataFrame:
    """Links ⋈ stations ⋈ brokers ⋈ institutions (three inner equi-joins)."""
    s = stations.select(F.col("obj_id").alias("_station"), "fk_broker", "station_id")
    b = brokers.select(F.col("obj_id").alias("_broker"), "broker_id", "broker_name")
    i = institutions.select(F.col("obj_id").alias("_pa"), F.col("id_dominio").alias("organization_fiscal_code"))
    j = links.join(s, F.col("fk_station") == F.col("_station")).join(b, F.col("fk_broker") == F.col("_broker")).join(i, F.col("fk_pa") == F.col("_pa"))
    return j.select("broker_id", "broker_name", "station_id", "organization_fiscal_code", "segregazione")


def broker_config(cfg: DataFrame) -> DataFrame:
    """Joined configuration rows with a segregation code, padded."""
    return cfg.where(F.col("segregazione").isNotNull()).select(
        "broker_id", "broker_name", "station_id", "organization_fiscal_code",
        pad2("segregazione").alias("segregation_code"))


def enrich_counts(counts: DataFrame, cfg: DataFrame) -> DataFrame:
    """Left-join counts to broker config on (organisation, segregation code)."""
    return counts.join(broker_config(cfg), ["organization_fiscal_code", "segregation_code"], "left")


def accumulate(history: DataFrame, new: DataFrame, keys: Sequence[str], total: str = "total",
               name: str = "broker_name") -> DataFrame:
    """History ∪ new, non-numeric totals → 0, rows with a missing key
    dropped, totals summed per key; the name is the smallest seen (the source
    keeps the first, which has no defined order on a cluster)."""
    cols = [*keys, total, name]
    both = (history.select(*[F.col(c) for c in cols]).withColumn(total, to_long_or_zero(total))
            .unionByName(new.select(*cols).withColumn(total, to_long_or_zero(total))))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return both.where(cond).groupBy(*keys).agg(F.sum(total).alias(total), F.min(name).alias(name))


def station_trx(events: DataFrame, cfg: DataFrame, lo: str, hi: str) -> DataFrame:
    """D7 + C8: transactions per (station, organisation): equi-join on the
    organisation with the IUV-prefix residual (unpadded segregation code); the
    residual stays inside the hash join, so no nested loop is planned."""
    ev = events.where((F.col("payment_ts") >= F.lit(lo).cast("timestamp_ntz"))
                      & (F.col("payment_ts") < F.lit(hi).cast("timestamp_ntz")))
    links = cfg.where(F.col("segregazione").isNotNull()).select(
        "station_id", "organization_fiscal_code", F.col("segregazione").cast("string").alias("seg"))
    j = ev.join(links, (ev.id_pa == links.organization_fiscal_code) & ev.iuv.startswith(links.seg), "inner")
    return j.groupBy(F.col("station_id").alias("stazione"), F.col("id_pa").alias("ec")).agg(
        F.count(F.lit(1)).alias("trx"))


def _digit(code: Column, i: int) -> Column:
    return F.substring(code, i + 1, 1).try_cast("int")


def vat_valid(code: Column) -> Column:
    """11 digits whose last digit is the Luhn-style check digit."""
    return F.coalesce(code.rlike(VAT_PATTERN) & (vat_check_digit(code) == _digit(code, 10)), F.lit(False))


def fiscal_check_char(code: Column) -> Column:
    """Check character of the first 15 characters of a personal tax code."""
    odd = F.array(*[F.lit(v) for v in FISCAL_ODD_VALUES])
    total = None
    for i in range(15):
        pos = F.instr(F.lit(FISCAL_ALPHABET), F.substring(code, i + 1, 1))
        if i % 2 == 0:
            term = F.try_element_at(odd, pos)
        else:
            term = F.when(pos <= 10, pos - 1).otherwise(pos - 11)
        total = term if total is None else total + term
    return F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), total % 26 + 1, 1)


def fiscal_code_valid(code: Column) -> Column:
    """Personal tax code shape plus check character."""
    shape = code.rlike(FISCAL_CODE_PATTERN)
    return F.coalesce(shape & (fiscal_check_char(code) == F.substring(code, 16, 1)), F.lit(False))


def vat_check_digit(code: Column) -> Column:
    """Check digit of the first 10 digits of a VAT number."""
    total = None
    for i in range(10):
        d = _digit(code, i)
        term = d if i % 2 == 0 else F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        total = term if total is None else total + term
    return (F.lit(10) - total % 10) % 10


def code_validity(pp: DataFrame) -> DataFrame:
    """Type F → personal tax code, type G → VAT number; others null."""
    code = F.upper(F.col("fiscal_code"))
    valid = (F.when(F.col("type") == "F", fiscal_code_valid(code))
             .when(F.col("type") == "G", vat_valid(code)))
    return pp.withColumn("valid_fiscal_code", valid)


def debtor_metrics(pp: DataFrame) -> DataFrame:
    """Completeness counters (nulls count as "different", as in pandas ``!=``)."""
    checked = code_validity(pp)
    equal = F.col("fiscal_code") == F.col("organization_fiscal_code")
    agg = checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(equal).alias("both_equal"),
        F.count_if(F.col("fiscal_code").isNull()).alias("fiscal_code_empty"),
        F.count_if(F.col("organization_fiscal_code").isNull()).alias("org_fiscal_code_empty"),
        F.count_if(F.col("type") == "F").alias("type_f"),
        F.count_if(F.col("type") == "G").alias("type_g"),
        F.count_if((F.col("type") == "F") & F.col("valid_fiscal_code")).alias("valid_fiscal_f"),
        F.count_if((F.col("type") == "G") & F.col("valid_fiscal_code")).alias("valid_fiscal_g"),
    )
    agg = agg.withColumn("both_different", F.col("total") - F.col("both_equal"))
    metrics = ["both_equal", "both_different", "fiscal_code_empty", "org_fiscal_code_empty",
               "type_f", "type_g", "valid_fiscal_f", "valid_fiscal_g"]
    return agg.select("total", *metrics,
                      *[(F.col(m) / F.col("total") * F.lit(100)).alias(f"pct_{m}") for m in metrics])
