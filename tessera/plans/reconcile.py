"""Reconciliation, range checks, file enrichment and delimited-file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, predicates, ranges, windows
from ..session import scratch_dir
from ..sources.delimited import export_csv, load_registry, read_delimited
from ..sources.fixtures import fixture, with_fixtures

PAYMENTS_AFTER = "1995-06-30 00:00:00"
REGISTRY_COLUMN = "dati_specifici_di_incasso"
REGISTRY_PATTERN = r"^[6-9]/"


def _reconciled(spark, sf_dir):
    a = fixture(spark, sf_dir, "biz_a")
    b = fixture(spark, sf_dir, "biz_b")
    return joins.reconcile(a, b, "payment_token", "payment_token", "seq", "seq")


def q_reconcile_left(spark, sf_dir):
    return _reconciled(spark, sf_dir)[0].select("payment_token", "notice_number")


def q_reconcile_right(spark, sf_dir):
    return _reconciled(spark, sf_dir)[1].select("payment_token", "notice_number")


def q_keep_last(spark, sf_dir):
    return windows.keep_last(fixture(spark, sf_dir, "biz_a"), ["notice_number"], "seq")


def q_range_overlap_adjacent(spark, sf_dir):
    return ranges.overlap_adjacent(fixture(spark, sf_dir, "issuer_range"))


def q_range_overlap_owner_all(spark, sf_dir):
    return ranges.overlap_owner_all(fixture(spark, sf_dir, "issuer_range"))


def q_range_overlap_cross(spark, sf_dir):
    return ranges.overlap_cross(fixture(spark, sf_dir, "issuer_range"))


def _payments(spark, sf_dir):
    ev = predicates.time_range(fixture(spark, sf_dir, "payment_event"), "payment_ts", PAYMENTS_AFTER, None, after=True)
    return ev.select(F.col("id_pa").alias("id_dominio"), "iuv", F.col("id").cast("string").alias("payment_id"))


def q_enrich_left(spark, sf_dir):
    return joins.enrich_left(fixture(spark, sf_dir, "pos_file"), _payments(spark, sf_dir),
                             ["id_dominio", "iuv"], ["payment_id"])


def q_csv_roundtrip(spark, sf_dir):
    """A2 + A10: the POS file exported as `;` CSV (range-partitioned files: the
    file grows with the data, so it is not funnelled into one task), read back
    as strings."""
    path = scratch_dir(spark, "pos-csv")
    export_csv(fixture(spark, sf_dir, "pos_file"), path, sep=";", sort=["id_dominio", "iuv"])
    return read_delimited(spark, path, sep=";", cols=["id_dominio", "iuv"])


#: Rows of a delivered registry file, about; never fewer than three files.
REGISTRY_ROWS = 20_000


def _registry_files(spark, sf_dir):
    """The taxonomy registry as delimited text files, as it is delivered: one
    row per part code, quoted, padded values, some with a quoted separator, and
    columns that each file orders in its own way; 'X-<even>' rows are truncated
    before the code column. Their number grows with the registry."""
    codes = fixture(spark, sf_dir, "taxonomy")
    files = codes.agg(F.greatest(F.lit(3), F.ceil(F.count(F.lit(1)) / REGISTRY_ROWS)).cast("int").alias("n"))
    own = codes.select("code", F.pmod(F.regexp_extract("code", "[-/]([0-9]+)", 1).cast("long"), files.scalar()).cast("int").alias("file_no"))
    short = F.col("code").startswith("X-") & (F.substring("code", 3, 10).cast("int") % 2 == 0)
    order = F.col("file_no") % 3
    quoted, code = F.concat(F.lit('"'), F.col("code"), F.lit('"')), F.concat(F.lit('" '), F.col("code"), F.lit(' " '))
    text = F.lit('"voce; di tassonomia"')
    line = (F.when(short, quoted).when(order == 0, F.concat_ws(";", quoted, code, text)).when(order == 1, F.concat_ws("; ", quoted, text, code))
            .otherwise(F.concat_ws(" ;", text, quoted, code)))
    header = (F.when(order == 0, '"codice" ; "dati_specifici_di_incasso" ; "descrizione"').when(order == 1, 'codice;"descrizione; estesa";dati_specifici_di_incasso')
              .otherwise('"descrizione" ;codice; dati_specifici_di_incasso '))
    heads = files.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("file_no")).select("file_no", F.lit(0).alias("k"), F.lit("").alias("code"), header.alias("value"))
    body = own.select("file_no", F.lit(1).alias("k"), "code", line.alias("value"))
    path = scratch_dir(spark, "taxonomy-txt")
    (heads.unionByName(body).repartition("file_no").sortWithinPartitions("file_no", "k", "code").select("file_no", "value")
     .write.partitionBy("file_no").text(path))
    return path


def _registry(spark, sf_dir):
    return load_registry(spark, _registry_files(spark, sf_dir), REGISTRY_COLUMN, REGISTRY_PATTERN)


def q_registry_valid(spark, sf_dir):
    return _registry(spark, sf_dir)[0]


def q_registry_rejects(spark, sf_dir):
    return _registry(spark, sf_dir)[1].withColumn("file", F.regexp_extract("file", "file_no(?:=|%3D)([0-9]+)", 1).cast("int"))


QUERIES = {
    "reconcile_left": q_reconcile_left,
    "reconcile_right": q_reconcile_right,
    "keep_last": q_keep_last,
    "range_overlap_adjacent": q_range_overlap_adjacent,
    "range_overlap_owner_all": q_range_overlap_owner_all,
    "range_overlap_cross": q_range_overlap_cross,
    "enrich_left": q_enrich_left,
    "csv_roundtrip": q_csv_roundtrip,
    "registry_valid": q_registry_valid,
    "registry_rejects": q_registry_rejects,
}

_FX = ("biz_a", "biz_b", "issuer_range", "pos_file", "payment_event", "taxonomy")
_CTES = """
last_a AS (SELECT payment_token, arg_max(notice_number, seq) AS notice_number FROM biz_a GROUP BY 1),
last_b AS (SELECT payment_token, arg_max(notice_number, seq) AS notice_number FROM biz_b GROUP BY 1),
filed AS (SELECT code, cast(regexp_extract(code, '[-/]([0-9]+)', 1) AS BIGINT)
  % (SELECT greatest(3, ceil(count(*) / 20000.0))::BIGINT FROM taxonomy) AS file FROM taxonomy),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY code) + 1 AS line_no FROM filed)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CTES} {sql}", *_FX)


ORACLE = {
    "reconcile_left": _o("SELECT * FROM last_a WHERE payment_token NOT IN (SELECT payment_token FROM last_b)"),
    "reconcile_right": _o("SELECT * FROM last_b WHERE payment_token NOT IN (SELECT payment_token FROM last_a)"),
    "keep_last": _o("SELECT notice_number, arg_max(payment_token, seq) AS payment_token, max(seq) AS seq "
                    "FROM biz_a GROUP BY 1"),
    "range_overlap_adjacent": _o(
        "SELECT abi, a_key, a_low, a_high, b_key, b_low, b_high FROM (SELECT abi, row_key AS a_key, low_range AS a_low, "
        "high_range AS a_high, lead(row_key) OVER w AS b_key, lead(low_range) OVER w AS b_low, "
        "lead(high_range) OVER w AS b_high FROM issuer_range WINDOW w AS (PARTITION BY abi ORDER BY low_range, row_key)) "
        "WHERE b_key IS NOT NULL AND a_high >= b_low"),
    "range_overlap_owner_all": _o(
        "SELECT a.abi, a.row_key AS a_key, a.low_range AS a_low, a.high_range AS a_high, b.row_key AS b_key, b.low_range AS b_low, b.high_range AS b_high "
        "FROM issuer_range a JOIN issuer_range b ON a.abi = b.abi AND b.low_range BETWEEN a.low_range AND a.high_range "
        "AND (a.low_range, a.row_key) < (b.low_range, b.row_key)"),
    "range_overlap_cross": _o(
        "SELECT a.abi AS a_owner, a.row_key AS a_key, a.low_range AS a_low, a.high_range AS a_high, b.abi AS b_owner, "
        "b.row_key AS b_key, b.low_range AS b_low, b.high_range AS b_high FROM issuer_range a JOIN issuer_range b "
        "ON b.low_range >= a.low_range AND b.low_range <= a.high_range AND a.abi <> b.abi "
        "AND (a.low_range < b.low_range OR (a.low_range = b.low_range AND a.row_key < b.row_key))"),
    "enrich_left": _o(
        "SELECT f.id_dominio, f.iuv, p.payment_id FROM pos_file f LEFT JOIN (SELECT id_pa AS id_dominio, iuv, "
        f"cast(id AS VARCHAR) AS payment_id FROM payment_event WHERE payment_ts > TIMESTAMP '{PAYMENTS_AFTER}') p "
        "USING (id_dominio, iuv)"),
    "csv_roundtrip": _o("SELECT id_dominio, iuv FROM pos_file"),
    "registry_valid": _o(f"SELECT DISTINCT code FROM taxonomy WHERE regexp_matches(code, '{REGISTRY_PATTERN}')"),
    "registry_rejects": _o(
        "SELECT file::INT AS file, line_no, CASE WHEN cast(substr(code, 3) AS INTEGER) % 2 = 0 THEN 'N/D' ELSE code END AS value, "
        "CASE WHEN cast(substr(code, 3) AS INTEGER) % 2 = 0 THEN 'missing column' ELSE 'invalid format' END AS reason "
        "FROM ranked WHERE code LIKE 'X-%'"),
}
