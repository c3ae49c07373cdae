"""Stand-in business tables derived from the driver's parquet tables.

Each stand-in is one SQL text written against a small :class:`Dialect`, so the
same definition runs on Spark (reading parquet files directly) and on DuckDB
(reading the pre-registered views) for the oracle.  Nulls/NaN that the driver
tables lack are injected with ``CASE``.

Every stand-in reads whole tables; filters that appear below define *which*
business rows exist (for instance orders in status ``P`` are maintenances),
they never thin the data out to keep checks cheap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure


@dataclass(frozen=True)
class Dialect:
    engine: str  # "spark" | "duckdb"
    sf_dir: str = ""

    def t(self, name: str) -> str:
        if self.engine == "spark":
            return f"parquet.`{self.sf_dir.rstrip('/')}/{name}.parquet`"
        return name

    def us(self, expr: str) -> str:
        """Epoch microseconds of a timestamp expression (UTC)."""
        if self.engine == "spark":
            return f"unix_micros(cast({expr} AS timestamp))"
        return f"epoch_us({expr})"

    def ntz(self, expr: str) -> str:
        """Time-zone-less timestamp (Spark's date_trunc returns a zoned one)."""
        if self.engine == "spark":
            return f"cast({expr} AS timestamp_ntz)"
        return f"cast({expr} AS timestamp)"

    def lst(self, expr: str) -> str:
        """Sorted comma-joined list aggregate."""
        if self.engine == "spark":
            return f"array_join(array_sort(collect_list({expr})), ',')"
        return f"string_agg({expr}, ',' ORDER BY {expr})"


def _kpi_silver(d: Dialect) -> str:
    return f"""
SELECT l_returnflag AS kpi_id, concat('PSP', lpad(cast(l_suppkey AS string), 3, '0')) AS psp_id,
  concat(substr(cast(date_trunc('month', l_shipdate) AS string), 1, 10), 'T00:00:00Z') AS period_start,
  concat(substr(cast(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS string), 1, 10), 'T00:00:00Z') AS period_end,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN cast('NaN' AS double) ELSE l_tax END AS perc_kpi,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE cast(l_quantity AS bigint) END AS total_kpi_sample,
  cast(l_linenumber AS bigint) AS total_kpi_fault,
  CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE cast(5 * (1 + l_suppkey % 4) AS double) END AS kpi_threshold
FROM {d.t('lineitem')}"""


def _crm(d: Dialect) -> str:
    # Every supplier is listed twice: by nation and by the last digits of its
    # key, in lists of at most 400 suppliers. Keys ending in 9 are alone in
    # both, so they belong to no group; those not ending in 3 are alone in the second.
    block = "cast(floor(s_suppkey / 400) AS bigint)"
    alone = "cast(s_suppkey AS string)"
    nation = (f"CASE WHEN s_suppkey % 10 = 9 THEN concat('S', {alone}) ELSE concat('C', lpad(cast(s_nationkey AS string), 2, '0'), '-', "
              f"cast({block} AS string)) END")
    digits = (f"CASE WHEN s_suppkey % 10 = 3 THEN concat('D', cast(s_suppkey % 20 AS string), '-', cast({block} AS string)) "
              f"ELSE concat('T', {alone}) END")
    return f"""
SELECT {nation} AS contract_id, {d.lst("concat(' PSP', lpad(cast(s_suppkey AS string), 3, '0'))")} AS provider_names
FROM {d.t('supplier')} GROUP BY {nation}
UNION ALL
SELECT {digits}, {d.lst("concat('PSP', lpad(cast(s_suppkey AS string), 3, '0'))")} FROM {d.t('supplier')} GROUP BY {digits}
UNION ALL SELECT 'Z0', ' , '"""


def _payment_position(d: Dialect) -> str:
    return f"""
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN concat('ACA_', cast(o_orderkey AS string))
       WHEN o_orderkey % 7 = 0 THEN concat('ACAX', cast(o_orderkey AS string)) ELSE concat('GPD-', cast(o_orderkey AS string)) END AS iupd,
  CASE o_orderstatus WHEN 'O' THEN 'VALID' WHEN 'P' THEN 'PARTIALLY_PAID' ELSE 'PAID' END AS status,
  CASE WHEN o_custkey % 3 = 0 THEN 'G' ELSE 'F' END AS type,
  CASE WHEN o_custkey % 19 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN 'RSSMRA85T10A562S' WHEN o_custkey % 23 = 0 THEN lpad(cast(o_custkey % 200 AS string), 11, '0')
       ELSE lpad(cast(o_custkey AS string), 11, '0') END AS fiscal_code,
  lpad(cast(o_custkey % 200 AS string), 11, '0') AS organization_fiscal_code,
  CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE c_name END AS company_name,
  CASE o_orderkey % 4 WHEN 0 THEN 'WISP' WHEN 1 THEN 'ACA' ELSE 'GPD' END AS service_type,
  {d.us('o_orderdate')} AS inserted_date
FROM {d.t('orders')} JOIN {d.t('customer')} ON o_custkey = c_custkey"""


def _payment_option(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS payment_position_id,
  concat(CASE WHEN min(l_suppkey) % 50 = 49 THEN 'RF' ELSE lpad(cast(min(l_suppkey) % 50 AS string), 2, '0') END,
         lpad(cast(l_orderkey * 10 + l_linenumber AS string), 13, '0')) AS iuv,
  lpad(cast(l_orderkey % 200 AS string), 11, '0') AS organization_fiscal_code,
  CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE rpad('x', cast(l_orderkey % 160 AS int), 'x') END AS description,
  CASE WHEN l_orderkey % 43 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN {d.us('max(l_shipdate) + INTERVAL 25 YEAR')}
       WHEN l_orderkey % 59 = 0 THEN {d.us('max(l_shipdate) + INTERVAL 200 YEAR')} ELSE {d.us('max(l_shipdate)')} END AS due_date
FROM {d.t('lineitem')} GROUP BY l_orderkey, l_linenumber"""


def _transfer(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS payment_option_id, cast(round(l_extendedprice * 100) AS bigint) AS amount,
  CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN concat(lpad(cast(l_partkey % 50 AS string), 7, '0'), 'TS')
       WHEN l_partkey % 17 = 0 THEN 'BADCODE'
       ELSE concat(cast(6 + l_partkey % 4 AS string), '/', lpad(cast(l_partkey % 50 AS string), 7, '0'),
            CASE l_partkey % 5 WHEN 0 THEN 'IM' WHEN 1 THEN 'TS' WHEN 2 THEN 'SP' WHEN 3 THEN 'SA' ELSE 'AP' END, '/') END AS category
FROM {d.t('lineitem')}"""


def _taxonomy(d: Dialect) -> str:
    return f"""
SELECT DISTINCT CASE WHEN p_partkey % 7 = 1 THEN concat('X-', cast(p_partkey AS string))
  WHEN p_partkey % 3 = 0 THEN concat('9/', lpad(cast(1000000 + p_partkey AS string), 7, '0'), 'XX/') ELSE concat(cast(6 + p_partkey % 4 AS string), '/', lpad(cast(p_partkey % 50 AS string), 7, '0'),
  CASE p_partkey % 5 WHEN 0 THEN 'IM' WHEN 1 THEN 'TS' WHEN 2 THEN 'SP' WHEN 3 THEN 'SA' ELSE 'AP' END, '/') END AS code
FROM {d.t('part')}"""


def _partner_report(d: Dialect) -> str:
    return f"""
SELECT s_suppkey % 50 AS segregazione, concat('BRK', lpad(cast(s_nationkey AS string), 2, '0')) AS id_intermediario_pa,
  lpad(cast(s_suppkey * 2 % 200 AS string), 11, '0') AS id_dominio FROM {d.t('supplier')}"""


def _broker_cfg(d: Dialect) -> str:
    return f"""
SELECT concat('BRK', lpad(cast(s_nationkey AS string), 2, '0')) AS broker_id, n_name AS broker_name,
  concat('BRK', lpad(cast(s_nationkey AS string), 2, '0'), '_', lpad(cast(s_suppkey % 50 AS string), 2, '0')) AS station_id,
  lpad(cast(s_suppkey * 2 % 200 AS string), 11, '0') AS organization_fiscal_code,
  CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE s_suppkey % 50 END AS segregazione
FROM {d.t('supplier')} JOIN {d.t('nation')} ON s_nationkey = n_nationkey"""


def _cfg_broker(d: Dialect) -> str:
    return f"""
SELECT n_nationkey AS obj_id, concat('BRK', lpad(cast(n_nationkey AS string), 2, '0')) AS broker_id, n_name AS broker_name FROM {d.t('nation')}"""


def _cfg_station(d: Dialect) -> str:
    return f"""
SELECT DISTINCT s_nationkey * 100 + s_suppkey % 50 AS obj_id, s_nationkey AS fk_broker,
  concat('BRK', lpad(cast(s_nationkey AS string), 2, '0'), '_', lpad(cast(s_suppkey % 50 AS string), 2, '0')) AS station_id
FROM {d.t('supplier')}"""


def _cfg_link(d: Dialect) -> str:
    # One supplier in seventeen points to an institution that isn't registered.
    return f"""
SELECT s_nationkey * 100 + s_suppkey % 50 AS fk_station, CASE WHEN s_suppkey % 17 = 0 THEN -1 ELSE s_suppkey * 2 % 200 END AS fk_pa,
  CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE s_suppkey % 50 END AS segregazione
FROM {d.t('supplier')}"""


def _cfg_institution(d: Dialect) -> str:
    return f"""
SELECT DISTINCT s_suppkey * 2 % 200 AS obj_id, lpad(cast(s_suppkey * 2 % 200 AS string), 11, '0') AS id_dominio FROM {d.t('supplier')}"""


def _payment_event(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 100 + l_linenumber AS id, lpad(cast(l_orderkey % 200 AS string), 11, '0') AS id_pa,
  concat(cast(l_suppkey % 50 AS string), lpad(cast(l_orderkey AS string), 12, '0')) AS iuv, l_shipdate AS payment_ts
FROM {d.t('lineitem')}"""


def _pos_file(d: Dialect) -> str:
    # The whole order book appears in the file; one order in three carries an
    # IUV prefix (77) that matches no payment, so unmatched rows exist.
    return f"""
SELECT DISTINCT lpad(cast(l_orderkey % 200 AS string), 11, '0') AS id_dominio,
  concat(cast(CASE WHEN l_orderkey % 3 = 0 THEN 77 ELSE l_suppkey % 50 END AS string), lpad(cast(l_orderkey AS string), 12, '0')) AS iuv
FROM {d.t('lineitem')}"""


def _issuer_range(d: Dialect) -> str:
    return f"""
SELECT s_suppkey AS row_key, concat('ABI', cast(s_nationkey % 7 AS string)) AS abi,
  cast(s_suppkey * 100 AS decimal(38,0)) AS low_range,
  cast(s_suppkey * 100 + CASE WHEN s_suppkey % 12 = 0 THEN 950 ELSE 40 + s_suppkey % 90 END AS decimal(38,0)) AS high_range
FROM {d.t('supplier')}
UNION ALL SELECT -1, 'ABIW', cast(150 AS decimal(38,0)), cast('3000000000000000000' AS decimal(38,0))
UNION ALL SELECT -2 - s_suppkey, concat('ABI', cast(s_nationkey % 7 AS string)),
  cast(CASE WHEN s_suppkey % 40 = 0 THEN 5000 ELSE s_suppkey * 100 + 99 END AS decimal(38,0)),
  cast(CASE WHEN s_suppkey % 40 = 0 THEN 5000 + s_suppkey % 3 ELSE s_suppkey * 100 + 99 END AS decimal(38,0))
FROM {d.t('supplier')}"""


def _biz_a(d: Dialect) -> str:
    # Export A: every order; the low-priority ones under tokens that export B lacks.
    return f"""
SELECT concat(CASE WHEN o_orderpriority = '5-LOW' THEN 'L' ELSE 'T' END, cast(o_orderkey AS string)) AS payment_token,
  concat('N', cast(o_custkey AS string)) AS notice_number, o_orderkey AS seq
FROM {d.t('orders')}"""


def _biz_b(d: Dialect) -> str:
    return f"""
SELECT DISTINCT concat('T', cast(l_orderkey AS string)) AS payment_token, concat('N', cast(l_orderkey AS string)) AS notice_number, l_orderkey AS seq
FROM {d.t('lineitem')}"""


def _agreement_base(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS event_id, l_shipdate AS inserted_ts, lpad(cast(l_orderkey % 200 AS string), 11, '0') AS ec,
  concat(lpad(cast(l_suppkey % 50 AS string), 2, '0'), lpad(cast(l_orderkey AS string), 13, '0')) AS iuv, concat('ccp', cast(l_linenumber AS string)) AS ccp,
  cast(l_extendedprice AS decimal(18,2)) AS amount, cast(l_tax AS decimal(18,2)) AS fee,
  CASE WHEN l_linestatus = 'O' THEN 'CP' ELSE 'PO' END AS method, CASE WHEN l_linenumber % 2 = 0 THEN 'codiceConvenzione' ELSE 'altro' END AS conv_key,
  concat('CONV', cast(l_partkey % 10 AS string)) AS cod_conv,
  CASE WHEN l_returnflag = 'R' THEN 'KO' WHEN l_returnflag = 'A' THEN 'OK' ELSE NULL END AS outcome
FROM {d.t('lineitem')}"""


def _iban_rank(d: Dialect) -> str:
    return f"""
SELECT o_custkey AS fk_pa, concat('IT', lpad(cast(o_orderkey AS string), 25, '0')) AS iban, o_orderdate AS inserted_date, o_orderkey AS iban_id,
  CASE WHEN o_orderkey % 6 = 0 THEN '0201138TS' WHEN o_orderkey % 6 = 1 THEN 'ALTRO' ELSE NULL END AS attribute_name
FROM {d.t('orders')}"""


def _institution(d: Dialect) -> str:
    return f"""
SELECT lpad(cast(c_custkey AS string), 11, '0') AS row_key, c_name AS company_name,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'L5' WHEN 'MACHINERY' THEN 'L6' ELSE 'L9' END AS category,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('c_', 'a', cast(c_custkey AS string)) END AS origin_id,
  CASE WHEN c_custkey % 7 = 0 THEN 'ITA' ELSE lpad(cast(c_custkey AS string), 6, '0') END AS istat,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('ref', cast(c_custkey AS string), '@example.org') END AS referent_email
FROM {d.t('customer')}"""


def _ec_config(d: Dialect) -> str:
    # Historic institution configuration table (the last-resort source).
    return f"""
SELECT lpad(cast(c_custkey AS string), 11, '0') AS row_key,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('H', cast(c_custkey AS string)) END AS hist_catasto,
  lpad(cast(c_custkey % 1000 AS string), 6, '0') AS hist_istat,
  concat('hist', cast(c_custkey AS string), '@example.org') AS hist_email
FROM {d.t('customer')}"""


def _maintenance(d: Dialect) -> str:
    return f"""
SELECT o_orderkey AS maintenance_id, concat('BRK', lpad(cast(o_custkey % 25 AS string), 2, '0')) AS broker_code,
  concat('BRK', lpad(cast(o_custkey % 25 AS string), 2, '0'), '_', lpad(cast(o_orderkey % 50 AS string), 2, '0')) AS station_code,
  {d.ntz("date_trunc('month', o_orderdate)")} AS starts_at,
  {d.ntz("date_trunc('month', o_orderdate) + INTERVAL 1 DAY")} AS ends_at
FROM {d.t('orders')}"""


def _maintenance_report(d: Dialect) -> str:
    # Notices already published for the maintenances of every third month; the others carry another title.
    return f"""
SELECT DISTINCT concat(CASE WHEN extract(month FROM o_orderdate) % 3 = 0 THEN n_name ELSE concat('Avviso ', n_name) END,
    ' - Manutenzione Programmata') AS title,
  {d.ntz("date_trunc('month', o_orderdate)")} AS starts_at, {d.ntz("date_trunc('month', o_orderdate) + INTERVAL 1 DAY")} AS ends_at
FROM {d.t('orders')} JOIN {d.t('nation')} ON o_custkey % 25 = n_nationkey"""


# Ids as the alerting service has them: numbers, hexadecimal, and dashed ones that begin like another id.
_INCIDENT_ID = ("CASE event_id % 4 WHEN 1 THEN lower(hex(event_id)) WHEN 3 THEN "
                "concat(lower(hex(event_id - 2)), '-', cast(event_id % 7 AS string), CASE WHEN event_id % 3 = 0 THEN '-ab' ELSE '' END) ELSE cast(event_id AS string) END")


def _incident(d: Dialect) -> str:
    return f"""
SELECT {_INCIDENT_ID} AS id, CASE WHEN value > 100 THEN 'resolved' ELSE 'open' END AS status, event_type AS message,
  concat(event_type, CASE WHEN user_id % 3 = 0 THEN ',toStatusPage' ELSE '' END) AS tags_csv
FROM {d.t('events')}"""


def _status_report(d: Dialect) -> str:
    # Reports of events with an even user id name their incident: the others are new incidents.
    return f"""
SELECT event_id + 500000 AS report_id,
  CASE WHEN user_id % 2 = 0 THEN concat('Incident [ID: ', {_INCIDENT_ID}, '] - ', event_type) ELSE concat('Notice - ', event_type) END AS title,
  CASE event_id % 3 WHEN 0 THEN 'Resolved' WHEN 1 THEN 'open' ELSE 'resolved' END AS aggregate_state,
  CASE WHEN event_id % 5 = 0 THEN 'maintenance' ELSE 'manual' END AS report_type
FROM {d.t('events')}"""


_FIXTURES = {
    "kpi_silver": _kpi_silver,
    "crm": _crm,
    "payment_position": _payment_position,
    "payment_option": _payment_option,
    "transfer": _transfer,
    "taxonomy": _taxonomy,
    "partner_report": _partner_report,
    "broker_cfg": _broker_cfg,
    "cfg_broker": _cfg_broker,
    "cfg_station": _cfg_station,
    "cfg_link": _cfg_link,
    "cfg_institution": _cfg_institution,
    "payment_event": _payment_event,
    "pos_file": _pos_file,
    "issuer_range": _issuer_range,
    "biz_a": _biz_a,
    "biz_b": _biz_b,
    "agreement_base": _agreement_base,
    "iban_rank": _iban_rank,
    "institution": _institution,
    "ec_config": _ec_config,
    "maintenance": _maintenance,
    "maintenance_report": _maintenance_report,
    "incident": _incident,
    "status_report": _status_report,
}

NAMES = tuple(_FIXTURES)


def fixture_sql(name: str, dialect: Dialect) -> str:
    return _FIXTURES[name](dialect)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in table ``name`` as a lazy Spark DataFrame."""
    configure(spark)
    return spark.sql(fixture_sql(name, Dialect("spark", sf_dir)))


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix a DuckDB query with CTEs for the stand-ins it reads."""
    duck = Dialect("duckdb")
    ctes = ",\n".join(f"{n} AS ({fixture_sql(n, duck)}\n)" for n in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
