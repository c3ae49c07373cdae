"""Event-log decoding, flow lists and CDC envelopes.

The event log is derived by Spark from the ``agreement_base`` stand-in: every
row becomes a notify event whose payload is a base64 SOAP/XML document (with
namespace prefixes), and rows with a known outcome also get a result event
with a base64 JSON payload. The oracle reads ``agreement_base`` directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import to_cdc
from ..functions.codec import text_b64
from ..operators import payloads
from ..operators.predicates import epoch_micros
from ..operators.sinks import metrics_json
from ..sources.fixtures import fixture, with_fixtures

PSP = "PSPXXXMM"
WINDOW = ("1995-03-01 00:00:00", "1997-01-01 00:00:00")
EXPAND = ("1995-01-01 00:00:00", "1995-07-01 00:00:00")
STORED_BEFORE = "1998-01-01"
EMIT_US = 820_454_400_123_456
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _notify_xml():
    def tag(name, value):
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    meta = F.concat(F.lit("<mapEntry><key>tipoVersamento</key><value>"), F.col("method"),
                    F.lit("</value></mapEntry><mapEntry><key>canale</key><value>WEB</value></mapEntry>"))
    def entry(key, value):
        return F.concat(F.lit("<mapEntry>"), tag("key", key), tag("value", value), F.lit("</mapEntry>"))

    # every fourth payment has a second entry; every fifth event is a cart whose second payment has its code last
    more = F.when(F.col("event_id") % 4 == 1, entry(F.lit("nota"), F.lit("n"))).otherwise("")
    second = F.when(F.col("event_id") % 5 == 0, F.concat(
        F.lit("<payment>"), tag("creditorReferenceId", F.concat(F.lit("99"), F.col("iuv"))), tag("fiscalCodePA", F.col("ec")), F.lit("<metadata>"),
        entry(F.lit("altro"), F.lit("x")), entry(F.lit("codiceConvenzione"), F.concat("cod_conv", F.lit("-2"))), F.lit("</metadata></payment>"))).otherwise("")
    payment = F.concat(
        F.lit("<paymentList><payment>"), tag("creditorReferenceId", F.col("iuv")), tag("fiscalCodePA", F.col("ec")),
        F.lit("<metadata>"), entry(F.col("conv_key"), F.col("cod_conv")), more, F.lit("</metadata></payment>"), second, F.lit("</paymentList>"))
    return F.concat(
        F.lit('<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Body>'
              '<nod:pspNotifyPaymentV2>'),
        tag("fee", F.col("fee").cast("string")),
        tag("timestampOperation", F.date_format("inserted_ts", ISO)),
        tag("totalAmount", F.col("amount").cast("string")),
        F.lit("<additionalPaymentInformations><metadata>"), meta, F.lit("</metadata></additionalPaymentInformations>"),
        payment,
        F.lit("</nod:pspNotifyPaymentV2></soapenv:Body></soapenv:Envelope>"))


def event_log(spark, sf_dir):
    base = fixture(spark, sf_dir, "agreement_base")
    notify = base.select(
        (F.col("event_id") * 2).alias("event_id"), "inserted_ts", F.lit(PSP).alias("psp"),
        F.lit("pspNotifyPaymentV2").alias("tipo_evento"), F.lit("REQ").alias("sotto_tipo_evento"),
        F.col("ec").alias("id_dominio"), "iuv", "ccp", text_b64(_notify_xml()).alias("payload"))
    result = base.where(F.col("outcome").isNotNull()).select(
        (F.col("event_id") * 2 + 1).alias("event_id"), (F.col("inserted_ts") + F.expr("INTERVAL 1 HOUR")).alias("inserted_ts"),
        F.lit(PSP).alias("psp"), F.lit("sendPaymentResult-v2").alias("tipo_evento"), F.lit("REQ").alias("sotto_tipo_evento"),
        F.col("ec").alias("id_dominio"), "iuv", "ccp",
        text_b64(F.to_json(F.struct("outcome", F.col("iuv").alias("creditorReferenceId")))).alias("payload"))
    return notify.unionByName(result)


def q_agreement_payments(spark, sf_dir):
    return payloads.agreement_payments(event_log(spark, sf_dir), *WINDOW, PSP)


def q_result_outcome(spark, sf_dir):
    return payloads.result_outcome(event_log(spark, sf_dir)).drop("inserted_ts")


def q_exclude_ko(spark, sf_dir):
    log = event_log(spark, sf_dir)  # each reader builds the events of its own type only
    return payloads.exclude_ko(payloads.agreement_payments(log, *WINDOW, PSP), payloads.result_outcome(log))


def flows(spark, sf_dir):
    base = fixture(spark, sf_dir, "agreement_base")
    return base.select(
        F.col("ec").alias("id_dominio"), (F.col("event_id") / 10).cast("bigint").alias("order_key"),
        F.concat(F.lit("FL"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("flow_id"),
        F.date_format("inserted_ts", ISO).alias("flow_date"), "ccp", "amount")


def flow_documents(spark, sf_dir):
    """One flow-list document per order (at most seven flows each)."""
    frag = F.concat(F.lit("<idRendicontazione><identificativoFlusso>"), F.col("flow_id"),
                    F.lit("</identificativoFlusso><dataOraFlusso>"), F.col("flow_date"),
                    F.lit("</dataOraFlusso></idRendicontazione>"))
    docs = flows(spark, sf_dir).groupBy("id_dominio", "order_key").agg(
        F.array_join(F.array_sort(F.collect_list(frag)), "").alias("_body"))
    return docs.select("id_dominio", F.concat(F.lit("<listaRendicontazioni>"), F.col("_body"),
                                              F.lit("</listaRendicontazioni>")).alias("xml"))


def q_flow_list(spark, sf_dir):
    return payloads.flow_list(flow_documents(spark, sf_dir))


def flow_responses(spark, sf_dir):
    f = flows(spark, sf_dir)
    body = F.concat(F.lit("<flusso><id>"), F.col("flow_id"), F.lit("</id><importo>"), F.col("amount").cast("string"),
                    F.lit("</importo></flusso>"))
    wrapped = F.concat(F.lit("<risposta><esito>OK</esito><xmlRendicontazione>"), text_b64(body),
                       F.lit("</xmlRendicontazione></risposta>"))
    # Responses for third-line flows come back without the body tag.
    response = F.when(F.col("ccp") == "ccp3", F.lit("<risposta><esito>KO</esito></risposta>")).otherwise(wrapped)
    return f.select("flow_id", response.alias("response"))


def q_flow_body(spark, sf_dir):
    return payloads.flow_body(flow_responses(spark, sf_dir))


def _flow_keys(spark, sf_dir):
    fl = payloads.flow_list(flow_documents(spark, sf_dir))
    key = F.concat(F.substring("flow_date", 1, 10), F.lit("##"), F.col("id_dominio"), F.lit("##"),
                   F.col("flow_id"), F.lit(".xml"))
    return fl.select(key.alias("blob_key"), "flow_date")


def q_flow_save_once(spark, sf_dir):
    keys = _flow_keys(spark, sf_dir)
    existing = keys.where(F.col("flow_date") < STORED_BEFORE)
    return payloads.save_once(keys, existing, "blob_key")[1]


def _expanded(spark, sf_dir):
    return payloads.child_expand(fixture(spark, sf_dir, "payment_position"), fixture(spark, sf_dir, "payment_option"),
                                 fixture(spark, sf_dir, "transfer"), epoch_micros(EXPAND[0]), epoch_micros(EXPAND[1]))


def q_child_expand_pp(spark, sf_dir):
    return _expanded(spark, sf_dir)[0].select("id", "iupd", "inserted_date")


def q_child_expand_po(spark, sf_dir):
    return _expanded(spark, sf_dir)[1].select("id", "payment_position_id", "iuv")


def q_child_expand_tr(spark, sf_dir):
    return _expanded(spark, sf_dir)[2].select("payment_option_id", "amount", "category")


def q_report_json(spark, sf_dir):
    """The expansion counters as one JSON metrics document."""
    pp, po, tr = _expanded(spark, sf_dir)
    one_row = (pp.select(F.lit("positions").alias("m"))
               .unionByName(po.select(F.lit("options").alias("m")))
               .unionByName(tr.select(F.lit("transfers").alias("m")))
               .agg(*[F.count_if(F.col("m") == m).alias(m) for m in ("positions", "options", "transfers")]))
    return metrics_json(one_row, "child expansion")


def cdc_source(spark, sf_dir):
    pp = fixture(spark, sf_dir, "payment_position")
    text = F.date_format(F.timestamp_micros("inserted_date"), ISO)
    # Some validity dates arrive with a five-digit year and must be clamped.
    validity = F.when((F.col("id") % 13 == 0) & ~text.contains("-02-29"), F.concat(F.lit("12000"), F.substring(text, 5, 20))).otherwise(text)
    return pp.select("id", "iupd", "status", "inserted_date", validity.alias("validity_date"))


def q_cdc_envelope(spark, sf_dir):
    env = to_cdc(cdc_source(spark, sf_dir), ["id", "iupd", "status", "inserted_date", "validity_date"],
                 date_cols=["validity_date"], now_us=EMIT_US)
    return env.select("after.*", "op", "ts_ms", "ts_us", "ts_ns")


QUERIES = {
    "agreement_payments": q_agreement_payments,
    "result_outcome": q_result_outcome,
    "exclude_ko": q_exclude_ko,
    "flow_list": q_flow_list,
    "flow_body": q_flow_body,
    "flow_save_once": q_flow_save_once,
    "child_expand_pp": q_child_expand_pp,
    "child_expand_po": q_child_expand_po,
    "child_expand_tr": q_child_expand_tr,
    "report_json": q_report_json,
    "cdc_envelope": q_cdc_envelope,
}

# ---------------------------------------------------------------- DuckDB oracle
_FX = ("agreement_base", "payment_position", "payment_option", "transfer")
_LO, _HI = epoch_micros(EXPAND[0]), epoch_micros(EXPAND[1])
_CTES = f"""
paid AS (SELECT event_id, inserted_ts, ec, iuv, amount, fee, cod_conv, ccp, method FROM agreement_base WHERE conv_key = 'codiceConvenzione'
  UNION ALL SELECT event_id, inserted_ts, ec, concat('99', iuv), amount, fee, concat(cod_conv, '-2'), ccp, method FROM agreement_base WHERE event_id % 5 = 0),
pay AS (SELECT event_id * 2 AS event_id, strftime(inserted_ts, '%Y-%m-%dT%H:%M:%S') AS timestamp_operation, ec, iuv,
  cast(amount AS VARCHAR) AS amount, cast(fee AS VARCHAR) AS fee, cod_conv, ccp FROM paid
  WHERE inserted_ts >= TIMESTAMP '{WINDOW[0]}' AND inserted_ts < TIMESTAMP '{WINDOW[1]}' AND method = 'CP'),
res AS (SELECT event_id * 2 + 1 AS rid, inserted_ts + INTERVAL 1 HOUR AS rts, ec AS r_dom, iuv, ccp, outcome
  FROM agreement_base WHERE outcome IS NOT NULL),
firsts AS (SELECT event_id, iuv, outcome FROM (SELECT p.event_id, p.iuv, r.outcome, row_number() OVER (PARTITION BY p.event_id, p.iuv, p.ec
  ORDER BY r.rts, r.rid) AS rn FROM pay p JOIN res r ON p.iuv = r.iuv AND p.ccp = r.ccp AND contains(r.r_dom, p.ec))
  WHERE rn = 1),
fl AS (SELECT ec AS id_dominio, concat('FL', lpad(cast(event_id AS VARCHAR), 12, '0')) AS flow_id,
  strftime(inserted_ts, '%Y-%m-%dT%H:%M:%S') AS flow_date, ccp, amount FROM agreement_base),
keys AS (SELECT concat(substr(flow_date, 1, 10), '##', id_dominio, '##', flow_id, '.xml') AS blob_key, flow_date FROM fl),
exp_pp AS (SELECT * FROM payment_position WHERE inserted_date >= {_LO} AND inserted_date < {_HI}),
exp_po AS (SELECT * FROM payment_option WHERE payment_position_id IN (SELECT id FROM exp_pp)),
exp_tr AS (SELECT * FROM transfer WHERE payment_option_id IN (SELECT id FROM exp_po)),
src AS (SELECT id, iupd, status, inserted_date, strftime(make_timestamp(inserted_date), '%Y-%m-%dT%H:%M:%S') AS txt
  FROM payment_position)
"""


def _o(sql):
    return with_fixtures(f"WITH {_CTES} {sql}", *_FX)


ORACLE = {
    "agreement_payments": _o("SELECT * FROM pay"),
    "result_outcome": _o("SELECT rid AS event_id, r_dom AS id_dominio, iuv, ccp, outcome FROM res"),
    "exclude_ko": _o("SELECT * FROM pay WHERE (event_id, iuv) NOT IN (SELECT (event_id, iuv) FROM firsts WHERE outcome = 'KO')"),
    "flow_list": _o("SELECT id_dominio, flow_id, flow_date FROM fl"),
    "flow_body": _o("SELECT flow_id, CASE WHEN ccp = 'ccp3' THEN NULL ELSE concat('<flusso><id>', flow_id, "
                    "'</id><importo>', cast(amount AS VARCHAR), '</importo></flusso>') END AS body, ccp = 'ccp3' AS missing "
                    "FROM fl"),
    "flow_save_once": _o(f"SELECT count_if(flow_date >= '{STORED_BEFORE}') AS saved, "
                         f"count_if(flow_date < '{STORED_BEFORE}') AS already_present FROM keys"),
    "report_json": _o(
        "SELECT '{\"title\":\"child expansion\",\"metrics\":{\"positions\":' || (SELECT count(*) FROM exp_pp) || ',\"options\":' || "
        "(SELECT count(*) FROM exp_po) || ',\"transfers\":' || (SELECT count(*) FROM exp_tr) || '}}' AS report"),
    "child_expand_pp": _o("SELECT id, iupd, inserted_date FROM exp_pp"),
    "child_expand_po": _o("SELECT id, payment_position_id, iuv FROM exp_po"),
    "child_expand_tr": _o("SELECT payment_option_id, amount, category FROM exp_tr"),
    "cdc_envelope": _o(
        "SELECT id, iupd, status, inserted_date, CASE WHEN id % 13 = 0 AND txt NOT LIKE '%-02-29%' THEN epoch_us(try_strptime(concat('9999', "
        "substr(txt, 5)), '%Y-%m-%dT%H:%M:%S')) ELSE epoch_us(strptime(txt, '%Y-%m-%dT%H:%M:%S')) END AS validity_date, "
        f"'c' AS op, cast({EMIT_US // 1000} AS BIGINT) AS ts_ms, cast({EMIT_US} AS BIGINT) AS ts_us, "
        f"cast({EMIT_US} AS BIGINT) * 1000 AS ts_ns FROM src"),
}
