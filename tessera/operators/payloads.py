"""Event-log payload jobs.

Decoding and parsing are per-row native expressions (``unbase64``,
``from_xml``, ``get_json_object``) inside whole-stage codegen; the per-row
remote lookups of the source become one hash join on (iuv, ccp).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import b64_text, parse_xml, strip_namespaces, tagged_body
from ..session import materialise

NOTIFY_SCHEMA = (
    "Body STRUCT<pspNotifyPaymentV2: STRUCT<fee: STRING, timestampOperation: STRING, totalAmount: STRING, "
    "additionalPaymentInformations: STRUCT<metadata: STRUCT<mapEntry: ARRAY<STRUCT<key: STRING, value: STRING>>>>, "
    "paymentList: STRUCT<payment: ARRAY<STRUCT<creditorReferenceId: STRING, fiscalCodePA: STRING, "
    "metadata: STRUCT<mapEntry: ARRAY<STRUCT<key: STRING, value: STRING>>>>>>>>"
)
FLOW_LIST_SCHEMA = ("idRendicontazione ARRAY<STRUCT<identificativoFlusso: STRING, dataOraFlusso: STRING>>")


def agreement_payments(events: DataFrame, start: str, end: str, psp: str,
                       event_type: str = "pspNotifyPaymentV2") -> DataFrame:
    """H7: notified payments paid by card ('CP') that carry an agreement code.

    ``inserted_ts`` lies in [start, end), so neighbouring slices share no event.
    A notification may hold one payment or a cart of several, and a payment one
    metadata entry or several: there is a row for each payment and each of its
    agreement codes. An event that names the card method several times gives
    its rows once for each. Every payload is decoded and parsed once; what it
    says is judged after."""
    ev = events.where(
        (F.col("inserted_ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("inserted_ts") < F.lit(end).cast("timestamp_ntz"))
        & (F.col("psp") == psp) & (F.col("tipo_evento") == event_type) & (F.col("sotto_tipo_evento") == "REQ"))
    body = parse_xml(strip_namespaces(b64_text(F.col("payload"))), NOTIFY_SCHEMA)

    def card_payments(n: Column) -> Column:
        cards = F.filter(n["additionalPaymentInformations"]["metadata"]["mapEntry"], lambda e: (e["key"] == "tipoVersamento") & (e["value"] == "CP"))

        def coded(pay: Column) -> Column:
            codes = F.filter(pay["metadata"]["mapEntry"], lambda e: e["key"] == "codiceConvenzione")
            return F.transform(codes, lambda e: F.struct(
                n["timestampOperation"].alias("timestamp_operation"), pay["fiscalCodePA"].alias("ec"), pay["creditorReferenceId"].alias("iuv"),
                n["totalAmount"].alias("amount"), n["fee"].alias("fee"), e["value"].alias("cod_conv")))

        # a payment without metadata has no codes; flatten would turn the whole cart into null
        rows = F.flatten(F.filter(F.transform(n["paymentList"]["payment"], coded), lambda r: r.isNotNull()))
        return F.flatten(F.transform(cards, lambda _: rows))

    # bound once in a lambda and exploded with outer, so that no filter repeats the parsing below
    found = F.transform(F.array(body["Body"]["pspNotifyPaymentV2"]), card_payments)[0]
    rows = ev.select("event_id", "ccp", F.explode_outer(found).alias("r")).where(F.col("r").isNotNull())
    return rows.select("event_id", "r.*", "ccp")


def result_outcome(events: DataFrame, event_type: str = "sendPaymentResult-v2") -> DataFrame:
    """H8: outcome field of base64 JSON result events."""
    ev = events.where((F.col("tipo_evento") == event_type) & (F.col("sotto_tipo_evento") == "REQ"))
    return ev.select("event_id", "inserted_ts", "id_dominio", "iuv", "ccp",
                     F.get_json_object(b64_text(F.col("payload")), "$.outcome").alias("outcome"))


def exclude_ko(payments: DataFrame, results: DataFrame) -> DataFrame:
    """Drop a payment when the first matching result (by time, then id)
    has outcome KO. A result matches on iuv and ccp with a domain containing
    the payment's organisation; payments without a match are kept. Each payment
    of a cart is judged by its own results. The payments are written once, so
    that no payload is parsed for the judgement and again for the answer."""
    payments = materialise(payments, "payments")
    r = results.select(F.col("id_dominio").alias("r_dom"), F.col("iuv").alias("r_iuv"), F.col("ccp").alias("r_ccp"),
                       F.struct("inserted_ts", "event_id").alias("r_order"), F.col("outcome").alias("r_outcome"))
    p = payments.select("event_id", "ec", "iuv", "ccp")
    m = p.join(r, (p.iuv == r.r_iuv) & (p.ccp == r.r_ccp) & F.col("r_dom").contains(F.col("ec")), "inner")
    first = m.groupBy("event_id", "iuv", "ec").agg(F.min_by("r_outcome", "r_order").alias("first_outcome"))
    ko = first.where(F.col("first_outcome") == "KO").select("event_id", "iuv", "ec")
    return payments.join(ko, ["event_id", "iuv", "ec"], "left_anti")


def flow_list(docs: DataFrame, date_prefix: str | None = None) -> DataFrame:
    """Every ``idRendicontazione`` of the flow-list documents → (flow id, flow date),
    optionally only flows whose date starts with ``date_prefix``."""
    parsed = docs.select("id_dominio", parse_xml(F.col("xml"), FLOW_LIST_SCHEMA).alias("d"))
    flows = parsed.select("id_dominio", F.explode("d.idRendicontazione").alias("f")).select(
        "id_dominio", F.col("f.identificativoFlusso").alias("flow_id"), F.col("f.dataOraFlusso").alias("flow_date"))
    if date_prefix:
        flows = flows.where(F.col("flow_date").startswith(date_prefix))
    return flows


def flow_body(responses: DataFrame) -> DataFrame:
    """Decoded body between the flow tags; a missing tag is reported as missing."""
    raw = tagged_body(F.col("response"))
    return responses.select("flow_id", F.when(raw != "", b64_text(raw)).alias("body"),
                            (raw == "").alias("missing"))


def save_once(new: DataFrame, existing: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not stored yet, plus one row of counts."""
    stored = existing.select(key).distinct().withColumn("_seen", F.lit(True))
    tagged = new.join(stored, key, "left")
    to_store = tagged.where(F.col("_seen").isNull()).drop("_seen")
    counts = tagged.agg(F.count_if(F.col("_seen").isNull()).alias("saved"),
                        F.count_if(F.col("_seen")).alias("already_present"))
    return to_store, counts


def child_expand(pp: DataFrame, po: DataFrame, t: DataFrame, lo_us: int, hi_us: int
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C11: positions inserted in [lo, hi), their options, their transfers."""
    pos = pp.where((F.col("inserted_date") >= lo_us) & (F.col("inserted_date") < hi_us))
    opts = po.join(pos.select(F.col("id").alias("_pid")), po.payment_position_id == F.col("_pid"), "left_semi")
    trs = t.join(opts.select(F.col("id").alias("_oid")), t.payment_option_id == F.col("_oid"), "left_semi")
    return pos, opts, trs
