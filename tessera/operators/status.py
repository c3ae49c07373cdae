"""Maintenance and incident status operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Message texts (must equal the source's wording).
MAINTENANCE_TITLE = "{broker} - Manutenzione Programmata"
MAINTENANCE_INTRO = ("{broker} ha pianificato una manutenzione programmata nella fascia oraria indicata.\n\n"
                     "Non sarà possibile effettuare pagamenti verso i seguenti Enti Creditori:\n")
MAINTENANCE_STATIONS = "\nDi seguito le stazioni impattate:\n"
STATUS_PAGE_TAG = "toStatusPage"
TITLE_MARK = "ID: "
# ------------------------------------------------------------------------------


def maintenance_groups(maint: DataFrame) -> DataFrame:
    """One row per (broker, start, end) with its sorted distinct stations,
    so the list is bounded by the stations of one broker."""
    return maint.groupBy("broker_code", "starts_at", "ends_at").agg(
        F.array_sort(F.collect_set("station_code")).alias("stations"))


def impacted_entities(groups: DataFrame, inst: DataFrame) -> DataFrame:
    """Distinct institutions of the broker served by one of the group's stations."""
    exploded = groups.select("broker_code", "starts_at", "ends_at", F.explode("stations").alias("station_id"))
    j = exploded.join(inst, (exploded.broker_code == inst.broker_id) & (exploded.station_id == inst.station_id))
    return j.select("broker_code", "starts_at", "ends_at", "company_name", "tax_code").distinct()


def maintenance_messages(groups: DataFrame, inst: DataFrame) -> DataFrame:
    """H13 + D19: title and description per group; institutions sorted by
    (name, tax code); broker name = smallest registered for the broker."""
    impacted = impacted_entities(groups, inst)
    pa = impacted.groupBy("broker_code", "starts_at", "ends_at").agg(
        F.array_sort(F.collect_set(F.struct("company_name", "tax_code"))).alias("pa_list"))
    names = inst.groupBy("broker_id").agg(F.min("broker_company_name").alias("broker_name"))
    g = (groups.join(pa, ["broker_code", "starts_at", "ends_at"], "left")
         .join(names, groups.broker_code == names.broker_id, "left"))
    broker = F.coalesce(F.col("broker_name"), F.lit(""))
    pa_lines = F.array_join(F.transform(F.coalesce("pa_list", F.array().cast("array<struct<company_name:string,tax_code:string>>")),
                                        lambda p: F.concat(F.lit("- "), p["company_name"], F.lit(" - "), p["tax_code"], F.lit("\n"))), "")
    st_lines = F.array_join(F.transform("stations", lambda s: F.concat(F.lit("- "), F.replace(s, F.lit("_"), F.lit(" ")),
                                                                        F.lit("\n"))), "")
    intro = MAINTENANCE_INTRO.split("{broker}")
    message = F.concat(F.lit(intro[0]), broker, F.lit(intro[1]), pa_lines, F.lit(MAINTENANCE_STATIONS), st_lines)
    title_parts = MAINTENANCE_TITLE.split("{broker}")
    title = F.concat(F.lit(title_parts[0]), broker, F.lit(title_parts[1]))
    return g.select("broker_code", "starts_at", "ends_at", title.alias("title"), message.alias("message"))


def tag_list(csv: Column) -> Column:
    return F.split(csv, ",")


def _titles_by_id(reports: DataFrame, ids: DataFrame, compat: bool) -> DataFrame:
    """(_rid, report_id, aggregate_state): a row for each id that a title can name.

    A title names an id if the id's text stands right after a mark, so it
    equals the first characters there; only lengths that some id has are
    tried. Their list is bounded by the longest id.
    """
    lengths = ids.agg(F.sort_array(F.collect_set(F.length("_id"))).alias("l")).scalar()
    parts = F.split("title", TITLE_MARK, -1)
    tails = F.filter(F.transform(parts, lambda _, i: F.when(i > 0, F.array_join(F.slice(parts, i + 1, F.size(parts)), TITLE_MARK))), lambda t: t.isNotNull())
    own = reports.select(F.explode(tails).alias("_tail"), "report_id", "aggregate_state")
    # where the rest is shorter than the length, it is a shorter id's match
    fits = F.filter(F.col("_lengths"), lambda n: n <= F.length("_tail"))
    if not compat:
        fits = F.filter(fits, lambda n: ~F.substring(F.col("_tail"), n + 1, 1).rlike("[0-9A-Za-z_-]"))
    tried = own.withColumn("_lengths", lengths).select(F.explode(fits).alias("_n"), "_tail", "report_id", "aggregate_state")
    return tried.select(F.substring("_tail", F.lit(1), F.col("_n")).alias("_rid"), "report_id", "aggregate_state")


def match_by_title(incidents: DataFrame, reports: DataFrame, compat: bool = False) -> DataFrame:
    """First report (smallest id) whose title carries ``ID: <incident id>``.

    Ids are any texts. Default: no letter, digit, ``_`` or ``-`` follows the
    id, so ``ID: 1`` never matches ``ID: 12`` or ``ID: 1-7``. ``compat=True`` keeps the
    source's substring test. Both are an equi-join on the texts after the
    marks, cut to the lengths of the ids; no pair of a title and an id is
    tried. A null id or title matches nothing.
    """
    ids = incidents.select(F.col("id").cast("string").alias("_id"))
    keyed = _titles_by_id(reports, ids, compat)
    first = keyed.groupBy("_rid").agg(F.min_by(F.struct("report_id", "aggregate_state"), "report_id").alias("_r"))
    j = incidents.join(first, incidents.id.cast("string") == first._rid, "left")
    return j.select(incidents.columns + [F.col("_r.report_id").alias("report_id"),
                                         F.col("_r.aggregate_state").alias("report_state")])


def incident_actions(incidents: DataFrame, reports: DataFrame) -> DataFrame:
    """CREATE when no manual report matches; RESOLVE when the report is not
    yet 'Resolved' and the incident is 'resolved' with a different report state;
    NOOP otherwise. 'Resolved' and 'resolved' are different states."""
    tagged = incidents.where(F.array_contains("tags", STATUS_PAGE_TAG))
    manual = reports.where(F.col("report_type") == "manual")
    m = match_by_title(tagged, manual)
    action = (F.when(F.col("report_id").isNull(), F.lit("CREATE"))
              .when(F.col("report_state") == F.col("status"), F.lit("NOOP"))
              .when(F.col("report_state") == "Resolved", F.lit("NOOP"))
              .when(F.col("status") == "resolved", F.lit("RESOLVE"))
              .otherwise(F.lit("NOOP")))
    return m.select("id", "status", "report_id", "report_state", action.alias("action"))
