"""Join operators.

No side carries a broadcast hint: AQE broadcasts a side from its measured
bytes and splits skewed partitions of the shuffle joins that remain. Where a
derived key has few values (two-character prefixes), the fact side is
aggregated per key before it meets the registry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pad2, prefix2
from ..session import materialise


def position_option_transfer(pp: DataFrame, po: DataFrame, t: DataFrame) -> DataFrame:
    """Positions ⋈ options ⋈ transfers (inner equi-joins on parent ids)."""
    j = pp.join(po, pp.pp_id == po.payment_position_id, "inner")
    return j.join(t, t.payment_option_id == j.po_id, "inner")


def waterfall_options(pp: DataFrame, po: DataFrame, t: DataFrame, category_pattern: str,
                      excluded_iupd: str, statuses: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """C3 in one pass: the final options with their position's columns, and the
    qualifying transfers. An option is final iff it has a qualifying transfer
    and a qualifying position, so ``po ⋈ pp_ok ⋉ t_ok`` equals the waterfall's
    ``po_final ⋈ pp_final`` without recomputing the intermediate sets."""
    t_ok = t.where(F.col("category").rlike(category_pattern))
    pp_ok = pp.where(~F.col("iupd").like(excluded_iupd) & F.col("status").isin(list(statuses)))
    with_pp = po.join(pp_ok, po.payment_position_id == pp_ok.pp_id, "inner")
    final = with_pp.join(t_ok.select("payment_option_id"), F.col("po_id") == F.col("payment_option_id"), "left_semi")
    return final, t_ok


def semi_waterfall(pp: DataFrame, po: DataFrame, t: DataFrame, category_pattern: str,
                   excluded_iupd: str, statuses: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Final positions, options and transfers. The final options (with
    their position's columns) are materialised once; positions are distinct
    in them, and transfers are those of a final option. Ids are unique."""
    final, t_ok = waterfall_options(pp, po, t, category_pattern, excluded_iupd, statuses)
    final = materialise(final, "final-options")
    t_final = t_ok.join(final.select("po_id"), t_ok.payment_option_id == F.col("po_id"), "left_semi")
    return final.select(*pp.columns).distinct(), final.select(*po.columns), t_final


#: Registry rows in one array of :func:`partner_match`, at most.
REGISTRY_RUN = 64
#: Parts of a prefix's options there; registry rows are sent to each.
KEY_PARTS = 64


def partner_match(opts: DataFrame, rpt: DataFrame, match: str = "prefix") -> DataFrame:
    """Options ⋈ partner registry on ``substr(iuv,1,2) = lpad(segregazione,2,'0')``.

    ``match='prefix'`` is the source's key (organisation not in it, so a
    prefix shared by several registry rows fans out); ``'prefix+domain'``
    also requires the registry's domain to be the option's organisation.

    The work lies in the rows that come out, one for each registry row of an
    option's key. So registry rows are joined as short arrays, whose rows are
    read in line, and options are dealt out to all shuffle partitions: AQE
    would merge them by the few bytes that go in. A registry that is not
    broadcast would bring all options of a prefix to one task, so they are
    dealt out in parts, each of which meets all arrays of its prefix.
    """
    on = ["seg_key", "id_dominio"] if match == "prefix+domain" else ["seg_key"]
    dim = rpt.withColumn("seg_key", pad2("segregazione"))
    # by all columns: rows that tie are equal, so a task run again makes the same arrays
    place = F.row_number().over(Window.partitionBy(*on).orderBy(*dim.columns)) - 1
    runs = dim.withColumn("_run", F.floor(place / REGISTRY_RUN)).groupBy(*[F.col(k).alias(f"_{k}") for k in on], "_run").agg(
        F.collect_list(F.struct(*dim.columns)).alias("_rows"))
    n = int(opts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = opts.withColumn("iuv_prefix", prefix2("iuv"))
    cond = F.col("iuv_prefix") == F.col("_seg_key")
    if match == "prefix+domain":  # the organisation spreads a prefix, and few rows come out
        o = o.repartition(n, "iuv")
        cond = cond & (F.col("organization_fiscal_code") == F.col("_id_dominio"))
        return o.join(runs, cond, "inner").select(o["*"], F.inline("_rows"))
    part = F.pmod(F.xxhash64(*opts.columns), F.lit(KEY_PARTS)).cast("int")
    dealt = o.withColumn("_part", part).repartition(n, "iuv_prefix", "_part")
    every = runs.withColumn("_for", F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1)))).repartition(n, "_seg_key", "_for")
    return dealt.join(every, cond & (F.col("_part") == F.col("_for")), "inner").select(*o.columns, F.inline("_rows"))


def partner_prefixes(rpt: DataFrame, partner: str = "id_intermediario_pa") -> DataFrame:
    """C2 for aggregates: (iuv_prefix, partner, n_rows), the registry counted
    per prefix and partner, so that facts aggregated per prefix join it once
    and are weighted by its row count instead of being copied per row."""
    return rpt.groupBy(pad2("segregazione").alias("iuv_prefix"), partner).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_by_registry(facts: DataFrame, registry: DataFrame, prefix: str, value: str, keys: Sequence[str],
                         partner: str, out: str) -> DataFrame:
    """D3: distinct ``value`` per registry ``partner`` and ``keys``, where a
    registry row (``prefix``, ``partner``) takes the facts of its prefix.

    Values are first counted by the set of prefixes they are found under (few
    sets: a prefix has two characters), so a value found under several prefixes
    of a partner counts once and only sets, not values, meet the registry. Null
    values do not count; facts without a partner give no row."""
    found = facts.where(F.col(value).isNotNull() & F.col(prefix).isNotNull()).groupBy(*keys, value).agg(
        F.array_sort(F.collect_set(prefix)).alias("_set"))
    sets = found.groupBy(*keys, "_set").agg(F.count(F.lit(1)).alias("_n"))
    named = sets.withColumn(prefix, F.explode("_set")).join(registry.select(prefix, partner).distinct(), prefix)
    return named.select(partner, *keys, "_set", "_n").distinct().groupBy(partner, *keys).agg(F.sum("_n").alias(out))


#: HLL sketches of 2^LG_K registers and the relative standard error of their merged estimates.
LG_K = 12
SKETCH_ERROR = 1.04 / 2 ** (LG_K / 2)


def distinct_sketches(facts: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """D3 (approximate): one HLL sketch of ``value`` per ``keys``, to be stored and merged."""
    return facts.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(LG_K)).alias("sketch"))


def merge_sketches(stored: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """D3 (approximate): the distinct count per ``keys`` of any stored sketches together."""
    return stored.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def enrich_left(small: DataFrame, big: DataFrame, keys: Sequence[str], cols: Sequence[str], reduce_big: bool = False) -> DataFrame:
    """C4: every row of ``small`` left-joined to matching rows of ``big``; a
    runtime bloom filter prunes ``big`` before the shuffle where it pays.
    ``reduce_big`` first semi-joins ``big`` with the keys of ``small``, for a
    file that covers little of it."""
    hits = big.select(*keys, *cols)
    if reduce_big:
        hits = hits.join(small.select(*keys).distinct(), list(keys), "left_semi")
    return small.join(hits, list(keys), "left")


def lookup_left(df: DataFrame, lookup: DataFrame, keys: Sequence[str] | Column) -> DataFrame:
    """Left lookup join (the lookup side is the build side)."""
    return df.join(lookup, keys, "left")


def exclude_existing(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (left anti-join)."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def membership_flag(df: DataFrame, col: str, codes: DataFrame, code_col: str, name: str) -> DataFrame:
    """C14: boolean ``name`` = value of ``col`` is one of the distinct ``codes``."""
    code_set = codes.select(F.col(code_col).alias("_code")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(code_set, df[col] == code_set["_code"], "left")
    return joined.withColumn(name, F.coalesce(F.col("_hit"), F.lit(False))).drop("_code", "_hit")


def reconcile(a: DataFrame, b: DataFrame, key_a: str, key_b: str, order_a: str, order_b: str,
              empty_guard: bool = True) -> tuple[DataFrame, DataFrame]:
    """Keys present on one side only, after keeping the last row per key
    on each side (by the given order column, "last write wins").

    With ``empty_guard`` (the source's behaviour) nothing is reported when
    either side is empty; the check is a bounded ``isEmpty`` probe.
    """
    from .windows import keep_last

    last_a = keep_last(a, [key_a], order_a)
    last_b = keep_last(b, [key_b], order_b)
    only_a = last_a.join(last_b.select(F.col(key_b).alias("_k")), F.col(key_a) == F.col("_k"), "left_anti")
    only_b = last_b.join(last_a.select(F.col(key_a).alias("_k")), F.col(key_b) == F.col("_k"), "left_anti")
    if empty_guard and (a.isEmpty() or b.isEmpty()):
        return only_a.limit(0), only_b.limit(0)
    return only_a, only_b


def prefix_residual_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                         text_col: str, prefix_col: str) -> DataFrame:
    """Equi-join on the keys plus ``left.text startswith right.prefix`` as a
    residual of the same hash join (no nested-loop join is planned). The
    prefix is used as stored (unpadded), as the source does. Texts are tried
    against the different prefixes of their key, however many rows of ``right``
    share one; only what starts with a prefix then meets those rows."""
    prefix = right[prefix_col].cast("string")
    tried = right.select(right[right_key].alias("_key"), prefix.alias("_prefix")).distinct()
    hits = left.join(tried, (left[left_key] == F.col("_key")) & left[text_col].startswith(F.col("_prefix")), "inner")
    return hits.join(right, (F.col("_key") == right[right_key]) & (F.col("_prefix") == prefix), "inner").drop("_key", "_prefix")
