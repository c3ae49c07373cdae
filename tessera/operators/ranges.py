"""Numeric range overlap checks.

C10 avoids the nested-loop plan a pure range predicate gets: every range is
assigned to the finest level of a bucket hierarchy at which it spans at most
``fanout`` buckets and is exploded into those bucket ids; every candidate
start point is keyed once per level. The join is then an equi-join on
``(level, bucket)`` with the exact overlap test as residual, each pair is
produced exactly once (it is owned by the bucket holding the later range's
start), and no range explodes into more than ``fanout`` rows however wide it
is. Bounds are DECIMAL(38,0) because issuer ranges exceed BIGINT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

DEC = "decimal(38,0)"


def _scanned(df: DataFrame, order: list[str], rows_per_bucket: int) -> DataFrame:
    """``df`` as a written table sorted by ``order`` over buckets ``_b``, numbered in that order.

    Spark samples the buckets' bounds, so they hold about equally many rows
    wherever the values lie. No row order is lost between two buckets.
    """
    n = max(1, -(-df.count() // rows_per_bucket))
    return materialise(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()), "ranges")


def overlap_adjacent(df: DataFrame, owner: str = "abi", lo: str = "low_range", hi: str = "high_range",
                     key: str = "row_key", rows_per_bucket: int = 100_000) -> DataFrame:
    """Per owner, ranges sorted by start (then key); report consecutive
    pairs where the first ends at or after the second starts. Only adjacent
    pairs are compared, as in the source (contained ranges can be missed;
    :func:`overlap_owner_all` finds them).

    Skew-safe: the ranges are dealt by quantiles of (owner, start, key), so
    neither an owner with a third of all ranges nor starts that crowd together
    fill one task; the pair that crosses a bucket border comes from a summary
    with one row per bucket.
    """
    ranged = _scanned(df.select(owner, F.col(key).alias("_k"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi")), [owner, "_lo", "_k"], rows_per_bucket)
    row = F.struct(F.col(owner).alias("o"), F.col("_k").alias("k"), F.col("_lo").alias("l"), F.col("_hi").alias("h"))
    order = F.struct(owner, "_lo", "_k")

    def pairs(frame: DataFrame) -> DataFrame:
        return frame.where((F.col("cur.o") == F.col("nxt.o")) & (F.col("cur.h") >= F.col("nxt.l"))).select(
            F.col("cur.o").alias(owner), F.col("cur.k").alias("a_key"), F.col("cur.l").alias("a_low"), F.col("cur.h").alias("a_high"),
            F.col("nxt.k").alias("b_key"), F.col("nxt.l").alias("b_low"), F.col("nxt.h").alias("b_high"))

    inside = ranged.select(row.alias("cur"), F.lead(row).over(Window.partitionBy("_b").orderBy(owner, "_lo", "_k")).alias("nxt"))
    ends = ranged.groupBy("_b").agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
    across = ends.select(F.col("last").alias("cur"), F.lead("first").over(Window.orderBy("_b")).alias("nxt"))
    return pairs(inside).unionByName(pairs(across))


def overlap_owner_all(df: DataFrame, owner: str = "abi", lo: str = "low_range", hi: str = "high_range",
                      key: str = "row_key", rows_per_bucket: int = 100_000, run: int = 4096) -> DataFrame:
    """C9, all pairs: every two ranges of one owner of which the later (by start, then ``key``, which
    identifies a range) starts inside the earlier; contained ranges too. Ranges
    without a bound, or that end before they start, are left out.

    A sweep instead of a join of candidates: the ranges that start inside a
    range follow it without a gap in the order of starts. Starts and ends are
    sorted together over quantile buckets, and a running count of starts,
    carried over the bucket borders by a sum of one row per bucket, gives
    each range its place and the last place that it reaches. Only pairs that
    overlap are made, wide ranges in runs of ``run`` places over many tasks.
    """
    own = [F.col(owner).alias("_o"), F.col(key).alias("_k"), F.col(lo).cast(DEC).alias("_lo"), F.col(hi).cast(DEC).alias("_hi")]
    ranged = df.select(*own).where("_lo is not null and _hi is not null and _o is not null")
    points = F.array(F.struct(F.col("_lo").alias("at"), F.lit(0).alias("end")), F.struct(F.col("_hi").alias("at"), F.lit(1).alias("end")))
    events = _scanned(ranged.where("_hi >= _lo").select("_o", "_k", "_lo", "_hi", F.explode(points).alias("p")).select("_o", "_k", "_lo", "_hi", "p.at", "p.end"),
                      ["_o", "at", "end", "_k"], rows_per_bucket)
    before = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = events.groupBy("_b").agg(F.count_if(F.col("end") == 0).alias("_n")).select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(1 - F.col("end")).over(Window.partitionBy("_b").orderBy("_o", "at", "end", "_k").rowsBetween(Window.unboundedPreceding, 0))
    counted = events.withColumn("_c", inside).join(offsets, "_b").withColumn("_c", F.col("_c") + F.col("_before"))
    place = lambda end: F.max(F.when(F.col("end") == end, F.col("_c")))
    placed = materialise(counted.groupBy("_o", "_k", "_lo", "_hi").agg(place(0).alias("_at"), place(1).alias("_to")), "places")
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("_to") - F.col("_at") - 1, F.lit(run).cast("long"))))
    a = placed.where("_to > _at").select("*", runs.alias("_run")).repartition("_at", "_run")
    first = F.col("_at") + 1 + F.col("_run") * run
    a = a.select("_o", "_k", "_lo", "_hi", F.explode(F.sequence(first, F.least(first + (run - 1), F.col("_to")))).alias("_b_at"))
    b = placed.select(F.col("_at").alias("_b_at"), F.col("_k").alias("b_key"), F.col("_lo").alias("b_low"), F.col("_hi").alias("b_high"))
    return a.join(b, "_b_at").select(F.col("_o").alias(owner), F.col("_k").alias("a_key"), F.col("_lo").alias("a_low"), F.col("_hi").alias("a_high"),
                                     "b_key", "b_low", "b_high")


def _bucket_width(df: DataFrame, lo: str, hi: str) -> tuple[int, int]:
    """Base bucket width (≈ 90th percentile of range lengths) and the longest length."""
    length = (F.col(hi) - F.col(lo)).cast("double")
    row = df.agg(F.percentile_approx(length, 0.9, 1000).alias("p"), F.max(length).alias("m")).first()
    p = int(row["p"] or 0)
    m = int(row["m"] or 0)
    return max(1, p), max(0, m)


def overlap_cross(df: DataFrame, owner: str = "abi", lo: str = "low_range", hi: str = "high_range",
                  key: str = "row_key", fanout: int = 16, width: int | None = None) -> DataFrame:
    """All pairs (a, b) of ranges of different owners where b starts inside
    a, a ordered before b by (start, key); each pair once."""
    base_w, longest = _bucket_width(df, lo, hi)
    w0 = width or base_w
    levels = [w0]
    while (longest // levels[-1]) + 2 > fanout:
        levels.append(levels[-1] * fanout)

    def start_of(v, w):
        return (v - F.pmod(v, F.lit(w).cast(DEC))).cast(DEC)

    def span(w):
        return F.call_function("div", start_of(F.col(hi), w) - start_of(F.col(lo), w), F.lit(w).cast(DEC)).cast(DEC) + 1

    level = None
    for i, w in enumerate(levels):
        cond = span(w) <= fanout
        level = F.when(cond, F.lit(i)) if level is None else level.when(cond, F.lit(i))
    level = F.coalesce(level, F.lit(len(levels) - 1))
    widths = F.array(*[F.lit(w).cast(DEC) for w in levels])

    a = df.select(F.col(owner).alias("a_owner"), F.col(key).alias("a_key"), F.col(lo).alias("a_low"),
                  F.col(hi).alias("a_high"), level.alias("level"))
    a = a.withColumn("_w", F.element_at(widths, F.col("level") + 1))
    a = a.withColumn("_first", (F.col("a_low") - F.pmod(F.col("a_low"), F.col("_w"))).cast(DEC))
    a = a.withColumn("_n", F.call_function("div", F.col("a_high") - F.pmod(F.col("a_high"), F.col("_w")) - F.col("_first"), F.col("_w")) + 1)
    a = a.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    a = a.withColumn("bucket", (F.col("_first") + F.col("_i") * F.col("_w")).cast(DEC)).drop("_w", "_first", "_n", "_i")

    b = df.select(F.col(owner).alias("b_owner"), F.col(key).alias("b_key"), F.col(lo).alias("b_low"),
                  F.col(hi).alias("b_high"))
    b = b.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))))
    b = b.withColumn("_w", F.element_at(widths, F.col("level") + 1))
    b = b.withColumn("bucket", (F.col("b_low") - F.pmod(F.col("b_low"), F.col("_w"))).cast(DEC)).drop("_w")

    before = (F.col("a_low") < F.col("b_low")) | ((F.col("a_low") == F.col("b_low")) & (F.col("a_key") < F.col("b_key")))
    cond = ((a.level == b.level) & (a.bucket == b.bucket) & (F.col("b_low") <= F.col("a_high"))
            & before & (F.col("a_owner") != F.col("b_owner")))
    return a.join(b, cond, "inner").select("a_owner", "a_key", "a_low", "a_high", "b_owner", "b_key", "b_low", "b_high")
