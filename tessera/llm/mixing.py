"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, columns, materialise, prefix

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its size.
MOST_COPIES = 3
SEED = 7


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) → the same with ``target`` (double), the words the mix should take of it.

    Sources by code point, null last, weigh ``weights``, repeating, and share
    the total of all sizes; a target stops at ``most`` times its source's size,
    and the excess is shared by weight among the others until none is above.
    In order of size by weight the capped sources come first, so one pass of
    running sums finds the level. The table has one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    w = F.array(*[F.lit(x).cast("long") for x in weights])[(rank % len(weights)).cast("int")]
    cap = F.col("source_size") * most
    s = sources.withColumn("w", w).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    s = s.withColumn("level", left.cast("double") / rest.cast("double"))
    level = F.max("level").over(everything)  # it rises up to the first source that isn't capped, and falls after
    s = s.withColumn("level", level)
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """(id, th, size, source, source_size, target, n_copies), one row per row of ``docs``; ``th`` is xxhash64 of the text.

    Within a source every document expects target / source_size copies. The
    documents stand in order of size (a class of about its root's width, then
    a salt of the id, then size, id and text hash); the prefix sum of the expected copies
    plus the source's random offset crosses n_copies integers at each. Near
    sizes stand together, so the words taken stay close to the target. The
    prefix sum is made of counts per (source, class, salt) and places inside;
    salts split a class into groups of about the square root of the source's
    rows, so neither a hot source nor a common size meets in one task.

    A null or empty text has size 0 and a null source is a source of its own,
    the last one. Repeated rows each have their own place. A source of size 0
    gives no copies. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("class", F.floor(2 * F.sqrt("size")).cast("int"))
    rows = materialise(rows, "sizes")
    classes = materialise(rows.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "size_classes")
    sources = classes.groupBy("source").agg(F.sum("n").alias("n_source"), F.sum("size").alias("source_size"))
    aimed = targets(sources, weights, most)
    salts = classes.join(sources.select(F.col("source").alias("s"), "n_source"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "class", F.ceil(F.col("n") / F.ceil(F.sqrt("n_source"))).alias("n_salts"))
    salts = materialise(salts, "salts")
    same = lambda a, b, *cols: [a[c].eqNullSafe(b[c]) for c in cols]
    salted = rows.join(salts, same(rows, salts, "source", "class")).select(
        rows.id, rows.th, rows.source, rows["class"], rows["size"], F.pmod(_hash(F.coalesce(rows.id, rows.th), seed), salts.n_salts).alias("salt"))
    salted = materialise(salted, "salted")
    groups = salted.groupBy("source", "class", "salt").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("source").orderBy("class", "salt").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("source", "class", "salt", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    offset = F.pmod(_hash(F.coalesce("source", F.lit("")), seed), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = aimed.select("source", "source_size", "target", rate.alias("rate"), offset.alias("offset"))
    groups = groups.join(aimed, same(groups, aimed, "source")).select(
        groups.source, "class", "salt", "ahead", "source_size", "target", "rate", "offset")
    groups = materialise(groups, "groups")
    place = F.row_number().over(Window.partitionBy("source", "class", "salt").orderBy("size", "id", "th"))
    placed = salted.withColumn("place", place)
    placed = placed.join(groups, same(placed, groups, "source", "class", "salt")).select(
        "id", "th", placed["size"], placed.source, "source_size", "target", "rate", "offset", (F.col("ahead") + F.col("place")).alias("place"))
    upto = lambda k: F.floor(k * F.col("rate") + F.col("offset"))
    return placed.select("id", "th", "size", "source", "source_size", "target", (upto(F.col("place")) - upto(F.col("place") - 1)).alias("n_copies"))


def _hash(c: Column, seed: int) -> Column:
    """48 random bits of a value, the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string"))), 1, 12), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as :func:`copies` says, in its own columns.

    Rows that repeat an id, a text and a source share their copies evenly; the
    first in order of the hash of all columns get the one more.
    """
    n = copies(docs, id_col, text_col, source_col, weights, most, seed)
    n = materialise(n.groupBy("id", "th", "source").agg(F.sum("n_copies").alias("n"), F.count("*").alias("of")), "copies")
    p = prefix(docs)
    n = n.select(*[F.col(c).alias(p + c) for c in n.columns])
    own = columns(docs)
    one = [docs[id_col].eqNullSafe(F.col(p + "id")), F.xxhash64(docs[text_col]) == F.col(p + "th"), docs[source_col].eqNullSafe(F.col(p + "source"))]
    rows = docs.join(n.filter(F.col(p + "of") == 1).hint("merge"), one).select(*own, F.col(p + "n"))
    repeated = n.filter(F.col(p + "of") > 1)
    if not repeated.isEmpty():
        place = F.row_number().over(Window.partitionBy(p + "id", p + "th", p + "source").orderBy(F.xxhash64(F.struct(*own))))
        more = F.floor(F.col(p + "n") / F.col(p + "of")) + F.when(place <= F.col(p + "n") % F.col(p + "of"), 1).otherwise(0)
        rows = rows.unionByName(docs.join(repeated, one).select(*own, more.alias(p + "n")))
    times = F.when(F.col(p + "n") > 0, F.sequence(F.lit(1).cast("long"), F.col(p + "n"))).otherwise(F.array().cast("array<long>"))
    return rows.withColumn(p + "n", F.explode(times)).drop(p + "n")
