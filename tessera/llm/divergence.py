"""Source divergence audit: how far the sources of a language are apart, and by which terms.

Terms are grouped by cells of counts. A divergence is evaluated once per cell,
cells of equal value are merged and ranked by their cumulative number of
terms, and only the cells that reach the wanted ranks are expanded to terms.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

#: Probabilities are whole parts of this.
SCALE = 1_000_000_000
#: Documents of a language that a term must stand in.
MIN_DOCS = 3
#: Ranks of the ``term`` part.
MOST = 200
#: Entries that a task counts before it hands them on.
HELD = 1 << 20

# A term as bytes of lower-cased UTF-8: ASCII letters and every character beyond ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_COUNTS = "lang string, source string, term binary, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) → occurrences and documents of each term; a group's empty term only says that it occurs."""
    uses: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), c in uses.items():
            d = docs[lang, source]
            terms = [b"", *c]
            yield pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                                   pa.array(terms, pa.binary()), pa.array([0, *c.values()], pa.int64()),
                                   pa.array([0, *(d[t] for t in c)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        uses.clear()
        docs.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
            terms = _TERM.findall(text.lower())  # of bytes: only A-Z change
            c = uses.setdefault((lang, source), Counter())
            before = len(c)
            c.update(terms)
            docs.setdefault((lang, source), Counter()).update(set(terms))
            held += len(c) - before + 1
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def kept_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n): occurrences in the group and in the language of each term in ``min_docs`` documents of it.

    A row with the empty term stands for each group, also for one without
    terms. Tasks count before the one shuffle, by (lang, term), so a frequent
    term has a row per task and source.
    """
    rows = docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang), ("source", source), ("text", text))])
    counts = rows.mapInArrow(_counted, _COUNTS).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    seen = counts.select("*", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("lang_docs"))
    seen = seen.filter((F.col("term") == b"") | (F.col("lang_docs") >= min_docs))
    return seen.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)); null without terms."""
    under = F.when(terms > 0, total + terms)
    exact = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), under.cast("decimal(20,0)"))
    return F.when(n < F.lit(9 * 10**9), F.call_function("div", F.lit(SCALE).cast("long") * (n + 1), under)).otherwise(exact) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)² / q) of two shares, which a long holds."""
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
                      most: int = MOST) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources of each group, and the terms that mark it.

    Each language keeps the terms in at least ``min_docs`` of its documents
    (rows). A group is an occurring (lang, source); its share of a kept term is
    1 + floor(SCALE (count + 1) / (all its counts + number of kept terms)),
    that of the language likewise. Part ``pair`` has every other source of the
    language, the value summed over all kept terms (0 without any). Part
    ``term`` has terms that occur in the group with a share above the
    language's, to rank ``most``. Ranks count from 1 by value descending, then
    item in UTF-8 order; equal values and repeated documents are nothing
    special. Nulls are read as empty texts, texts without a term still make
    their group occur, an empty table has no rows; other columns are ignored.
    """
    kept = materialise(kept_terms(docs, lang, source, text, min_docs), "terms")
    terms = kept.filter("term <> ''")
    vectors = terms.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("v"))
    vectors = materialise(vectors.groupBy("lang", "v").agg(F.count("*").alias("m")), "vectors")
    cells = materialise(terms.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m")), "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("total"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(vectors.groupBy("lang").agg(F.sum("m").alias("terms")), "lang")
    every = kept.filter("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = materialise(every.withColumn("zero", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "groups")
    return _terms(terms, cells, groups, most).unionByName(_pairs(cells, vectors, groups))


def _terms(terms: DataFrame, cells: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.join(groups, ["lang", "source"]).select("lang", "source", "n", "lang_n", "m", p.alias("p"), q.alias("q")).filter("p > q")
    cells = materialise(cells.select("lang", "source", "n", "lang_n", "m", divergence(F.col("p"), F.col("q")).alias("value")), "cells")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # every value has a term, so no value after the first ``most`` can reach the ranks
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m")).withColumn("k", F.row_number().over(down)).filter(F.col("k") <= most)
    values = values.withColumn("before", F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter(F.col("before") < most)
    chosen = cells.drop("m").join(values.drop("m", "k"), ["lang", "source", "value"])
    merged = Window.partitionBy("lang", "source", "value").orderBy("term")
    found = terms.join(chosen, ["lang", "source", "n", "lang_n"]).withColumn("k", F.row_number().over(merged)).filter(F.col("k") <= most)
    rank = F.col("before") + F.col("k")
    return found.filter(rank <= most).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.cast("int").alias("rank"))


def _pairs(cells: DataFrame, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """Σ f over all kept terms for each two sources, from the cells of counts above zero.

    With z(x, y) the divergence at counts x and y, the sum over all terms is
    V z(0,0), plus z(c,0) - z(0,0) for each term of the one, z(0,c) - z(0,0)
    for each term of the other, and z(a,b) - z(a,0) - z(0,b) + z(0,0) for each
    term of both. Terms with equal counts in every source are one cell.
    """
    col, z = F.col, divergence
    here = groups.select("lang", col("source").alias("g"), col("total").alias("g_total"), "terms", col("zero").alias("g0"))
    there = groups.select("lang", col("source").alias("h"), col("total").alias("h_total"), col("zero").alias("h0"))

    def sums(rows: DataFrame, there_value: Column, back_value: Column | None) -> DataFrame:
        """What m terms add to the value of (g, h) and, seen from the other side, to that of (h, g), in parts that a long holds."""
        rows = rows.select("lang", "g", "h", "m", there_value.alias("x"), *([] if back_value is None else [back_value.alias("y")]))
        parts = [F.sum(col("m") * part(col(c))).alias(f"{c}{k}") for c in ("x", "y")[:2 if back_value is not None else 1]
                 for k, part in enumerate((lambda v: F.call_function("div", v, F.lit(SCALE).cast("long")), lambda v: v % SCALE))]
        found = rows.groupBy("lang", "g", "h").agg(*parts)
        whole = lambda c: (F.lit(SCALE).cast("decimal(10,0)") * col(f"{c}0").cast("decimal(20,0)") + col(f"{c}1").cast("decimal(20,0)")).cast("decimal(38,0)")
        out = found.select("lang", col("g").alias("source"), col("h").alias("item"), whole("x").alias("v"))
        return out if back_value is None else out.unionByName(found.select("lang", col("h").alias("source"), col("g").alias("item"), whole("y").alias("v")))

    g0, h0, p, q = col("g0"), col("h0"), col("p"), col("q")
    two = here.join(there, "lang").filter("g <> h")
    none = sums(two.withColumn("m", F.when(col("terms") > 0, col("terms")).otherwise(0)), F.coalesce(z(g0, h0), F.lit(0).cast("long")), None)
    single = cells.groupBy("lang", col("source").alias("g"), "n").agg(F.sum("m").alias("m")).join(two, ["lang", "g"])
    alone = sums(single.withColumn("p", share(col("n"), col("g_total"), col("terms"))), z(p, h0) - z(g0, h0), z(h0, p) - z(h0, g0))
    placed = vectors.filter(F.size("v") > 1).select("lang", "m", "v", F.posexplode("v").alias("i", "x"))
    met = placed.select("lang", "m", "x", F.explode(F.slice("v", col("i") + 2, F.size("v"))).alias("y"))
    met = met.groupBy("lang", col("x.source").alias("g"), col("y.source").alias("h"), col("x.n").alias("a"), col("y.n").alias("b")).agg(F.sum("m").alias("m"))
    met = met.join(here, ["lang", "g"]).join(there, ["lang", "h"]).withColumns(
        {"p": share(col("a"), col("g_total"), col("terms")), "q": share(col("b"), col("h_total"), col("terms"))})
    both = sums(met, z(p, q) - z(p, h0) - z(g0, q) + z(g0, h0), z(q, p) - z(h0, p) - z(q, g0) + z(h0, g0))
    value = none.unionByName(alone).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("v").cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.cast("int").alias("rank"))
