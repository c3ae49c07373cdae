"""Exact cosine k-nearest-neighbour retrieval.

Unit vectors make cosine distance a Euclidean one, so the triangle inequality
holds. The corpus is dealt to the cells of pivots (a bounded sample of its own
vectors). A query first visits its nearest cell, which bounds the distance of
its k-th hit; then only the cells that can hold a vector within that bound:
those whose ring around the pivot, and whose side of the half-way plane, come
near enough. The result is exact whatever the pivots are.

Visits are scored on a grid: where a cell has many queries or many vectors,
both are split, and each pair of parts meets in one task, which holds a part
of the queries and streams the vectors past them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .windows import top_k_per_group

#: Vectors of a cell and of a part of one, and queries that a task holds, on average.
BLOCK = 4096
#: Pivots at most: they and the cells' bounds are sent to every task.
PIVOTS = 512
#: Added to bounds: beyond the rounding of distances to twelve digits.
MARGIN = 1e-5


def _unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _usable(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, v) of the vectors that have a direction: not null, not zero, all components finite."""
    ok = F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("v")).where(ok)


def cells(corpus: DataFrame, block: int = BLOCK, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(id, v) → (cell, id, v) with unit vectors; the pivots; and per cell its vectors, least and largest distance from the pivot.

    There is a pivot for about ``block`` vectors, ``pivots`` at most; larger
    cells are split when they are scored. The pivots are the vectors with the smallest id hashes.
    """
    n = min(pivots, max(1, corpus.count() // block))
    chosen = [r.v for r in corpus.orderBy(F.xxhash64("id"), "id").limit(n).collect()]
    if not chosen:
        return corpus.select(F.lit(0).alias("cell"), "id", "v"), np.zeros((0, 0)), np.zeros((0, 3))
    at = _unit(chosen)

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                v = _unit(f["v"])
                near = _distances(v, at)
                cell = near.argmin(axis=1)
                yield pd.DataFrame({"cell": cell, "id": f["id"], "v": list(v), "r": near[np.arange(len(f)), cell]})

    kind = corpus.schema["id"].dataType.simpleString()
    placed = materialise(corpus.mapInPandas(dealt, f"cell int, id {kind}, v array<double>, r double"), "cells")
    bounds = np.zeros((len(at), 3))
    for cell, size, least, most in placed.groupBy("cell").agg(F.count(F.lit(1)), F.min("r"), F.max("r")).collect():  # one row a pivot
        bounds[cell] = size, least, most
    return placed.drop("r"), at, bounds


def _distances(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (v @ at.T)))


def nearest_cell(queries: DataFrame, at: np.ndarray, bounds: np.ndarray) -> DataFrame:
    """(id, v) → (id, v, cell): unit queries at the nearest cell that holds a vector."""
    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                v = _unit(f["v"])
                yield pd.DataFrame({"id": f["id"], "v": list(v), "cell": np.where(bounds[:, 0] > 0, _distances(v, at), np.inf).argmin(axis=1)})

    return queries.mapInPandas(first, f"id {queries.schema['id'].dataType.simpleString()}, v array<double>, cell int")


def other_cells(visited: DataFrame, at: np.ndarray, bounds: np.ndarray) -> DataFrame:
    """(id, v, cell, far) → (id, v, cell): the other cells that can hold a vector within cosine distance ``far`` (null: all)."""
    between = _distances(at, at)

    def rest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            v = np.stack(f["v"])
            near, own = _distances(v, at), f["cell"].to_numpy()
            reach = np.sqrt(2.0 * np.maximum(f["far"].fillna(2.0).to_numpy(np.float64), 0.0)) + MARGIN
            closest = near.min(axis=1, keepdims=True)
            # a vector of the cell is not farther from its pivot than from the query's closest one
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (near**2 - closest**2) / (2.0 * between[near.argmin(axis=1)])
            plane = np.where(np.isfinite(plane), plane, 0.0)
            least = np.maximum(np.maximum(near - bounds[:, 2], bounds[:, 1] - near), plane)
            go = (least <= reach[:, None]) & (bounds[:, 0] > 0)
            go[np.arange(len(f)), own] = False
            q, cell = np.nonzero(go)
            yield pd.DataFrame({"id": f["id"].to_numpy()[q], "v": [f["v"].iloc[i] for i in q], "cell": cell.astype(np.int32)})

    return visited.mapInPandas(rest, f"id {visited.schema['id'].dataType.simpleString()}, v array<double>, cell int")


def _scored(visits: DataFrame, placed: DataFrame, bounds: np.ndarray, k: int, block: int) -> DataFrame:
    """(q, c, distance): the k nearest of each part of a cell for every query that visits it."""
    spark = visits.sparkSession
    asked = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("q_parts"))
    sizes = spark.createDataFrame([(i, max(1, -(-int(b[0]) // block))) for i, b in enumerate(bounds)], "cell int, c_parts int")
    grid = asked.join(sizes, "cell")
    q_kind, c_kind = visits.schema["id"].dataType.simpleString(), placed.schema["id"].dataType.simpleString()
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = visits.join(grid, "cell").select("cell", part("q_parts").alias("i"), every("c_parts").alias("j"), F.lit(0).alias("side"),
                                         F.col("id").alias("q"), F.lit(None).cast(c_kind).alias("c"), "v")
    c = placed.join(grid, "cell").select("cell", every("q_parts").alias("i"), part("c_parts").alias("j"), F.lit(1).alias("side"),
                                         F.lit(None).cast(q_kind).alias("q"), F.col("id").alias("c"), "v")

    def streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, vectors, kept = None, [], [], None

        def out() -> pd.DataFrame:
            hits = [(q, i, d) for q, hit in zip(ids, kept) for d, i in hit]
            return pd.DataFrame(hits, columns=["q", "c", "distance"])

        for f in frames:
            for (cell, i, j, side), g in f.groupby(["cell", "i", "j", "side"], sort=False, dropna=False):
                if (cell, i, j) != key:
                    if kept:
                        yield out()
                    key, ids, vectors, kept = (cell, i, j), [], [], None
                if side == 0:
                    ids += g["q"].tolist()
                    vectors += g["v"].tolist()
                    continue
                if kept is None:
                    kept, m = [[] for _ in ids], np.stack(vectors) if vectors else None
                if m is None:
                    continue
                g = g.sort_values("c")  # equal distances: the smallest id first
                dist = np.round(1.0 - m @ np.stack(g["v"]).T, 12)
                c_ids = g["c"].tolist()
                for row, order in enumerate(np.argsort(dist, axis=1, kind="stable")[:, :k]):
                    kept[row] = sorted(kept[row] + [(float(dist[row, x]), c_ids[x]) for x in order])[:k]
        if kept:
            yield out()

    both = q.unionByName(c).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "side")
    return both.mapInPandas(streamed, f"q {q_kind}, c {c_kind}, distance double")


def knn(queries: DataFrame, corpus: DataFrame, k: int = 5, qid: str = "query_id", vid: str = "vec_id",
        vec: str = "embedding", block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """K1: the k corpus vectors closest to each query by cosine distance (1 - cos,
    rounded to twelve digits, so equal texts tie; ties go to the smallest id).
    Vectors that are null, zero or not finite have no direction: as queries
    they have no hits, in the corpus they are none."""
    asked, found = _usable(queries, qid, vec), _usable(corpus, vid, vec)
    placed, at, bounds = cells(found, block, pivots)
    q_kind, c_kind = asked.schema["id"].dataType.simpleString(), found.schema["id"].dataType.simpleString()
    if not len(at):
        return queries.sparkSession.createDataFrame([], f"{qid} {q_kind}, {vid} {c_kind}, distance double, rank int")
    first = materialise(nearest_cell(asked, at, bounds), "visits")
    near = materialise(_scored(first, placed, bounds, k, block), "hits")
    best = top_k_per_group(near, ["q"], [F.asc("distance"), F.asc("c")], k, "rank")
    if len(at) > 1:
        far = best.where(F.col("rank") == k).select(F.col("q").alias("id"), F.col("distance").alias("far"))
        others = materialise(other_cells(first.join(far, "id", "left"), at, bounds), "visits")
        near = near.unionByName(_scored(others, placed, bounds, k, block))
        best = top_k_per_group(near, ["q"], [F.asc("distance"), F.asc("c")], k, "rank")
    return best.select(F.col("q").alias(qid), F.col("c").alias(vid), "distance", "rank")


def context(hits: DataFrame, chunks: DataFrame, qid: str = "query_id", vid: str = "vec_id", rank: str = "rank",
            text: str = "document", source: str = "source", sep: str = "\n---\n") -> DataFrame:
    """K2: per query, the distinct sorted sources of its hits and their texts in
    order of rank. A group has at most the k hits of one query."""
    found = hits.join(chunks.select(F.col(vid).alias("_id"), text, source), F.col(vid) == F.col("_id"))
    return found.groupBy(qid).agg(
        F.array_join(F.array_sort(F.collect_set(source)), ",").alias("sources"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank, text))), lambda s: s[text]), sep).alias("context"))
