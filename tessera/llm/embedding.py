"""Near-duplicate embeddings by cross-polytope hashing.

A hash function rotates a vector pseudo-randomly (three rounds of random signs
and a fast Hadamard transform) and takes the nearest signed basis vector. A
table joins several functions to one bucket. Every vector lies in its home
bucket and probes the next likeliest ones; whoever probes another's home is a
candidate, and every candidate pair is verified in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.components import components

SEED = 11
#: Buckets that a vector probes in a table, its home included.
PROBES = 12
#: Signed basis vectors that a probe may take for a function, nearest first.
CHOICES = 4
#: Share of pairs at exactly the threshold that all tables together may miss.
MISS = 0.001


def rotate(x: np.ndarray, table: int, function: int) -> np.ndarray:
    """(n, d) rotated, d a power of two."""
    d = x.shape[1]
    rng = np.random.default_rng([SEED, table, function])
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], d)
        h = 1
        while h < d:
            x = x.reshape(len(x), -1, 2, h)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), d)
            h *= 2
        x /= math.sqrt(d)
    return x


def buckets(x: np.ndarray, table: int, functions: int, probes: int = PROBES) -> np.ndarray:
    """(n, probes) bucket codes of unit vectors, the home first; fewer columns if there are fewer buckets."""
    n, width = x.shape
    d = 1 << max(1, (width - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - width)))
    choices = min(CHOICES, 2 * d)
    codes, costs = [], []
    for f in range(functions):
        r = rotate(x, table, f)
        both = np.concatenate([r, -r], axis=1)
        near = np.argsort(-both, axis=1, kind="stable")[:, :choices]
        at = np.take_along_axis(both, near, axis=1)
        codes.append(near.astype(np.uint64))
        costs.append((at[:, :1] - at) ** 2)
    # the best choices of the first functions, one function more at a time: the best of all begin with those
    cost, picked = np.zeros((n, 1)), np.zeros((n, 1, 0), np.int64)
    for c in costs:
        total = (cost[:, :, None] + c[:, None, :]).reshape(n, -1)
        best = np.argsort(total, axis=1, kind="stable")[:, :probes]
        cost = np.take_along_axis(total, best, axis=1)
        picked = np.concatenate([np.take_along_axis(picked, (best // choices)[:, :, None], axis=1), (best % choices)[:, :, None]], axis=2)
    code = np.full(cost.shape, width * 1_000_003 + table, np.uint64)
    for f, c in enumerate(codes):
        code = code * np.uint64(0x9E3779B97F4A7C15) + np.take_along_axis(c, picked[:, :, f], axis=1)
    return code ^ code >> np.uint64(29)


@cache
def tables_for(width: int, functions: int, threshold: float, probes: int = PROBES, miss: float = MISS) -> int:
    """Tables after which at most ``miss`` of the pairs at cosine ``threshold`` have met in none, from simulated pairs."""
    rng = np.random.default_rng(SEED)
    a, b = rng.standard_normal((2, 4096, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b *= math.sqrt(max(0.0, 1 - threshold**2)) / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    x, y = buckets(a, 0, functions, probes), buckets(threshold * a + b, 0, functions, probes)
    met = ((x == y[:, :1]) | (y == x[:, :1])).any(axis=1).mean()
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(met, 0.999))))


def unit(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) of a list column, once for each length."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, starts = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64), vectors.offsets.to_numpy()[:-1]
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.nonzero(sizes == size)[0]
        x = flat[starts[at][:, None] + np.arange(size)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def functions_for(n: int, width: int) -> int:
    """Functions that make about as many buckets as there are vectors of a length."""
    return max(2, math.ceil(math.log(max(n, 2)) / math.log(2 << max(1, (width - 1).bit_length()))))


def _candidates(reps: DataFrame, functions: dict[int, int], threshold: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of vectors of which one probes the other's home."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in unit(batch.column(1)):
                own = functions[x.shape[1]]
                for t in range(tables_for(x.shape[1], own, threshold)):
                    code = buckets(x, t, own)
                    rank = np.broadcast_to(np.arange(code.shape[1], dtype=np.int32), code.shape)
                    yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64).ravel()), pa.array(np.repeat(ids[at], code.shape[1])),
                                                      pa.array(rank.ravel())], ["key", "rep", "rank"])

    keys = materialise(reps.select("rep", "vec").mapInArrow(work, "key long, rep long, rank int"), "buckets")
    home = keys.filter("rank = 0").select("key", F.col("rep").alias("home"))
    met = keys.select("key", "rep").join(home, "key").filter("rep <> home")
    return met.select(F.least("rep", "home").alias("a"), F.greatest("rep", "home").alias("b")).distinct()


def _verified(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` whose cosine reaches ``threshold``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            near = np.zeros(batch.num_rows, bool)
            other = {at[0]: (at, v) for at, v in unit(y)} if batch.num_rows else {}
            for at, v in unit(x):
                for them, w in other.values():
                    if v.shape[1] == w.shape[1]:
                        both, i, j = np.intersect1d(at, them, assume_unique=True, return_indices=True)
                        near[both] = np.einsum("ij,ij->i", v[i], w[j]) >= threshold
            yield batch.select([0, 1]).filter(pa.array(near))

    one = reps.select(F.col("rep").alias("a"), F.col("vec").alias("x"))
    two = reps.select(F.col("rep").alias("b"), F.col("vec").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(work, "a long, b long").distinct()


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id and kept.

    Equal vectors are one representative with a count, so a vector that a
    third of all rows share is hashed once. The number of functions makes, for
    each length of its own, about as many buckets as there are different
    vectors of it; the number of tables follows from :data:`MISS`. n_links: other rows with a cosine of at least
    ``threshold`` among the pairs found; component_id: the smallest id
    reachable by links; kept: id = component_id.

    Vectors that are null, empty or zero, hold null or non-finite components
    or have no id link with nothing (0 links, a component of their own).
    Vectors of different lengths never link. Rows that repeat an id and a
    vector count as other rows. Other columns are not read; an empty table
    gives an empty one.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = F.coalesce(F.col("id").isNotNull() & F.forall("vec", fine) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = materialise(rows.select("id", F.when(valid, F.col("vec")).alias("vec")), "vectors")
    reps = materialise(rows.filter("vec is not null").groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "representatives")
    lengths = reps.groupBy(F.size("vec").alias("width")).count().collect()  # a row for each length
    functions = {r["width"]: functions_for(r["count"], r["width"]) for r in lengths}
    edges = materialise(_verified(_candidates(reps, functions, threshold), reps, threshold), "links")
    copies = materialise(reps.groupBy("rep").agg(F.sum("copies").alias("copies")), "copies")
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(copies, ends.b == copies.rep).groupBy("a").agg(F.sum("copies").alias("links"))
    roots = components(edges)
    known = copies.join(linked, copies.rep == linked.a, "left").join(roots, copies.rep == roots.node, "left").select(
        "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    known = materialise(known, "known")
    named = materialise(reps.select(F.col("vec").alias("v"), "rep").join(known, "rep"), "named")
    out = rows.join(named, rows.vec == named.v, "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
