"""Reachability over a link graph.

A frontier loop of DataFrames: each round joins the frontier with the edge
table and removes already-visited nodes with a ``left_anti`` join, until the
frontier is empty. The edges, and every frontier, are written once to the
cluster's shared folder, so no round repeats an earlier one or the extraction
of the links, and a lost executor recomputes at most one round. The only
driver-side value per round is the frontier's emptiness.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def reachable(edges: DataFrame, seeds: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """All nodes reachable from ``seeds`` (one column ``node``), seeds included."""
    e = materialise(edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d")).distinct(), "edges")
    rounds = [materialise(seeds.select("node").distinct(), "frontier")]
    while not rounds[-1].isEmpty():
        step = rounds[-1].join(e, F.col("node") == F.col("_s")).select(F.col("_d").alias("node")).distinct()
        new = materialise(step.join(reduce(DataFrame.unionByName, rounds), "node", "left_anti"), "frontier")
        if len(rounds) > 16:  # keep the plan short: one table for the rounds so far
            rounds = [materialise(reduce(DataFrame.unionByName, rounds), "visited")]
        rounds.append(new)
    return reduce(DataFrame.unionByName, rounds)
