"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.scratch import Scratch


def connected(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``links`` (a, b: long) to (node, component): the smallest node that each linked node can reach.

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour. A chain of n
    links takes about log n rounds. All steps are joins and minima with map-side combine, so a node with a large share
    of the links is no single task's work. No links: no rows. Repeated links and links to itself change nothing.
    """
    edges = scratch.save(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        f"{label}-0",
    )
    step = 0
    while not _is_stars(edges):
        step += 1
        edges = scratch.save(_small_star(_large_star(edges)), f"{label}-{step}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other at most, and only on nodes that hang on none."""
    both = edges.selectExpr("a AS node", "1 AS hangs").unionByName(edges.selectExpr("b AS node", "0 AS hangs"))
    seen = both.groupBy("node").agg(F.sum("hangs").alias("times"), F.min("hangs").alias("low"))
    return seen.filter("times > 1 OR (times = 1 AND low = 0)").isEmpty()


def _smallest(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.selectExpr("a AS u", "b AS v").unionByName(edges.selectExpr("b AS u", "a AS v"))
    low = _smallest(both).select("u", F.least("u", "low").alias("low"))
    return (
        both.filter("v > u").join(low, "u").filter("v > low").selectExpr("v AS a", "low AS b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    hung = edges.join(low, "a").filter("b > low").selectExpr("b AS a", "low AS b")
    return hung.unionByName(low.selectExpr("a", "low AS b")).distinct()
