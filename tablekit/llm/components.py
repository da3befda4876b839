"""Connected components of a link table by alternating large-star and small-star steps.

A step replaces links so that nodes point at the smallest neighbour they know; it
ends when no link changes.  The neighbours' minimum is an aggregate (combined
before the shuffle) and is joined back to the links, so a node with very many
links is never gathered in one task.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours in (u, v)."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _star(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    """Every neighbour points at the smallest one."""
    return pairs.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame, staging: Staging, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Links to oneself and repeated links change nothing; null ends are left out.
    """
    down = lambda d: d.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges, n = staging.put(f"{name}0", down(links)), 0
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = _minimum(both)
        larger = both.where("v > u")
        large = down(_star(larger, smallest).union(
            edges.join(smallest, "u").select("u", F.col("m").alias("v"))))
        least = _minimum(large)
        small = down(_star(large, least).union(least.select("u", F.col("m").alias("v"))))
        n += 1
        edges = staging.put(f"{name}{n}", small)
        staging.drop(f"{name}{n - 1}")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
