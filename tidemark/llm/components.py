"""Connected components of links that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import spread_join
from .shared import Scratch


def connected_components(links: DataFrame, work: Scratch, name: str = "cc", most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links (a, b).

    Alternates large-star and small-star steps, which keep components and
    shrink every tree to a star in a logarithmic number of rounds.  Each round is a stored
    table; a node with very many links is a hot key of an aggregation (combined
    map-side) and of a join that deals its links over several tasks.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = work.keep(edges, f"{name}/0")

    def star(e: DataFrame, both: bool, many: int, at: str) -> DataFrame:
        """Link every neighbour of a node to the least of them; both: neighbours above the node, else those below."""
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else e
        least = work.keep(near.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count(F.lit(1)).alias("n")), f"{at}-least")
        hub = F.col("least")
        out = spread_join(near, least, ["a"], ["b"], many * (1 + both))
        if both:
            return out.where("b > a").select(F.col("b").alias("a"), hub.alias("b")).distinct()
        kept = out.where(F.col("b") != hub).select(F.col("b").alias("a"), hub.alias("b"))
        return kept.unionByName(least.select("a", hub.alias("b"))).where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()

    before = mark(edges)
    for k in range(1, most_rounds + 1):
        if not before[0]:
            break
        large = work.keep(star(edges, True, before[0], f"{name}/{k}-large"), f"{name}/{k}-large")
        edges = work.keep(star(large, False, before[0], f"{name}/{k}-small"), f"{name}/{k}")
        after = mark(edges)
        for old in (f"{k - 1}", f"{k}-large", f"{k}-large-least", f"{k}-small-least"):
            work.drop(f"{name}/{old}")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
