"""Connected components of a link table, as alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """(``u``, ``v``) links to (``node``, ``root``): each linked node's smallest reachable node.

    Nodes without links are absent.  Stars stay linear in the links whatever a node's
    degree; every round is stored, so a lost executor costs one round at most.
    """
    edges = store(links.where("u <> v").select("u", "v").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = store(_small_star(_large_star(edges).where("u <> v").distinct()).where("u <> v").distinct(), "stars")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
