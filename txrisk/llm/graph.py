"""Connected components of an undirected edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


SALTS = 8           # parts that a hub's edges are dealt to


def _joined(edges: DataFrame, low: DataFrame, other: str) -> DataFrame:
    """``edges`` with the smallest neighbour ``m`` of ``u``: each node's row of
    ``low`` goes to every salt, so that the edges of a hub are spread."""
    salt = F.pmod(F.xxhash64(other), F.lit(SALTS)).alias("salt")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    return edges.select("u", "v", salt).join(low.select("u", "m", every), ["u", "salt"]).select("u", "v", "m")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _joined(both.where("v > u"), low, "v").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _joined(down, low, "v").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (smallest node reachable) for nodes that have an edge.

    Every round rewires neighbours to the smallest one seen (large star, then
    small star), so the number of rounds grows with the logarithm of the graph.
    Each round's edges are written to the shared folder; only a count and a
    checksum reach the driver.
    """
    e = save(edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
             "edges")
    state = None
    while True:
        r = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(r) == state or not r[0]:
            break
        state = tuple(r)
        e = save(_small_star(_large_star(e)), "star")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
