"""Connected components of a link table, as Spark jobs.

Large-star / small-star contraction: every node hangs its larger neighbours,
then itself and its smaller ones, on the smallest neighbour it knows, until
the links are stars around the smallest node of each component.  Every step is
a written table in the shared checkpoint folder, so lineage stays short and a
lost executor costs one step at most; the per-node minima are written before
they are joined, which lets the skew join split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node whose component holds a smaller node.

    ``links`` holds undirected links between integers in columns ``a`` and
    ``b``; order, repeats and self-links don't matter, a link with a null end
    is no link.  ``component`` is the smallest node reachable; nodes that are
    themselves the smallest are left out (``coalesce(component, node)``).
    """
    edges = materialize(_pairs(links, a, b), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "least")
        edges = materialize(_pairs(both.join(least, "u").where("v > u"), "v", "m"), "large-star")
        least = materialize(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        step = edges.join(least, "hi").select(
            F.explode(F.array(F.struct(F.col("hi").alias("x"), "m"), F.struct(F.col("lo").alias("x"), "m"))).alias("e"))
        edges = materialize(_pairs(step, "e.x", "e.m"), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
