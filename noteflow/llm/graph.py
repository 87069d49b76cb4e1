"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch


def components(edges: DataFrame, scratch: Scratch, tag: str = "graph") -> DataFrame:
    """(node, component) for all ends of ``edges(u, v)``; a component is named by its smallest node.

    Rounds of contraction: every node points to the smallest of itself and its neighbours, pointers are
    followed to their ends, and the edges between different ends are the next, smaller graph. Each
    round at least halves the nodes that still have edges. Minima are aggregated before the shuffle, and
    every step is a written table.
    """
    spark = edges.sparkSession
    both = edges.filter("u <> v").select("u", "v").union(edges.filter("u <> v").select("v", "u")).distinct()
    graph, done = scratch.keep(both, f"{tag}0"), []
    for n in range(1, 200):
        if graph.isEmpty():
            break
        to = graph.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("end"))
        to = scratch.keep(to.withColumn("moved", F.lit(True)), f"{tag}{n}to0")
        for jump in range(1, 200):
            nxt = to.select(F.col("node").alias("end"), F.col("end").alias("_end"))
            there = to.drop("moved").join(nxt, "end", "left").select("node", F.coalesce("_end", "end").alias("_to"), "end")
            to = scratch.keep(there.select("node", F.col("_to").alias("end"), (F.col("_to") != F.col("end")).alias("moved")), f"{tag}{n}to{jump}")
            if to.filter("moved").isEmpty():
                break
        done.append(to.drop("moved"))
        ends = to.drop("moved")
        moved = graph.join(ends.select(F.col("node").alias("u"), F.col("end").alias("a")), "u").join(ends.select(F.col("node").alias("v"), F.col("end").alias("b")), "v")
        graph = scratch.keep(moved.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), f"{tag}{n}")
    if not done:
        return spark.createDataFrame([], "node long, component long")
    out = done[0].select("node", F.col("end").alias("component"))
    for step in done[1:]:
        nxt = step.select(F.col("node").alias("component"), F.col("end").alias("_end"))
        out = out.join(nxt, "component", "left").select("node", F.coalesce("_end", "component").alias("component"))
    return out


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b, the smallest node that each can reach."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new
