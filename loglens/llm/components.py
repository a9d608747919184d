"""Distributed connected components by contraction towards the smaller neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import Staged


def connected_components(edges: DataFrame, left: str, right: str) -> Staged:
    """(node, root) for every node of ``edges``; nodes share a root iff connected.

    Every round sends each root to its smallest neighbouring root and contracts
    the edges along those pointers.  A local minimum of a random order keeps
    its name, so callers pass random ids (hashes): the expected number of rounds
    is logarithmic.  A hub with a third of all edges is only ever the key of a
    partial ``min`` and of equi joins whose other side is unique, which AQE
    splits.  Null endpoints and loops are ignored; repeated edges are merged.
    The only driver-side state is whether edges remain.
    """
    both = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    nodes = both.select(F.col("u").alias("node")).union(both.select("v")).distinct()
    comp = Staged(nodes.select("node", F.col("node").alias("root")), "components")
    live = Staged(both.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                      .distinct(), "component-edges")
    while not live.df.isEmpty():
        e = live.df
        sym = e.select("u", "v").union(e.select("v", "u"))
        to = Staged(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), "component-step")
        pu = to.df
        pv = to.df.select(F.col("u").alias("v"), F.col("p").alias("q"))
        nxt = Staged(e.join(pu, "u").join(pv, "v").where("p <> q")
                      .select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct(), "component-edges")
        new = Staged(comp.df.join(pu.withColumnRenamed("u", "root"), "root", "left")
                         .select("node", F.coalesce("p", "root").alias("root")), "components")
        for old in (live, comp, to):
            old.drop()
        live, comp = nxt, new
    live.drop()
    return comp
