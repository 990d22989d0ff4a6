"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspark.durable import save

#: Most edges that one task contracts at once (pairs of nodes, about 100 MB while at work).
TASK_EDGES = 500_000


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum; equal for equal edge sets."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1_000_003))).alias("s")).first()
    return r["n"], r["x"], r["s"]


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of an edge list and the smallest node that each reaches: roots hook to smaller roots, then paths are halved."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[root]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _contract(kind: pa.DataType):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            u, v = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("u", "v"))
            nodes, low = contracted(u, v)
            yield pa.record_batch([pa.array(nodes, kind), pa.array(low, kind)], names=["node", "component"])
    return run


def connected_components(edges: DataFrame, u: str, v: str, rounds: int = 40, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(node, component)`` for every node of an edge; component is the smallest node reached.

    Alternating large-star and small-star steps: each is one aggregate and one join on the
    node, so a hub with a third of all edges is combined on the map side, never collected. The
    number of rounds grows with the logarithm of the longest chain. Every round is written to
    the shared folder. A graph of at most ``task_edges`` distinct edges, counted beforehand, is
    contracted by one task instead, with the same result: its rounds would be all overhead.
    Null ends and loops are ignored; an empty table gives an empty table.
    """
    e = (edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
         .where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = save(e)
    mark = _mark(e)
    if mark[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    if mark[0] <= task_edges:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = e.schema["u"].dataType
        return save(e.coalesce(1).mapInArrow(_contract(to_arrow_type(kind)), f"node {kind.simpleString()}, component {kind.simpleString()}"))
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
                 .select("p.u", "p.v").where("u <> v").distinct())
        e = save(small)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
