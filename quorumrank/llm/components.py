"""Connected components of an edge table by alternating star contraction, without collecting links anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .shared import forget, stored


#: Links that one task may hold; more are contracted in rounds over the cluster.
ONE_TASK_LINKS = 10_000


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Each round points every node at the smallest label around it (large star), then re-hangs the smaller
    neighbours below that label (small star). Rounds grow with the logarithm of the longest path. Every round
    is written to the shared folder, so a lost executor costs one round. Self links, repeated and reversed
    links and null ends are allowed; nodes without a link don't appear. Nodes are whole numbers. Up to ONE_TASK_LINKS
    links are connected in one task, with the same result.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("u is not null and v is not null and u <> v").distinct()
    links, before = _written(pairs)
    if before[0] <= ONE_TASK_LINKS:
        return links.select(
            F.col("u").cast("long"), F.col("v").cast("long")
        ).repartition(1).mapInArrow(_in_one_task, "node long, component long")
    for _ in range(max_rounds):
        moved, after = _written(_star(_star(links, larger=True), larger=False))
        forget(links.sparkSession, links)
        links = moved
        if before == after:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable by the pairs, for each of n rows."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    u, v = (np.concatenate(x) if held else np.zeros(0, np.int64) for x in (list(zip(*held, strict=True)) or [(), ()]))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    component = nodes[forest(at[: len(u)], at[len(u) :], len(nodes))]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(component)], ["node", "component"])


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a written table, and their number and checksum, which are taken while they are written."""
    seen = Observation()
    observed = links.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    return stored(observed, "links"), (seen.get["n"], seen.get["x"])


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Large star: every neighbour above u hangs below u's smallest neighbour. Small star: those below u do."""
    around = links.select("u", "v")
    if larger:
        around = around.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = around.join(lowest, "u")
    if larger:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()
