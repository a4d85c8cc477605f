"""Connected components of a link table, distributed: local forests, then alternating large and small stars.

Links are first contracted where they lie: a task takes about ``TASK_LINKS`` of them and passes on a star for each of its
components, so no more links than nodes. If one task had them all, those stars are the components. Otherwise each
round regroups links around the smallest neighbour; only minima are grouped, with partial sums before the exchange, and
what is left is contracted again. Nothing is collected but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialise, scope
from .workers import trimmed

#: Links that a task contracts, about.
TASK_LINKS = 500_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links (a, b), sorted, and the smallest node that each one reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        open_ = lx != ly
        if not open_.any():
            return nodes, nodes[label]
        x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        size += batch.num_rows
        if size > 2 * TASK_LINKS:  # a task dealt more than its share contracts as it goes
            held = [stars(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            size = len(held[0][0])
    if held:
        node, low = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], ["a", "b"])


def _contracted(links: DataFrame) -> tuple[DataFrame, bool]:
    """Stars of the links' parts (with a self-link of each root), and whether they are whole components."""
    tasks = max(1, -(-links.count() // TASK_LINKS))
    out = materialise(links.coalesce(tasks).mapInArrow(trimmed(_contract), "a bigint, b bigint"))
    return out, tasks == 1


def connected_components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node``, ``label`` (the smallest node reachable) of every node in ``links`` (a, b: bigint).

    Self-links only name a node. An empty table gives an empty result.
    """
    with scope():
        given = materialise(links.select(F.col("a").cast("long"), F.col("b").cast("long")))
        local, whole = _contracted(given)
        if whole:
            return materialise(local.select(F.col("a").alias("node"), F.col("b").alias("label")), outer=True)
        now = materialise(local.where("a <> b").distinct())
        for _ in range(most_rounds):
            # stars already: no node hangs on two, and none that others hang on hangs itself
            shape = now.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")), F.struct(F.col("b").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("e")).groupBy("e.x").agg(F.sum("e.down").alias("down"), F.max("e.up").alias("up"))
            if shape.where("down > 1 or (down > 0 and up > 0)").isEmpty():
                break
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = materialise(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
            down = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            after, whole = _contracted(materialise(small.unionByName(down.select("a", F.col("m").alias("b")))))
            discard(large)
            discard(now)
            now = materialise(after.where("a <> b").distinct())
            if whole:
                break
        else:
            raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
        every = local.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return materialise(every.join(now.select(F.col("a").alias("node"), F.col("b").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("label")), outer=True)
