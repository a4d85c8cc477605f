"""Conflict-constrained best-fit packing of documents into fixed token budgets.

Rows are numbered in the order of (id, cluster, source, tokens) and dealt evenly, by that number and not by key, to
shards of about ``shard_rows`` rows; each shard packs alone in bounded memory. Bins that a shard couldn't fill are
opened again and their pieces dealt to fewer shards, round by round, until one shard holds all that is left: what
shards cost is paid once, in that last one, whatever the number of rows. Within a shard, bins are kept by residual; each
carries a bitmap of source lanes and one of duplicate clusters. A piece goes to the bin with the smallest residual
that holds it, and the successor search goes on to larger residuals until a bin without conflict
is found: that bin is the tightest compatible one. Else a new bin opens. Pieces come largest first.

A bin has twice as many lanes as pieces of the shard's mean size fill it (16 at least). A source has lanes in proportion to its
share of the shard's rows (at least one), and a bin takes one piece a lane: no source can crowd a bin, a source with
a third of all rows still packs, and short pieces fill bins as well as long ones.
Copies (equal cluster) never share a bin. A document over the capacity is cut into full pieces,
each a bin of its own, and a rest.

Edge cases: a null or empty text, or one without words, has no tokens: it gets one row with 0
tokens and a null bin; a null source is a source of its own; null ids are carried; repeated rows
are packed each, as copies of each other; extra columns are ignored; an empty table gives an
empty result. An output column takes no other name: extra columns aren't carried. Ties in size go by row number; rows of one number's
key are alike, so the same rows pack the same way in whatever partitions and order they come.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise
from .workers import trimmed

SCHEMA = "doc_id bigint, source string, piece int, n_tokens int, bin_id bigint, bin_offset int, bin_free int"
#: A bin with a larger part of its capacity free than this is opened again in the next round.
LOOSE = 1 / 16


def best_fit(sizes: list[int], lanes: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and each bin's residual.

    ``lanes`` and ``clusters`` are bit numbers, -1 for none; pieces of one number don't share a bin.
    """
    residual: list[int] = []
    lane_map: list[int] = []
    cluster_map: list[int] = []
    by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_at = 0  # bit r: some bin has residual r
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        lane = 1 << lanes[i] if lanes[i] >= 0 else 0
        cluster = 1 << clusters[i] if clusters[i] >= 0 else 0
        found, rest = -1, open_at >> size
        base = size
        while rest:
            step = (rest & -rest).bit_length() - 1
            base += step
            for at, b in enumerate(by_residual[base]):
                if not (lane_map[b] & lane or cluster_map[b] & cluster):
                    found = b
                    del by_residual[base][at]
                    break
            if found >= 0:
                if not by_residual[base]:
                    open_at &= ~(1 << base)
                break
            rest >>= step + 1
            base += 1
        if found < 0:
            found = len(residual)
            residual.append(capacity)
            lane_map.append(0)
            cluster_map.append(0)
        bins[i], offsets[i] = found, capacity - residual[found]
        residual[found] -= size
        lane_map[found] |= lane
        cluster_map[found] |= cluster
        if residual[found]:
            by_residual[residual[found]].append(found)
            open_at |= 1 << residual[found]
    return bins, offsets, residual


def _pack_shard(rows: pd.DataFrame, capacity: int, source_lanes: int | None) -> pd.DataFrame:
    rows = rows.sort_values(["rid", "piece"], kind="stable")
    sources = rows["source"].tolist()
    tokens = rows["n_tokens"].to_numpy(np.int64)
    pieces = rows["piece"].tolist()
    cluster = rows["cluster"].to_numpy(np.int64)
    share = Counter(sources)
    if source_lanes is None:
        filled = tokens[tokens > 0]
        source_lanes = max(16, 2 * -(-capacity * len(filled) // max(1, int(filled.sum()))))
    width = {s: max(1, round(source_lanes * c / len(sources))) for s, c in share.items()}
    first, at = {}, 0
    for s in sorted(width, key=lambda s: (s is None, s or "")):
        first[s], at = at, at + width[s]
    names, dense, counts = np.unique(cluster, return_inverse=True, return_counts=True)
    bit = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[dense]
    turn: Counter = Counter()
    row, piece, size, lane, bits = [], [], [], [], []
    for i, (s, n) in enumerate(zip(sources, tokens.tolist(), strict=True)):
        for p in range(max(1, -(-n // capacity))):
            row.append(i)
            piece.append(pieces[i] + p)
            size.append(min(capacity, n - p * capacity))
            lane.append(first[s] + turn[s] % width[s])
            bits.append(int(bit[i]))
        turn[s] += 1
    real = [j for j, z in enumerate(size) if z > 0]
    bins, offsets, residual = best_fit([size[j] for j in real], [lane[j] for j in real], [bits[j] for j in real], capacity)
    out = pd.DataFrame({"doc_id": rows["doc_id"].array[row], "source": [sources[i] for i in row], "piece": piece, "n_tokens": size})
    placed = {j: (b, o, residual[b]) for j, b, o in zip(real, bins, offsets, strict=True)}
    shard = int(rows["shard"].iat[0])
    none = (None, None, None)
    got = [placed.get(j, none) for j in range(len(row))]
    out["bin_id"] = pd.array([None if g[0] is None else (shard << 32) + g[0] for g in got], "Int64")
    out["bin_offset"] = pd.array([g[1] for g in got], "Int32")
    out["bin_free"] = pd.array([g[2] for g in got], "Int32")
    out["cluster"] = cluster[row]
    out["rid"] = rows["rid"].to_numpy(np.int64)[row]
    return out


def _shards(capacity: int, source_lanes: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def pack() -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(held)
            rows = table.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
            rows["source"] = table.column("source").to_pylist()
            out = _pack_shard(rows, capacity, source_lanes)
            schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("piece", pa.int32()), ("n_tokens", pa.int32()), ("bin_id", pa.int64()), ("bin_offset", pa.int32()), ("bin_free", pa.int32()), ("cluster", pa.int64()), ("rid", pa.int64())])
            yield from pa.Table.from_pandas(out, schema=schema, preserve_index=False).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard").to_numpy()
            edge = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            for a, b in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                if held and held[0].column("shard")[0].as_py() != shard[a]:
                    yield from pack()
                    held.clear()
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield from pack()

    return run


def word_count(text: Column) -> Column:
    """Words of a text; a null has none."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+"))).cast("long")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rid``: the place of each row in the order of its columns; many rows alike are sorted by several tasks."""
    order = [*rows.columns, "_at"]
    told = rows.withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(told.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("part")).count().collect())  # a row a partition
    ends = list(accumulate((c for _, c in counts), initial=0))
    base = rows.sparkSession.createDataFrame([(p, e) for (p, _), e in zip(counts, ends, strict=False)], "_part long, _base long")
    at = placed.join(F.broadcast(base), part == F.col("_part"))
    return at.withColumn("rid", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_base")


def pack(df: DataFrame, capacity: int = 2048, tokens: Column | None = None, cluster: Column | None = None, shard_rows: int = 4096, source_lanes: int | None = None) -> DataFrame:
    """A row for each piece of each row of ``df`` (doc_id, source, text), with its bin.

    ``tokens``: each row's length, by default its words; ``cluster``: rows of one value are
    copies, by default those of one text; ``source_lanes``: of a bin, by default as said above.
    """
    tokens = word_count(F.col("text")) if tokens is None else tokens
    cluster = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) if cluster is None else cluster
    narrow = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), tokens.cast("long").alias("n_tokens"), cluster.cast("long").alias("cluster"))
    rows = _numbered(materialise(narrow)).withColumn("piece", F.lit(0))
    left = rows.count()
    done: list[DataFrame] = []
    first = 0  # shards of earlier rounds
    while True:
        shards = max(1, -(-left // shard_rows))
        dealt = rows.withColumn("shard", F.lit(first) + F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
        ready = dealt.repartition("shard").sortWithinPartitions("shard", "rid", "piece")
        packed = ready.mapInArrow(trimmed(_shards(capacity, source_lanes)), f"{SCHEMA}, cluster bigint, rid bigint")
        if shards > 1:
            packed = materialise(packed)
            loose = F.coalesce(F.col("bin_free") > int(capacity * LOOSE), F.lit(False))
            rows = packed.where(loose).select("doc_id", "source", F.col("n_tokens").cast("long").alias("n_tokens"), "cluster", "rid", "piece")
            before, left = left, rows.count()
            if 2 * left <= before:
                done.append(packed.where(~loose))
                first += shards
                continue
        done.append(packed)
        return reduce(DataFrame.unionByName, done).drop("cluster", "rid")
