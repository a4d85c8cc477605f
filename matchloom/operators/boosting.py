"""Gradient boosting for win probabilities that routes missing values; histograms are sums that Spark makes.

Trees are symmetric: all nodes of a level share one split (feature, cut, side of the missing), so a tree is ``depth``
splits and 2^depth values. A feature's values fall into bins between exact quantiles, bin 0 holds the missing ones (null
or NaN), and each split tries them on both sides. A level is one aggregation of (leaf, feature, bin); what comes to the driver
is at most 2^(depth - 1) * features * (bins + 1) sums, whatever the rows. Gradients are whole multiples of 2^-20, so
sums don't depend on their order and a lost executor's rerun gives the same tree.

Tasks bin their rows and add up their sums with numpy. Margins are stored every few rounds; between them the last trees are evaluated where the rows lie. A model
is a short JSON text, and scoring is one expression over all trees, without Python.

Rows without a label are left out of the fit and are scored like others. An empty table gives a model without trees that says 0.5, one of
a single class its (bounded) prior; a feature without values gives no split. Equal gains go to the first feature, the lowest cut, the missing left.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluate import dev_valid_split, quantiles, select_mode, split_diagnostics
from .models import balanced
from .stored import stored

#: Gradients and weights are whole multiples of 1 / UNIT.
UNIT = 1 << 20
_TREES = "array<struct<f:array<int>,cut:array<int>,miss:array<int>,value:array<double>,gain:array<double>>>"


@dataclass
class Boosted:
    """Features, their inner bin edges, the margin without trees, and the trees."""

    features: list[str]
    edges: list[list[float]]
    start: float = 0.0
    depth: int = 3
    trees: list[dict] = field(default_factory=list)

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Boosted:
        return Boosted(**json.loads(text))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 32) -> list[list[float]]:
    """Distinct inner quantiles of each feature, exact; a feature without values has none."""
    found = quantiles(df.select(*[F.col(f).cast("double").alias(f) for f in features]), {f: [i / bins for i in range(1, bins)] for f in features})
    return [sorted({e for e in found[f] if e is not None}) for f in features]


def binned(features: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """Bin numbers by feature: 0 for a missing value, else one more than the edges below it."""

    def one(f: str, e: Sequence[float]) -> Column:
        x = F.col(f).cast("double")
        below = F.size(F.filter(F.array(*[F.lit(float(v)) for v in e]).cast("array<double>"), lambda v: v < x))
        return F.when(x.isNull() | F.isnan(x), F.lit(0)).otherwise(1 + below)

    return F.array(*[one(f, e) for f, e in zip(features, edges, strict=True)])


def _side(bins: Column, f: Column | int, cut: Column | int, miss: Column | int) -> Column:
    b = F.get(bins, F.lit(f) if isinstance(f, int) else f)
    return F.when(b == 0, miss).otherwise((b > cut).cast("int"))


def margin(bins: Column, trees: Sequence[dict], depth: int, start: Column | float) -> Column:
    """``start`` and the values of all trees; one expression, whatever their number."""
    start = start if isinstance(start, Column) else F.lit(float(start))
    if not trees:
        return start

    def add(total: Column, t: Column) -> Column:
        leaf = sum((_side(bins, t["f"][i], t["cut"][i], t["miss"][i]) * (1 << i) for i in range(depth)), F.lit(0))
        return total + F.get(t["value"], leaf)

    return F.aggregate(F.from_json(F.lit(json.dumps(list(trees))), _TREES), start, add)


def probability(m: Column) -> Column:
    return 1 / (1 + F.exp(-m))


def with_bins(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` without its features, with ``bins``: their bin numbers (0 for a missing value, else one more than the edges below it)."""
    rest = [c for c in df.columns if c not in features]
    steps = [np.array(e, float) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.zeros((batch.num_rows, len(steps)), np.int32)
            for i, e in enumerate(steps):
                x = batch.column(len(rest) + i).to_numpy(zero_copy_only=False)
                bins[:, i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, "left"))
            held = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(steps)), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], held], [*rest, "bins"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*rest, *[F.col(f).cast("double").alias(f"__{i}") for i, f in enumerate(features)]).mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in rest], "bins array<int>"]))


def _sides(bins: np.ndarray, f: int, cut: int, miss: int) -> np.ndarray:
    return np.where(bins[:, f] == 0, miss, bins[:, f] > cut)


def histogram(df: DataFrame, features: int, width: int, trees: Sequence[dict] = (), splits: Sequence[tuple[int, int, int]] = ()) -> DataFrame:
    """Sums of the weighted derivatives of the log loss, in units, and the number of rows by (leaf, feature number, bin) of ``bins``.

    Rows have ``bins``, ``y``, ``w`` and the margin ``m`` before ``trees``; ``splits`` of the tree that is made give the leaf. A task adds up its rows, so
    what is exchanged is bounded by tasks, leaves, features and bins. Sums are of whole numbers, exact in any order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, 1 << len(splits), features, width), np.int64)
        for batch in batches:
            bins = batch.column(0).flatten().to_numpy().reshape(-1, features)
            y, w, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            for t in trees:
                leaf = sum(_sides(bins, f, cut, miss) << i for i, (f, cut, miss) in enumerate(zip(t["f"], t["cut"], t["miss"], strict=True)))
                m = m + np.array(t["value"])[leaf]
            p = 1 / (1 + np.exp(-m))
            g, h = np.floor(w * (p - y) * UNIT + 0.5), np.floor(w * p * (1 - p) * UNIT + 0.5)
            leaf = sum((_sides(bins, *s) << i for i, s in enumerate(splits)), np.zeros(len(y), int))
            for f in range(features):
                at = leaf * width + bins[:, f]
                for k, v in enumerate((g, h, None)):
                    sums[k, :, f] += np.bincount(at, v, width << len(splits)).astype(np.int64).reshape(-1, width)
        leaf, f, b = np.nonzero(sums[2])
        if len(leaf):
            yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int32()) for v in (leaf, f, b)], *[pa.array(s[leaf, f, b]) for s in sums]], ["leaf", "feature", "bin", "g", "h", "n"])

    parts = df.select("bins", *[F.col(c).cast("double").alias(c) for c in ("y", "w", "m")]).mapInArrow(run, "leaf int, feature int, bin int, g long, h long, n long")
    return parts.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, cuts: Sequence[int], l2: float, min_rows: int) -> tuple[float, int, int, int] | None:
    """Gain, feature, cut and side of the missing of the best split of all leaves at once; sums are (leaf x feature x bin)."""
    best = None
    for f, most in enumerate(cuts):
        left = [np.cumsum(x[:, f, 1 : most + 2], 1) for x in (g, h, n)]
        gap = [x[:, f, :1] for x in (g, h, n)]
        whole = [a[:, -1:] + b for a, b in zip(left, gap, strict=True)]
        below = [np.concatenate([np.zeros_like(b), a[:, :-1]], 1) for a, b in zip(left, gap, strict=True)]  # by cut, from 0
        loss = (whole[0] ** 2 / (whole[1] + l2)).sum()
        for miss in (0, 1):
            gl, hl, nl = (a if miss else a + b for a, b in zip(below, gap, strict=True))
            gr, hr, nr = (w - a for w, a in zip(whole, (gl, hl, nl), strict=True))
            gain = (gl**2 / (hl + l2) + gr**2 / (hr + l2)).sum(0) - loss
            gain[(nl.sum(0) < min_rows) | (nr.sum(0) < min_rows)] = -math.inf
            c = int(gain.argmax())
            better = best is None or gain[c] > best[0] or (gain[c] == best[0] and f == best[1] and c < best[2])
            if gain[c] > 1e-9 and better:
                best = (float(gain[c]), f, c, miss)
    return best


def _tree(rows: DataFrame, trees: Sequence[dict], cuts: Sequence[int], depth: int, step: float, l2: float, min_rows: int) -> dict | None:
    """One tree from rows with ``bins``, ``y``, ``w`` and the margin before ``trees``: an aggregation a level."""
    tree = {"f": [0] * depth, "cut": [1 << 30] * depth, "miss": [0] * depth, "value": [0.0] * (1 << depth), "gain": [0.0] * depth}
    splits: list[tuple[int, int, int]] = []
    width = max(cuts, default=0) + 2  # the missing, and one bin more than edges
    sums = None
    for level in range(depth):
        sums = np.zeros((3, 1 << level, len(cuts), width))
        for r in histogram(rows, len(cuts), width, trees, splits).collect():  # bounded, see the module's text
            sums[:, r.leaf, r.feature, r.bin] = r.g / UNIT, r.h / UNIT, r.n
        split = best_split(*sums, cuts, l2, min_rows)
        if split is None:
            break
        tree["gain"][level], tree["f"][level], tree["cut"][level], tree["miss"][level] = split
        splits.append(split[1:])
    else:
        level = depth
    if not level:
        return None
    if level == depth:
        # the last level's sums, parted by its split
        _, f, cut, miss = split
        bins = np.arange(width)
        right = np.where(bins == 0, miss == 1, bins > cut)
        parts = [(sums[:2, :, f, ~right].sum(-1)), sums[:2, :, f, right].sum(-1)]
        g, h = np.concatenate(parts, 1)
    else:
        g, h = sums[:2, :, 0].sum(-1)
    tree["value"][: len(g)] = (-step * g / (h + l2)).tolist()
    return tree


def fit(
    df: DataFrame, features: Sequence[str], label: str = "win", key: Sequence[str] = ("match_id", "perspective"), rounds: int = 100, depth: int = 3, step: float = 0.1, l2: float = 1.0,
    min_rows: int = 10, share: float = 1.0, bins: int = 32, weight: str | None = None, valid: str | None = None, every: int = 8, tolerance: float = 1e-4, edges: list[list[float]] | None = None,
) -> Boosted:
    """A model of ``rounds`` trees at most.

    ``share`` of the rows, drawn by ``key`` and round, makes each tree. Rows whose ``valid`` is true only judge: every ``every`` rounds their
    log loss is taken, and where it falls by less than ``tolerance`` the fit stops; the trees up to the least stay. ``l2`` and ``min_rows`` are positive.
    """
    rows = df.where(F.col(label).isNotNull())
    edges = bin_edges(rows.where(~F.coalesce(F.col(valid).cast("boolean"), F.lit(False))) if valid else rows, features, bins) if edges is None else edges
    model = Boosted(list(features), edges, depth=depth)
    cuts = [len(e) for e in edges]
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    judged = F.coalesce(F.col(valid).cast("boolean"), F.lit(False)) if valid else F.lit(False)
    draw = F.xxhash64(*[F.col(k).cast("string") for k in key])
    ready = rows.select(F.col(label).cast("double").alias("__y"), w.alias("__w"), judged.alias("__judged"), draw.alias("__draw"), *features)
    held = stored(with_bins(ready, features, edges).withColumnsRenamed({f"__{c}": c for c in ("y", "w", "judged", "draw")}))
    whole = lambda x: F.sum(F.round(x * F.lit(float(UNIT))).cast("long"))
    total = held.where("not judged").agg(whole(F.col("w")).alias("w"), whole(F.col("w") * F.col("y")).alias("y")).first()
    if not total.w:
        return model
    prior = min(1 - 1e-6, max(1e-6, total.y / total.w))
    model.start = math.log(prior / (1 - prior))
    held = held.withColumn("m", F.lit(model.start))
    least, best, done = math.inf, 0, 0
    while len(model.trees) < rounds:
        if len(model.trees) - done >= every:
            held = stored(held.withColumn("m", margin(F.col("bins"), model.trees[done:], depth, F.col("m"))))
            done, m = len(model.trees), F.col("m")
            if valid:
                p = F.least(F.lit(1 - 1e-12), F.greatest(F.lit(1e-12), probability(m)))
                loss = held.where("judged").agg(F.avg(-F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
                if loss is not None and loss > least - tolerance:
                    break
                least, best = (least, best) if loss is None else (loss, done)
        drawn = held.where("not judged")
        if share < 1:
            drawn = drawn.where(F.pmod(F.xxhash64("draw", F.lit(len(model.trees))), F.lit(1 << 20)) < int(share * (1 << 20)))
        tree = _tree(drawn, model.trees[done:], cuts, depth, step, l2, min_rows)
        if tree is None:
            break
        model.trees.append(tree)
    if best:
        del model.trees[best:]
    return model


def score(model: Boosted, df: DataFrame, name: str = "p") -> DataFrame:
    """``df`` with the model's probability; a feature that ``df`` lacks is missing in every row."""
    absent = {f: F.lit(None).cast("double") for f in model.features if f not in df.columns}
    m = margin(F.col("__bins"), model.trees, model.depth, model.start)
    return df.withColumns(absent).withColumn("__bins", binned(model.features, model.edges)).withColumn(name, probability(m)).drop("__bins", *absent)


def importances(spark: SparkSession, models: Mapping[str, Boosted]) -> DataFrame:
    """Shares of the gain by feature and model, one row a feature over all models: their mean, its place, and a column a model."""
    share: dict[str, dict[str, float]] = {}
    for name, model in models.items():
        whole = sum(sum(t["gain"]) for t in model.trees)
        for f in model.features:
            share.setdefault(f, {})[name] = 0.0
        for t in model.trees:
            for f, gain in zip(t["f"], t["gain"], strict=True):
                share[model.features[f]][name] += gain / whole
    mean = {f: sum(s.values()) / len(models) for f, s in share.items()}
    ranked = sorted(share, key=lambda f: (-mean[f], f))
    rows = [(f, i, mean[f], *[share[f].get(n) for n in models]) for i, f in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, ", ".join(["feature string", "place int", "mean_share double", *[f"`{n}` double" for n in models]]))


#: Boosting in three sizes: rounds, depth, step, share of rows, least rows of a side.
MODES = {"light": (300, 3, 0.05, 0.8, 20), "balanced": (500, 4, 0.04, 0.85, 15), "power": (800, 5, 0.03, 0.9, 10)}


def fit_modes(long: DataFrame, features: Sequence[str], label: str = "win", key: Sequence[str] = ("match_id", "perspective"), modes: Mapping[str, tuple[int, int, float, float, int]] | None = None) -> tuple[str, dict[str, Boosted], DataFrame]:
    """The chosen mode, all models and their figures: class weights, missing values unimputed.

    Each mode is fitted on the earlier dates and stops by the later ones; of those near the least loss the one with the smallest gap is chosen.
    """
    marked = dev_valid_split(long.where(F.col(label).isNotNull()))
    weighed = balanced(marked, label)
    edges = bin_edges(marked.where("is_valid = 0"), features)
    fitted = {n: fit(weighed, features, label, key, rounds, depth, step, min_rows=leaf, share=share, weight="weight", valid="is_valid", edges=edges) for n, (rounds, depth, step, share, leaf) in (modes or MODES).items()}
    every = None
    for n, model in fitted.items():
        part = score(model, marked).select(F.lit(n).alias("model"), F.col("is_valid").alias("is_test"), F.col(label).alias("y"), "p")
        every = part if every is None else every.unionByName(part)
    figures = split_diagnostics(every)
    table = long.sparkSession.createDataFrame(figures.collect(), figures.schema)  # a row a mode
    chosen = select_mode(table.select(F.col("model").alias("mode"), F.col("test_logloss").alias("logloss"), F.abs("gap").alias("gap"))).first()["mode"]
    return chosen, fitted, table
