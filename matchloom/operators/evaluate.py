"""Temporal splits and model evaluation as aggregations."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratings import clip_prob, logistic10


def temporal_split(df: DataFrame, months: int = 3, date: str = "match_date") -> DataFrame:
    """``is_test``: on or after the newest date less ``months``."""
    split = df.agg(F.add_months(F.max(date), -months).alias("split_date"))
    return df.crossJoin(F.broadcast(split)).withColumn("is_test", (F.col(date) >= F.col("split_date")).cast("int"))


def dev_valid_split(df: DataFrame, share: float = 0.8, date: str = "match_date") -> DataFrame:
    """``is_valid`` by distinct dates: the last ones after floor(share * dates), at least one on either side."""
    dates = df.select(date).distinct()
    n = dates.agg(F.count("*").alias("n_dates"))
    ranked = dates.withColumn("date_rank", F.row_number().over(Window.orderBy(date)))
    cut = F.greatest(F.lit(1), F.least(F.col("n_dates") - 1, F.floor(F.col("n_dates") * share)))
    flags = ranked.crossJoin(F.broadcast(n)).select(date, (F.col("date_rank") > cut).cast("int").alias("is_valid"))
    return df.join(flags, date)


#: Scores lie in [0, 1]; ranks are summed by so many equal ranges of them, and within each range by itself.
RANGES = 4096


def _range(p: Column) -> Column:
    return F.least(F.lit(RANGES - 1), F.greatest(F.lit(0), F.floor(p * RANGES))).cast("int")


def running_by_score(df: DataFrame, by: Sequence[str], score: str, value: Column, name: str, ascending: bool = True) -> DataFrame:
    """``name``: the sum of ``value`` over rows of the group up to the score, inclusive; no group is summed in one task.

    Rows have distinct scores. Sums of whole ranges are carried over at most RANGES rows a group, the rest within a range.
    """
    order = lambda c: F.col(c).asc() if ascending else F.col(c).desc()
    placed = df.withColumns({"_range": _range(F.col(score)), "_value": value})
    whole = placed.groupBy(*by, "_range").agg(F.sum("_value").alias("_t"))
    before = whole.withColumn("_before", F.sum("_t").over(Window.partitionBy(*by).orderBy(order("_range"))) - F.col("_t")).drop("_t")
    within = F.sum("_value").over(Window.partitionBy(*by, "_range").orderBy(order(score)))
    return placed.withColumn("_within", within).join(before, [*by, "_range"]).withColumn(name, F.col("_within") + F.col("_before")).drop("_range", "_value", "_within", "_before")


#: A rank's bracket is cut into so many ranges, until it holds few distinct values or one.
CUTS, FEW = 2048, 5_000
#: Rank error of the sketch that brackets the ranks: one in so many rows.
SKETCH = 10_000


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of a column, exact; see :func:`quantiles`."""
    return quantiles(df, {column: shares})[column]


def quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Interpolated quantiles of several columns, exact, in two jobs whatever the columns, where brackets hold few values.

    The first pass brackets all ranks of all columns by a quantile sketch and counts rows. The second counts what lies below
    each bracket, and its values: one by one, or in CUTS equal ranges where the rows may be many, and only the ranges that hold a rank go on
    to a further pass, with all columns' at once. At most CUTS counts or FEW values a bracket come to the driver. Nulls and NaN are left out.
    """
    names = list(wanted)
    x = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(names)])
    aggs = []
    for i, c in enumerate(names):
        around = sorted({min(1.0, max(0.0, q + e)) for q in wanted[c] for e in (-4 / SKETCH, 0.0, 4 / SKETCH)})
        aggs += [F.count(f"x{i}").alias(f"n{i}"), F.min(f"x{i}").alias(f"a{i}"), F.max(f"x{i}").alias(f"b{i}"), F.percentile_approx(f"x{i}", around, SKETCH).alias(f"p{i}")]
    first = x.agg(*aggs).first()
    value: dict[tuple[int, int], float] = {}
    # (column, low, high, rows before low or None, ranks, distinct values at most): the sketch's brackets may miss, then the whole range is looked through
    brackets: list[tuple[int, float, float, int | None, set[int], int]] = []
    for i, c in enumerate(names):
        n = first[f"n{i}"]
        around = sorted({min(1.0, max(0.0, q + e)) for q in wanted[c] for e in (-4 / SKETCH, 0.0, 4 / SKETCH)})
        for q in wanted[c] if n else ():
            ranks = {math.floor(q * (n - 1)), math.ceil(q * (n - 1))}
            place = min(range(len(around)), key=lambda k: abs(around[k] - q))
            p = first[f"p{i}"]
            whole = n <= FEW
            low = first[f"a{i}"] if whole or q * n < 8 else p[max(0, place - 1)]
            high = first[f"b{i}"] if whole or (1 - q) * n < 8 else p[min(len(around) - 1, place + 1)]
            brackets.append((i, low, high, None, ranks, n if whole else 12 * n // SKETCH + 8))
    while brackets:
        brackets = _look(x, brackets, first, value)
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(names):
        n = first[f"n{i}"]
        out[c] = []
        for q in wanted[c]:
            if not n:
                out[c].append(None)
                continue
            k = q * (n - 1)
            a, b = value[i, math.floor(k)], value[i, math.ceil(k)]
            out[c].append(a + (b - a) * (k - math.floor(k)))
    return out


def _look(x: DataFrame, brackets: list[tuple[int, float, float, int | None, set[int], int]], first, value: dict[tuple[int, int], float]) -> list:
    """One pass over all brackets: values found go to ``value``, what is still open comes back."""
    spans = [(i, low, high, most <= FEW or not low + (high - low) / CUTS > low) for i, low, high, _, _, most in brackets]
    found = x.mapInArrow(_bracketed(spans), "k int, part int, one double, c long, low double, high double")
    counts = found.groupBy("k", "part", "one").agg(F.sum("c").alias("c"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    left = []
    for k, (i, _, _, before, ranks, _) in enumerate(brackets):
        mine = sorted((r for r in counts if r["k"] == k and r["part"] >= 0), key=lambda r: (r["part"], r["low"]))
        skipped = sum(r["c"] for r in counts if r["k"] == k and r["part"] < 0) if before is None else before
        open_ = set(ranks)
        for r in mine:
            held = {rank for rank in open_ if skipped <= rank < skipped + r["c"]}
            open_ -= held
            if held and r["low"] == r["high"]:
                value.update({(i, rank): r["low"] for rank in held})
            elif held:
                left.append((i, r["low"], r["high"], skipped, held, r["c"]))
            skipped += r["c"]
        if open_:  # outside the sketch's bracket
            left.append((i, first[f"a{i}"], first[f"b{i}"], 0, open_, first[f"n{i}"]))
    return left


def _bracketed(spans: list[tuple[int, float, float, bool]]):
    """Of each batch: by bracket (column, low, high, fine) the rows below it (part -1) and its values, each by itself where it is fine, else by CUTS equal ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[int, np.ndarray] = {}
            out: list[tuple[np.ndarray, ...]] = []
            for k, (i, low, high, fine) in enumerate(spans):
                if i not in columns:
                    v = batch.column(i).to_numpy(zero_copy_only=False)
                    columns[i] = np.sort(v[~np.isnan(v)])
                v = columns[i]
                a, b = np.searchsorted(v, low, "left"), np.searchsorted(v, high, "right")
                if a:
                    out.append((k, np.array([-1]), np.array([np.nan]), np.array([a]), v[:1], v[a - 1 : a]))
                v = v[a:b]
                if len(v):
                    part = np.zeros(len(v), int) if fine else np.minimum(CUTS - 1, np.floor((v - low) / ((high - low) / CUTS))).astype(int)
                    at = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) if fine else part[1:] != part[:-1]])
                    ends = np.r_[at[1:], len(v)]
                    out.append((k, part[at], v[at] if fine else np.full(len(at), np.nan), ends - at, v[at], v[ends - 1]))
            if out:
                ks = np.repeat([o[0] for o in out], [len(o[1]) for o in out])
                part, one, c, lo, hi = (np.concatenate([o[j] for o in out]) for j in range(1, 6))
                yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(part, pa.int32()), pa.array(one, pa.float64(), from_pandas=True), pa.array(c, pa.int64()), pa.array(lo), pa.array(hi)], ["k", "part", "one", "c", "low", "high"])

    return run


def metrics(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """n, log loss, Brier score, exact AUC (average ranks of ties) and accuracy by group; rows without y or p are left out.

    Scores are counted by distinct value first, so ranks come from one row a value.
    """
    ok = df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))).withColumns({"_p": clip_prob(F.col(p)), "_y": F.col(y).cast("double")})
    base = ok.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(-(F.col("_y") * F.log("_p") + (1 - F.col("_y")) * F.log(1 - F.col("_p")))).alias("logloss"),
        F.avg((F.col("_p") - F.col("_y")) * (F.col("_p") - F.col("_y"))).alias("brier"),
        F.avg(((F.col("_p") >= 0.5).cast("int") == F.col("_y")).cast("double")).alias("accuracy"),
        F.sum("_y").alias("_n1"),
    )
    tied = ok.groupBy(*by, "_p").agg(F.count("*").alias("c"), F.sum("_y").alias("pos"))
    upto = running_by_score(tied, by, "_p", F.col("c"), "_upto")
    ranks = upto.withColumn("r", F.col("_upto") - F.col("c") + (F.col("c") + 1) / 2).groupBy(*by).agg(F.sum(F.col("r") * F.col("pos")).alias("_ranks"))
    n1, n0 = F.col("_n1"), F.col("n") - F.col("_n1")
    auc = F.when((n1 > 0) & (n0 > 0), (F.col("_ranks") - n1 * (n1 + 1) / 2) / (n1 * n0))
    return base.join(ranks, list(by)).withColumn("roc_auc", auc).drop("_n1", "_ranks")


def scale_grid(df: DataFrame, diff: str, grid: Sequence[float], y: str = "y") -> DataFrame:
    """Metrics of the logistic-10 of ``diff`` at each scale, and their rank: least log loss, Brier, greatest AUC. Scales with fewer than ten rows, or rows of one class, aren't ranked."""
    rows = df.where(F.col(diff).isNotNull()).withColumn("scale", F.explode(F.array(*[F.lit(float(s)) for s in grid])))
    m = metrics(rows.withColumn("p", logistic10(F.col(diff), F.col("scale"))), ["scale"], y)
    m = m.where("n >= 10 and roc_auc is not null")
    return m.withColumn("place", F.row_number().over(Window.orderBy("logloss", "brier", F.col("roc_auc").desc())))


def calibration_bins(df: DataFrame, y: str = "y", p: str = "p", bins: int = 8) -> DataFrame:
    """Rows, mean score and share of positives by quantile bin: the inner edges strictly below the score."""
    edges = [e for e in exact_quantiles(df, p, [i / bins for i in range(1, bins)]) if e is not None]
    below = sum(((F.lit(e) < F.col(p)).cast("int") for e in edges), F.lit(0))
    binned = df.withColumn("bin", below)
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_pred"), F.avg(F.col(y).cast("double")).alias("frac_pos"))


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """False and true positive rates at each distinct score, highest first."""
    tied = df.groupBy(F.col(p).alias("threshold")).agg(F.sum(y).alias("pos"), F.count("*").alias("c"))
    both = tied.agg(F.sum("pos").alias("_pos"), F.sum(F.col("c") - F.col("pos")).alias("_neg"))
    sums = running_by_score(running_by_score(tied, [], "threshold", F.col("pos"), "tp", False), [], "threshold", F.col("c") - F.col("pos"), "fp", False)
    return sums.crossJoin(F.broadcast(both)).select("threshold", (F.col("tp") / F.col("_pos")).alias("tpr"), (F.col("fp") / F.col("_neg")).alias("fpr"))


def confusion(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.groupBy(F.col(y).cast("int").alias("fact"), (F.col(p) >= 0.5).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


def symmetrised(df: DataFrame, key: str = "match_id", p: str = "p") -> DataFrame:
    """One row a match: the mean of side 1's score and one less side 2's; their gap."""
    one, two = F.max(F.when(F.col("perspective") == "player1", F.col(p))), F.max(F.when(F.col("perspective") == "player2", F.col(p)))
    return df.groupBy(key).agg(one.alias("p_ab"), two.alias("p_ba")).withColumns({"p1": (F.col("p_ab") + 1 - F.col("p_ba")) / 2, "gap": F.abs(F.col("p_ab") - (1 - F.col("p_ba")))})


def select_mode(candidates: DataFrame, tolerance: float = 0.0025) -> DataFrame:
    """Of candidates within ``tolerance`` of the least log loss, the one with the smallest train/test gap."""
    least = candidates.agg(F.min("logloss").alias("least"))
    near = candidates.crossJoin(F.broadcast(least)).where(F.col("logloss") <= F.col("least") + tolerance)
    return near.orderBy("gap", "logloss", "mode").limit(1).drop("least")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """missing share, mean, sample deviation, min, max of each column, from one pass."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x.isNull().cast("double")).alias(f"{c}__missing"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{k}").alias(k) for k in ("missing", "mean", "std", "min", "max")]) for c in columns])).alias("r")).select("r.*")


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of all columns, one row."""
    found = quantiles(df, {c: [0.5] for c in columns})
    return df.sparkSession.createDataFrame([tuple(found[c][0] for c in columns)], ", ".join(f"`{c}` double" for c in columns))


def impute(df: DataFrame, fill: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of ``columns`` replaced from the one-row ``fill``."""
    f = fill.select(*[F.col(c).alias(f"_m_{c}") for c in columns])
    return df.crossJoin(F.broadcast(f)).withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in columns}).drop(*[f"_m_{c}" for c in columns])


def best_model(table: DataFrame) -> DataFrame:
    """The first by log loss, Brier score and (greatest) AUC, then by name."""
    return table.orderBy("logloss", "brier", F.desc("roc_auc"), "model").limit(1)


def metric_table(scored: DataFrame, models: Sequence[str], keep: Sequence[str] = ("y",)) -> DataFrame:
    """Metrics of several probability columns at once: unpivoted, then one aggregation."""
    long = scored.select(*keep, F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("p")) for m in models])).alias("_m")).select(*keep, "_m.*")
    return metrics(long, ["model"])


def split_diagnostics(scored: DataFrame) -> DataFrame:
    """Metrics of train and test rows (``is_test``) in one row a model, and the log-loss gap."""
    m = metrics(scored, ["model", "is_test"])
    side = lambda c, t: F.max(F.when(F.col("is_test") == t, F.col(c)))
    out = m.groupBy("model").agg(*[side(c, t).alias(f"{name}_{c}") for c in ("logloss", "roc_auc") for t, name in ((0, "train"), (1, "test"))])
    return out.withColumn("gap", F.col("test_logloss") - F.col("train_logloss"))
