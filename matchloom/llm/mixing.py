"""Mixing sources to target weights, in DataFrame operations only.

Each source's weight is its token share to the power a, normalised. Without a target entropy, a is
the smallest in [0, 1] whose repetitions stay within ``repetition_limit``; with one, the a that
meets it, not below that. Both are found by bisection: the limit's from the least and the greatest share, the entropy's in
aggregations over the sources that try 32 exponents at once. Weights and repetitions are columns; what comes to the driver doesn't
grow with the number of sources. The budget is by default the least at which no source is cut: every document appears at least once.

A source with r repetitions gives floor(r) whole passes and a part of one more. Each pass orders
the source's documents by a hash of the pass: a permutation. The last pass takes documents up to
the hash at which its token budget is met, found in two steps (sums of hash blocks, then one block),
so no source is sorted in one place; a document's tokens decide at which hash, ties in the hash are taken together. ``position`` spreads a source's passes evenly over [0, 1), and
``block`` cuts it: every block of the output has about the target weights.

Edge cases: a null source counts as ''; a null or empty text has one token; rows that repeat a doc_id
in one source are taken or left together in a partial pass; null ids are carried; extra columns are
ignored unless named in ``keep``, and an output column whose name a kept one has gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .packing import word_count
from .storage import fresh, materialise, scope

#: Above so many sources the plan table is joined by key instead of broadcast.
BROADCAST_SOURCES = 10_000


def temperature_weights(tokens: dict[str, float], repetition_limit: float = 2.0, target_entropy: float | None = None) -> tuple[float, dict[str, float]]:
    """The exponent and the normalised weights, plainly, of a few sources; :func:`source_plan` is held against it."""
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items()}

    def weights(a: float) -> dict[str, float]:
        top = max(math.log(p) for p in share.values())
        raw = {s: math.exp(a * (math.log(p) - top)) for s, p in share.items()}
        z = sum(raw.values())
        return {s: x / z for s, x in raw.items()}

    def most_repeated(w: dict[str, float]) -> float:
        ratio = [w[s] / share[s] for s in w]
        return max(ratio) / min(ratio)

    def entropy(w: dict[str, float]) -> float:
        return -sum(x * math.log(x) for x in w.values() if x > 0)

    def bisect(too_flat) -> float:
        low, high = 0.0, 1.0
        if not too_flat(weights(low)):
            return low
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if too_flat(weights(mid)) else (low, mid)
        return high

    a = bisect(lambda w: most_repeated(w) > repetition_limit)
    if target_entropy is not None:
        a = max(a, bisect(lambda w: entropy(w) > target_entropy))
    return a, weights(a)


def _exponent(shares: DataFrame, repetition_limit: float, target_entropy: float | None) -> float:
    """The exponent for a table of shares (``p``)."""
    low_p, high_p = shares.agg(F.min("p"), F.max("p")).first()

    def bisect(too_flat, low: float = 0.0, high: float = 1.0) -> float:
        if not too_flat(low):
            return low
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if too_flat(mid) else (low, mid)
        return high

    # weights over shares are p^(a - 1) / z: greatest for the least share
    a = bisect(lambda a: (a - 1) * math.log(low_p / high_p) > math.log(repetition_limit))
    if target_entropy is None:
        return a
    low, high = 0.0, 1.0
    for _ in range(11):  # 33^11 > 2^52
        grid = [low + (high - low) * i / 32 for i in range(33)]
        raw = lambda x: F.exp(F.lit(x) * (F.log("p") - F.lit(math.log(high_p))))
        row = shares.agg(*[f(raw(x), x) for x in grid for f in (lambda w, _: F.sum(w), lambda w, x: F.sum(w * F.lit(x) * (F.log("p") - F.lit(math.log(high_p)))))]).first()
        entropy = [math.log(row[2 * i]) - row[2 * i + 1] / row[2 * i] for i in range(33)]
        below = next((i for i, h in enumerate(entropy) if h <= target_entropy), 32)
        if below == 0:
            return max(a, low)
        low, high = grid[below - 1], grid[below]
    return max(a, high)


def source_plan(totals: DataFrame, repetition_limit: float = 2.0, target_entropy: float | None = None, budget_tokens: float | None = None) -> DataFrame:
    """Of ``totals`` (source, tokens): share, weight, reps, whole passes and the tokens of a part of one more."""
    corpus = float(totals.agg(F.sum("tokens")).first()[0])
    shares = totals.withColumn("p", F.col("tokens") / F.lit(corpus))
    a = _exponent(shares, repetition_limit, target_entropy)
    z, most = shares.select(F.pow("p", F.lit(a)).alias("w"), "tokens").agg(F.sum("w"), F.max(F.col("tokens") / F.col("w"))).first()
    budget = budget_tokens if budget_tokens is not None else most * z
    planned = shares.withColumn("weight", F.pow("p", F.lit(a)) / F.lit(z)).withColumn("reps", F.col("weight") * F.lit(budget) / F.col("tokens"))
    planned = planned.withColumn("whole", F.floor(F.col("reps") + F.lit(1e-9)).cast("int"))
    rest = F.col("reps") - F.col("whole")
    return planned.withColumn("part", F.when(rest > 1e-9, rest * F.col("tokens")).otherwise(F.lit(0.0))).select("source", "tokens", F.col("p").alias("share"), "weight", F.greatest("reps", F.lit(1e-12)).alias("reps"), "whole", "part")


def _frac(source: Column, doc_id: Column, epoch: Column, seed: int) -> Column:
    """A hash in [0, 1) with 52 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("int"), source, doc_id), 12) / F.lit(float(2**52))


def source_tokens(df: DataFrame, tokens: Column | None = None) -> DataFrame:
    """(source, doc_id, n) of each row of ``df`` (doc_id, source, text)."""
    n = F.greatest(F.lit(1), word_count(F.col("text")) if tokens is None else tokens).cast("long")
    return df.select(F.coalesce(F.col("source"), F.lit("")).alias("source"), F.col("doc_id"), n.alias("n"))


def mix_sources(df: DataFrame, keep: list[str], repetition_limit: float = 2.0, target_entropy: float | None = None, budget_tokens: float | None = None, seed: int = 17, blocks: int = 1024, tokens: Column | None = None) -> DataFrame:
    """``keep`` columns, and mix_source, epoch, position, block of each draw of each row of ``df`` (doc_id, source, text)."""
    with scope():
        return _mixed(df, keep, repetition_limit, target_entropy, budget_tokens, seed, blocks, tokens)


def _mixed(df: DataFrame, keep: list[str], repetition_limit: float, target_entropy: float | None, budget_tokens: float | None, seed: int, blocks: int, tokens: Column | None) -> DataFrame:
    source = F.coalesce(F.col("source"), F.lit(""))
    out = {c: fresh(keep, c) for c in ("mix_source", "epoch", "position", "block")}
    narrow = materialise(source_tokens(df, tokens))
    totals = materialise(narrow.groupBy("source").agg(F.sum("n").alias("tokens")))
    count = totals.count()
    if not count:
        return df.select(*keep, source.alias(out["mix_source"]), *[F.lit(0).cast(t).alias(out[c]) for c, t in (("epoch", "int"), ("position", "double"), ("block", "int"))])
    plan = materialise(source_plan(totals, repetition_limit, target_entropy, budget_tokens).select("source", "whole", "part", "reps"))
    small = F.broadcast if count <= BROADCAST_SOURCES else lambda rows: rows  # the plan has a row a source

    # the last pass: where in hash order its budget is met; a source is cut into so many hash blocks that one has some 2^16 rows
    most = narrow.groupBy("source").count().agg(F.max("count")).first()[0]
    cuts = 1 << max(10, (most >> 16).bit_length())
    last = narrow.join(small(plan), "source").where("part > 0").withColumn("v", _frac(F.col("source"), F.col("doc_id"), F.col("whole"), seed))
    last = last.withColumn("b", F.floor(F.col("v") * F.lit(cuts)).cast("int"))
    sums = last.groupBy("source", "b").agg(F.sum("n").alias("t"), F.first("part").alias("part"))
    upto = F.sum("t").over(Window.partitionBy("source").orderBy("b"))
    cut = sums.withColumn("before", upto - F.col("t")).where("before < part and before + t >= part").select("source", F.col("b"), (F.col("part") - F.col("before")).alias("left"))
    inside = last.join(small(cut), ["source", "b"]).groupBy("source", "left", "v").agg(F.sum("n").alias("t"))
    so_far = F.sum("t").over(Window.partitionBy("source").orderBy("v")) - F.col("t")
    edge = inside.withColumn("before", so_far).where("before < left").groupBy("source").agg(F.max("v").alias("edge"))
    full_plan = plan.join(edge, "source", "left").withColumn("edge", F.when(F.col("part") > 0, F.coalesce("edge", F.lit(2.0))).otherwise(F.lit(-1.0)))
    ready = materialise(full_plan, outer=True)

    # working columns have names that no kept column has
    own = {c: fresh([*keep, *out.values()], f"_mix_{c}") for c in ("source", "doc", "whole", "part", "reps", "edge", "draws")}
    named = df.select(*keep, source.alias(own["source"]), F.col("doc_id").alias(own["doc"]))
    joined = named.join(small(ready.withColumnsRenamed({c: own[c] for c in ("source", "whole", "part", "reps", "edge")})), own["source"])
    v = lambda epoch: _frac(F.col(own["source"]), F.col(own["doc"]), epoch, seed)
    draws = joined.withColumn(own["draws"], F.col(own["whole"]) + F.when(v(F.col(own["whole"])) <= F.col(own["edge"]), 1).otherwise(0)).where(F.col(own["draws"]) > 0)
    each = draws.withColumn(out["epoch"], F.explode(F.sequence(F.lit(0), F.col(own["draws"]) - 1)))
    placed = each.withColumn(out["position"], F.least(F.lit(1.0 - 2**-40), (F.col(out["epoch"]) + v(F.col(out["epoch"]))) / F.col(own["reps"])))
    return placed.select(*keep, F.col(own["source"]).alias(out["mix_source"]), F.col(out["epoch"]).cast("int").alias(out["epoch"]), out["position"], F.floor(F.col(out["position"]) * blocks).cast("int").alias(out["block"]))
