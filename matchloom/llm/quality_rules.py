"""Quality rules as weak supervision, in DataFrame operations only.

Every rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the
corpus-wide counts of vote patterns estimates how accurate each rule is and how common good
documents are; a document's posterior probability of being good decides, instead of asking
every rule to pass. A pattern table has at most 3^9 rows whatever the corpus, so it may go to
the driver; texts are read once, and only the narrow feature rows are kept between the passes.

Edge cases: a null text counts as empty; a text without words has all counts 0 and fails the
base; repeated rows give repeated result rows; null ids are carried; extra columns are ignored unless kept, and an output
column whose name a kept one has gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import fresh, materialise

SPACE = " \t\n\x0b\f\r"

#: name, condition for a bad vote, condition for a good vote; else the rule abstains.
RULES: list[tuple[str, str, str]] = [
    ("symbols", "n_symbols * 10 > n_words", "n_symbols * 50 <= n_words"),
    ("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words", "word_chars between 3.5D * n_words and 8 * n_words"),
    ("capitals", "n_upper * 100 > 40 * word_chars", "n_upper * 100 <= 10 * word_chars"),
    ("shouting", "n_exclaim * 10 > n_words", "n_exclaim * 50 <= n_words"),
    ("dup_lines", "n_dup_lines * 100 > 30 * n_lines", "n_dup_lines = 0"),
    ("repeats", "n_repeat_words * 100 > 10 * n_words", "n_repeat_words = 0"),
    ("short_words", "n_short * 100 < 8 * n_words", "n_short * 100 >= 15 * n_words"),
    ("sentences", "n_words >= 60 and n_stops * 100 < n_words", "n_stops * 40 >= n_words"),
    ("length", "n_words < 10", "n_words >= 40"),
]


#: Names that the counts and the working columns of :func:`text_features` have.
TAKEN = ("_t", "_s", "_w", "_l", "_win", "_again", "_sorted", "_pos", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim", "n_short", "n_stops", "quality", "base_failed", "kept", "text")


def text_features(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the counts that rules read, one row per input row."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = df.select(*keep, t.alias("_t")).withColumn("_s", F.trim(F.col("_t"), F.lit(SPACE)))
    words = base.withColumn("_w", F.when(F.col("_s") == "", F.array().cast("array<string>")).otherwise(F.split("_s", r"\s+")))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    word = lambda k: lambda i: F.get(F.col("_w"), i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 5),
        lambda i: F.xxhash64(*[word(k)(i) for k in range(5)]),
    )
    counted = words.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size(F.filter("_w", lambda w: (F.length(w) <= 3) & ~w.isin("|", "-", "*"))).cast("long").alias("n_short"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count("_t", F.lit(r"[.?!](?=\s|$)")).cast("long").alias("n_stops"),
        lines.alias("_l"),
        F.when(F.size("_w") >= 5, windows).otherwise(F.array().cast("array<bigint>")).alias("_win"),
    )
    # a window repeats only in texts whose distinct windows are fewer; just those are sorted
    again = F.size(F.array_distinct("_win")) < F.size("_win")
    dealt = counted.withColumn("_again", again).withColumn(
        "_sorted",
        F.when(F.col("_again"), F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    same = lambda x, j: F.coalesce(F.get(F.col("_sorted"), j)["h"] == x["h"], F.lit(False))
    found = dealt.withColumn(
        "_pos",
        F.sort_array(F.transform(F.filter("_sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])),
    )
    covered = F.aggregate(
        F.transform("_pos", lambda p, i: F.least(F.lit(5), F.coalesce(F.get(F.col("_pos"), i + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return found.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_exclaim",
        "n_short",
        "n_stops",
    )


def vote_columns(rules: list[tuple[str, str, str]] = RULES) -> list[Column]:
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).cast("int").alias(f"vote_{name}") for name, bad, good in rules]


#: Prior, and each rule's accuracy on good and on bad documents (of those it votes on).
Accuracies = tuple[float, list[float], list[float]]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> Accuracies:
    """Prior and accuracies from counted vote patterns, by expectation-maximisation.

    A rule has one accuracy for good documents and one for bad ones: junk of one kind passes the
    rules made for other kinds, so a good vote says less than a bad one. Documents start as
    bad when two rules say so. Bounds keep the classes from swapping and any rule from deciding
    against all others alone.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    total = sum(c for _, c in patterns)
    if not total:
        return 0.8, [0.9] * n_rules, [0.4] * n_rules
    start = (0.95, 0.7, 0.1)
    good = [start[min(2, sum(v < 0 for v in votes))] for votes, _ in patterns]
    was = None
    for _ in range(rounds):
        prior = min(0.98, max(0.02, sum(p * c for p, (_, c) in zip(good, patterns, strict=True)) / total))
        on_good, on_bad = [], []
        for r in range(n_rules):
            yes, said, no, spoke = 9.0, 10.0, 4.0, 10.0
            for p, (votes, c) in zip(good, patterns, strict=True):
                if votes[r]:
                    said += p * c
                    spoke += (1 - p) * c
                    yes += p * c * (votes[r] > 0)
                    no += (1 - p) * c * (votes[r] < 0)
            on_good.append(min(0.99, max(0.6, yes / said)))
            on_bad.append(min(0.95, max(1 - on_good[-1] + 0.02, no / spoke)))
        found = (prior, on_good, on_bad)
        good = [posterior(votes, found) for votes, _ in patterns]
        if was is not None and abs(prior - was) < 1e-9:
            break
        was = prior
    return found


def log_odds(found: Accuracies) -> list[tuple[float, float]]:
    """What a good and what a bad vote of each rule adds to the log odds of a good document."""
    _, on_good, on_bad = found
    return [(math.log(a / (1 - b)), math.log((1 - a) / b)) for a, b in zip(on_good, on_bad, strict=True)]


def posterior(votes: tuple[int, ...], found: Accuracies) -> float:
    prior = found[0]
    z = math.log(prior / (1 - prior)) + sum((up if v > 0 else down) for v, (up, down) in zip(votes, log_odds(found), strict=True) if v)
    return 1 / (1 + math.exp(-z))


def apply_quality_rules(df: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.5, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Features, votes, ``quality`` (posterior), ``base_failed`` and ``kept`` of every row."""
    # a kept column with the name of a count or an output travels under another name
    own = {c: fresh([*TAKEN, *(f"vote_{r[0]}" for r in rules), *keep], f"_k{i}") for i, c in enumerate(keep)}
    hidden = df.select(*[F.col(c).alias(own[c]) for c in keep], F.col(text).alias("text"))
    scored = materialise(text_features(hidden, list(own.values())).select("*", *vote_columns(rules)))
    names = [f"vote_{r[0]}" for r in rules]
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in scored.groupBy(*names).count().collect())
    found = estimate(patterns)
    z = F.lit(math.log(found[0] / (1 - found[0])))
    for name, (up, down) in zip(names, log_odds(found), strict=False):
        z = z + F.when(F.col(name) > 0, up).when(F.col(name) < 0, down).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = scored.withColumn("quality", 1 / (1 + F.exp(-z))).withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= F.lit(threshold)))
    added = [c for c in out.columns if c not in own.values()]
    return out.select(*[F.col(own[c]).alias(c) for c in keep], *[F.col(c).alias(fresh(keep, c)) for c in added])
