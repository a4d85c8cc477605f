"""Homomorphic multiset hashes of documents, in DataFrame operations only.

A document is the multiset of its paragraphs (lines with a word, trimmed). Each paragraph has a
wide vector and a document's fingerprint is the sum of its paragraphs' vectors, lane by lane:

* 16 equality lanes, uniform 32-bit values hashed from the paragraph, summed modulo 2^32;
* 64 likeness lanes, modulo 2^32: the sum of +1/-1 signs hashed from the paragraph's three-word
  shingles (never across paragraphs).

Sums commute, so paragraph order does not matter, and :func:`combine` inserts or deletes
paragraphs without the rest of the text. The likeness lanes are a tug-of-war sketch: the mean
square of a difference estimates the squared distance of two shingle multisets, so likeness is
1 - |a-b|^2 / (|a|^2 + |b|^2), held to [0, 1].

Edge cases: a null text counts as empty and has the zero fingerprint; rows with equal id and text
are one document and each gets its result; rows with an equal id and different texts follow each
other by text hash; null ids come after all others; extra columns are ignored; an empty table gives
an empty result; a single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise, scope

EQUALITY_LANES, SIGN_LANES, SHINGLE = 16, 64, 3
#: Three 21-bit counters share a long: of bits m, m + 21 and m + 42, the last bit alone; a group below has fewer than 2^21 shingles.
FIELD = 21
_THREE = 1 | 1 << FIELD | 1 << 2 * FIELD
_NO_ID = -(2**63)
_BLANK = " \t\x0b\f\r"


def _eq(lane: int, bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(0xFFFFFFFF)) if lane % 2 == 0 else F.shiftrightunsigned(bits, 32)


def equality_lanes(text: Column) -> Column:
    """``eq`` array<bigint> of one text."""
    paragraphs = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(_BLANK))), lambda x: x != "")
    hashes = lambda x: F.array(*[_eq(k, F.xxhash64(F.lit(k // 2), x)) for k in range(EQUALITY_LANES)])
    return F.aggregate(paragraphs, F.array(*[F.lit(0).cast("long")] * EQUALITY_LANES), lambda s, x: _add_eq(s, hashes(x)))


def sign_lanes(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``signs`` array<int>; one row for each key.

    Needs no exchange when ``df`` is already dealt by some of the keys.
    """
    paragraphs = df.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_pp", "_raw"))
    words = paragraphs.withColumn("_par", F.trim(F.col("_raw"), F.lit(_BLANK))).select(*keys, "_pp", F.split("_par", r"\s+").alias("_w"), "_par")
    shingles = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_w") - SHINGLE, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(SHINGLE)]),
    )
    rows = words.select(*keys, "_pp", F.posexplode_outer(F.when(F.col("_par") != "", shingles)).alias("_sp", "_h"))
    packs = [F.shiftrightunsigned("_h", m).bitwiseAND(F.lit(_THREE)) for m in range(FIELD)] + [F.shiftrightunsigned("_h", SIGN_LANES - 1)]
    part = rows.groupBy(*keys, F.shiftright("_pp", 8).alias("_b1"), F.shiftright("_sp", 12).alias("_b2")).agg(
        F.count("_h").alias("_n"), *[F.coalesce(F.sum(p), F.lit(0)).alias(f"_p{m}") for m, p in enumerate(packs)]
    )
    place = lambda j: (FIELD, 0) if j == 3 * FIELD else (j % FIELD, j // FIELD)
    lane = lambda m, b: F.sum(F.shiftright(F.col(f"_p{m}"), FIELD * b).bitwiseAND(F.lit((1 << FIELD) - 1)))
    whole = part.groupBy(*keys).agg(F.sum("_n").alias("_n"), *[lane(*place(j)).alias(f"_s{j}") for j in range(SIGN_LANES)])
    return whole.select(*keys, F.array(*[_signed32(2 * F.col(f"_s{j}") - F.col("_n")).cast("int") for j in range(SIGN_LANES)]).alias("signs"))


def fingerprint_lanes(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``eq`` array<bigint> and ``signs`` array<int>; one row for each key."""
    each = df.select(*keys, equality_lanes(F.coalesce(F.col(text), F.lit(""))).alias("_eq"))
    eq = each.groupBy(*keys).agg(F.array(*[F.sum(F.col("_eq")[k]).bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(EQUALITY_LANES)]).alias("eq"))
    eq = eq.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "eq")
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return sign_lanes(df, keys, text).join(eq, same).select(*keys, "eq", "signs")


def _add_eq(a: Column, b: Column, way: int = 1) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + way * y).bitwiseAND(F.lit(0xFFFFFFFF)))


def _add_signs(a: Column, b: Column, way: int = 1) -> Column:
    return F.zip_with(a, b, lambda x, y: _signed32(x.cast("long") + way * y.cast("long")).cast("int"))


def _signed32(x: Column) -> Column:
    low = x.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 0x80000000, low - 0x100000000).otherwise(low)


def fingerprint_text(eq: str, signs: str) -> Column:
    """The lanes as hexadecimal text."""
    strong = F.concat(*[F.lpad(F.lower(F.hex(F.col(eq)[k].cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0") for k in range(EQUALITY_LANES)])
    weak = F.concat(*[F.lpad(F.lower(F.hex(F.col(signs)[j].cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0") for j in range(SIGN_LANES)])
    return F.concat(strong, F.lit("-"), weak)


def combine(a_eq: Column, a_signs: Column, b_eq: Column, b_signs: Column, insert: bool = True) -> tuple[Column, Column]:
    """Lanes of a with b's paragraphs inserted, or deleted."""
    way = 1 if insert else -1
    return _add_eq(a_eq, b_eq, way), _add_signs(a_signs, b_signs, way)


def likeness(a: Column, b: Column) -> Column:
    """Of two ``signs`` columns: estimated 1 - |a-b|^2 / (|a|^2 + |b|^2), in [0, 1]; two empty ones are alike."""

    def square(x: Column) -> Column:
        return x.cast("double") * x.cast("double")

    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)
    apart = total(F.zip_with(a, b, lambda x, y: square(_signed32(x.cast("long") - y.cast("long")))))
    size = total(F.zip_with(a, b, lambda x, y: square(x) + square(y)))
    return F.when(size == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / size)))


def _in_order(docs: DataFrame) -> DataFrame:
    """Each distinct (kid, h) with the next one by descending id, and the one before it.

    Positions come from a range exchange of narrow rows; only one row a partition is summed
    in one place.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id", "kid", "h", F.length("text").alias("n")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").asc()]
    dealt = ids.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    placed = materialise(dealt.withColumn("mid", F.monotonically_increasing_id()))
    from pyspark.sql import Window

    parts = placed.groupBy(F.shiftright("mid", 33).alias("pid")).agg(F.count("*").alias("c"))
    everything = Window.orderBy("pid")
    offsets = parts.select(
        "pid",
        (F.sum("c").over(everything) - F.col("c")).alias("before"),
        F.sum("c").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    # one row for each partition of the exchange above: a bounded table
    at = placed.join(F.broadcast(offsets), F.shiftright("mid", 33) == offsets["pid"]).select(
        "kid", "h", "n", (F.col("before") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))).alias("pos"), "total"
    )
    after = at.select(
        F.col("kid").alias("prev_kid"),
        F.col("h").alias("prev_h"),
        F.floor(F.col("n") / 3).cast("int").alias("prev_cut"),
        ((F.col("pos") + 1) % F.col("total")).alias("pos"),
    )
    return at.select("kid", "h", "pos").join(after, "pos").drop("pos")


def edited_fingerprints(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text: the last floor(n/3) code points replaced by the first as many (or all) of
    the next document by descending id; after the last comes the first.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumns({"kid": F.coalesce(F.col("doc_id"), F.lit(_NO_ID)).cast("long"), "h": F.xxhash64("text")})
    with scope():
        return _edited(docs)


def _edited(docs: DataFrame) -> DataFrame:
    order = _in_order(docs)
    # the one exchange of texts: every branch below needs just these columns, so it is reused
    single = docs.select("kid", "h", "text").repartition("kid", "h").groupBy("kid", "h").agg(F.first("text").alias("text"), F.count("*").alias("copies")).join(order, ["kid", "h"])
    # what a document gives to the one before it: never more than a third of that one
    given = single.select(F.col("prev_kid").alias("kid"), F.col("prev_h").alias("h"), F.expr("left(text, prev_cut)").alias("given"))
    kept = F.expr("left(text, length(text) - floor(length(text) / 3))")
    edited = single.join(given, ["kid", "h"]).withColumn("kept", kept)
    edited = edited.withColumn("edited", F.concat("kept", F.when(F.length("kept") < F.length("text"), F.col("given")).otherwise(F.lit(""))))
    # whole paragraphs that the edit keeps are read once for both texts: sums of lanes of a text's parts, cut between paragraphs, are the text's
    edited = edited.withColumn("same", F.length("kept") - F.length(F.substring_index("kept", "\n", -1)))
    parts = [F.expr("left(text, same)"), F.expr("substr(text, same + 1)"), F.expr("substr(edited, same + 1)")]
    each = edited.select("kid", "h", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("t")) for k, p in enumerate(parts)])).alias("x"))
    lanes = sign_lanes(each.select("kid", "h", "x.kind", "x.t"), ["kid", "h", "kind"], "t")
    signs = lanes.groupBy("kid", "h").agg(*[F.max(F.when(F.col("kind") == k, F.col("signs"))).alias(f"s{k}") for k in range(3)])
    digest = edited.select(
        "kid", "h", "prev_kid", "prev_h", "copies", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), *[equality_lanes(p).alias(f"e{k}") for k, p in enumerate(parts)]
    )
    signed = lambda eq: F.transform(eq, lambda x: _signed32(x).cast("int"))
    of = lambda k: F.struct(signed(_add_eq(F.col("e0"), F.col(f"e{k}"))).alias("eq"), _add_signs(F.col("s0"), F.col(f"s{k}")).alias("signs"))
    both = digest.join(signs, ["kid", "h"]).select("kid", "h", "prev_kid", "prev_h", "copies", "n_chars", "edited_sha256", of(1).alias("a"), of(2).alias("b"))
    found = materialise(both, outer=True)
    to_prev = found.select(F.col("prev_kid").alias("kid"), F.col("prev_h").alias("h"), F.col("a.signs").alias("next_signs"))
    whole = found.join(to_prev, ["kid", "h"])
    each = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).withColumn("doc_id", F.nullif(F.col("kid"), F.lit(_NO_ID)))
    return each.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("a.eq").alias("eq"),
        F.col("a.signs").alias("signs"),
        F.col("b.eq").alias("edited_eq"),
        F.col("b.signs").alias("edited_signs"),
        likeness(F.col("a.signs"), F.col("b.signs")).alias("near_edited"),
        likeness(F.col("a.signs"), F.col("next_signs")).alias("near_next"),
    ).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint_text("eq", "signs").alias("fingerprint"),
        fingerprint_text("edited_eq", "edited_signs").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
