"""Vector codes: product quantisation with codebooks learned by Elkan's form of Lloyd's iteration, in integers.

A component x becomes floor(1024 x); a vector is cut into equal consecutive parts, each with a codebook of its own that starts as that part
of the vectors with the smallest ids. Between rounds each task's vectors keep, for each part, an upper bound of the distance to
their entry and a lower bound of the distance to each entry, in a table in the shared folder. A round shifts the bounds by
how far entries moved, drops a part whose upper bound lies below half the way from its entry to the nearest other one, drops
entries whose lower bound or half distance lies above the upper bound, always strictly, and takes integer distances to what is
left: the nearest entry, ties to the lower index. Bounds are 32-bit floats, rounded outwards. A round is one pass over the state:
it writes the next state and each task's sums by entry (at most parts x entries rows a task), which Spark adds; the driver holds
codebooks only.

Edge cases: a vector that is null, or holds a null, NaN or infinite component, has no row. Vectors of another length than that of the smallest
kept id, or of one that the parts don't divide, have none either. With fewer vectors than entries the codebook is as long as there are
vectors. Rows of one id are vectors each, in the order of their components; null ids come last. Components too large for sums of squares in 64 bits are
computed in Python integers; an error that passes 64 bits is held at the largest long. Null labels are one label. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import join_back
from .storage import discard, materialise
from .workers import trimmed

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LARGEST = (1 << 63) - 1
#: More than the rounding of the arithmetic of any bound.
SLACK = 1e-6
_BLOCK = 4096
_PAIRS = 1 << 16
_UP, _DOWN = np.float32(np.inf), np.float32(-np.inf)

#: By part position: entries x components, as integers.
Books = list[np.ndarray]


def above(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter((np.asarray(x, np.float64) * (1 + SLACK)).astype(np.float32), _UP)


def below(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = np.minimum((np.asarray(x, np.float64) * (1 - SLACK)).astype(np.float32), np.finfo(np.float32).max)
    return np.maximum(np.nextafter(y, _DOWN), np.float32(0))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to rows of ``b``, one by one."""
    d = a - b
    return (d * d).sum(-1)


def all_squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    if x.dtype != object and 4 * x.shape[1] * int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))) ** 2 < 1 << 53:  # exact in doubles
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([squares(x, book[j]) for j in range(len(book))], 1)


def root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64))


class Moves:
    """What a round needs of a part's codebook: entries, their distances, and how far each came since the last round."""

    def __init__(self, book: np.ndarray, last: np.ndarray | None) -> None:
        self.book = book
        half = root(all_squares(book, book)) / 2
        np.fill_diagonal(half, np.inf)
        self.half = below(half)
        np.fill_diagonal(self.half, np.float32(np.inf))
        self.nearest = self.half.min(1)
        self.moved = None if last is None else above(root(squares(book, last)))
        if self.moved is not None:
            self.moved[(book == last).all(1)] = 0


def first_assign(x: np.ndarray, m: Moves) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry, upper bound and lower bounds from all distances."""
    sq = all_squares(x, m.book)
    at = np.argmin(sq, 1) if sq.dtype != object else np.array([min(range(len(m.book)), key=lambda j: (r[j], j)) for r in sq], np.int64)
    d = root(sq)
    return at, above(d[np.arange(len(x)), at]), below(d)


def next_assign(x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, m: Moves) -> int:
    """Assigns anew in place; how many distances it took."""
    took = 0
    upper[:] = above(upper.astype(np.float64) + m.moved[at])
    lower[:] = below(np.maximum(lower.astype(np.float64) - m.moved, 0))
    open_ = np.flatnonzero(~(upper < m.nearest[at]))
    if not len(open_):
        return took
    own = squares(x[open_], m.book[at[open_]])
    took += len(open_)
    upper[open_] = above(root(own))
    u, a = upper[open_][:, None], at[open_]
    # strictly: an entry that may be as near as the own one is compared in integers
    ask = ~(u < lower[open_]) & ~(u < m.half[a])
    ask[np.arange(len(open_)), a] = False
    row, entry = np.nonzero(ask)
    took += len(row)
    best_sq, best = own.copy(), a.copy()
    sq = np.empty(len(row), own.dtype)
    for i in range(0, len(row), _PAIRS):
        r, e = row[i : i + _PAIRS], entry[i : i + _PAIRS]
        sq[i : i + _PAIRS] = squares(x[open_[r]], m.book[e])
    lower[open_[row], entry] = below(root(sq))
    # of each row the least (distance, entry), against its own
    if len(row):
        order = sorted(range(len(row)), key=lambda i: (row[i], sq[i], entry[i])) if sq.dtype == object else np.lexsort((entry, sq, row))
        row, entry, sq = row[order], entry[order], sq[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        r, e, s = row[first], entry[first], sq[first]
        better = (s < best_sq[r]) | ((s == best_sq[r]) & (e < best[r]))
        r, e, s = r[better], e[better], s[better]
        # the entry that is left keeps its distance as a lower bound
        lower[open_[r], best[r]] = below(root(best_sq[r]))
        best[r], best_sq[r] = e, s
        at[open_] = best
        upper[open_] = above(root(best_sq))
    return took


_STATE = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int64())), ("w", pa.list_(pa.string())), ("code", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()), ("error", pa.int64()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])
STATE = "vec_id bigint, label string, v array<bigint>, w array<string>, code binary, upper binary, lower binary, error bigint, part int, entry int, n bigint, sums array<string>"


def _round(books: Books, last: Books | None, final: bool, wide: bool):
    """One pass: next state of each vector (``final``: its code and error), and the task's sums."""
    dims, entries = books[0].shape[1], len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if wide else np.int64
        moves = [Moves(b.astype(kind), None if last is None else last[p].astype(kind)) for p, b in enumerate(books)]
        sums = np.zeros((len(books), entries, dims), object)
        count = np.zeros((len(books), entries), np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, _BLOCK):
                batch = whole.slice(i, _BLOCK)
                n = batch.num_rows
                at = lambda c: batch.column(batch.schema.names.index(c))  # noqa: B023, E731
                if wide:
                    x = np.array([[int(y) for y in r] for r in at("w").to_pylist()], object)
                else:
                    x = at("v").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                code, error = np.empty((n, len(books)), np.uint8), np.zeros(n, kind)
                uppers, lowers = np.empty((n, len(books)), np.float32), np.empty((n, len(books), entries), np.float32)
                if last is not None:
                    code[:] = np.frombuffer(b"".join(at("code").to_pylist()), np.uint8).reshape(n, -1)
                    uppers[:] = np.frombuffer(b"".join(at("upper").to_pylist()), np.float32).reshape(uppers.shape)
                    lowers[:] = np.frombuffer(b"".join(at("lower").to_pylist()), np.float32).reshape(lowers.shape)
                for p, m in enumerate(moves):
                    y = x[:, p * dims : (p + 1) * dims]
                    if last is None:
                        a, uppers[:, p], lowers[:, p] = first_assign(y, m)
                    else:
                        a, u, low = code[:, p].astype(np.int64), uppers[:, p].copy(), lowers[:, p].copy()
                        next_assign(y, a, u, low, m)
                        uppers[:, p], lowers[:, p] = u, low
                    code[:, p] = a
                    if final:
                        error = error + squares(y, m.book[a])
                    else:
                        count[p] += np.bincount(a, minlength=entries)
                        order = np.argsort(a, kind="stable")
                        held, first = np.unique(a[order], return_index=True)
                        sums[p][held] += np.add.reduceat(y[order], first).astype(object)
                own = {"vec_id": at("vec_id"), "label": at("label"), "code": pa.array([r.tobytes() for r in code], pa.binary())}
                if final:
                    own["error"] = pa.array([min(int(e), LARGEST) for e in error], pa.int64())
                else:
                    own |= {"v": at("v"), "w": at("w"), "upper": pa.array([r.tobytes() for r in uppers], pa.binary()), "lower": pa.array([r.tobytes() for r in lowers], pa.binary())}
                yield pa.RecordBatch.from_arrays([own[f.name].cast(f.type) if f.name in own else pa.nulls(n, f.type) for f in _STATE], schema=_STATE)
        rows = [{"part": p, "entry": e, "n": int(count[p, e]), "sums": [str(s) for s in sums[p, e]]} for p, e in zip(*np.nonzero(count), strict=True)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _STATE)

    return run


def _updated(books: Books, state: DataFrame, dims: int, wide: bool) -> Books:
    """Entries as floors of their parts' means; parts x entries rows come to the driver."""
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(dims)]
    out = [b.astype(object) for b in books]
    for r in state.where("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():
        out[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return out if wide else [b.astype(np.int64) for b in out]


def vector_codes(df: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each kept row of ``df`` (vec_id, embedding, label).

    ``entries``: 256 at most, two hexadecimal digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must lie in 1..256")
    spark = df.sparkSession
    out = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    given = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    kept = given.where(F.col("e").isNotNull() & (F.size("e") > 0) & (F.size("e") % parts == 0) & ~F.exists("e", bad))
    order = [F.asc_nulls_last("vec_id"), "e"]
    heads = kept.select("vec_id", "e").orderBy(*order).limit(entries).collect()  # ``entries`` rows
    if not heads:
        return spark.createDataFrame([], out)
    length = len(heads[0]["e"])
    kept = kept.where(F.size("e") == length)
    if any(len(r["e"]) != length for r in heads):
        heads = kept.select("vec_id", "e").orderBy(*order).limit(entries).collect()
    widest = kept.agg(F.max(F.array_max(F.transform("e", F.abs)))).first()[0]
    wide = 4 * length * int(widest * scale + 1) ** 2 >= 1 << 62
    none = F.lit(None)
    if wide:
        scaled = kept.select("vec_id", "label", none.cast("array<bigint>").alias("v"), F.col("e").cast("array<string>").alias("w"))
        state = scaled.mapInArrow(trimmed(_floors(scale)), scaled.schema)
    else:
        state = kept.select("vec_id", "label", F.transform("e", lambda x: F.floor(x * scale)).alias("v"), none.cast("array<string>").alias("w"))
    cores = spark.sparkContext.defaultParallelism
    state = materialise(state.repartition(cores) if state.rdd.getNumPartitions() < cores else state)
    dims = length // parts
    first = np.array([[floor_of(x, scale) for x in r["e"]] for r in heads], object)
    books: Books = [first[:, p * dims : (p + 1) * dims] for p in range(parts)]
    books = [b if wide else b.astype(np.int64) for b in books]
    last: Books | None = None
    for _ in range(rounds):
        after = materialise(state.mapInArrow(trimmed(_round(books, last, False, wide)), STATE))
        discard(state)
        last, books = books, _updated(books, after, dims, wide)
        state = after.where("part is null")
        state._matchloom_path = after._matchloom_path
    coded = materialise(state.mapInArrow(trimmed(_round(books, last, True, wide)), STATE).select("vec_id", "label", "code", "error"))
    discard(state)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()
    keyed = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    labels = materialise(keyed.groupBy("key").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"), F.count("*").alias("rows")))
    total = labels.agg(F.sum("rows")).first()[0] or 0
    back = join_back(keyed, labels, ["key"], total, "rows")
    return back.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def floor_of(x: float, scale: int) -> int:
    """floor(scale x), exact for a finite double."""
    a, b = x.as_integer_ratio()
    return a * scale // b


def _floors(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [[str(floor_of(float(x), scale)) for x in r] for r in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(whole, pa.list_(pa.string()))], names=batch.schema.names)

    return run
