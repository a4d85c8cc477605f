"""Fuzzy line deduplication: MinHash, banding, exact Jaccard, distributed union-find.

A line with a word is put in normal form (its words, A-Z lower-cased, with one space between) and
becomes the set of its 8-byte shingles; a shorter one is a single shingle. Signatures are one-permutation
MinHash over 128 bins; an empty bin takes the value of the first full one in a random order of its own, so bins
of one band don't share a source and unlike short lines don't agree in whole bands. 21 bands of 6 bins: a pair at
a Jaccard of 0.8 is missed with a probability of about 0.002, one at 0.15 is a candidate with 0.0003. Lines that share a
band form candidate blocks, found with a combined exchange; each block is verified by exact Jaccard and the links
go to distributed union-find. One line a component stays: the first by doc_id, then by place.

Lines without a word stay as they are. Only lines that repeat or share a band travel further than the key exchange, by a filter of
bounded size and an exact join; a line that a third of all documents have costs one row a batch in that exchange.

Edge cases: a null text stays null, an empty one empty; null ids are carried and keep all their
lines, which count nowhere; repeated rows keep the same lines, and rows of one doc_id with different texts each lose
their own: a text is known by id and hash; of equal lines the first by (doc_id, line) stays; extra columns are kept by the caller's ``keep``, and an
output column whose name one of them has gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import connected_components
from .jaccard_join import verified_links
from .shingles import U, mix, slices, utf8
from .storage import fresh, materialise, scope, shuffle_partitions
from .workers import trimmed

SHINGLE, BANDS, ROWS, BINS = 8, 21, 6, 128
CHUNK_BYTES = 1 << 19
#: Band keys that one task of the exchange gathers, about.
TASK_KEYS = 2_000_000
_EMPTY = U(np.iinfo(np.uint64).max)
#: Of each bin, the order in which others are asked when it is empty; and the place of each in that order.
_ORDER = np.stack([np.random.Generator(np.random.PCG64(77 + b)).permutation(BINS) for b in range(BINS)])
_PLACE = np.argsort(_ORDER, 1).astype(np.int16)
_ASKED = np.ascontiguousarray(_ORDER.T)
#: A line with fewer full bins takes the first of them by their places instead of asking bin after bin.
FEW = 16
#: Whitespace that a text in normal form doesn't have.
_ODD = (b"  ", b"\t", b"\r", b"\x0b", b"\x0c", b" \n", b"\n ")


def normal_lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of all lines with a word in normal form; each one's row and line number."""
    low = raw.tobytes().lower()  # A-Z only
    odd = any(x in low for x in _ODD)
    lines: list[bytes] = []
    rows: list[int] = []
    numbers: list[int] = []
    bounds = offsets.tolist()
    for r in range(len(bounds) - 1):
        for i, line in enumerate(low[bounds[r] : bounds[r + 1]].split(b"\n")):
            if odd or line[:1] == b" " or line[-1:] == b" ":
                line = b" ".join(line.split())
            if line:
                lines.append(line)
                rows.append(r)
                numbers.append(i)
    at = np.zeros(len(lines) + 1, np.int64)
    np.cumsum([len(x) for x in lines], out=at[1:])
    return np.frombuffer(b"".join(lines), np.uint8), at, np.array(rows, np.int64), np.array(numbers, np.int64)


def line_shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 8-byte shingles of all lines in order (with repeats), and where each line's begin."""
    size = np.diff(offsets)
    padded = np.concatenate([raw, np.zeros(SHINGLE, np.uint8)]).tobytes()
    code = np.ndarray((len(raw),), "<u8", padded, 0, (1,)).astype(U)
    short = np.flatnonzero(size < SHINGLE)
    if len(short):
        code[offsets[:-1][short]] &= (U(1) << (U(8) * size[short].astype(U))) - U(1)
    # a line's last positions start no shingle
    count = np.maximum(size - SHINGLE + 1, 1)
    at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    edge = np.zeros(len(raw) + 1, np.int8)
    edge[offsets[:-1]] += 1
    edge[offsets[:-1] + count] -= 1
    return mix(code[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]), at


def line_ids(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """An id of each line's text: a hash of its shingles in order."""
    if not len(codes):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        plain = np.add.reduceat(codes, at[:-1])
        weighted = np.add.reduceat(codes * np.arange(1, 2 * len(codes) + 1, 2, dtype=U), at[:-1])
        # the weight of a line's first shingle is taken off, so a line's place in the batch doesn't count
        ordered = weighted - plain - plain * (U(2) * at[:-1].astype(U))
        return mix(mix(plain + np.diff(at).astype(U)) + ordered).view(np.int64)


def signatures(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The MinHash signature (lines x BINS) of each line."""
    lines = len(at) - 1
    low = np.full(lines * BINS, _EMPTY, U)
    cell = (codes >> U(57)).view(np.int64)
    cell += np.repeat(np.arange(0, lines * BINS, BINS), np.diff(at))
    np.minimum.at(low, cell, codes << U(7))
    sig = low.reshape(lines, BINS)
    full = sig != _EMPTY
    count = full.sum(1)
    out = low.copy()
    few = np.flatnonzero((count > 0) & (count < FEW))
    for m in np.unique(count[few]):
        rows = few[count[few] == m]
        bins = np.nonzero(full[rows])[1].reshape(-1, m)
        for i in range(0, len(rows), 1024):
            some = bins[i : i + 1024]
            best = _PLACE[:, some].argmin(2).T  # of each row and bin, which of its full bins comes first
            own = sig[rows[i : i + 1024]]
            out.reshape(lines, BINS)[rows[i : i + 1024]] = np.where(own != _EMPTY, own, np.take_along_axis(own, np.take_along_axis(some, best, 1), 1))
    full[count < FEW] = True
    cell = np.flatnonzero(~full.ravel())
    bin_ = cell & (BINS - 1)
    step = 0
    while len(cell):
        value = low.take(cell - bin_ + _ASKED[step].take(bin_))
        hit = value != _EMPTY
        out[cell[hit]] = value[hit]
        left = ~hit
        cell, bin_ = cell[left], bin_[left]
        step += 1
    return out.reshape(lines, BINS)


def band_keys(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """BANDS keys of each line."""
    bands = signatures(codes, at)[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), bands.shape[:2]).copy()
        for j in range(ROWS):
            key = mix(key * U(0x9FB21C651E98DF25) + bands[:, :, j])
    return (key & ~U(31)) | np.arange(BANDS, dtype=U)  # the last bits say which band it is


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    raw, offsets = utf8(batch.column("text"))
    for i, j in slices(offsets, CHUNK_BYTES):
        text, at, row, number = normal_lines(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        if len(row):
            yield i, j, *line_shingles(text, at), row, number


LINE_SCHEMA = "doc_id bigint, tid bigint, line int, lid bigint, n bigint, bands binary"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lines with a word; the band keys only with the first of equal lines of a chunk."""
    width = 8 * BANDS
    for batch in batches:
        ids, tids = batch.column("doc_id"), batch.column("tid")
        for i, _, codes, at, row, number in _chunks(batch):
            lid, n = line_ids(codes, at), np.diff(at)
            first = np.sort(np.unique(lid, return_index=True)[1])
            if len(first) < len(lid):
                own = np.repeat(np.isin(np.arange(len(lid)), first, assume_unique=True), n)
                codes, at = codes[own], np.concatenate([[0], np.cumsum(n[first])])
            keys = band_keys(codes, at).tobytes()
            bands: list[bytes | None] = [None] * len(lid)
            for x, f in enumerate(first.tolist()):
                bands[f] = keys[x * width : (x + 1) * width]
            where = pa.array(row + i)
            yield pa.RecordBatch.from_arrays([ids.take(where), tids.take(where), pa.array(number.astype(np.int32)), pa.array(lid), pa.array(n), pa.array(bands, pa.binary())], ["doc_id", "tid", "line", "lid", "n", "bands"])


def _groups_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order with their ids, where each key begins, its smallest id, and the id's group."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    low = np.minimum.reduceat(ids, first)
    return keys, ids, first, low, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))


def _links(ids: np.ndarray, low: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Distinct (id, smallest id of its key)."""
    apart = ids != low[group]
    return np.unique(np.stack([ids[apart], low[group[apart]]], 1), axis=0) if apart.any() else np.zeros((0, 2), np.int64)


def _repeated(keys: np.ndarray, ids: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Ids that a key of the first band has twice: lines that repeat."""
    own = np.flatnonzero((keys & U(31)) == 0)
    pair = np.stack([group[own], ids[own]], 1)
    found, count = np.unique(pair, axis=0, return_counts=True) if len(own) else (pair, np.zeros(0, np.int64))
    return found[count > 1, 1]


def _key_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the lines of a key; a line that repeats is linked with itself."""
    keys, ids = [], []

    def out(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    for batch in batches:
        for x, y in zip(batch.column("keys"), batch.column("ids"), strict=True):
            if len(x.as_py()):
                keys.append(np.frombuffer(x.as_py(), U))
                ids.append(np.frombuffer(y.as_py(), np.int64))
            else:
                yield out(np.frombuffer(y.as_py(), np.int64).reshape(-1, 2))
    if keys:
        key, line, first, low, group = _groups_of(np.concatenate(keys), np.concatenate(ids))
        many = np.diff(np.append(first, len(key)))[group] > 1
        twice = _repeated(key[many], line[many], group[many])
        pairs = np.concatenate([_links(line, low, group), np.stack([twice, twice], 1)])
        if len(pairs):
            yield out(pairs)


def _band_blobs(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("lid").to_numpy(zero_copy_only=False)
            if not len(every):
                continue
            have = np.flatnonzero(batch.column("bands").is_valid().to_numpy(zero_copy_only=False))
            names, count = np.unique(every, return_counts=True)
            lid, first = np.unique(every[have], return_index=True)
            # a line without band keys repeats one of its chunk
            twice = np.union1d(names[count > 1], np.setdiff1d(names, lid, assume_unique=True))
            pairs, blobs = np.stack([twice, twice], 1), []
            if len(lid):
                keys, ids, start, low, group = _groups_of(np.frombuffer(b"".join(batch.column("bands").take(pa.array(have[first])).to_pylist()), U), np.repeat(lid, BANDS))
                pairs = np.concatenate([pairs, _links(ids, low, group)])
                keys = keys[start]
                part = ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)
                edge = np.searchsorted(part, np.arange(parts + 1))
                blobs = [(int(p), keys[edge[p] : edge[p + 1]].tobytes(), low[edge[p] : edge[p + 1]].tobytes()) for p in np.flatnonzero(edge[1:] > edge[:-1])]
            if len(pairs):
                blobs.append((int(pairs[0, 0]) % parts, b"", pairs.tobytes()))
            p, x, y = zip(*blobs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], ["part", "keys", "ids"])

    return run


def shingles_of(line: bytes) -> np.ndarray:
    """Distinct shingles of a line in normal form, sorted."""
    line = line.ljust(SHINGLE, b"\0")
    codes = np.sort(mix(np.ndarray((len(line) - SHINGLE + 1,), "<u8", line, 0, (1,)).astype(U)))
    return codes[np.concatenate([[True], codes[1:] != codes[:-1]])]


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, block, chunk, n, line in normal form) of the lines that each row's ``want`` names."""
    for batch in batches:
        want = batch.column("want")
        names = want.flatten()
        line = names.field("line").to_numpy(zero_copy_only=False).tolist()
        edge = np.concatenate([[0], np.cumsum(pc.list_value_length(want).to_numpy(zero_copy_only=False))]).tolist()
        got: list[bytes] = []
        for r, text in enumerate(batch.column("text").to_pylist()):
            lines = text.encode().lower().split(b"\n")
            got += [b" ".join(lines[i].split()) for i in line[edge[r] : edge[r + 1]]]
        if got:
            n = np.maximum(np.array([len(x) for x in got], np.int64) - SHINGLE + 1, 1)
            yield pa.RecordBatch.from_arrays([names.field("sid"), names.field("block"), names.field("chunk"), pa.array(n), pa.array(got, pa.binary())], ["sid", "block", "chunk", "n", "set"])


def _texts(df: DataFrame) -> DataFrame:
    """doc_id, text and its hash ``tid`` of rows with both: a text is known by id and hash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tid")).where("doc_id is not null and text is not null")


def all_lines(df: DataFrame) -> DataFrame:
    """doc_id, tid, line, lid, n, bands of all lines with a word of ``df`` (doc_id, text): one pass over the texts."""
    return materialise(_texts(df).mapInArrow(trimmed(_lines), LINE_SCHEMA))


def lost_lines(df: DataFrame, num: int = 80, den: int = 100, block_shingles: int = 1_000_000) -> DataFrame:
    """(doc_id, tid, line) of all lines that go, over ``df`` (doc_id, text)."""
    with scope():
        docs = _texts(df)
        lines = all_lines(df)
        parts = max(shuffle_partitions(df.sparkSession), -(-lines.where("bands is not null").count() * BANDS // TASK_KEYS))
        blobs = lines.select("lid", "bands").mapInArrow(trimmed(_band_blobs(parts)), "part int, keys binary, ids binary")
        links = blobs.repartition(parts, "part").mapInArrow(trimmed(_key_links), "a bigint, b bigint")
        # lines that repeat or share a band; all others stay and go no further
        blocks = connected_components(links).select(F.col("node").alias("lid"), F.col("label").alias("block"))
        some = bloom.filtered(lines.select("doc_id", "tid", "line", "lid", "n"), "lid", bloom.build(blocks.select("lid")))
        some = materialise(some.join(blocks, "lid"))
        first = materialise(some.groupBy("lid", "block").agg(F.min(F.struct("doc_id", "line", "tid")).alias("at"), F.min("n").alias("n")))
        chunks = materialise(first.groupBy("block").agg(F.ceil(F.sum("n") / F.lit(block_shingles)).alias("chunks"), F.count("*").alias("lines")).where("lines > 1").drop("lines"))
        placed = first.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("lid"), F.col("chunks")).cast("int"))
        # the lines themselves come from the one document that holds each, by its line number
        wanted = materialise(placed.groupBy("at.doc_id", "at.tid").agg(F.collect_list(F.struct(F.col("at.line").alias("line"), F.col("lid").alias("sid"), "block", "chunk")).alias("want")))
        texts = bloom.filtered(docs, "doc_id", bloom.build(wanted.select("doc_id"))).join(wanted, ["doc_id", "tid"])
        sets = materialise(texts.select("text", "want").mapInArrow(trimmed(_wanted_lines), "sid bigint, block bigint, chunk int, n bigint, set binary"))
        near = verified_links(sets, chunks.where("chunks > 1"), num, den, shingles_of, block_shingles)
        found = connected_components(near).select(F.col("node").alias("lid"), "label")
        rooted = materialise(first.join(found, "lid", "left").select("lid", "at", F.coalesce("label", "lid").alias("label")))
        stays = rooted.groupBy("label").agg(F.min("at").alias("stays"))
        known = rooted.join(stays, "label").select("lid", "stays")
        return materialise(some.join(known, "lid").where("doc_id <> stays.doc_id or line <> stays.line").select("doc_id", "tid", "line").distinct(), outer=True)


def line_winners(df: DataFrame, num: int = 80, den: int = 100, block_shingles: int = 1_000_000) -> DataFrame:
    """(doc_id, line) of the one line that stays of each component, over ``df`` (doc_id, text)."""
    return all_lines(df).select("doc_id", "tid", "line").distinct().join(lost_lines(df, num, den, block_shingles), ["doc_id", "tid", "line"], "left_anti").select("doc_id", "line").distinct()


_BLANK = " \t\n\x0b\x0c\r"


def _counted(text: str | None) -> int:
    """Lines with a word."""
    return sum(1 for x in text.split("\n") if x.strip(_BLANK)) if text else 0


def _unlike(names: list[str], added: list[str], bits: np.ndarray):
    """Rows whose document loses no line, by the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            maybe = bloom.contains(bits, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
            part = batch.filter(pa.array(~maybe))
            n = pa.array([_counted(t) for t in part.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), n, n], [*names, *added])

    return run


def _without_lost(names: list[str], lost: str, added: list[str]):
    """Rows without the lines that ``lost`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, had, kept = [], [], []
            for t, gone in zip(batch.column("text").to_pylist(), batch.column(lost).to_pylist(), strict=True):
                had.append(_counted(t))
                kept.append(had[-1] - len(gone or ()))
                out = set(gone or ())
                new.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in out) if out else t)
            cols = [batch.column(c) if c != "text" else pa.array(new, pa.string()) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(had, pa.int64()), pa.array(kept, pa.int64())], [*names, *added])

    return run


def dedup_lines(df: DataFrame, keep: list[str], num: int = 80, den: int = 100) -> DataFrame:
    """``keep`` columns (doc_id and text among them) with the text's repeated lines gone; n_lines and n_kept_lines, of lines with a word."""
    own, tid, lost = (fresh(df.columns, x) for x in ("_id", "_tid", "_lost"))
    with scope():
        gone = lost_lines(df, num, den).groupBy("doc_id", "tid").agg(F.collect_list("line").alias(lost))
        changed = materialise(gone.withColumnsRenamed({"doc_id": own, "tid": tid}), outer=True)
    added = [fresh(keep, "n_lines"), fresh(keep, "n_kept_lines")]
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{c}` bigint" for c in added)])
    bits = bloom.build(changed.select(own))
    # documents that lose no line keep their text and needn't meet the others' lines
    same = df.select(*keep).mapInArrow(trimmed(_unlike(keep, added, bits)), schema)
    met = bloom.filtered(df.select(*keep), "doc_id", bits).join(changed, (F.col("doc_id") == F.col(own)) & (F.xxhash64("text") == F.col(tid)), "left")
    return same.unionByName(met.select(*keep, lost).mapInArrow(trimmed(_without_lost(keep, lost, added)), schema))
