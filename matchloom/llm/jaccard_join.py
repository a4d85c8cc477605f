"""Exact n-gram Jaccard self-join of documents by signature trees.

1. Every text becomes its set of distinct word shingles; equal sets share one id.
2. A set can only link if few of its shingles are its own: with a Jaccard of t, at most n - ceil(t n) of n. The
   shingles below a hash limit (all of a small set, 2 (1 - t) of a large one) are counted over the corpus; a set with
   more shingles of its own among them than that links with nothing and goes no further. A shingle
   that many sets have costs two entries a batch.
3. Of the sets left, those that can link are brought together: a set is cut into as many buckets as a linked pair can
   have differing shingles, plus one, so such a pair has a bucket in common (sizes fall in classes
   1.5 apart; near a border a set is also cut as the next class is). Of sets with a bucket in common, those
   stay candidates whose sizes and count sketches allow a link; candidates that hang together form a block.
4. Each block is joined by dual traversal of a signature tree, pruned by greatest possible
   overlap, with exact verification. Blocks over ``block_shingles`` are cut into chunks: first
   each chunk by itself, then one set of each found component, then, exactly, whatever lies
   outside its block's largest component against all the block.
5. Components of the links come from :func:`connected_components`.

Edge cases: null or empty texts, and texts without words, have an empty set, link with nothing and
are their own component; a null id is carried, links with nothing and has a null component;
repeated rows each get a row; rows with one id and different texts are each linked by their own
text; ties (equal sets) are one set; extra columns are ignored; an empty table gives an empty result. Set ids are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import connected_components
from .shingles import U, mix, set_ids, shingle_sets, slices, utf8
from .signature_tree import linked, tree_links
from .storage import materialise, scope, shuffle_partitions
from .workers import trimmed

CHUNK_BYTES = 1 << 20
#: Bucket keys that a map task gathers before it sends them on.
HELD_KEYS = 400_000
#: Keys that one task of an exchange gathers, about.
TASK_KEYS = 1_000_000
CELLS = 32  # of four bits: two words
BLOB_COLUMNS = ["part", "keys", "ids", "sizes", "sketches"]
BLOB_SCHEMA = "part int, keys binary, ids binary, sizes binary, sketches binary"


def _classes(num: int, den: int, most: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sizes of the classes, the buckets that each class is cut into, and its spare buckets.

    A linked pair agrees in one bucket more than the spare ones. So a set with no more empty buckets than
    that needn't be found by them: one with a shingle is among those that agree.
    """
    first = [1]
    while first[-1] < most:
        first.append(max(first[-1] + 1, first[-1] * 3 // 2))
    last = np.array(first[1:], np.int64) - 1
    differ = 2 * last * (den - num) // (den + num)
    spare = np.where(differ < 30, 0, 3 + differ // 16)
    return np.array(first[:-1], np.int64), differ + 1 + spare, spare


def bucket_keys(flat: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all buckets of all sets, and the set that each is of."""
    first, buckets, spares = _classes(num, den)
    sizes = np.diff(at)
    own = np.searchsorted(first, sizes, "right") - 1
    keys, rows = [], []
    for step in (0, 1):
        which = np.flatnonzero((sizes > 0) & ((step == 0) | (sizes * den // num >= first[np.minimum(own + 1, len(first) - 1)])))
        if not len(which):
            continue
        cls = own[which] + step
        cut = buckets[cls]
        base = np.concatenate([[0], np.cumsum(cut)])
        reps = sizes[which]
        of = np.repeat(np.arange(len(which)), reps)
        within = np.arange(len(of)) - np.repeat(np.cumsum(reps) - reps, reps)
        h = flat[np.repeat(at[which], reps) + within]
        with np.errstate(over="ignore"):
            m = mix(h + U(0x2545F4914F6CDD1D))
            cell = base[of] + (((m >> U(32)) * cut[of].astype(U)) >> U(32)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            total = np.zeros(len(h) + 1, U)
            np.cumsum(mix(h ^ U(0xD6E8FEB86659FD93))[order], out=total[1:])
            edge = np.searchsorted(cell[order], np.arange(base[-1] + 1))
            sums = total[edge[1:]] - total[edge[:-1]]
            owner = np.repeat(np.arange(len(which)), cut)
            place = np.arange(base[-1]) - np.repeat(base[:-1], cut)
            keys.append(mix(sums + mix(cls[owner].astype(U) * U(0x100000001) + (place.astype(U) << U(20)))))
        # empty buckets of a set that has no more of them than the spare ones name nothing
        empty = edge[1:] == edge[:-1]
        count = np.bincount(owner[empty], minlength=len(which))
        named = ~(empty & (count <= spares[cls])[owner])
        keys[-1] = keys[-1][named]
        rows.append(which[owner][named])
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(rows)


def _sets_of(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = utf8(batch.column("text"))
    for i, j in slices(offsets, CHUNK_BYTES):
        flat, at = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
        yield i, j, flat, at


def sampled(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """The hash limit below which sets of n shingles name theirs; it falls with n."""
    share = np.minimum(1.0, 2 * (den - num) / den + 12 / np.maximum(n, 1))
    return np.where(share >= 1, U(2**64 - 1), (share * 2.0**63).astype(U) << U(1))


def own_bound(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many shingles of a set of n no partner needs to have."""
    return n - -(-num * n // den)


def _checked(flat: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles are named, and which of those all possible partners name too."""
    n = np.diff(at)
    return flat <= np.repeat(sampled(n, num, den), n), flat <= np.repeat(sampled(-(-n * den // num), num, den), n)


def _sizes(k: int, num: int, den: int):
    """Of each document: its set's id and size, and how many checked shingles others must have for it to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for _, _, flat, at in _sets_of(batch, k):
                n = np.diff(at)
                _, checked = _checked(flat, at, num, den)
                count = np.concatenate([[0], np.cumsum(checked)])
                got.append((set_ids(flat, at), n, np.maximum(0, count[at[1:]] - count[at[:-1]] - own_bound(n, num, den))))
            if got:
                ids, n, need = (np.concatenate(x) for x in zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids.view(np.int64)), pa.array(n), pa.array(need)], ["doc_id", "sid", "n_shingles", "need"])

    return run


COUNT_COLUMNS = ["part", "keys", "ids", "checked"]
COUNT_SCHEMA = "part int, keys binary, ids binary, checked binary"


def _shared(keys: np.ndarray, ids: np.ndarray, checked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, id) in order with ``checked``; whether their key has two ids or more, and is a key's first or second."""
    order = np.lexsort((ids, keys))
    keys, ids, checked = keys[order], ids[order], checked[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(keys)) if len(keys) else np.zeros(0, np.int64)
    seen = np.concatenate([[0], np.cumsum(checked)])
    checked = (seen[last] - seen[np.flatnonzero(new)]) > 0
    keys, ids = keys[new], ids[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    more = np.zeros(len(keys), bool)
    more[:-1] = ~first[1:]
    more |= ~first
    second = np.zeros(len(keys), bool)
    second[1:] = first[:-1] & ~first[1:]
    return keys, ids, checked, more, first | second


def _id_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(ids, return_counts=True)


def _count_blobs(k: int, num: int, den: int, parts: int):
    """Named shingles by part. Those that two sets of the batches at hand have are counted here, and only two of the sets sent on."""

    def blobs(got: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        keys, ids, checked, more, two = _shared(*(np.concatenate(x) for x in zip(*got, strict=True)))
        own, counts = _id_counts(ids[more & checked])
        send = ~more | two
        keys, ids, checked = keys[send], ids[send], (checked & ~more)[send]
        part = ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)  # keys are sorted, so parts are
        edge = np.searchsorted(part, np.arange(parts + 1))
        for q in np.flatnonzero(edge[1:] > edge[:-1]):
            cut = slice(edge[q], edge[q + 1])
            yield pa.RecordBatch.from_arrays([pa.array([int(q)], pa.int32()), *(pa.array([x[cut].tobytes()], pa.binary()) for x in (keys, ids, checked))], COUNT_COLUMNS)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array([int(U(own[0].view(U)) % U(parts))], pa.int32()), pa.array([b""], pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in (own, counts.astype(np.int64)))], COUNT_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            for _, _, flat, at in _sets_of(batch, k):
                named, checked = _checked(flat, at, num, den)
                got.append((flat[named], np.repeat(set_ids(flat, at).view(np.int64), np.diff(at))[named], checked[named]))
                held += len(got[-1][0])
                if held >= HELD_KEYS:
                    yield from blobs(got)
                    got, held = [], 0
        if held:
            yield from blobs(got)

    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, shared): how many of a set's checked shingles other sets have, in parts to be summed."""
    held: list[tuple[np.ndarray, ...]] = []

    def out(ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts.astype(np.int64))], ["sid", "shared"])

    for batch in batches:
        for x, y, z in zip(batch.column("keys"), batch.column("ids"), batch.column("checked"), strict=True):
            ids = np.frombuffer(y.as_py(), np.int64)
            if len(x.as_py()):
                held.append((np.frombuffer(x.as_py(), U), ids, np.frombuffer(z.as_py(), bool)))
            else:
                yield out(ids, np.frombuffer(z.as_py(), np.int64))
    if held:
        keys, ids, checked, more, _ = _shared(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield out(*_id_counts(ids[more & checked]))


def count_sketches(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each set, how many shingles fall in each of CELLS cells, modulo 16, in two 64-bit words.

    The (circular) distance of two sketches is at most the number of shingles by which the sets
    differ: a pair further apart than linked sets can be is none.
    """
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    cell = rows * CELLS + (mix(flat + U(0x8BB84B93962EACC9)) >> U(59)).astype(np.int64)
    counts = np.bincount(cell, minlength=CELLS * (len(at) - 1)).reshape(-1, CELLS).astype(U) & U(15)
    return (counts << (U(4) * (np.arange(CELLS, dtype=U) & U(15)))).reshape(-1, 2, 16).sum(2, dtype=U)


def _cells(sketches: np.ndarray) -> np.ndarray:
    return ((sketches[:, :, None] >> (U(4) * np.arange(16, dtype=U))) & U(15)).astype(np.uint8).reshape(-1, CELLS)


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of cells (rows x CELLS)."""
    gap = (a - b) & 15
    return np.minimum(gap, 16 - gap).sum(1, dtype=np.int64)


def _key_blobs(num: int, den: int, parts: int):
    """Of each batch and part: keys, and the id, size and sketch of the set that each is of."""

    def blobs(got: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        keys, ids, n, sketch = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((ids, keys))
        keys, ids, n, sketch = keys[order], ids[order], n[order], sketch[order]
        # equal sets are one
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids, n, sketch = keys[new], ids[new], n[new], sketch[new]
        part = ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)  # keys are sorted, so parts are
        edge = np.searchsorted(part, np.arange(parts + 1))
        for q in np.flatnonzero(edge[1:] > edge[:-1]):
            cut = slice(edge[q], edge[q + 1])
            yield pa.RecordBatch.from_arrays([pa.array([int(q)], pa.int32()), *(pa.array([x[cut].tobytes()], pa.binary()) for x in (keys, ids, n, sketch))], BLOB_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            starts = np.concatenate([[0], np.cumsum(n)])
            for i, j in slices(8 * starts, CHUNK_BYTES):
                flat, at = np.frombuffer(b"".join(batch.column("set").slice(i, j - i).to_pylist()), U), starts[i : j + 1] - starts[i]
                keys, rows = bucket_keys(flat, at, num, den)
                got.append((keys, batch.column("sid").to_numpy()[i:j][rows], n[i:j].astype(np.int32)[rows], count_sketches(flat, at)[rows]))
                held += len(keys)
                if held >= HELD_KEYS:
                    yield from blobs(got)
                    got, held = [], 0
        if held:
            yield from blobs(got)

    return run


def _near(vec: np.ndarray, n: np.ndarray, one: int, others: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which of ``others`` can link with ``one``, by sizes and sketches."""
    m = n[others]
    both = m + n[one]
    low, high = np.minimum(m, n[one]), np.maximum(m, n[one])
    apart = sketch_distance(vec[others], vec[one])
    return (den * low >= num * high) & (apart <= both - 2 * -(-num * both // (num + den)))


def _candidate_links(num: int, den: int):
    """Links (a, b) that join, within each key, all sets that can link by sizes and sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sid, n, sketch = [], [], [], []
        for batch in batches:
            for r in range(batch.num_rows):
                for to, c, kind in ((keys, "keys", U), (sid, "ids", np.int64), (n, "sizes", np.int32), (sketch, "sketches", U)):
                    to.append(np.frombuffer(batch.column(c)[r].as_py(), kind))
        if not keys:
            return
        key, ids = np.concatenate(keys), np.concatenate(sid)
        names, first, row = np.unique(ids, return_index=True, return_inverse=True)
        size, vectors = np.concatenate(n)[first].astype(np.int64), _cells(np.concatenate(sketch).reshape(-1, 2)[first])
        order = np.lexsort((row, key))
        key, row = key[order], row[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        key, row = key[new], row[new]
        edge = np.concatenate([np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), [len(key)]])
        width = np.diff(edge)
        two = edge[:-1][width == 2]
        pairs = np.unique(np.stack([row[two], row[two + 1]], 1), axis=0) if len(two) else np.zeros((0, 2), np.int64)
        found = []
        if len(pairs):
            a, b = pairs.T
            both, low, high = size[a] + size[b], np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            for i in range(0, len(a), 65536):
                apart = sketch_distance(vectors[a[i : i + 65536]], vectors[b[i : i + 65536]])
                t = both[i : i + 65536]
                ok = (den * low[i : i + 65536] >= num * high[i : i + 65536]) & (apart <= t - 2 * -(-num * t // (num + den)))
                found.append(pairs[i : i + 65536][ok])
        seen = set()
        for g in np.flatnonzero(width > 2):
            members = row[edge[g] : edge[g + 1]]
            mark = members.tobytes()
            if mark in seen:
                continue
            seen.add(mark)
            left = members
            while len(left) > 1:
                reached, left = [left[0]], left[1:]
                while reached and len(left):
                    u = reached.pop()
                    near = _near(vectors, size, u, left, num, den)
                    if near.any():
                        hit = left[near]
                        found.append(np.stack([np.full(len(hit), u), hit], 1))
                        reached += hit.tolist()
                        left = left[~near]
        if found:
            links = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(names[links[:, 0]]), pa.array(names[links[:, 1]])], ["a", "b"])

    return run


def _fetch(k: int):
    """(sid, n, set) of rows whose text has the set that ``sid`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column("sid").to_numpy(zero_copy_only=False)
            for i, j, flat, at in _sets_of(batch, k):
                ok = np.flatnonzero(set_ids(flat, at).view(np.int64) == want[i:j])
                ok = ok[np.unique(want[i:j][ok], return_index=True)[1]]
                blobs = [flat[at[r] : at[r + 1]].tobytes() for r in ok]
                yield pa.RecordBatch.from_arrays([batch.column("sid").take(pa.array(ok + i)), pa.array(np.diff(at)[ok]), pa.array(blobs, pa.binary())], ["sid", "n", "set"])

    return run


Decode = Callable[[bytes], np.ndarray]


def hashes_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, U)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str], decode: Decode) -> Iterator[dict[str, list]]:
    """Rows of one group after another, of batches sorted by ``names``."""
    held: dict[str, list] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) if c != "set" else batch.column(c) for c in batch.schema.names}
        edge = np.flatnonzero(np.any([cols[c][1:] != cols[c][:-1] for c in names], 0)) + 1
        for a, b in zip([0, *edge], [*edge, batch.num_rows], strict=True):
            key = tuple(int(cols[c][a]) for c in names)
            rows = {c: [decode(x.as_py()) for x in v.slice(a, b - a)] if c == "set" else v[a:b].tolist() for c, v in cols.items()}
            if held and tuple(held[c][0] for c in names) == key:
                for c in rows:
                    held[c] += rows[c]
            else:
                if held:
                    yield held
                held = rows
    if held:
        yield held


def _block_links(num: int, den: int, names: list[str], crossed: bool, decode: Decode):
    """Links in each group; crossed: only between rows of side 0 and of side 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, names, decode):
            once = list({(s, side): i for i, (s, side) in enumerate(zip(g["sid"], g.get("side", [0] * len(g["sid"])), strict=True))}.values())
            sid, sets = [g["sid"][i] for i in once], [g["set"][i] for i in once]
            label = np.array([g["label"][i] for i in once] if "label" in g else sid, np.int64)
            if len(sid) == 2 and not crossed:
                found = [(0, 1)] if label[0] != label[1] and linked(sets[0], sets[1], num, den) else []
            elif crossed:
                x, y = ([i for i, o in enumerate(once) if g["side"][o] == side] for side in (0, 1))
                found = tree_links([sets[i] for i in x], label[x], num, den, [sets[i] for i in y], label[y]) if x and y else []
                found = [(x[i], y[j]) for i, j in found]
            else:
                found = tree_links(sets, label, num, den) if len(sid) > 1 else []
            if found:
                a, b = zip(*((sid[i], sid[j]) for i, j in found), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _joined(rows: DataFrame, names: list[str], num: int, den: int, decode: Decode, crossed: bool = False) -> DataFrame:
    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(trimmed(_block_links(num, den, names, crossed, decode)), "a bigint, b bigint")


def similarity_components(df: DataFrame, k: int = 5, num: int = 80, den: int = 100, block_shingles: int = 2_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``df`` (doc_id, text).

    Two documents link when den * |intersection| >= num * |union| of their k-word shingle sets;
    component_id is the smallest doc_id reachable.
    """
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = docs.where("doc_id is not null")
    with scope():
        sized = materialise(docs.mapInArrow(trimmed(_sizes(k, num, den)), "doc_id bigint, sid bigint, n_shingles bigint, need bigint"))
        by_set = materialise(sized.where("doc_id is not null and n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("low"), F.first("n_shingles").alias("n"), F.first("need").alias("need")))
        tasks = lambda keys: max(shuffle_partitions(spark), -(-int(keys or 0) // TASK_KEYS))
        parts = tasks(by_set.agg(F.sum("n") * min(1.0, 2.2 * (den - num) / den)).first()[0])
        counts = named.mapInArrow(trimmed(_count_blobs(k, num, den, parts)), COUNT_SCHEMA).repartition(parts, "part").mapInArrow(trimmed(_count_shared), "sid bigint, shared bigint")
        shared = counts.groupBy("sid").agg(F.sum("shared").alias("shared"))
        left = materialise(by_set.join(shared, "sid", "left").where("need <= coalesce(shared, 0)").select(F.col("low").alias("doc_id"), "sid", "n"))
        near = bloom.filtered(named, "doc_id", bloom.build(left.select("doc_id")))
        sets = materialise(near.join(left, "doc_id").select("sid", "text").mapInArrow(trimmed(_fetch(k)), "sid bigint, n bigint, set binary"))
        parts = tasks(left.agg(F.sum("n") * ((den - num) / den + 0.2)).first()[0])
        candidates = sets.mapInArrow(trimmed(_key_blobs(num, den, parts)), BLOB_SCHEMA).repartition(parts, "part").mapInArrow(trimmed(_candidate_links(num, den)), "a bigint, b bigint")
        blocks = connected_components(candidates).select(F.col("node").alias("sid"), F.col("label").alias("block"))
        holders = left.join(blocks, "sid")
        chunks = materialise(holders.groupBy("block").agg(F.ceil(F.sum("n") / F.lit(block_shingles)).alias("chunks")))
        placed = holders.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int")).select("sid", "block", "chunk")
        links = verified_links(sets.join(placed, "sid"), chunks.where("chunks > 1"), num, den, hashes_of, block_shingles)
        ones = connected_components(links).select(F.col("node").alias("sid"), F.col("label").alias("root"))
        rooted = by_set.join(ones, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        roots = rooted.groupBy("root").agg(F.min("low").alias("component"))
        component = rooted.join(roots, "root").select("sid", "component")
        out = sized.join(component, "sid", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"))
        return materialise(out, outer=True)


def verified_links(sets: DataFrame, wide: DataFrame, num: int, den: int, decode: Decode, block_shingles: int) -> DataFrame:
    """Links of ``sets`` (sid, block, chunk, n, set) within each block, enough for their components.

    ``wide`` (block, chunks) are the blocks that were cut into chunks. For those the sets themselves are
    moved again only for one set of each found component, and for what is left after that.
    """
    links = materialise(_joined(sets.select("block", "chunk", "sid", "set"), ["block", "chunk"], num, den, decode))
    if wide.isEmpty():
        return links
    members = materialise(sets.join(wide, "block").select("sid", "block", "chunk", "chunks", "n"))

    def labelled(links: DataFrame) -> DataFrame:
        found = connected_components(links).select(F.col("node").alias("sid"), "label")
        return materialise(members.join(found, "sid", "left").withColumn("label", F.coalesce("label", "sid")))

    def roomed(rows: DataFrame, seed: int) -> DataFrame:
        rooms = rows.groupBy("block").agg(F.ceil(F.sum("n") / F.lit(block_shingles)).cast("int").alias("rooms"))
        return rows.join(rooms, "block").withColumn("room", F.pmod(F.xxhash64("sid", F.lit(seed)), F.col("rooms")).cast("int"))

    def with_sets(rows: DataFrame) -> DataFrame:
        return sets.select("sid", "set").join(materialise(rows), "sid")

    leaders = labelled(links).groupBy("block", "chunk", "label").agg(F.min_by(F.struct("sid", "n"), "sid").alias("x")).select("block", "label", "x.sid", "x.n")
    chosen = with_sets(roomed(leaders, 7).select("block", "room", "sid", "label"))
    links = materialise(links.unionByName(_joined(chosen, ["block", "room"], num, den, decode)))
    # exactly what is left: sets outside their block's largest component, against the whole block
    second = labelled(links)
    largest = second.groupBy("block", "label").count().groupBy("block").agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("labels"))
    rest = materialise(second.join(largest.where("labels > 1"), "block"))
    if rest.isEmpty():
        return links
    minor = roomed(rest.where("label <> main"), 11)
    left = minor.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1))).withColumn("side", F.lit(0))
    right = rest.join(minor.select("block", "rooms").distinct(), "block").withColumn("room", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1))).withColumn("side", F.lit(1))
    names = ["block", "room", "chunk", "side", "sid", "label"]
    crossed = with_sets(left.select(*names).unionByName(right.select(*names)))
    return materialise(links.unionByName(_joined(crossed, ["block", "room", "chunk"], num, den, decode, crossed=True)))
