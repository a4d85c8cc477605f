"""Phrase collocations by language: count-min sketches, exact counts of what survives them, scores, subsumption.

A text is cut at ``[.,;:!?]`` and line ends into pieces, a piece at spaces and tabs into words; A-Z count as a-z.
First pass: each task counts its 1- to 3-grams by language in a count-min sketch of two rows of one-byte cells that stop at 255; sketches are
added cell by cell, and one bit a cell, count >= ``least``, is sent to all tasks. A sketch never counts too little, so every
n-gram with ``least`` occurrences has both bits. Second pass: n-grams with both bits are counted exactly, by their words. A
part of a frequent phrase is at least as frequent, so all counts that scores need are among these.

The sketch has a cell a character of the corpus, at most ``most_cells``: with more, more n-grams pass into the exact count, and the
result stays the same. Words and pairs have a sketch together; a triple enters its sketch only if the bits of its words and
pairs are set, which keeps that sketch light.

Cutting a phrase after its first k words gives l (occurrences of the first part), r (of the rest) and floor(1000000 a a / (l r)); the
lowest cut counts, ties to the smallest k. All products are decimals of 38 digits: exact up to 10^16 occurrences. A phrase goes if a phrase one word longer that
holds it has half its occurrences or more; longer ones that hold it have no more than that one.

Edge cases: a null text has no words; a null language is ``und``; repeated rows and ids count each; ties in score go to the larger a, then
to the phrase's bytes; extra columns are ignored; an empty table gives an empty result. A text of any length is read whole, by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shingles import U, mix
from .storage import materialise
from .workers import trimmed

LONGEST = 3
CHUNK = 1 << 19
#: A task's words are numbered; a key has 21 bits a word. Numbers start anew beyond 2^20 words.
WORD_BITS, MOST_WORDS = 21, 1 << 20
#: Longer texts are read in stretches of so many words, each with the words that its last phrases need.
STRETCH = 1 << 19
SKETCH_BLOCK = 1 << 18
#: Bytes of text that a task counts before its sketch or its counts meet those of others.
TASK_BYTES = 1 << 29
#: Counts that a task gathers before it adds up equal n-grams, and different n-grams that it holds.
MERGE, MOST_HELD = 1 << 21, 4 << 20
MOST_CELLS = 1 << 25
FULL = 255
_MASK = U((1 << WORD_BITS) - 1)
_ENDS = bytes.maketrans(b"\n\x0b\x0c\r,;:!?\t", b"......... ")
_SEED = [U(0x8F1BBCDCBFA53E0B), U(0x6A09E667F3BCC909), U(0xBB67AE8584CAA73B), U(0x3C6EF372FE94F82B)]

#: Two rows of packed bits for each length of n-grams that has a sketch.
Bits = dict[int, list[np.ndarray]]


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words; ``.`` stands between pieces."""
    return text.lower().translate(_ENDS).replace(b".", b" . ").split()


def word_hashes(names: list[bytes]) -> np.ndarray:
    """64 bits of each (not empty) word, the same in every task."""
    blob = np.frombuffer(b"".join(names), np.uint8).astype(np.uint64)
    length = np.array([len(x) for x in names], np.int64)
    starts = np.cumsum(length) - length
    place = np.arange(len(blob), dtype=np.int64) - np.repeat(starts, length)
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(mix(blob + U(257) * (place.astype(np.uint64) + U(1))), starts) + length.astype(np.uint64))


class Words(dict):
    """Numbers of a task's words, from 1 on; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})
        self.names: list[bytes] = [b"."]
        self._hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def hash_of(self, keys: np.ndarray, n: int, seed: np.uint64) -> np.ndarray:
        """64 bits of each n-gram of a language."""
        if len(self._hashes) < len(self.names):
            self._hashes = np.concatenate([self._hashes, word_hashes(self.names[len(self._hashes) :])])
        with np.errstate(over="ignore"):
            h = np.full(len(keys), seed + _SEED[n], np.uint64)
            for i in range(n):
                h = mix(h * U(0x9E3779B97F4A7C55) + self._hashes[(keys >> U(WORD_BITS * (n - 1 - i))) & _MASK])
        return h


#: A language's numbered words, and the number of places at which its n-grams may start.
Chunk = tuple[str, np.ndarray, int]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[Chunk], bool]]:
    """Words of (lang, text as bytes) by language, some CHUNK at a time; the flag says that the numbers are of no use after it."""
    words, held, size = Words(), {}, 0

    def flush() -> list[Chunk]:
        return [(lang, np.array(ids, np.int64), len(ids)) for lang, ids in held.items()]

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = tokens(text.as_py())
            if len(words) + min(len(found), STRETCH) > MOST_WORDS or len(found) > STRETCH:
                yield words, flush(), True
                words, held, size = Words(), {}, 0
            if len(found) > STRETCH:
                for at in range(0, len(found), STRETCH):
                    ids = np.array([words[w] for w in found[at : at + STRETCH + LONGEST - 1]], np.int64)
                    yield words, [(lang, ids, min(STRETCH, len(ids)))], True
                    words = Words()
                continue
            ids = held.setdefault(lang, [])
            ids.extend(map(words.__getitem__, found))
            ids.append(0)
            size += len(found) + 1
            if size >= CHUNK:
                yield words, flush(), False
                held, size = {}, 0
    yield words, flush(), True


def counted(ids: np.ndarray, starts: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the n-grams that lie within pieces, and their occurrences."""
    places = min(starts, len(ids) - n + 1)
    if places <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, ok = np.zeros(places, np.uint64), np.ones(places, bool)
    for i in range(n):
        x = ids[i : i + places]
        key = (key << U(WORD_BITS)) | x.astype(np.uint64)
        ok &= x > 0
    return np.unique(key[ok], return_counts=True)


def _cells(h: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """A cell in either row: of the low and of the high bits."""
    return (h & U(cells - 1)).astype(np.int64), (h >> U(65 - int(cells).bit_length())).astype(np.int64)


def add(row: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
    """Adds to cells that stop at FULL; a cell may come more than once."""
    if not len(at):
        return
    packed = np.sort((at << 8) | np.minimum(n, FULL))
    cell = packed >> 8
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    total = np.add.reduceat(packed & 255, first)
    row[cell[first]] = np.minimum(FULL, row[cell[first]] + total)


def passes(words: Words, bits: Bits, keys: np.ndarray, n: int, seed: np.uint64) -> np.ndarray:
    """Which n-grams have both bits set, and so have all their shorter parts, of the lengths that have bits."""
    ok = np.ones(len(keys), bool)
    for m in sorted(k for k in bits if k <= n):
        for i in range(n - m + 1):
            left = np.flatnonzero(ok)
            part = (keys[left] >> U(WORD_BITS * (n - m - i))) & U((1 << WORD_BITS * m) - 1)
            for row, at in zip(bits[m], _cells(words.hash_of(part, m, seed), 8 * len(bits[m][0])), strict=True):
                ok[left] &= (row[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return ok


def _seeds() -> dict[str, np.uint64]:
    class Seeds(dict):
        def __missing__(self, lang: str) -> np.uint64:
            self[lang] = word_hashes([b"\x00" + lang.encode("utf-8", "surrogatepass")])[0]
            return self[lang]

    return Seeds()


def _sketch(lengths: tuple[int, ...], cells: int, bits: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seeds, any_ = [np.zeros(cells, np.uint8) for _ in range(2)], _seeds(), False
        for words, found, _ in chunks(batches):
            for lang, ids, starts in found:
                for n in lengths:
                    keys, times = counted(ids, starts, n)
                    ok = passes(words, bits, keys, n, seeds[lang])
                    for row, at in zip(rows, _cells(words.hash_of(keys[ok], n, seeds[lang]), cells), strict=True):
                        add(row, at, times[ok])
                    any_ = True
        if any_:
            block = min(cells, SKETCH_BLOCK)
            for r, row in enumerate(rows):
                for b, part in enumerate(row.reshape(-1, block)):
                    if part.any():
                        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([b], pa.int32()), pa.array([pa.compress(part.tobytes(), "zstd", asbytes=True)], pa.binary())], ["row", "block", "cells"])

    return run


def _merge(cells: int, least: int):
    block = min(cells, SKETCH_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r, b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                part = np.frombuffer(pa.decompress(x.as_py(), block, "zstd", asbytes=True), np.uint8)
                if (r, b) not in total:
                    total[r, b] = np.zeros(block, np.uint8)
                np.minimum(total[r, b].astype(np.uint16) + part, FULL, out=total[r, b], casting="unsafe")
        for (r, b), x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([b], pa.int32()), pa.array([np.packbits(x >= least, bitorder="little").tobytes()], pa.binary())], ["row", "block", "cells"])

    return run


def _tasks(texts: DataFrame, size: int) -> DataFrame:
    """As many partitions as cores, or more where a task would read more than TASK_BYTES: what a task has counted comes out once."""
    return texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES))


def sketch_bits(texts: DataFrame, lengths: tuple[int, ...], cells: int, least: int, bits: Bits) -> list[np.ndarray]:
    """Two rows of bits: cells of the merged sketch that hold ``least`` (FULL at most) or more."""
    if not 0 < least <= FULL:
        raise ValueError(f"least must lie in 1..{FULL}")
    schema = "row int, block int, cells binary"
    own = texts.mapInArrow(trimmed(_sketch(lengths, cells, bits)), schema)
    merged = own.repartition("row", "block").mapInArrow(trimmed(_merge(cells, least)), schema)
    out = [np.zeros(cells // 8, np.uint8) for _ in range(2)]
    block = min(cells, SKETCH_BLOCK) // 8
    for r, b, x in merged.collect():  # a quarter of MOST_CELLS bytes at most
        out[r][b * block : (b + 1) * block] = np.frombuffer(x, np.uint8)
    return out


def _exact(bits: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, words_of = _seeds(), {}
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        size, merge_at = 0, MERGE

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            if len(parts) == 1:
                return parts[0]
            keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        def rows(words: Words) -> Iterator[pa.RecordBatch]:
            names = pa.array(words.names, pa.binary())
            for (lang, n), parts in held.items():
                keys, times = merged(parts)
                for at in range(0, len(keys), 1 << 18):
                    part = keys[at : at + (1 << 18)]
                    cols = [names.take(pa.array(((part >> U(WORD_BITS * (n - 1 - i))) & _MASK).astype(np.int64))) for i in range(n)]
                    phrase = pc.binary_join_element_wise(*cols, b" ") if n > 1 else cols[0]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), n, np.int32)), phrase.cast(pa.binary()), pa.array(times[at : at + (1 << 18)])], ["lang", "size", "phrase", "f"])

        for words, found, over in chunks(batches):
            for lang, ids, starts in found:
                words_of[lang] = words_of.get(lang, 0) + int((ids[:starts] > 0).sum())
                for n in range(1, LONGEST + 1):
                    keys, times = counted(ids, starts, n)
                    ok = passes(words, bits, keys, n, seeds[lang])
                    if ok.any():
                        held.setdefault((lang, n), []).append((keys[ok], times[ok]))
                        size += int(ok.sum())
            if size > merge_at:
                held = {k: [merged(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                merge_at = size + MERGE
            if over or size > MOST_HELD:
                yield from rows(words)
                held, size, merge_at = {}, 0, MERGE
        for lang, n in words_of.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([0], pa.int32()), pa.array([b""], pa.binary()), pa.array([n], pa.int64())], ["lang", "size", "phrase", "f"])

    return run


def frequent_ngrams(df: DataFrame, least: int = 10, most_cells: int = MOST_CELLS) -> DataFrame:
    """lang, size, phrase, f of every n-gram of 1 to 3 words that occurs ``least`` times or more; size 0 has a language's words.

    The result is a materialised table.
    """
    texts = df.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = min(most_cells, max(1 << 16, 1 << int(size).bit_length()))
    texts = _tasks(texts, size)
    both = sketch_bits(texts, (1, 2), cells, least, {})
    bits = {1: both, 2: both}
    bits[3] = sketch_bits(texts, (3,), cells, least, bits)
    found = texts.mapInArrow(trimmed(_exact(bits)), "lang string, size int, phrase binary, f bigint")
    exact = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("size") == 0) | (F.col("f") >= least))
    return materialise(exact.withColumn("phrase", F.col("phrase").cast("string")))


def _score(a: Column, x: Column, y: Column) -> Column:
    """floor(1000000 a a / (x y)), exact."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(x) * wide(y))


def collocations(df: DataFrame, least: int = 10, first: int = 2000, most_cells: int = MOST_CELLS) -> DataFrame:
    """The first phrases of each language in ``df`` (lang, text): lang, rank, phrase, a, l, r, n, score."""
    frequent = frequent_ngrams(df, least, most_cells)
    words = F.split("phrase", " ")
    phrases = frequent.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("w"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    halves = cut.withColumns({"x": F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), "y": F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    part = frequent.where(F.col("size").between(1, LONGEST - 1))
    known = lambda c, n: part.select("lang", F.col("phrase").alias(c), F.col("f").alias(n))
    scored = halves.join(known("x", "l"), ["lang", "x"]).join(known("y", "r"), ["lang", "y"]).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low"))
    inner = phrases.where("size > 2").withColumn("phrase", F.explode(F.array(F.array_join(F.expr("slice(w, 1, size - 1)"), " "), F.array_join(F.expr("slice(w, 2, size - 1)"), " "))))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    flat = left.select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the first of each of 64 shares of a language, then the first of these: no task sorts a whole language
    share = Window.partitionBy("lang", "share").orderBy(*order)
    some = flat.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= first)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    totals = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
