"""Operators 11 to 13 against plain versions on small fixtures."""

import collections
import hashlib
import math
import os
import random
import re

import numpy as np
import pytest

from matchloom.llm import collocations, vector_codes, warc

LARGEST = (1 << 63) - 1


# --- 11: vector codes


def lloyd(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain Lloyd iteration in Python integers: codes and errors in the order of ids, and the codebooks."""
    good = [(i, label, e) for i, e, label in rows if e is not None and len(e) and len(e) % parts == 0 and all(x is not None and math.isfinite(x) for x in e)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    vectors = [[vector_codes.floor_of(float(x), scale) for x in e] for _, _, e in good]
    d = len(vectors[0]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for v in vectors]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))
    for _ in range(rounds):
        at = [[near(v[p], books[p])[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for j in range(len(books[p])):
                own = [v[p] for v, a in zip(cut, at) if a[p] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    last = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    total = collections.Counter()
    for (_, label, _), b in zip(good, last):
        total[label] += min(sum(x[0] for x in b), LARGEST)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{x[1]:02x}" for x in b), min(sum(x[0] for x in b), LARGEST), min(total[label], LARGEST), digest) for (i, label, _), b in zip(good, last)]


VECTORS = "vec_id long, embedding array<double>, label int, code string, part int"


def got_codes(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], VECTORS)
    return [tuple(r) for r in vector_codes.vector_codes(df, **how).collect()]


@pytest.mark.parametrize("entries,spread,size", [(256, 1.0, 400), (7, 0.004, 300), (256, 1e25, 40)])
def test_codes_equal_plain_lloyd(spark, entries, spread, size):
    rng = np.random.default_rng(entries)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) * spread], int(rng.integers(3)) or None) for i in rng.permutation(size)]
    # ties by the dozen, repeated rows and ids, null and odd vectors
    rows += [(i, rows[0][1], 1) for i in range(size, size + 60)] + [rows[3], rows[3], (5, [0.0] * 8, 2), (None, [0.25] * 8, 2), (None, None, 1), (900, [1.0] * 7 + [None], 1), (901, [float("nan")] * 8, 1), (902, [float("inf")] * 8, 1), (903, [], 1), (904, [1.0] * 12, 1), (905, [1.0] * 6, 1)]
    assert sorted(got_codes(spark, rows, entries=entries), key=str) == sorted(lloyd(rows, entries=entries), key=str)


def test_codes_of_nothing(spark):
    assert got_codes(spark, []) == [] and got_codes(spark, [(1, None, 1)]) == []


def test_bounds_hold_and_prune():
    """Bounds never lie on the wrong side, and most distances aren't taken."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-2000, 2000, (32, 6))
    x = (centres[rng.integers(32, size=3000)] + rng.integers(-60, 60, (3000, 6))).astype(np.int64)
    book = x[:32].copy()
    at, upper, lower = vector_codes.first_assign(x, vector_codes.Moves(book, None))
    took = 0
    for _ in range(5):
        last, book = book, np.array([x[at == j].sum(0) // (at == j).sum() if (at == j).any() else book[j] for j in range(32)])
        took = vector_codes.next_assign(x, at, upper, lower, vector_codes.Moves(book, last))
        exact = vector_codes.all_squares(x, book)
        assert (at == exact.argmin(1)).all()
        assert (upper.astype(float) ** 2 >= exact[np.arange(len(x)), at]).all() and (lower.astype(float) ** 2 <= exact).all()
    assert took < 0.1 * exact.size


# --- 12: WARC


def member(i, payload, kind="response", refers=None):
    return warc.gzipped(warc.record(kind, f"urn:page:{i}:x:1", "u", "d", hashlib.sha256(payload).hexdigest(), len(payload), payload, refers), 0)


def test_ranges_of_any_size_read_alike(spark, tmp_path):
    """Archives inside payloads, junk, cut-off members and empty ones: all ranges give what one reader from the start gives."""
    inner = b"".join(member(i, b"inner %d" % i) for i in range(300))
    data = member(1000, inner) + warc.EMPTY_MEMBER + member(1, b"a") + b"junk\x1f\x8b\x08junk" + member(2, inner)[:3000] + member(3, os.urandom(5000) + warc.MAGIC * 50) + warc.gzipped(b"no record") + member(4, b"")
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "b c.warc.gz").write_bytes(inner)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    plain = [(at, end - at if kind == "record" else None) for kind, at, end, _ in warc.scan_range(f"file:{tmp_path}/a.warc.gz", 0, len(data)) if kind != "empty"]
    assert len([p for p in plain if p[1]]) > 4
    for size in (1 << 30, 40_000, 7001, 1500):
        found = warc.read_warc(spark, str(tmp_path), size, payload=True)
        a = found.where("file like '%/a.warc.gz'").collect()
        assert sorted((r["offset"], r["length"]) for r in a) == plain
        assert {r["record_id"]: bytes(r["payload"]) for r in a if not r["damaged"]}["urn:page:1000:x:1"] == inner
        assert found.where("file like '%b c.warc.gz'").count() == 300
    assert sum(r["damaged"] for r in a) == 1


def test_pages_come_back(spark, tmp_path):
    long_, short = "x" * 150, "y" * 99
    rows = [(3, "http://a b\n", long_), (1, "u", long_), (1, "u", long_), (1, "v", long_), (2, None, long_), (None, "u", long_), (5, "u", short), (4, "u", short), (6, "u", None), (7, "u", ""), (8, "é", "é" * 50), (9, "é", "é" * 50), (10, "z", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], "page_id long, url string, html string, digest string, payload int")
    out = warc.archived_pages(df, f"file:{tmp_path}/out", range_bytes=700).collect()
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out)
    want, seen = collections.Counter(), set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (html or "").encode()
        again = len(b) >= 100 and b in seen
        seen.add(b)
        first = min(r[0] for r in rows if r[0] is not None and r[2] == html) if again else None
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first] += 1
    assert got == want and not any(r["damaged"] or r["digest_agrees"] is False for r in out)
    import gzip

    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "out").glob("part*"))
    assert text.count(b"WARC/1.1\r\n") == len(rows) and text.count(b"WARC-Target-URI: http://a%20b%0A\r\n") == 1
    ids = re.findall(rb"WARC-Record-ID: (<.*?>)", text)
    assert len(set(ids)) == len(ids) and set(re.findall(rb"WARC-Refers-To: (<.*?>)", text)) <= set(ids)
    assert warc.archived_pages(df.limit(0)).collect() == []


# --- 13: collocations


def plain_phrases(rows, least=10, first=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = [b for (g, q), b in f.items() if g == lang and len(q) > len(p) and b >= least and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= 50 * a for b in inside):
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:first]
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(ranked)


@pytest.mark.parametrize("cells,stretch,first", [(1 << 26, 1 << 19, 2000), (1 << 16, 50, 9)])
def test_phrases_equal_plain_counts(spark, monkeypatch, cells, stretch, first):
    rng = random.Random(7)
    words = [rng.choice("abcdeéß") + rng.choice(["", "x", "Y", "\xa0", "-"]) for _ in range(14)]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice([" "] * 8 + ["\t", ". ", ",", "\n", " ; "]) for _ in range(rng.choice([0, 1, 2, 40, 200])))) for _ in range(150)]
    rows += [("en", None), (None, "a a a a a a a a a a a a"), ("xx", "one two"), ("en", "Ab " * 500)] + [("en", "same words here again")] * 12
    monkeypatch.setattr(collocations, "STRETCH", stretch)
    monkeypatch.setattr(collocations, "CHUNK", 300)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, size int, phrase string")
    got = [tuple(r) for r in collocations.collocations(df, first=first, most_cells=cells).collect()]
    assert sorted(got) == plain_phrases(rows, first=first)
    assert collocations.collocations(df.limit(0)).collect() == []


def test_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(9 * 10**15, 9 * 10**15 + 1, 9 * 10**15 + 2)], "a long, x long, y long")
    from pyspark.sql import functions as F

    a, x, y = 9 * 10**15, 9 * 10**15 + 1, 9 * 10**15 + 2
    assert df.select(collocations._score(F.col("a"), F.col("x"), F.col("y"))).first()[0] == 1000000 * a * a // (x * y)


def test_sketch_never_counts_too_little():
    rng = np.random.default_rng(1)
    row, true = np.zeros(64, np.uint8), np.zeros(64, np.int64)
    for _ in range(20):
        at, n = rng.integers(0, 64, 500), rng.integers(1, 400, 500)
        collocations.add(row, at, n % 3)
        np.add.at(true, at, n % 3)
    assert (row == np.minimum(true, 255)).all()
