import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import fingerprints, html_extract, licenses, line_dedup, mixing, packing, pii, quality_model, quality_rules, shingles, signature_tree
from matchloom.llm.components import connected_components
from matchloom.llm.jaccard_join import _cells, bucket_keys, count_sketches, similarity_components, sketch_distance

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "Some words here for nobody.", "en", "s", 5), (3, " \t\n ", "en", "s", 4), (4, "one", "en", "s", 3), (5, "One fine line here.\nAnother fine line here.", "en", "s", 9), (5, "One fine line here.\nAnother fine line here.", "en", "s", 9), (6, "x" * 60000 + " " + "long word text. " * 4000, "en", "t", 9)]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    texts = []
    for i in range(n):
        if i % 3 and texts:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 8, 30, 90, 200]))))
    return texts


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows, k, num, den):
    sets = {i: set(zip(*[words_of(t)[j:] for j in range(k)])) if len(words_of(t)) >= k else ({tuple(words_of(t))} if words_of(t) else set()) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,num,block", [(3, 90, 2_000_000), (5, 80, 2_000_000), (3, 80, 300)])
def test_jaccard_join_equals_brute_force(spark, k, num, block):
    rows = list(enumerate(corpus()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similarity_components(df, k, num, 100, block_shingles=block).collect()}
    assert got == brute_components(rows, k, num, 100)


def test_jaccard_join_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similarity_components(docs(spark, ODD), 5, 80, 100).collect()), key=str)
    assert len(got) == len(ODD) and (None, 1, None) in got and (1, 0, 1) in got and got.count((5, 4, 5)) == 2
    assert similarity_components(docs(spark, []), 5, 80, 100).count() == 0


def test_bucket_keys_meet_every_link():
    rng = np.random.default_rng(0)
    for num in (80, 90):
        for _ in range(300):
            n = int(rng.integers(1, 200))
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            change = int(rng.integers(0, max(1, n // 4) + 1))
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 2**63, int(rng.integers(0, change + 1)), dtype=np.uint64)]))
            if not len(b):
                continue
            flat, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            if signature_tree.linked(a, b, num, 100):
                keys, rows = bucket_keys(flat, at, num, 100)
                assert set(keys[rows == 0]) & set(keys[rows == 1])
                cells = _cells(count_sketches(flat, at))
                assert sketch_distance(cells[:1], cells[1:])[0] <= len(np.setxor1d(a, b))


def test_signature_tree_links_keep_components():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[rng.integers(0, 4) :], rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64)])) for b in base for _ in range(9)]
    want = brute_sets(sets, 80)
    links = signature_tree.tree_links(sets, np.arange(len(sets)), 80, 100)
    assert all(signature_tree.linked(sets[a], sets[b], 80, 100) for a, b in links)
    assert grouped(len(sets), links) == want


def brute_sets(sets, num):
    return grouped(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if signature_tree.linked(sets[i], sets[j], num, 100)])


def grouped(n, links):
    root = list(range(n))
    for a, b in links:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (1, 2), (5, 5), (7, 3)], "a long, b long")
    assert dict(map(tuple, connected_components(links).collect())) == {9: 3, 8: 3, 7: 3, 3: 3, 1: 1, 2: 1, 5: 5}
    assert connected_components(links.limit(0)).count() == 0


def test_words_match_the_pattern():
    texts = ["A b\tC", "", None, "\x0bé x", "a b c", "  lead trail  "]
    raw, at = shingles.utf8(pa.array(texts))
    words, starts = shingles.word_hashes(raw, at)
    assert np.diff(starts).tolist() == [len(words_of(t)) for t in texts]
    assert words[0] == shingles.word_hashes(*shingles.utf8(pa.array(["a"])))[0][0]


def plain_features(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    spots = collections.defaultdict(list)
    for i in range(len(w) - 4):
        spots[tuple(w[i : i + 5])].append(i)
    covered = {i + j for at in spots.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_base(spark):
    rows = [*ODD[:-1], (8, "a b c d e f a b c d e f g\nq\nq\n \nq", "en", "s", 1), (9, "the cat " * 40, "en", "s", 1), (10, "É# b\x0bc $5", "en", "s", 1)]
    out = quality_rules.apply_quality_rules(docs(spark, rows), ["doc_id", "text"]).collect()
    assert len(out) == len(rows)
    for r in out:
        n, *rest = plain_features(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 10 or 100 * rest[-1] > 20 * n) and not (r.base_failed and r.kept)
    assert quality_rules.apply_quality_rules(docs(spark, []), ["doc_id"]).count() == 0


def test_em_recovers_accuracies():
    rng = random.Random(4)
    true_good, true_bad = [0.97, 0.95, 0.9, 0.98], [0.7, 0.8, 0.6, 0.75]
    counts = collections.Counter()
    for _ in range(20000):
        good = rng.random() < 0.8
        counts[tuple((1 if rng.random() < g else -1) if good else (-1 if rng.random() < b else 1) for g, b in zip(true_good, true_bad))] += 1
    prior, on_good, on_bad = quality_rules.estimate(sorted(counts.items()))
    assert abs(prior - 0.8) < 0.03 and all(abs(a - b) < 0.05 for a, b in zip(on_good, true_good)) and all(abs(a - b) < 0.1 for a, b in zip(on_bad, true_bad))


def test_fingerprints(spark):
    rows = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(corpus(20))] + [(50, "p one a\np two b\np three c", "en", "s", 1), (51, "p three c\np one a\np two b", "en", "s", 1), *ODD[:6]]
    out = fingerprints.edited_fingerprints(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[50].fingerprint == by[51].fingerprint and by[1].fingerprint == by[2].fingerprint
    distinct = sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is None, -(x[0] or 0)))
    for i, (d, t) in enumerate(distinct):
        following = distinct[(i + 1) % len(distinct)][1]
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k] if k else t
        assert by[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by[d].n_chars == len(t)
        assert 0 <= by[d].near_edited <= 1 and 0 <= by[d].near_next <= 1
    assert fingerprints.edited_fingerprints(docs(spark, [])).count() == 0
    lanes = lambda text: fingerprints.fingerprint_lanes(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t")
    a, b = lanes("x y z\nu v w").withColumnsRenamed({"eq": "e1", "signs": "s1"}), lanes("u v w")
    minus = a.join(b, "k").select(*[c.alias(n) for c, n in zip(fingerprints.combine(F.col("e1"), F.col("s1"), F.col("eq"), F.col("signs"), insert=False), ("eq", "signs"))])
    assert minus.first() == lanes("x y z").select("eq", "signs").first()


def test_paragraphs_that_an_edit_keeps_are_read_once(spark, monkeypatch):
    """The parts' lanes add up to those of the whole texts, and no part holds what another does."""
    seen = []
    read = fingerprints.sign_lanes
    monkeypatch.setattr(fingerprints, "sign_lanes", lambda df, keys, text: seen.append(df.agg(F.sum(F.length(text))).first()[0]) or read(df, keys, text))
    text = "\n".join(f"line {i} of words that stay" for i in range(30))
    out = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame([(2, text), (1, "b c d\n" * 200)], "doc_id long, text string")).collect()}
    n = len(text)
    edited = text[: n - n // 3] + ("b c d\n" * 200)[: n // 3]
    whole = fingerprints.fingerprint_lanes(spark.createDataFrame([(1, text), (2, edited)], "k int, t string"), ["k"], "t").select("k", fingerprints.fingerprint_text("eq", "signs").alias("f"))
    assert {r.k: r.f for r in whole.collect()} == {1: out[2].fingerprint, 2: out[2].edited_fingerprint}
    assert seen[0] < 1.5 * (n + 1200)


def test_likeness_lanes_hold_many_repeats(spark):
    df = docs(spark, [(i, "again " * n, "en", "s", 0) for i, n in ((1, 65538), (2, 70002), (3, 0))])
    r = {x.doc_id: x for x in fingerprints.fingerprint_lanes(df, ["doc_id"], "text").select("doc_id", "signs").collect()}
    assert {abs(x) for x in r[1].signs} == {65536} and {abs(x) for x in r[2].signs} == {70000}
    pair = spark.createDataFrame([(r[a].signs, r[b].signs) for a, b in ((1, 3), (1, 2))], "a array<int>, b array<int>")
    empty, close = [x[0] for x in pair.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()]
    assert empty == 0 and abs(close - (1 - 4464**2 / (65536**2 + 70000**2))) < 1e-12


def test_temperature_weights():
    tokens = {"hot": 1000.0, "mid": 100.0, "low": 10.0}
    a, w = mixing.temperature_weights(tokens, repetition_limit=2.0)
    ratio = {s: w[s] / (t / 1110) for s, t in tokens.items()}
    assert max(ratio.values()) / min(ratio.values()) == pytest.approx(2.0) and 0 < a < 1 and sum(w.values()) == pytest.approx(1)
    _, w = mixing.temperature_weights(tokens, 1e9, target_entropy=0.9)
    assert -sum(x * np.log(x) for x in w.values()) == pytest.approx(0.9)


def test_mixing_realises_weights(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 40), "en", s, 1) for i, s in enumerate(["hot"] * 600 + ["a"] * 150 + ["b"] * 60)]
    out = mixing.mix_sources(docs(spark, rows), ["doc_id", "text"]).collect()
    n = lambda r: max(1, len(r.text.split()))
    got, have = collections.Counter(), collections.Counter()
    for r in out:
        got[r.mix_source] += n(r)
    for _, t, _, s, _ in rows:
        have[s] += max(1, len(t.split()))
    _, w = mixing.temperature_weights(dict(have))
    assert {r.doc_id for r in out} == set(range(len(rows)))
    assert all(abs(got[s] / sum(got.values()) - w[s]) < 0.01 for s in w)
    assert max(collections.Counter(r.doc_id for r in out).values()) <= 2 and all(0 <= r.position < 1 for r in out)
    odd = mixing.mix_sources(docs(spark, ODD), ["doc_id", "text"]).collect()
    assert len(odd) >= len(ODD) and mixing.mix_sources(docs(spark, []), ["doc_id"]).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(5)
    sizes = [rng.randint(1, 60) for _ in range(300)]
    lanes, clusters = [rng.randint(0, 5) for _ in sizes], [rng.choice([-1, -1, 0, 1, 2]) for _ in sizes]
    bins, offsets, residual = packing.best_fit(sizes, lanes, clusters, 100)
    state: list[list] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b, (free, ls, cs) in enumerate(state) if free >= sizes[i] and lanes[i] not in ls and clusters[i] not in cs]
        if fits:
            assert state[bins[i]][0] == min(state[b][0] for b in fits) and bins[i] in fits
        else:
            assert bins[i] == len(state)
            state.append([100, set(), set()])
        b = state[bins[i]]
        assert offsets[i] == 100 - b[0]
        b[0] -= sizes[i]
        b[1].add(lanes[i])
        b[2] |= {clusters[i]} - {-1}
    assert residual == [b[0] for b in state]


def test_pack_is_whole(spark):
    rows = [(i, "w " * (i % 70), "en", f"s{i % 4}", 1) for i in range(300)] + ODD
    out = packing.pack(docs(spark, rows), capacity=50, shard_rows=64).collect()
    got = collections.Counter()
    for r in out:
        got[r.doc_id] += r.n_tokens
    want = collections.Counter()
    for d, t, *_ in rows:
        want[d] += len((t or "").split())
    assert got == want
    fill = collections.Counter()
    for r in out:
        fill[r.bin_id] += r.n_tokens
        assert (r.bin_id is None) == (r.n_tokens == 0)
    assert max(v for k, v in fill.items() if k is not None) <= 50
    assert packing.pack(docs(spark, [])).count() == 0


def plain_line_dedup(rows, num=80):
    normal = lambda x: " ".join(words_of(x)).encode()
    sh = lambda b: {b[i : i + 8] for i in range(len(b) - 7)} if len(b) >= 8 else {b}
    lines = [(d, i, sh(normal(x))) for d, t in rows for i, x in enumerate((t or "").split("\n")) if words_of(x)]
    root = list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            if 100 * len(lines[a][2] & lines[b][2]) >= num * len(lines[a][2] | lines[b][2]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    first = {}
    for i, (d, n, _) in enumerate(lines):
        first[root[i]] = min(first.get(root[i], (d, n)), (d, n))
    return set(first.values())


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "lambda"], k=rng.randint(1, 25))) for _ in range(40)]
    near = lambda x: x.replace("alpha", "alpho", 1) if rng.random() < 0.4 else x.upper() if rng.random() < 0.2 else x
    rows = [(i, "\n".join([near(rng.choice(pool)) for _ in range(rng.randint(0, 6))] + [""] * (i % 2))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in line_dedup.line_winners(df).collect()}
    want = plain_line_dedup(rows)
    assert len(got ^ want) <= 0.02 * len(want)
    out = {r.doc_id: r for r in line_dedup.dedup_lines(df, ["doc_id", "text"]).collect()}
    for d, t in rows:
        lines = t.split("\n")
        assert out[d].text == "\n".join(x for i, x in enumerate(lines) if not x or (d, i) in got)
        assert out[d].n_lines == sum(map(bool, lines)) and out[d].n_kept_lines == sum((d, i) in got for i in range(len(lines)))


def test_line_dedup_odd_rows(spark):
    out = line_dedup.dedup_lines(docs(spark, ODD), ["doc_id", "text", "source"]).collect()
    assert len(out) == len(ODD) and [r.text for r in out if r.doc_id == 1] == [None]
    assert [r.text for r in out if r.doc_id is None] == ["Some words here for nobody."]
    assert line_dedup.dedup_lines(docs(spark, []), ["doc_id", "text"]).count() == 0


def test_html(spark):
    w = html_extract.trained_weights()
    page = '<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=1>Home</a></ul></nav><div class="cookie-notice">We use cookies here</div><article><h1>A  title</h1><p>First &amp; <b>bold</b>\n text<script>var x="</p>";</script><p>Second.</p></article><section id="comments"><p>nice one, really nice</p></section><aside>more</aside><form>f</form><footer>legal</footer>'
    assert html_extract.main_text(page, w) == "A title\nFirst & bold text\nSecond."
    for seed in (77,):
        pages = html_extract.labelled_pages(60, seed)
        hits = sum(html_extract.main_text(p, w) == t for p, t in pages)
        assert hits >= 54
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p>x &lt; y")], "page_id long, url string, html string")
    out = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_main_text(df, ["page_id", "url"]).collect()}
    assert out[2] == out[3] == ("", 0) and out[None] == ("x < y", 5)
    scores = [random.Random(i).uniform(-1, 1) for i in range(30)]
    a, b = html_extract.best_run(scores)
    assert sum(scores[a:b]) == pytest.approx(max(sum(scores[i:j]) for i in range(30) for j in range(i, 31)))


def test_html_wrappers_with_marks_stay():
    w = html_extract.trained_weights()
    body = "<h1>A title</h1>" + "<p>some main words of the page follow here</p>" * 5
    text = "\n".join(["A title", *["some main words of the page follow here"] * 5])
    side, notice = '<div class="sidebar"><p>tiny side words</p></div>', f'<div class="cookie-notice"><p>{"we use cookies " * 40}</p></div>'
    readers = "".join(f'<article class="comment"><p>{"a reader says this and that " * 20}{i}</p></article>' for i in range(9))
    for page in (
        f'<div class="content-sidebar-wrap"><article>{body}</article>{side}</div>',
        f'<div id="page" class="page has-sidebar"><div>{body}</div>{side}</div><p>Legal</p>',
        f'<form id="aspnetForm"><nav>x</nav><div class="search">find it</div><div>{body.replace("h1", "h2")}</div></form>',
        f'<main><div class="widget form">{body}</div>{side}</main>',
        f'<div class="related"><article>teaser words</article></div><div class="x-widget"><form><article>{body}</article></form></div>',
        f'<article>{body}</article><section id="comments">{readers}</section>',
        f"{notice}<div>{body}</div>",
    ):
        assert html_extract.main_text(f"<html><body>{page}</body></html>", w) == text, page


def test_licences(spark):
    held = licenses.varied_paragraphs(800, 1234)
    model = licenses.train_model()
    raw, at = shingles.utf8(pa.array([t for t, _ in held]))
    found = licenses.scan(raw, at, model)
    right = sum(({f for f, _, _ in x} == ({y} if y < len(licenses.FAMILIES) else set())) for x, (_, y) in zip(found, held))
    assert right / len(held) > 0.95
    df = docs(spark, [*ODD, (9, "Hello there.\nReleased under the MIT License.\nMit und die Lizenz.", "en", "s", 1)])
    out = {r.doc_id: r for r in licenses.scan_licences(df, ["doc_id"]).collect()}
    assert out[9].families == "mit" and out[9].findings.startswith("mit:1:") and out[1].n_notices == 0
    assert licenses.scan_licences(docs(spark, []), ["doc_id"]).count() == 0


def test_licences_two_notices_and_long_lines():
    model = licenses.train_model()
    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    t = licenses.TEMPLATES
    texts = {
        "Licensed under the MIT License or the Apache License, Version 2.0": {"mit", "apache-2.0"},
        f"{filler(900)} {t['gpl'][1]} {filler(700)} {t['mit'][1]} {filler(400)}": {"gpl", "mit"},
        f"{filler(3)}\n{t['bsd'][0]} and {t['mpl-2.0'][0]}": {"bsd", "mpl-2.0"},
        f"{filler(5000)}": set(),
        **{x: {f} for f, xs in t.items() for x in xs},
    }
    raw, at = shingles.utf8(pa.array(list(texts)))
    for (text, want), found in zip(texts.items(), licenses.scan(raw, at, model)):
        assert {licenses.FAMILIES[f] for f, _, _ in found} == want, (text[:80], found)


def test_personal_data_patterns():
    text = "a@b.com 300.1.2.3 or 10.0.0.1, 4111 1111 1111 1111 or +1 (212) 555-0100"
    got = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.pattern_spans(text)]
    assert got == [("email", "a@b.com"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0100")]


@pytest.fixture(scope="module")
def tagger():
    return pii.train_tagger()


def test_tagger_held_out(tagger):
    text, tags = pii.labelled_text(np.random.default_rng(99), 30000)
    gold, i = set(), 0
    while i < len(tags):
        if tags[i] % 2:
            j = i + 1
            while j < len(tags) and tags[j] == tags[i] + 1:
                j += 1
            gold.add((i, (tags[i] - 1) // 2, j))
            i = j
        else:
            i += 1
    found = set(pii.tag_spans([text], tagger)[0])
    assert len(found & gold) > 0.85 * len(gold)


def test_bound_equals_decoding_everything(tagger, monkeypatch):
    texts = [pii.labelled_text(np.random.default_rng(s), n)[0] for s, n in ((1, 3000), (2, 700), (3, 30))] + ["plain words only " * 60]
    fast = pii.tag_spans(texts, tagger)
    monkeypatch.setattr(np, "flatnonzero", lambda x: np.arange(len(x)))
    assert pii.tag_spans(texts, tagger) == fast


def test_personal_data_rows(spark, tagger):
    out = {r.doc_id: r for r in pii.find_personal_data(docs(spark, [*ODD, (9, "mail a@b.com or 10.0.0.1", "en", "s", 1)]), ["doc_id"], tagger).collect()}
    assert out[9].spans == "email:5:12,ip:16:24" and out[9].base_sha256 == hashlib.sha256(b"email:5:12,ip:16:24").hexdigest()
    assert out[1].spans == "" and out[1].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_quality_model(spark):
    rng = random.Random(3)
    clean = lambda: " ".join(" ".join(rng.choices("the of and in a to house garden water people morning evening city river".split(), k=rng.randint(6, 14))).capitalize() + "." for _ in range(8))
    junk = lambda: " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in clean().split())
    rows = [(i, junk() if i % 6 == 0 else clean(), "en", "s", 1) for i in range(10, 310)]
    out = {r.doc_id: r for r in quality_model.score_quality(docs(spark, rows + ODD[:4]), ["doc_id"]).collect()}
    right = sum(out[i].accepted == (i % 6 != 0) for i, *_ in rows)
    assert right > 0.97 * len(rows) and not out[1].accepted and out[2].quality == 0
    assert quality_model.score_quality(docs(spark, []), ["doc_id"]).count() == 0


def test_pipeline_odd_rows(spark):
    import corpus_pipeline

    rng = random.Random(6)
    clean = lambda: "\n".join(" ".join(rng.choices([f"word{i}" for i in range(300)], k=30)).capitalize() + "." for _ in range(4))
    texts = [clean() for _ in range(30)]
    rows = [(100 + i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(200, texts[0], "en", "s0", 1), *ODD]
    df = docs(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        before = df
        df = stage(spark, df, "")
        if name != "packing":
            assert df.columns == before.columns
    kept = {r.doc_id for r in df.collect()}
    assert set(range(100, 130)) <= kept and 200 not in kept and 1 not in kept
    empty = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0


def test_filter_stays_small_on_the_driver_and_loses_no_id(spark):
    from matchloom.llm import bloom

    bits = bloom.build(spark.range(5_000_000).select("id"))
    assert len(bits) <= 8 << 20 and bloom.filtered(spark.range(0, 5_000_000, 7), "id", bits).count() == len(range(0, 5_000_000, 7))
