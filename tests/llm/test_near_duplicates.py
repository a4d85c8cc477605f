"""The near-duplicate stage where ids repeat."""

import pytest

import corpus_pipeline


def text(seed, n=40):
    return " ".join(f"w{(seed * 7919 + i * 31) % 997}x{seed}" for i in range(n))


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _own_id int")
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_unlike_texts_of_one_id_are_documents(spark):
    a, b, c, d = (text(i) for i in range(4))
    near = a + " tail"
    rows = [(5, a), (5, b), (5, b), (7, c), (9, near), (9, d), (None, a), (None, a), (3, None), (3, ""), (11, c), (2, d + " end")]
    got = kept(spark, rows)
    texts = [t for _, t in got]
    # one of each group of like texts stays, nothing else is lost, rows without an id all stay
    assert texts.count(b) == 1 and texts.count(c) == 1 and (7, c) in got and (2, d + " end") in got and (9, d) not in got
    assert sum(t in (a, near) and i is not None for i, t in got) == 1 and (5, a) in got
    assert sum(i is None for i, _ in got) == 2 and sum(i == 3 for i, _ in got) == 1


def test_ids_that_cannot_be_numbered_are_refused(spark):
    with pytest.raises(ValueError):
        kept(spark, [((1 << 63) - 1, text(1)), ((1 << 63) - 1, text(2))])
    assert len(kept(spark, [((1 << 63) - 1, text(1)), ((1 << 63) - 1, text(1)), (-(1 << 62), text(2))])) == 2
