"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shipping import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similarity_components

    return similarity_components(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_quality_rules

    out = apply_quality_rules(_table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licences

    return scan_licences(_table(spark, sf_dir, "documents"), ["doc_id"])


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edited_fingerprints

    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents"), ["doc_id"]).withColumnRenamed("mix_source", "source")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_personal_data

    return find_personal_data(_table(spark, sf_dir, "documents"), ["doc_id"])


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_model import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), ["doc_id"])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents"), ["doc_id", "text"])


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import vector_codes

    return vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archived_pages

    return archived_pages(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scans": op4_license_scans,
    "op5_fingerprints": op5_fingerprints,
    "op6_source_mixing": op6_source_mixing,
    "op7_personal_data": op7_personal_data,
    "op8_quality_model": op8_quality_model,
    "op9_line_dedup": op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_warc": op12_warc,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}



def llm_quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's contract fixes of its columns."""
    out = op3_quality_rules(spark, sf_dir)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def llm_fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5's contract fixes of its columns."""
    return op5_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def llm_source_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan by which op6 draws: exponent to a repetition limit of 2."""
    from .mixing import source_plan, source_tokens

    totals = source_tokens(_table(spark, sf_dir, "documents")).groupBy("source").agg(F.sum("n").alias("tokens"))
    rounded = [F.round(c, 6).alias(c) for c in ("share", "weight", "reps")]
    return source_plan(totals).select("source", "tokens", *rounded, F.col("whole").cast("int").alias("whole"))


def llm_base_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op7's fixed patterns."""
    return op7_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def llm_packing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: documents, pieces and tokens that op10 packs."""
    out = op10_best_fit_packing(spark, sf_dir)
    return out.groupBy("source").agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"), (F.max(F.col("bin_offset") + F.col("n_tokens")) <= 2048).alias("fits"))


QUERIES |= {f.__name__: f for f in (llm_quality_base, llm_fingerprint_edits, llm_source_weights, llm_base_patterns, llm_packing_totals)}

_SPACE = r"\x20\x09-\x0D"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _vector_codes_sql(rounds: int = 4) -> str:
    """Every distance of every round, and means as floors of exact sums."""
    steps = [
        "k as (select vec_id, label, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "x as materialized (select vec_id, label, p, d, v[p * (len(v) // 4) + d] as x from k, unnest([0, 1, 2, 3]) a(p), unnest(generate_series(1, len(v) // 4)) b(d))",
        "c0 as materialized (select p, e, d, x as y from x join (select vec_id, row_number() over (order by vec_id) - 1 as e from k) using (vec_id) where e < 256)",
    ]
    for r in range(rounds + 1):
        near = f"select vec_id, x.p as p, e, sum((x - y) * (x - y)) as q from x join c{r} c on c.p = x.p and c.d = x.d group by 1, 2, 3"
        steps.append(f"a{r} as materialized (select vec_id, p, e, q from ({near}) qualify row_number() over (partition by vec_id, p order by q, e) = 1)")
        if r < rounds:
            mean = f"select x.p as p, e, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m from x join a{r} a on a.vec_id = x.vec_id and a.p = x.p group by 1, 2, 3"
            steps.append(f"c{r + 1} as materialized (select c.p, c.e, c.d, coalesce(cast(m as bigint), y) as y from c{r} c left join ({mean}) u on u.p = c.p and u.e = c.e and u.d = c.d)")
    steps.append(f"h as (select sha256(string_agg(cast(y as varchar), ',' order by p, e, d)) as h from c{rounds})")
    steps.append(f"z as (select vec_id, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) as code, cast(sum(q) as bigint) as error from a{rounds} group by 1)")
    return "with " + ", ".join(steps) + " select z.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256 from z join k using (vec_id), h"


ORACLE_SQL: dict[str, str] = {
    # sets of three-word shingles, all pairs that share one, components by reachability
    "op2_ngram_jaccard": f"""with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^{_SPACE}]+') as w from documents),
 s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct([array_to_string(w[i:i + 2], ' ') for i in generate_series(1, len(w) - 2)]) end as s from w),
 e as (select doc_id, len(s) as n, unnest(s) as g from s),
 l as (select a.doc_id as x, b.doc_id as y from e a join e b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2 having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
 r as (select doc_id, doc_id as y from s union select r.doc_id, l.y from r join l on l.x = r.y)
 select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.y) as component_id from s join r on r.doc_id = s.doc_id group by s.doc_id, len(s.s)""",
    "llm_quality_base": f"""with w as (select doc_id, {_WORDS} as w, coalesce(text, '') as t, [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^{_SPACE}]')] as l from documents),
 win as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as g from w, unnest(generate_series(1, len(w) - 4)) u(i)), rep as (select doc_id, i from win qualify count(*) over (partition by doc_id, g) > 1),
 cov as (select doc_id, count(distinct i + k) as c from rep, unnest([0, 1, 2, 3, 4]) v(k) group by 1),
 b as (select w.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(c, 0) as n_repeat_words from w left join cov on cov.doc_id = w.doc_id)
 select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from b""",
    "llm_base_patterns": """with t as (select doc_id, coalesce(text, '') as t from documents),
 m as (select doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+') as e, regexp_extract_all(t, '[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)') as i,
  [regexp_replace(x, '[^0-9]', '', 'g') for x in regexp_extract_all(t, '[0-9](?:[\\x20-]?[0-9])+')] as c, [regexp_replace(x, '[^0-9]', '', 'g') for x in regexp_extract_all(t, '\\+[0-9][\\x20().0-9-]+[0-9]')] as p from t)
 select doc_id, cast(len(e) as bigint) as n_email, cast(len([x for x in i if list_max([coalesce(try_cast(y as ubigint), 999) for y in string_split(x, '.')]) <= 255]) as bigint) as n_ip,
  cast(len([x for x in c if length(x) between 14 and 19 and list_sum([cast(x[k] as int) * (1 + (length(x) - k) % 2) - case when cast(x[k] as int) * (1 + (length(x) - k) % 2) > 9 then 9 else 0 end for k in generate_series(1, length(x))]) % 10 = 0]) as bigint) as n_card,
  cast(len([x for x in p if length(x) between 10 and 15]) as bigint) as n_phone from m""",
    "llm_fingerprint_edits": """with o as (select doc_id, coalesce(text, '') as t, row_number() over (order by doc_id desc) as i, count(*) over () as c from documents),
 n as (select a.doc_id, a.t, b.t as nxt, length(a.t) // 3 as k from o a join o b on b.i = a.i % a.c + 1)
 select doc_id, cast(length(t) as bigint) as n_chars, sha256(substr(t, 1, length(t) - k) || substr(nxt, 1, k)) as edited_sha256 from n""",
    "llm_source_weights": f"""with t as (select coalesce(source, '') as source, cast(sum(greatest(1, len({_WORDS}))) as bigint) as tokens from documents group by 1),
 p as (select source, tokens, cast(tokens as double) / sum(tokens) over () as p from t), a as (select greatest(0, 1 - ln(2.0::double) / ln(max(p) / min(p))) as a from p),
 w as (select source, tokens, p, power(p, a) / sum(power(p, a)) over () as w from p, a), b as (select *, max(tokens / w) over () as budget from w)
 select source, tokens, round(p, 6) as share, round(w, 6) as weight, round(w * budget / tokens, 6) as reps, cast(floor(w * budget / tokens + 1e-9) as int) as whole from b""",
    "llm_packing_totals": f"""with d as (select doc_id, source, cast(len({_WORDS}) as bigint) as n from documents)
 select source, count(distinct doc_id) as documents, cast(sum(greatest(1, ceil(n / 2048.0))) as bigint) as pieces, cast(sum(n) as bigint) as tokens, true as fits from d group by 1""",
    "op11_vector_codes": _vector_codes_sql(),
    "op12_warc": """with p as (select page_id, encode(coalesce(html, '')) as b from pages), d as (select page_id, octet_length(b) as n, sha256(b) as h from p),
 r as (select *, row_number() over (partition by h order by page_id) as i, min(page_id) over (partition by h) as f from d)
 select page_id, cast(n as bigint) as payload_bytes, h as payload_digest, case when n >= 100 and i > 1 then 'revisit' else 'response' end as record_type, case when n >= 100 and i > 1 then f end as refers_to from r""",
    # n-grams, cuts, containing triples
    "op13_collocations": f"""with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as p from documents),
 w as (select lang, regexp_extract_all(p, '[^\\x20\\x09]+') as w from p),
 g as (select lang, 1 as z, unnest(w) as g from w union all select lang, 2, unnest([array_to_string(w[i:i + 1], ' ') for i in generate_series(1, len(w) - 1)]) from w
  union all select lang, 3, unnest([array_to_string(w[i:i + 2], ' ') for i in generate_series(1, len(w) - 2)]) from w),
 f as materialized (select lang, z, g, count(*) as f from g group by all), n as (select lang, sum(f) as n from f where z = 1 group by 1),
 c as (select lang, z, g, f as a, string_split(g, ' ') as w from f where z > 1 and f >= 10),
 k as (select c.*, k, array_to_string(w[1:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y from c, unnest([1, 2]) t(k) where k < z),
 s as (select k.lang, k.g, k.a, k.k, x.f as l, y.f as r, (1000000::hugeint * k.a * k.a) // (x.f::hugeint * y.f) as score from k join f x on x.lang = k.lang and x.g = k.x and x.z = k.k join f y on y.lang = k.lang and y.g = k.y and y.z = k.z - k.k),
 m as (select * from s qualify row_number() over (partition by lang, g order by score, k) = 1),
 b as (select lang, g, max(a) as a from (select lang, array_to_string(w[1:2], ' ') as g, a from c where z = 3 union all select lang, array_to_string(w[2:3], ' '), a from c where z = 3) group by 1, 2),
 d as (select m.* from m left join b on b.lang = m.lang and b.g = m.g where b.a is null or 100 * b.a < 50 * m.a)
 select d.lang, row_number() over (partition by d.lang order by score desc, d.a desc, d.g) as rank, d.g as phrase, d.a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from d join n on n.lang = d.lang qualify rank <= 2000""",
}
