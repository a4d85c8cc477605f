"""The training-data pipeline over ``documents``: quality, lines, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread
as the next one's ``docs``; all but the last return the columns of their input, whatever an extra one is called: the
operators give their own columns other names then. Repeated rows, null ids, null or empty texts and empty
tables are handled as each operator's module says; a row with a null id is never dropped as a near duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm import bloom
from matchloom.llm.jaccard_join import similarity_components
from matchloom.llm.line_dedup import dedup_lines
from matchloom.llm.mixing import mix_sources
from matchloom.llm.packing import pack
from matchloom.llm.quality_model import score_quality
from matchloom.llm.storage import discard, fresh, materialise, scope
from matchloom.sources.shipping import ship_package


def _with_size(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer accepts; those without words go."""
    ship_package(spark)
    return score_quality(docs, docs.columns).where(F.col(fresh(docs.columns, "accepted"))).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; a document left without any line goes."""
    ship_package(spark)
    had, kept = (F.col(fresh(docs.columns, c)) for c in ("n_lines", "n_kept_lines"))
    return _with_size(dedup_lines(docs, docs.columns).where((had == 0) | (kept > 0)), docs.columns)


def _one_of_each(docs: DataFrame) -> DataFrame:
    """The smallest doc_id of each component, once; rows of one id have one text here."""
    own, stays, maybe = (fresh(docs.columns, c) for c in ("_id", "_stays", "_maybe"))
    with scope():
        found = similarity_components(docs, k=5, num=80, den=100)
        ids = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays"))
        # only documents that go or that repeat meet this table: the others pass by a filter of bounded size
        touched = materialise(ids.where("stays = 0 or rows > 1").select(F.col("doc_id").alias(own), F.col("stays").alias(stays)), outer=True)
    marked = bloom.marked(docs, "doc_id", bloom.build(touched.select(own)), maybe)
    met = marked.where(F.col(maybe)).join(touched, F.col("doc_id") == F.col(own), "left")
    clear = met.where(F.col(own).isNull()).select(*docs.columns)
    repeated = met.where(F.col(stays) == 1).select(*docs.columns).dropDuplicates(["doc_id"])
    return marked.where(~F.col(maybe)).select(*docs.columns).unionByName(clear).unionByName(repeated)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each component at a Jaccard of 0.8 of five-word shingles, once; rows that share an id but not
    their text are documents of their own, the one with the smaller SHA-256 first.

    Where ids repeat so, a document goes by id * texts + number of its text; ids for which that passes 64 bits are refused.
    """
    ship_package(spark)
    # of the ids with several texts: each text's number
    texts = docs.where("doc_id is not null").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")).distinct()
    several = texts.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    with scope():
        odd = materialise(several, outer=True)
    most = odd.agg(F.max("texts")).first()[0]
    if most is None:
        return _one_of_each(docs)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if max(abs(low), abs(high)) >= (1 << 62) // most:
        raise ValueError(f"ids repeat with up to {most} texts and are too large to be numbered by text")
    own, sha, number = (fresh(docs.columns, c) for c in ("_own_id", "_sha", "_number"))
    numbered = texts.join(odd, "doc_id", "left_semi").select(F.col("doc_id").alias(own), F.col("sha").alias(sha), (F.row_number().over(Window.partitionBy("doc_id").orderBy("sha")) - 1).alias(number))
    with scope():
        known = materialise(numbered, outer=True)
    told = docs.withColumns({own: F.col("doc_id"), sha: F.sha2(F.coalesce("text", F.lit("")), 256)}).join(known, [own, sha], "left")
    rows = told.withColumn("doc_id", F.col(own) * F.lit(most).cast("long") + F.coalesce(F.col(number), F.lit(0)))
    with scope():
        rows = materialise(rows.drop(sha, number), outer=True)
    return _one_of_each(rows).withColumn("doc_id", F.col(own)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, repeated as its source's weight asks."""
    ship_package(spark)
    return mix_sources(docs, docs.columns).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece with its bin; draws of one document never share a bin."""
    ship_package(spark)
    return pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: Signatures, components and trained weights have no SQL form; tests hold each stage's effect against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        with scope():
            after = materialise(stage(spark, docs, sf_dir), outer=True)
        discard(docs)  # a stage's table; the input has none
        docs = after
    return docs
