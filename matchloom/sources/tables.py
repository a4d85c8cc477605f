"""Readers and writers: all-string CSV with coercion, workbooks as table folders, bundles, manifests, zipped pages."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import normalize_age_group, normalize_rni, surname_initials_key
from ..operators.keyed import first_available, first_by_key, require_columns


def read_rankings(spark: SparkSession, path: str) -> DataFrame:
    """Ranking rows of CSV files read as text: coerced, valid ones only, the best place of each (id, group, date)."""
    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(
        first_available(raw, ["place_num", "place"], "double").alias("place"), first_available(raw, ["fio", "fio_from_link"]).alias("full_name"), normalize_rni(first_available(raw, ["rni_final", "rni"])).alias("rni"),
        first_available(raw, ["points_num", "points"], "double").alias("points"), first_available(raw, ["total_tournaments_num", "total_tournaments"], "double").alias("total_tournaments"),
        first_available(raw, ["counting_tournaments_num", "counting_tournaments"], "double").alias("counting_tournaments"),
        normalize_age_group(first_available(raw, ["age_group_filter", "age_group_in_table"])).alias("age_group"), parse_date(first_available(raw, ["ranking_date", "ranking_date_dt"])).alias("classification_date"),
    )
    ok = rows.where("rni is not null and classification_date is not null and age_group <> ''").withColumn("name_key", surname_initials_key(F.col("full_name")))
    return first_by_key(ok, ["rni", "age_group", "classification_date"], [F.col("place").asc_nulls_last(), F.col("points").desc_nulls_last()])


def write_workbook(tables: dict[str, DataFrame], folder: str) -> None:
    """A workbook is a folder with one Parquet table a sheet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_sheet(spark: SparkSession, folder: str, name: str, required: list[str] | None = None) -> DataFrame:
    return require_columns(spark.read.parquet(f"{folder}/{name}"), required or [])


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Saved pages of a folder, one row a file."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("page_id"), F.col("value").alias("html"))


def read_zipped_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages within zip archives; an archive is opened by one task, a member is a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(m for m in z.namelist() if m.lower().endswith((".html", ".htm"))):
                        yield pa.RecordBatch.from_arrays([pa.array([f"{name}#{member}"]), pa.array([z.read(member).decode("utf-8", "replace")])], ["page_id", "html"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "page_id string, html string")


def file_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), "modificationTime")


def manifest(tables: dict[str, DataFrame]) -> str:
    """Row counts of named tables as JSON; one aggregation a table."""
    return json.dumps({name: {"rows": df.count(), "columns": df.columns} for name, df in tables.items()}, ensure_ascii=False)


def records_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV files with a header; every part is whole lines."""
    df.write.mode("overwrite").option("header", True).csv(folder)


def discover(spark: SparkSession, path: str, required: list[str], most: int = 65_536) -> DataFrame:
    """Files whose first line names all ``required`` columns, newest first; only their first bytes are looked at."""
    head = F.split(F.decode(F.substring(F.col("content"), 1, most), "UTF-8"), "\r?\n")[0]
    names = F.transform(F.split(F.translate(head, '"\ufeff', ""), "[,;\t]"), F.trim)
    files = spark.read.format("binaryFile").load(path)
    fit = F.forall(F.array(*[F.lit(r) for r in required]), lambda r: F.array_contains(names, r))
    return files.where(fit).select("path", F.col("length").alias("bytes"), "modificationTime").orderBy(F.desc("modificationTime"), "path")


def read_saved_pages(spark: SparkSession, folder: str, archive: str) -> DataFrame:
    """Pages of the folder, or of the archive where the folder is missing or has none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(where) and len(files.listStatus(where)):
        return read_pages(spark, folder)
    return read_zipped_pages(spark, archive)


def to_do(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a run that goes on after a break still has to fetch: keys (dates and groups, say) that aren't done."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def distinct_pages(pages: DataFrame, series: list[str], number: str = "page_no", html: str = "html") -> DataFrame:
    """Pages of a series up to the first that repeats an earlier one or has no rows: a site repeats its last page for ever."""
    by = Window.partitionBy(*series)
    seen = pages.withColumn("_h", F.sha2(F.coalesce(html, F.lit("")), 256))
    first = F.min(number).over(Window.partitionBy(*series, "_h"))
    ends = (F.col(number) > first) | (F.coalesce(F.col(html), F.lit("")) == "")
    stop = F.min(F.when(ends, F.col(number))).over(by)
    return seen.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col(number) < F.col("_stop"))).drop("_h", "_stop")
