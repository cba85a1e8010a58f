"""Discover dated input files, read the transaction text files,
and keep an ingest ledger so that a file is consumed once.

Listing goes through Spark's ``binaryFile`` source with only ``path``
selected, so file contents are never read and the listing is distributed
over the executors for large folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions.scalar import file_date, has_prefix
from cardlake.schemas import FILE_PREFIXES

TRANSACTIONS_TEXT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("card_num", T.StringType()),
    T.StructField("oper_type", T.StringType()),
    T.StructField("oper_result", T.StringType()),
    T.StructField("terminal", T.StringType()),
])


LEDGER_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("load_dt", T.DateType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("digest", T.StringType()),
])


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """``(path, file_name, length, modified)`` of the files directly in ``folder``; no content is read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", F.col("modificationTime").alias("modified"))


def with_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, file_name, length, modified, digest)``: files with the SHA-256 of their whole content, read in the executors."""
    return spark.read.format("binaryFile").load(paths).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", F.col("modificationTime").alias("modified"),
        F.sha2("content", 256).alias("digest"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark knows (not through Spark Connect, where it stays)."""
    if hasattr(spark, "_jvm"):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def input_files(names: DataFrame, prefixes=FILE_PREFIXES) -> DataFrame:
    """F6 + F5: keep names with one of the prefixes; add the embedded date."""
    return (names.where(has_prefix("file_name", prefixes))
            .withColumn("file_dt", file_date("file_name")))


def daily_dates(names: DataFrame, prefixes=FILE_PREFIXES) -> DataFrame:
    """S1 (A2, O1): distinct batch dates, ascending."""
    return input_files(names, prefixes).select("file_dt").distinct().orderBy("file_dt")


def batch_dates(names: DataFrame, prefixes=FILE_PREFIXES) -> list[dt.date]:
    """The driver-side list that drives the daily loop (the only collect)."""
    return [r.file_dt for r in daily_dates(names, prefixes).collect()]


def expected_file_names(day: dt.date) -> list[str]:
    """The trio of files the job needs for one date (Q19)."""
    tok = day.strftime("%d%m%Y")
    return [f"passport_blacklist_{tok}.xlsx", f"terminals_{tok}.xlsx", f"transactions_{tok}.txt"]


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """K7: input files not yet consumed.

    A name that the ledger does not know is pending. With ``length`` and
    ``modified`` on both sides, a known name whose file has changed in either
    since it was last entered is pending as well (``redelivered`` tells those
    whose content is the same).
    """
    files = input_files(listing)
    if not {"length", "modified"} <= {*files.columns} & {*ledger.columns}:
        return files.join(ledger.select("file_name"), "file_name", "left_anti")
    last = ledger.groupBy("file_name").agg(F.max_by(F.struct("length", "modified", F.lit(1).alias("known")), F.struct("load_dt", "modified")).alias("was"))
    same = F.col("was.length").isNull() | ((F.col("length") == F.col("was.length")) & (F.col("modified") == F.col("was.modified")))
    return files.join(last, "file_name", "left").where(F.col("was.known").isNull() | ~same).drop("was")


def unchanged(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Of files with a digest, the names whose content the ledger has under that name: delivered again without a change."""
    return files.join(ledger.where("digest is not null").select("file_name", "digest").distinct(), ["file_name", "digest"], "left_semi").select("file_name")


def read_transactions(spark: SparkSession, paths) -> DataFrame:
    """``;``-separated text with a header; explicit schema, fail on a bad
    row. ``file_dt`` comes from the file name via the hidden ``_metadata``."""
    df = (spark.read.schema(TRANSACTIONS_TEXT_SCHEMA)
          .option("sep", ";").option("header", True).option("mode", "FAILFAST")
          .csv(paths))
    return df.withColumn("file_dt", file_date(F.col("_metadata.file_name")))
