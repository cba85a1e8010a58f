"""Incremental fact load (K4) with Structured Streaming.

New ``transactions_DDMMYYYY.txt`` files in the landing folder are picked up
by a file stream; each micro-batch is staged (amount parsing, S5), projected
to the fact schema and written into the partition of its date and file. The
checkpoint records which files were consumed, and a replayed batch rewrites
the partitions of its own files only (dynamic partition overwrite), so every
file is loaded exactly once, several files of one date included.

Only the fact table is streamed: the dimensions need the daily snapshots in
date order (``plans.daily``), and one micro-batch may hold several dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardlake.functions.scalar import file_date
from cardlake.plans.daily import Warehouse
from cardlake.sources.files import TRANSACTIONS_TEXT_SCHEMA
from cardlake.sources.staging import stage_transactions, to_fact


def transaction_stream(spark: SparkSession, landing: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of every transactions file in ``landing`` with the file's date."""
    r = (spark.readStream.schema(TRANSACTIONS_TEXT_SCHEMA)
         .option("sep", ";").option("header", True).option("mode", "FAILFAST")
         .option("pathGlobFilter", "transactions_*.txt"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing).withColumn("load_dt", file_date(F.col("_metadata.file_name"))) \
        .withColumn("src", F.col("_metadata.file_name"))


def fact_rows(batch: DataFrame) -> DataFrame:
    """Fact rows of a batch of text rows, keeping ``load_dt`` and ``src``."""
    return to_fact(stage_transactions(batch, keep=("load_dt", "src")), keep=("load_dt", "src"))


def start_fact_stream(spark: SparkSession, landing: str, wh: Warehouse, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """Start the load; ``available_now`` drains what is there and stops."""
    def write(batch: DataFrame, batch_id: int) -> None:
        wh.write_fact_files(fact_rows(batch))

    w = (transaction_stream(spark, landing).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
