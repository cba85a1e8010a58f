"""Stage the daily inputs and derive the fact rows.

Staging is a projection of each snapshot onto the staging table's schema
(``conform``). Nothing here shuffles; these are narrow transformations that
fuse into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions.scalar import parse_amount
from cardlake.schemas import conform


def snapshot_reader(spark: SparkSession, fmt: str, path_or_table: str, **options) -> DataFrame:
    """Full snapshot of an operational table.

    ``fmt="jdbc"`` reads a database table in parallel when the caller passes
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``;
    any file format reads a path; ``fmt="table"`` reads a catalog table.
    """
    if fmt == "table":
        return spark.read.options(**options).table(path_or_table)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=path_or_table, **options).load()
    return spark.read.format(fmt).options(**options).load(path_or_table)


def stage_accounts(snapshot: DataFrame) -> DataFrame:
    """``account`` is renamed ``account_num``."""
    return conform(snapshot.withColumnRenamed("account", "account_num"), "stg_accounts")


def stage_clients(snapshot: DataFrame) -> DataFrame:
    return conform(snapshot, "stg_clients")


def stage_cards(snapshot: DataFrame) -> DataFrame:
    return conform(snapshot.withColumnRenamed("account", "account_num"), "stg_cards")


def stage_terminals(rows: DataFrame) -> DataFrame:
    return conform(rows, "stg_terminals")


def stage_blacklist(rows: DataFrame) -> DataFrame:
    return conform(rows, "stg_blacklist")


#: Column that a lenient ``stage_transactions`` adds: what is wrong with the row's amount, or NULL.
BAD = "bad_amount"


class BadAmounts(ValueError):
    pass


def stage_transactions(text_rows: DataFrame, keep: tuple[str, ...] = (), lenient: bool = False) -> DataFrame:
    """Amount text (decimal comma or point) -> decimal(18,2).

    An amount that does not parse -- including an empty one -- fails the
    load of that date (ledger Q13): either at the first such row, by a lazy
    JVM-side expression, or, ``lenient``, after the write, in which the rows
    with ``BAD`` are counted (``bad_amounts``, ``refuse_bad_amounts``).
    """
    parsed = parse_amount("amount")
    said = F.concat(F.lit("unparsable amount in transaction "), F.coalesce(F.col("transaction_id").cast("string"), F.lit("?")), F.lit(": "),
                    F.coalesce(F.col("amount"), F.lit("NULL")))
    if lenient:
        return conform(text_rows.withColumns({BAD: F.when(parsed.isNull(), said), "amount": parsed}), "stg_transactions", (*keep, BAD))
    return conform(text_rows.withColumn("amount", F.when(parsed.isNull(), F.raise_error(said)).otherwise(parsed)), "stg_transactions", keep)


def bad_amounts() -> dict[str, Column]:
    """Metrics of a lenient staging: number of bad rows, and the first and last of what is said of them."""
    return {"n_bad": F.count(BAD), "first_bad": F.min(BAD), "last_bad": F.max(BAD)}


def refuse_bad_amounts(day, got: dict) -> None:
    if got["n_bad"]:
        examples = "; ".join(dict.fromkeys([got["first_bad"], got["last_bad"]]))
        raise BadAmounts(f"{day}: {got['n_bad']} row(s), e.g. {examples}")


REJECTED = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("key_name", T.StringType()), T.StructField("n_rows", T.LongType())])


def to_fact(stg_transactions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """K4 projection (P11): id to text, timestamp text to timestamp, amount as is."""
    return conform(stg_transactions.select(
        F.col("transaction_id").cast("string").alias("trans_id"),
        F.to_timestamp("transaction_date").alias("trans_date"),
        "card_num", "oper_type",
        F.col("amount").alias("amt"),
        "oper_result", "terminal", *keep), "fact_transactions", keep)


def to_blacklist_fact(stg_blacklist: DataFrame) -> DataFrame:
    """K5 projection: ``date`` -> ``entry_dt``."""
    return conform(stg_blacklist.select(F.col("date").alias("entry_dt"), "passport"),
                   "fact_passport_blacklist")
