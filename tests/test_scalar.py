"""F1, F5, F6, S5, K1 on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cardlake.functions.scalar import FULL_NAME_SQL, file_date, file_date_or_null, has_prefix, parse_amount
from cardlake.schemas import conform
from cardlake.sources.staging import stage_transactions


def test_full_name_null_parts(spark):
    df = spark.createDataFrame([("A", None, "C"), (None, None, None), ("A", "B", "C")],
                               "l string, f string, m string")
    assert [r[0] for r in df.toDF("last_name", "first_name", "patronymic").selectExpr(FULL_NAME_SQL).collect()] == ["A  C", "  ", "A B C"]


def test_parse_amount_both_decimal_marks(spark):
    df = spark.createDataFrame([("10,5",), ("10.5",), ("10",), (" 7,25 ",), ("1 500,5",), ("",),
                                (None,)], "a string")
    got = [r[0] for r in df.select(parse_amount("a")).collect()]
    assert got == [Decimal("10.50"), Decimal("10.50"), Decimal("10.00"), Decimal("7.25"),
                   None, None, None]


def _txn_text(spark, amount):
    return spark.createDataFrame(
        [(1, "2021-03-01 10:00:00", amount, "C1", "PAY", "SUCCESS", "T1")],
        "transaction_id long, transaction_date string, amount string, card_num string, "
        "oper_type string, oper_result string, terminal string")


def test_stage_transactions_parses_amount(spark):
    r = stage_transactions(_txn_text(spark, "123456,78")).first()
    assert r.amount == Decimal("123456.78")


@pytest.mark.parametrize("bad", ["1 500,5", "", None])
def test_stage_transactions_fails_on_unparsable_amount(spark, bad):
    with pytest.raises(PySparkException):
        stage_transactions(_txn_text(spark, bad)).collect()


def test_file_date_and_prefix(spark):
    df = spark.createDataFrame([("transactions_01032021.txt",), ("terminals_15032021.xlsx",),
                                ("notes_01032021.txt",), ("transactions_xx.txt",)], "n string")
    rows = df.select(has_prefix("n", ("transactions_", "terminals_")).alias("p"),
                     file_date_or_null("n").alias("d")).collect()
    assert [r.p for r in rows] == [True, True, False, True]
    assert rows[0].d == dt.date(2021, 3, 1) and rows[1].d == dt.date(2021, 3, 15)
    assert rows[3].d is None
    with pytest.raises(PySparkException):
        df.where(F.col("n") == "transactions_xx.txt").select(file_date("n")).collect()


def test_conform_rejects_overlong_varchar(spark):
    df = spark.createDataFrame([("X" * 21, "A1")], "card_num string, account_num string") \
        .withColumns({"create_dt": F.lit(None).cast("timestamp"),
                      "update_dt": F.lit(None).cast("timestamp")})
    with pytest.raises(PySparkException):
        conform(df, "stg_cards").collect()
    ok = conform(df.withColumn("card_num", F.lit("C1")), "stg_cards").first()
    assert ok.card_num == "C1"


def test_conform_requires_every_column(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1).withColumnRenamed("id", "card_num"), "stg_cards")
