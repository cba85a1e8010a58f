"""The streamed fact load consumes each transactions file exactly once."""

import datetime as dt

from pyspark.sql import functions as F

from cardlake.plans.daily import Warehouse
from cardlake.streaming.fact_stream import start_fact_stream

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _file(land, day, ids):
    tok = day.strftime("%d%m%Y")
    body = "".join(f"{i};{day.isoformat()} 10:00:{i % 60:02d};{i},25;C{i % 3};PAY;SUCCESS;T1\n"
                   for i in ids)
    (land / f"transactions_{tok}.txt").write_text(HEADER + body)


def test_available_now_runs_are_exactly_once(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "terminals_01032021.xlsx").write_bytes(b"ignored")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ckpt = str(tmp_path / "ckpt")
    d1, d2, d3 = dt.date(2021, 3, 1), dt.date(2021, 3, 2), dt.date(2021, 3, 3)
    _file(land, d1, range(1, 6))
    _file(land, d2, range(6, 9))
    start_fact_stream(spark, str(land), wh, ckpt).awaitTermination()
    counts = {r.load_dt: r.n for r in wh.read_fact().groupBy("load_dt")
              .agg(F.count("*").alias("n")).collect()}
    assert counts == {d1: 5, d2: 3}

    _file(land, d3, range(9, 11))
    start_fact_stream(spark, str(land), wh, ckpt).awaitTermination()   # restart from checkpoint
    f = wh.read_fact()
    counts = {r.load_dt: r.n for r in f.groupBy("load_dt").agg(F.count("*").alias("n")).collect()}
    assert counts == {d1: 5, d2: 3, d3: 2}
    assert f.where(F.col("trans_id") == "9").first().amt == __import__("decimal").Decimal("9.25")


def test_two_files_of_one_date_in_two_batches(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    wh, ckpt = Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "ckpt")
    day = dt.date(2021, 3, 1)
    _file(land, day, range(1, 6))
    start_fact_stream(spark, str(land), wh, ckpt).awaitTermination()
    (land / "transactions_01032021.txt").rename(land / "transactions_late_01032021.txt.done")
    (land / "transactions_more_01032021.txt").write_text(HEADER + "9;2021-03-01 11:00:00;1,5;C1;PAY;SUCCESS;T1\n")
    start_fact_stream(spark, str(land), wh, ckpt).awaitTermination()
    assert sorted(r.trans_id for r in wh.read_fact().collect()) == ["1", "2", "3", "4", "5", "9"]
