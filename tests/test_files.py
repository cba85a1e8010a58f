"""A landing folder of dated files driving the daily run."""

import datetime as dt
import hashlib
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardlake.operators.report import fraud_report
from cardlake.plans.daily import Warehouse, run
from cardlake.schemas import LABEL_BAD_PASSPORT, LABEL_CITY_HOP, struct_type
from cardlake.sources.files import daily_dates, list_files, pending_files, read_transactions
from cardlake.sources.inputs import FileSource, MissingInput, UnknownInput
from cardlake.sources.staging import snapshot_reader
from cardlake.sources.workbook import read_workbooks
from tests.xlsx import write_xlsx

D1, D2 = dt.date(2021, 3, 1), dt.date(2021, 3, 2)
TXN_HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _landing(root, days=(D1, D2), skip=()):
    land = root / "landing"
    land.mkdir()
    for day in days:
        tok = day.strftime("%d%m%Y")
        iso = day.isoformat()
        if ("transactions", day) not in skip:
            (land / f"transactions_{tok}.txt").write_text(
                TXN_HEADER
                + f"{day.day}01;{iso} 10:00:00;100,50;C1;PAY;SUCCESS;T1\n"
                + f"{day.day}02;{iso} 10:20:00;20.00;C1;PAY;SUCCESS;T2\n"
                + f"{day.day}03;{iso} 11:00:00;7;C2;PAY;SUCCESS;T1\n")
        write_xlsx(land / f"terminals_{tok}.xlsx",
                   [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                    ["T1", "POS", "Moscow", "Lenina 1"], ["T2", "ATM", "Kazan", None]])
        write_xlsx(land / f"passport_blacklist_{tok}.xlsx",
                   [["date", "passport"], [dt.date(2021, 2, 1), "P2"]])
    (land / "notes.txt").write_text("not an input\n")
    return str(land)


def _snapshots(spark, root):
    ts = dt.datetime(2020, 1, 1)
    acc = spark.createDataFrame([("A1", dt.date(2030, 1, 1), "K1", ts, None),
                                 ("A2", dt.date(2030, 1, 1), "K2", ts, None)],
                                "account string, valid_to date, client string, "
                                "create_dt timestamp, update_dt timestamp")
    cli = spark.createDataFrame([("K1", "Ivanov", "Ivan", None, None, "P1", dt.date(2030, 1, 1),
                                  "+1", ts, None),
                                 ("K2", "Petrov", "Petr", "P", None, "P2", dt.date(2030, 1, 1),
                                  "+2", ts, None)], struct_type("stg_clients"))
    crd = spark.createDataFrame([("C1", "A1", ts, None), ("C2", "A2", ts, None)],
                                "card_num string, account string, create_dt timestamp, "
                                "update_dt timestamp")
    paths = {}
    for name, df in (("accounts", acc), ("clients", cli), ("cards", crd)):
        paths[name] = str(root / "ops" / name)
        df.write.parquet(paths[name])
    return {name: (lambda day, p=p: snapshot_reader(spark, "parquet", p)) for name, p in paths.items()}


def test_listing_dates_and_ledger(spark, tmp_path):
    land = _landing(tmp_path)
    listing = list_files(spark, land)
    assert [r.file_dt for r in daily_dates(listing).collect()] == [D1, D2]
    ledger = spark.createDataFrame([("transactions_01032021.txt",)], "file_name string")
    pend = {r.file_name for r in pending_files(listing, ledger).collect()}
    assert "transactions_01032021.txt" not in pend and "notes.txt" not in pend
    assert len(pend) == 5


def test_read_transactions_text(spark, tmp_path):
    land = _landing(tmp_path, days=(D1,))
    rows = read_transactions(spark, land + "/transactions_01032021.txt").collect()
    assert [(r.transaction_id, r.amount, r.file_dt) for r in rows][0] == (101, "100,50", D1)


def test_workbook_reader(spark, tmp_path):
    land = _landing(tmp_path, days=(D1,))
    t = read_workbooks(spark, land + "/terminals_01032021.xlsx", struct_type("stg_terminals"))
    assert sorted(tuple(r)[1:] for r in t.collect()) == [
        ("T1", "POS", "Moscow", "Lenina 1"), ("T2", "ATM", "Kazan", None)]
    b = read_workbooks(spark, land + "/passport_blacklist_*.xlsx", struct_type("stg_blacklist"))
    assert [(r.date, r.passport) for r in b.collect()] == [(dt.date(2021, 2, 1), "P2")]


def test_daily_run_from_files(spark, tmp_path):
    land = _landing(tmp_path)
    snaps = _snapshots(spark, tmp_path)
    src = FileSource(spark, land, snaps["accounts"], snaps["clients"], snaps["cards"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run(spark, src, wh, dates=src.dates())
    rep = sorted((r.report_dt, r.event_dt, r.passport, r.event_type) for r in wh.read_report().collect())
    # C1 hops Moscow -> Kazan within the hour each day; C2's client is blacklisted
    assert (D1, D1, "P1", LABEL_CITY_HOP) in rep and (D2, D2, "P1", LABEL_CITY_HOP) in rep
    assert (D2, D1, "P2", LABEL_BAD_PASSPORT) in rep
    facts = wh.read_fact().select("trans_id", "amt").collect()
    assert {(r.trans_id, r.amt) for r in facts} >= {("101", Decimal("100.50")), ("102", Decimal("20.00"))}
    # everything consumed: nothing pending
    assert src.dates(ledger=wh.read_ledger()) == []
    # the report equals a direct computation over the loaded tables
    direct = fraud_report(wh.read_fact().drop("load_dt"), wh.read_dim("cards", D2),
                          wh.read_dim("accounts", D2), wh.read_dim("clients", D2),
                          wh.read_dim("terminals", D2), wh.read_blacklist(D2), D2)
    assert sorted(map(tuple, direct.collect()), key=repr) == \
        sorted(map(tuple, wh.read_report().where(F.col("report_dt") == D2)
                   .select(direct.columns).collect()), key=repr)


def test_missing_file_stops_the_date_before_any_write(spark, tmp_path):
    land = _landing(tmp_path, days=(D1,), skip={("transactions", D1)})
    snaps = _snapshots(spark, tmp_path)
    src = FileSource(spark, land, snaps["accounts"], snaps["clients"], snaps["cards"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(MissingInput):
        run(spark, src, wh, dates=[D1])
    assert not (tmp_path / "wh").exists()


def test_unknown_file_of_a_date_is_refused(spark, tmp_path):
    """A second transactions file would be neither loaded nor entered in the ledger."""
    land = _landing(tmp_path, days=(D1,))
    with open(f"{land}/transactions_extra_01032021.txt", "w") as f:
        f.write("x")
    snaps = _snapshots(spark, tmp_path)
    src = FileSource(spark, land, snaps["accounts"], snaps["clients"], snaps["cards"])
    with pytest.raises(UnknownInput):
        run(spark, src, Warehouse(spark, str(tmp_path / "wh")), dates=[D1])
    assert not (tmp_path / "wh").exists()


def test_command_line_run(spark, tmp_path):
    from cardlake.__main__ import main

    land = _landing(tmp_path)
    _snapshots(spark, tmp_path)
    ops = tmp_path / "ops"
    args = ["--landing", land, "--warehouse", str(tmp_path / "wh"),
            "--accounts", str(ops / "accounts"), "--clients", str(ops / "clients"),
            "--cards", str(ops / "cards")]
    main(args)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert {r.report_dt for r in wh.read_report().select("report_dt").distinct().collect()} == {D1, D2}
    main(args)   # nothing pending: a second call loads nothing
    assert wh.read_ledger().count() == 6
    rows = sorted(map(tuple, wh.read_report().collect()), key=repr)
    main([*args, "--vacuum-hours", "0"])
    assert len(wh.log.names()) == 1
    assert sorted(map(tuple, Warehouse(spark, str(tmp_path / "wh")).read_report().collect()), key=repr) == rows


def test_a_file_delivered_again(spark, tmp_path):
    """Changed content under a known name is pending; the same content with another time is not."""
    land = _landing(tmp_path)
    snaps = _snapshots(spark, tmp_path)
    src = FileSource(spark, land, snaps["accounts"], snaps["clients"], snaps["cards"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run(spark, src, wh, dates=src.dates())
    led = {r.file_name: r for r in wh.read_ledger().collect()}
    name = "transactions_02032021.txt"
    text = open(f"{land}/{name}", "rb").read()
    assert len(led) == 6 and led[name].length == len(text) and led[name].digest == hashlib.sha256(text).hexdigest()
    os.utime(f"{land}/transactions_01032021.txt", (1, 1))
    assert src.dates(ledger=wh.read_ledger()) == []
    with open(f"{land}/{name}", "ab") as f:
        f.write(text.splitlines(keepends=True)[-1])
    assert src.dates(ledger=wh.read_ledger()) == [D2]
    n = wh.read_fact().count()
    run(spark, src, wh, dates=src.dates(ledger=wh.read_ledger()))
    assert wh.read_fact().count() == n + 1 and src.dates(ledger=wh.read_ledger()) == []
