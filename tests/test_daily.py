"""The daily run through a warehouse folder, and its re-run safety."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardlake.plans import daily
from cardlake.plans import fixtures as fx
from cardlake.plans.daily import MissingSnapshot, StaleHistory, Warehouse, run, run_day
from cardlake.sources.staging import BadAmounts
from tests.conftest import SF_SMALL


def _snapshot(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_three_days_then_rerun_changes_nothing(spark, tmp_root):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh)
    report = _snapshot(wh.read_report())
    facts = _snapshot(wh.read_fact())
    dims = {(n, d): _snapshot(wh.read_dim(n, d)) for n in ("clients", "accounts", "cards", "terminals") for d in fx.DAYS}
    assert {r[-1] for r in report} == set(fx.DAYS)
    assert len(facts) == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()

    # re-running the middle date (its inputs unchanged) leaves the tables as they were
    run_day(spark, src, wh, fx.DAYS[1], parallel=1)
    assert _snapshot(wh.read_report()) == report
    assert _snapshot(wh.read_fact()) == facts
    for (n, d), rows in dims.items():
        assert rows and _snapshot(wh.read_dim(n, d)) == rows

    # the ledger knows every date; a later run resumes after the last one
    assert wh.last_loaded_before(dt.date(2024, 1, 4)) == fx.DAYS[-1]
    led = wh.read_ledger()
    assert led.select("load_dt").distinct().count() == 3
    assert led.where(F.col("file_name").startswith("transactions_")).count() == 3


def test_report_rows_accumulate_by_report_date(spark, tmp_root):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh, dates=fx.DAYS[:2])
    by_day = {r.report_dt: r.n for r in
              wh.read_report().groupBy("report_dt").agg(F.count("*").alias("n")).collect()}
    assert set(by_day) == set(fx.DAYS[:2])
    # day 2 re-reports day 1's facts (reports cover every loaded fact)
    assert by_day[fx.DAYS[0]] > 0 and by_day[fx.DAYS[1]] > 0


def test_staging_holds_the_last_date(spark, tmp_root):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/a")
    run(spark, src, wh, dates=fx.DAYS[:2])
    assert wh.read_staging("stg_clients").count() == fx.clients_day(fx.Tables(spark, SF_SMALL), fx.DAYS[1]).count()
    assert {(r.table_name, r.n_rows) for r in wh.read_rejected().collect()} == {
        ("stg_clients", 0), ("stg_accounts", 0), ("stg_cards", 0), ("stg_terminals", 0)}


def test_a_date_before_loaded_ones(spark, tmp_root):
    """A late or repeated date must not leave later histories built on what was there before it."""
    src = fx.FixtureSource(spark, SF_SMALL)
    straight, wh = Warehouse(spark, tmp_root + "/a"), Warehouse(spark, tmp_root + "/b")
    run(spark, src, straight)
    run(spark, src, wh, dates=fx.DAYS[1:])
    with pytest.raises(StaleHistory):
        run(spark, src, wh, dates=fx.DAYS[:1])
    assert run(spark, src, wh, dates=fx.DAYS[:1], rebuild_later=True) == fx.DAYS
    # dates that skip a loaded one build on it
    assert run(spark, src, wh, dates=[fx.DAYS[0], fx.DAYS[2]], rebuild_later=True) == fx.DAYS
    assert run(spark, src, wh, dates=[fx.DAYS[2]]) == [fx.DAYS[2]]
    for name in ("clients", "terminals"):
        assert _snapshot(wh.read_dim(name, fx.DAYS[2])) == _snapshot(straight.read_dim(name, fx.DAYS[2]))
    assert _snapshot(wh.read_report()) == _snapshot(straight.read_report())


def test_an_unreadable_ledger_is_not_an_empty_one(spark):
    wh = Warehouse(spark, "nosuchfs://nowhere/wh")
    with pytest.raises(Exception, match="nosuchfs"):
        wh.loaded_dates()


def test_no_dates_and_empty_ledger(spark, tmp_root):
    wh = Warehouse(spark, tmp_root + "/empty")
    assert wh.last_loaded_before(dt.date(2024, 1, 1)) is None
    assert wh.read_ledger().count() == 0
    run(spark, fx.FixtureSource(spark, SF_SMALL), wh, dates=[])
    assert not os.path.exists(tmp_root + "/empty")


def _state(wh):
    dims = {(n, d): _snapshot(wh.read_dim(n, d)) for n in ("clients", "accounts", "cards", "terminals") for d in fx.DAYS}
    return dims, _snapshot(wh.read_fact()), _snapshot(wh.read_report()), _snapshot(wh.read_ledger())


def test_an_empty_rerun_replaces(spark, tmp_root):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh, dates=fx.DAYS[:1])
    assert wh.read_fact().count() and wh.read_report().count() and wh.read_blacklist(fx.DAYS[0]).count()
    src.without = {fx.DAYS[0]}
    run(spark, src, wh, dates=fx.DAYS[:1])
    assert [wh.read_fact().count(), wh.read_report().count(), wh.read_blacklist(fx.DAYS[0]).count()] == [0, 0, 0]
    assert wh.loaded_dates() == fx.DAYS[:1] and wh.read_dim("clients", fx.DAYS[0]).count()


class Lost(RuntimeError):
    pass


def test_a_run_lost_half_way_is_invisible(spark, tmp_root, monkeypatch):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh, dates=fx.DAYS[:2])
    before = _state(wh)
    src.without = {fx.DAYS[1]}
    def lost(*_):
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(daily.Tables, "write_ledger", lost)  # the last step: all else of the date is written
        with pytest.raises(Lost):
            run(spark, src, wh, dates=fx.DAYS[1:2])
    assert _state(Warehouse(spark, wh.root)) == before
    assert len(os.listdir(f"{wh.root}/rep_fraud")) == 3  # the lost report is there, but in no commit


def test_a_rebuild_lost_half_way_is_stale(spark, tmp_root, monkeypatch):
    src = fx.FixtureSource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh)
    before = _state(wh)
    real = daily.report_day

    def lost(spark, source, batch, day, **kw):
        if day == fx.DAYS[2]:
            raise Lost
        return real(spark, source, batch, day, **kw)

    with monkeypatch.context() as m:
        m.setattr(daily, "report_day", lost)
        with pytest.raises(Lost):
            run(spark, src, wh, dates=[fx.DAYS[0]], rebuild_later=True)
    assert wh.stale_dates() == [fx.DAYS[2]]
    with pytest.raises(StaleHistory):
        run(spark, src, wh, dates=[dt.date(2024, 1, 9)])
    assert run(spark, src, wh, dates=[fx.DAYS[1]], rebuild_later=True) == fx.DAYS[1:]
    assert wh.stale_dates() == [] and _state(wh) == before


def test_rebuilds_read_the_archive_and_not_todays_tables(spark, tmp_root):
    src = fx.TodaySource(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root + "/wh")
    for src.today in fx.DAYS[1:]:
        run(spark, src, wh, dates=[src.today])

    def day3():
        rows = wh.read_dim("clients", fx.DAYS[2])
        return rows.count(), rows.where("deleted_flg").count(), _snapshot(rows)

    before = day3()
    with pytest.raises(MissingSnapshot):  # day 1 was never staged, and the source has only day 3's tables
        run(spark, src, wh, dates=[fx.DAYS[0]], rebuild_later=True)
    assert day3() == before and wh.loaded_dates() == fx.DAYS[1:]
    assert run(spark, src, wh, dates=[fx.DAYS[1]], rebuild_later=True) == fx.DAYS[1:]
    assert day3() == before


def test_unchanged_staging_is_stored_once(spark, tmp_root):
    src = fx.TodaySource(spark, SF_SMALL)
    src.today = fx.DAYS[0]
    wh = Warehouse(spark, tmp_root + "/wh")
    run(spark, src, wh, dates=fx.DAYS[:2])  # accounts, clients and cards never change
    for table in ("stg_clients", "stg_accounts", "stg_cards"):
        folders = [f for f in os.listdir(f"{wh.root}/stg/{table}") if f.startswith("v=")]
        assert len(folders) == 1
        assert len({_snapshot(wh.read_staging(table, d))[0] for d in fx.DAYS[:2]}) == 1
    assert len([f for f in os.listdir(f"{wh.root}/stg/stg_terminals") if f.startswith("v=")]) == 2
    a, b = (spark.createDataFrame([r], "terminal_id string, terminal_type string, terminal_city string, terminal_address string")
            for r in ((None, "x", "x", "x"), ("x", None, "x", "x")))
    for df in (a, b):  # hashes alone would not tell which column is NULL
        wh.write_staging("stg_terminals", df, fx.DAYS[0])
        assert _snapshot(wh.read_staging("stg_terminals", fx.DAYS[0])) == _snapshot(df)


def test_bad_amounts_fail_the_date_with_their_number(spark, tmp_root):
    class Bad(fx.FixtureSource):
        def transactions(self, day):
            return super().transactions(day).withColumn("amount", F.expr("CASE WHEN transaction_id % 50 = 7 THEN '1 500,5' ELSE amount END"))

    src, wh = Bad(spark, SF_SMALL), Warehouse(spark, tmp_root + "/wh")
    n = src.transactions(fx.DAYS[0]).where("amount = '1 500,5'").count()
    with pytest.raises(BadAmounts, match=rf"{fx.DAYS[0]}: {n} row.*unparsable amount in transaction \d+: 1 500,5"):
        run(spark, src, wh, dates=fx.DAYS[:1])
    assert wh.loaded_dates() == [] and wh.read_fact().count() == 0


def test_the_content_digest_of_a_staging(spark, tmp_root):
    b = Warehouse(spark, tmp_root + "/wh").batch()
    rows = [(k, f"P{k}", None if k % 2 else "x") for k in range(20)]
    df = spark.createDataFrame(rows, "terminal_id int, terminal_type string, terminal_city string").selectExpr(
        "CAST(terminal_id AS STRING) AS terminal_id", "terminal_type", "terminal_city", "CAST(NULL AS STRING) AS terminal_address")
    for day, some in zip(fx.DAYS, (df, df.orderBy(F.desc("terminal_id")), df.where("terminal_id <> '3'")), strict=True):
        b.write_staging("stg_terminals", some, day)
    first, again, other = (b.entries[str(d), "stg/stg_terminals", ""] for d in fx.DAYS)
    assert first.path == again.path and first.digest == again.digest != other.digest
    assert first.digest.count("/") == 2  # two long sums a hash, no decimals
    b.write_staging("stg_terminals", df.where("false"), fx.DAYS[0])
    assert b.entries[str(fx.DAYS[0]), "stg/stg_terminals", ""].digest == "0-0/0-0/0"
