"""Reports of one date's operations from card tails equal the full report's part."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardlake.operators import tails
from cardlake.operators.enrich import enrich
from cardlake.operators.report import flagged, flagged_day
from cardlake.operators.rules import RULES
from cardlake.operators.windows import WINDOW_COLUMNS
from cardlake.plans import fixtures as fx
from cardlake.plans.daily import Warehouse, day_report, run
from tests.conftest import SF_SMALL
from tests.world import dims, fact

OUT = ["trans_id", "trans_date", "card_num", "amt", "oper_result", "terminal", "black_list_dt", *WINDOW_COLUMNS, *RULES]
WORLD = dict(cards=[(f"C{k}", "A1") for k in range(5)], terminals=[("T1", "CITY_A"), ("T2", "CITY_B"), ("T2", "CITY_C")],
             blacklist=[("2021-01-01", "P1"), ("2021-01-02", "P1")])  # fan-out of cards and of a terminal


def _rows(df):
    return sorted((tuple(r) for r in df.select(OUT).collect()), key=repr)


def _days(rnd, late):
    """Three dates' operations: bursts over midnight, silent cards, ties, no card, no id, no time; with late ones if asked."""
    days, n = [], 0
    for day in (1, 2, 3):
        rows = []
        for _ in range(rnd.randint(20, 60)):
            h, m = rnd.choice([(0, rnd.randint(0, 9)), (23, rnd.randint(40, 59)), (12, 0)])
            on = rnd.randint(1, day) if late and rnd.random() < 0.1 else day
            at = None if rnd.random() < 0.05 else f"2021-03-0{on} {h:02d}:{m:02d}:{rnd.choice([0, 30]):02d}"
            rows.append((None if rnd.random() < 0.05 else f"t{n:04d}", at, rnd.choice(["C1", "C1", "C1", "C2", "C3", "C9", None]),
                         rnd.choice([None, 10, 20, 30, 40]), rnd.choice(["SUCCESS", "REJECT"]), rnd.choice(["T1", "T2", "T9", None])))
            n += 1
        rows += rnd.sample(rows, 3)  # repeated rows
        days.append(rows)
    return days


@pytest.mark.parametrize(("seed", "late"), [(1, False), (2, True)])
def test_days_equal_the_whole(spark, seed, late):
    days = [fact(spark, rows).cache() for rows in _days(random.Random(seed), late)]
    world = dims(spark, **WORLD)
    carried, so_far = spark.createDataFrame(tails.tail(days[0]).collect(), days[0].select(tails.FACT).schema), days[0]
    for day in days[1:]:
        found = tails.late_cards(carried, day)
        assert found.count() > 0 or not late
        got = flagged_day(day, tails.before(carried, day, found, so_far), **world)
        every = so_far.withColumn("new", F.lit(False)).unionByName(day.withColumn("new", F.lit(True)))
        want = flagged(every, **world, keep=("new",)).where("new")
        assert _rows(got) == _rows(want)
        # a tail carried on is the tail of everything
        so_far = so_far.unionByName(day)
        rows = tails.tail(carried.unionByName(day)).collect()
        assert sorted(map(repr, rows)) == sorted(map(repr, tails.tail(so_far).collect()))
        carried = spark.createDataFrame(rows, carried.schema)


def test_tail_is_the_last_hour_and_one_before(spark):
    rows = [("t1", "2021-03-01 08:00:00", "C1"), ("t2", "2021-03-01 09:00:00", "C1"), ("t3", "2021-03-01 11:00:00", "C1"),
            ("t4", "2021-03-01 12:00:00", "C1"), ("t5", None, "C1"), ("t6", None, "C1"), ("t7", "2021-03-01 01:00:00", None), ("t8", None, "C2")]
    found = tails.tail(fact(spark, [(*r, 1, "SUCCESS", "T1") for r in rows])).collect()
    assert sorted(r.trans_id for r in found) == ["t2", "t3", "t4", "t6", "t7", "t8"]
    assert tails.tail(fact(spark, [(*r, 1, "SUCCESS", "T1") for r in rows]).where("false")).count() == 0


def _fact_files(df, wh, day):
    mine = [wh.path(e.path) for e in wh._of("fact_transactions", day=day)]
    facts = [f for f in df.inputFiles() if "/fact_transactions/" in f]
    return facts, [f for f in facts if not any(p in f for p in mine)]


def test_earlier_facts_are_read_for_late_cards_only(spark, tmp_root):
    wh, src, (day1, day2, _) = Warehouse(spark, tmp_root + "/wh"), fx.FixtureSource(spark, SF_SMALL), fx.DAYS
    run(spark, src, wh, dates=[day1, day2], scope="day")
    own, other = _fact_files(day_report(wh, day2), wh, day2)
    assert own and not other
    # the second date's operations are of the first date: their cards are late
    wh.write_fact(day2, wh.read_fact(day=day2).drop("load_dt").withColumn("trans_date", F.expr("trans_date - INTERVAL 1 DAY")))
    assert _fact_files(day_report(wh, day2), wh, day2)[1]


def _snapshot(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _by_date(wh, day):
    return _snapshot(wh.read_report().where(F.col("report_dt") == F.lit(str(day)).cast("date")))


def test_scope_can_change_and_dates_can_be_loaded_again(spark, tmp_root):
    src, (day1, day2, _) = fx.FixtureSource(spark, SF_SMALL), fx.DAYS
    wh = Warehouse(spark, tmp_root + "/a")
    run(spark, src, wh, dates=[day1])
    assert not wh._of("card_tail")
    # no tails are kept with scope "all": they are taken of all facts when the scope changes
    run(spark, src, wh, dates=[day2], scope="day")
    want, carried = _by_date(wh, day2), _snapshot(wh.tail_before(day2))
    assert want and carried
    # the first date without operations, then its operations again: the tails follow
    src.without = {day1}
    run(spark, src, wh, dates=[day1], rebuild_later=True, scope="day")
    assert _by_date(wh, day1) == [] and _snapshot(wh.tail_before(day2)) == []
    src.without = set()
    run(spark, src, wh, dates=[day1], rebuild_later=True, scope="day")
    assert _by_date(wh, day2) == want and _snapshot(wh.tail_before(day2)) == carried


def test_unknown_scope_is_refused(spark, tmp_root):
    with pytest.raises(ValueError):
        run(spark, fx.FixtureSource(spark, SF_SMALL), Warehouse(spark, tmp_root + "/wh"), scope="week")


def test_deduped_lookups_give_one_row_for_each_operation(spark):
    world = dims(spark, cards=[("C1", "A1"), ("C1", "A2"), (None, "A1"), (None, "A2")], accounts=[("A1", "2030-01-01", "K1"), ("A2", "2031-01-01", "K1")],
                 clients=[("K1", "I", "I", "I", "P1", "2030-01-01", "+1"), ("K1", "I", "I", "I", "P1", "2030-01-01", "+2")],
                 terminals=[("T1", "CITY_A"), ("T1", None), (None, "CITY_B")], blacklist=[("2021-01-01", "P1"), ("2021-01-02", "P1"), (None, "P1")])
    newer = F.when(F.col("account_num") == "A1", dt.datetime(2025, 1, 1)).otherwise(dt.datetime(2024, 1, 1))
    world["cards_hist"] = world["cards_hist"].withColumn("effective_from", newer)
    rows = fact(spark, [("t1", "2021-03-01 08:00:00", "C1", 1, "SUCCESS", "T1"), ("t1", "2021-03-01 08:00:00", "C1", 1, "SUCCESS", "T1"),
                        ("t2", "2021-03-01 09:00:00", None, 1, "SUCCESS", None)])
    got = sorted((r.trans_id, r.account_num, r.phone, r.terminal_city, r.black_list_dt) for r in enrich(rows, **world, dedupe=True).collect())
    assert got[:2] == [("t1", "A1", "+2", "CITY_A", dt.date(2021, 1, 2))] * 2 and got[2] == ("t2", None, None, None, None) and len(got) == 3
    assert enrich(rows, **world).count() > 3
