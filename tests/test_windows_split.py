"""Windows do not depend on the bucket length, whatever the rows look like."""

import random

import pytest

from cardlake.operators.enrich import enrich
from cardlake.operators.windows import WINDOW_COLUMNS, city_span, with_windows
from cardlake.plans import fixtures as fx
from cardlake.plans.queries import _enriched
from tests.conftest import SF_SMALL
from tests.world import dims, fact

LONG = 1000 * 86400  # one bucket for all rows with a timestamp


def _multiset(df, columns=("trans_id", "card_num", *WINDOW_COLUMNS)):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _same(e, buckets=(3600, 4 * 3600)):
    whole, span = _multiset(with_windows(e, LONG)), _multiset(city_span(e, LONG), ("trans_id", "city_min_1h", "city_max_1h"))
    for b in buckets:
        assert _multiset(with_windows(e, b)) == whole
        assert _multiset(city_span(e, b), ("trans_id", "city_min_1h", "city_max_1h")) == span
    return whole


def test_fixture(spark):
    _same(_enriched(fx.Tables(spark, SF_SMALL)))


def test_hot_card_with_gaps_ties_and_fanout(spark):
    rnd = random.Random(7)
    rows, tid = [], 0
    for day in range(1, 4):
        # one hot card: bursts, exact duplicate timestamps, long gaps
        for _ in range(rnd.randint(0, 40)):
            h, m, s = rnd.choice([0, 1, 23]), rnd.randint(0, 59), rnd.choice([0, 0, 30])
            rows.append((f"t{tid:05d}", f"2021-03-0{day} {h:02d}:{m:02d}:{s:02d}", "C1",
                         rnd.choice([10, 20, 30, 40]), rnd.choice(["SUCCESS", "REJECT"]),
                         rnd.choice(["T1", "T2", "T9"])))
            tid += 1
        # a sparse card: one operation per day; rows without a card
        rows.append((f"u{day}", f"2021-03-0{day} 12:00:00", "C2", 5, "REJECT", "T1"))
        rows += [(f"n{day}{k}", f"2021-03-0{day} 23:5{k}:00", None, 9 - k, "REJECT", "T2") for k in range(3)]
    _same(enrich(fact(spark, rows), **dims(spark, cards=[("C1", "A1"), ("C2", "A1")],
                                           blacklist=[("2021-01-01", "P1"), ("2021-01-02", "P1")])))  # fan-out x2


def test_null_timestamps_are_last_and_peers(spark):
    rows = [("t1", "2021-03-01 23:30:00", "C1", 30, "REJECT", "T1"),
            ("t2", "2021-03-02 00:10:00", "C1", 20, "REJECT", "T2"),
            ("t3", None, "C1", 10, "SUCCESS", "T1"), ("t4", None, "C1", 5, "SUCCESS", "T2"),
            ("t5", None, "C2", 5, "SUCCESS", "T2")]
    e = enrich(fact(spark, rows), **dims(spark, cards=[("C1", "A1"), ("C2", "A1")]))
    _same(e)
    got = {r.trans_id: r for r in with_windows(e).collect()}
    assert (got["t3"].prev_amt, got["t3"].prev2_amt) == (20, 30)
    assert [got[t].ops_20m for t in ("t3", "t4", "t5")] == [2, 2, 1]
    assert [got[t].city_change_1h for t in ("t2", "t3", "t4", "t5")] == [True, True, True, False]


def test_bucket_shorter_than_frame_is_rejected(spark):
    with pytest.raises(ValueError):
        with_windows(_enriched(fx.Tables(spark, SF_SMALL)), 600)


def test_plan_scans_the_fact_once_for_windows(spark):
    """One exchange on (card, bucket), used by both the windows and the lags across buckets."""
    e = _enriched(fx.Tables(spark, SF_SMALL))
    df = with_windows(e)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_COL") - final.count("ReusedExchange") <= 1 or "ReusedExchange" in final


def test_lags_across_buckets_carry_one_row_a_bucket(spark, monkeypatch):
    from cardlake.operators import windows

    rows = [(f"t{k}", f"2021-03-0{1 + k // 9} {9 + k % 9:02d}:{5 * (k % 5):02d}:00", "C1", 50 - k, "REJECT", "T1") for k in range(27)]
    e, carried, far_lags = enrich(fact(spark, rows), **dims(spark, cards=[("C1", "A1")])), [], windows._far_lags
    monkeypatch.setattr(windows, "_far_lags", lambda *a: carried.append(far_lags(*a)) or carried[-1])
    got = {r.trans_id: r for r in with_windows(e).collect()}
    for k in range(2, 27):
        r = got[f"t{k}"]
        assert (r.prev_amt, r.prev2_amt, r.prev_result) == (51 - k, 52 - k, "REJECT")
    far = carried[0]
    assert far.count() == len({(r._card, r._bucket) for r in far.collect()})
    assert set(far.columns) == {"_card", "_bucket", "_back1", "_back2"}  # no bucket's rows, only what is behind it
