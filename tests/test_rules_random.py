"""W1-W5 and R3/R4 against a brute-force Python model on random transactions."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from cardlake.operators.enrich import enrich
from cardlake.operators.windows import city_span
from tests.world import dims, fact, flagged_rows

CITY = {"T1": "CITY_A", "T2": "CITY_B", "T3": "CITY_C"}   # T9 is unknown


def _model(rows):
    """rows: (tid, ts, card, amt, res, term) -> {tid: (least city, greatest city, count, lags, R3, R4)}"""
    out = {}
    by_card = {}
    for r in rows:
        by_card.setdefault(r[2], []).append(r)
    for card_rows in by_card.values():
        seq = sorted(card_rows, key=lambda r: (r[1], r[0]))
        for i, (tid, ts, _, amt, res, term) in enumerate(seq):
            hour = [CITY.get(r[5]) for r in seq if ts - dt.timedelta(hours=1) <= r[1] <= ts]
            hour = [c for c in hour if c is not None]
            c1, c2 = (min(hour), max(hour)) if hour else (None, None)
            cnt = sum(1 for r in seq if ts - dt.timedelta(minutes=20) <= r[1] <= ts and r[3] is not None)
            l1 = seq[i - 1] if i >= 1 else None
            l2 = seq[i - 2] if i >= 2 else None
            lag1, lag1r = (l1[3], l1[4]) if l1 else (None, None)
            lag2, lag2r = (l2[3], l2[4]) if l2 else (None, None)
            r3 = c1 is not None and c1 != c2
            r4 = bool(cnt > 3 and lag1 is not None and lag2 is not None and amt is not None
                      and amt < lag1 < lag2 and res == "SUCCESS" and lag1r == "REJECT"
                      and lag2r == "REJECT")
            out[tid] = (c1, c2, cnt, lag1, lag1r, lag2, lag2r, r3, r4)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows_and_rules_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    base = dt.datetime(2021, 3, 1, 22, 0, 0)
    for n in range(150):
        card = rnd.choice(["C1", "C1", "C1", "C2", "C3"])          # C1 is hot
        ts = base + dt.timedelta(minutes=rnd.choice([0, 5, 10, 15, 20, 45, 60, 61, 90, 300]) * rnd.random() // 1
                                 + rnd.randint(0, 240))
        amt = rnd.choice([None, 10, 20, 30, 40, 50])
        rows.append((f"t{n:04d}", ts, card, amt, rnd.choice(["SUCCESS", "REJECT"]),
                     rnd.choice(["T1", "T2", "T3", "T9"])))
    txns = [(tid, ts.strftime("%Y-%m-%d %H:%M:%S"), card, amt, res, term)
            for tid, ts, card, amt, res, term in rows]
    rows = [(tid, dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S"), card,
             Decimal(amt) if amt is not None else None, res, term)
            for tid, t, card, amt, res, term in txns]
    expected = _model(rows)
    world = dict(cards=[("C1", "A1"), ("C2", "A1"), ("C3", "A1")], terminals=list(CITY.items()))
    for bucket in (3600, 4 * 3600, 86400):
        got = {r.trans_id: (r.ops_20m, r.prev_amt, r.prev_result, r.prev2_amt, r.prev2_result, r.city_hop, r.amount_probe)
               for r in flagged_rows(spark, txns, bucket_seconds=bucket, **world).collect()}
        assert got == {k: v[2:] for k, v in expected.items()}, bucket
        span = {r.trans_id: (r.city_min_1h, r.city_max_1h)
                for r in city_span(enrich(fact(spark, txns), **dims(spark, **world)), bucket).collect()}
        assert span == {k: v[:2] for k, v in expected.items()}, bucket
