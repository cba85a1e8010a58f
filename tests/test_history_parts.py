"""Histories kept in parts: a date writes the keys that it touches, and every date reads as if it were written whole."""

import datetime as dt
import random

import pytest

from cardlake.operators import scd2
from cardlake.plans import daily
from cardlake.plans.daily import Warehouse
from tests.test_scd2 import stored

SPEC = scd2.TERMINALS
SCHEMA = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"
DAYS = [dt.date(2024, 1, d) for d in range(1, 13)]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _staging(spark, cities):
    return spark.createDataFrame([(k, "POS", c, "x") for k, c in cities.items()], SCHEMA)


def test_parts_read_as_whole_histories(spark, tmp_root):
    """Twelve dates with few changes, deletes and returns, one without any; every date's history as of then, at the end."""
    rnd = random.Random(3)
    cities = {str(k): "A" for k in range(400)} | {None: "A"}
    wh = Warehouse(spark, tmp_root + "/wh")
    batch, want, prev, sizes = wh.batch(), {}, None, {}
    for n, day in enumerate(DAYS):
        if n not in (0, 4):
            for k in rnd.sample(range(400), rnd.choice([1, 3, 20])):
                if rnd.random() < 0.3 and str(k) in cities:
                    del cities[str(k)]
                else:
                    cities[str(k)] = rnd.choice("ABC")
        s = _staging(spark, cities)
        whole = stored(scd2.scd2_apply(daily.empty(spark, SPEC.table).select(SPEC.columns) if prev is None else
                                       spark.read.parquet(f"{tmp_root}/{prev}"), s, day, SPEC), f"{tmp_root}/{day}")
        want[day] = _rows(whole)
        batch.load_dim("terminals", day, s, prev, hot_rows=2 if n % 3 == 2 else scd2.HOT_ROWS)
        sizes[day], prev = batch.entries[(str(day), "dim/terminals", "")], day
    batch.publish()
    again = Warehouse(spark, tmp_root + "/wh")
    for day in DAYS:
        assert _rows(again.read_dim("terminals", day)) == want[day]
    assert sizes[DAYS[4]].folders == sizes[DAYS[3]].folders  # no key touched: no part
    for e in sizes.values():
        assert all(2 * b <= a for a, b in zip(e.sizes, e.sizes[1:], strict=False)), e.sizes
    # the first part is never written again for these few changes
    assert len({e.folders[0] for e in sizes.values()}) == 1
    assert max(len(e.folders) for e in sizes.values()) > 2


@pytest.mark.parametrize("hot_rows", [0, 1, 1000])
def test_touched_rows_are_those_of_altered_keys(spark, tmp_root, hot_rows):
    before = {str(k): "A" for k in range(20)}
    h = stored(scd2.initial_history(_staging(spark, before), DAYS[0], SPEC), tmp_root + "/h")
    after = {k: c for k, c in before.items() if k not in ("3", "4")} | {"5": "B", "20": "C", None: "Z"}
    s = stored(_staging(spark, after), tmp_root + "/s")
    touched = scd2.scd2_apply(h, s, DAYS[1], SPEC, hot_rows, touched_only=True)
    assert {r.terminal_id for r in touched.collect()} == {"3", "4", "5", "20"}
    whole = _rows(scd2.scd2_apply(h, s, DAYS[1], SPEC, hot_rows))
    assert _rows(touched) == [r for r in whole if r[0] in ("3", "4", "5", "20")]
    assert _rows(scd2.merged(h, touched, SPEC, several=False)) == whole


def test_vacuum_removes_what_no_commit_names(spark, tmp_root):
    wh = Warehouse(spark, tmp_root + "/wh")
    assert wh.vacuum(0) == []
    cities = {str(k): "A" for k in range(50)}
    wh.load_dim("terminals", DAYS[0], _staging(spark, cities))
    wh.load_dim("terminals", DAYS[1], _staging(spark, cities | {"7": "B"}), DAYS[0])
    wh.load_dim("terminals", DAYS[1], _staging(spark, cities | {"8": "B"}), DAYS[0])  # again: the part with key 7 is replaced
    lost = wh.batch()
    lost.load_dim("terminals", DAYS[2], _staging(spark, cities), DAYS[1])             # never published
    want = {d: _rows(wh.read_dim("terminals", d)) for d in DAYS[:2]}
    assert wh.vacuum(24) == []
    gone = wh.vacuum(0)
    assert sum(g.startswith("dim/") for g in gone) == 2 and sum(g.startswith("commits/") for g in gone) == 2
    again = Warehouse(spark, tmp_root + "/wh")
    assert {d: _rows(again.read_dim("terminals", d)) for d in DAYS[:2]} == want
    assert again.vacuum(0) == []
