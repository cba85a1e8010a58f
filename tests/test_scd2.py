"""Hand-made cases, the three-day fixture sequence, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardlake.operators import scd2
from cardlake.plans import fixtures as fx
from cardlake.plans.queries import _staged_day
from tests.conftest import SF_SMALL

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
OPEN = dt.datetime(3000, 1, 1)


def stored(df, path):
    """Histories are read from storage, as in the daily run."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _terms(spark, rows):
    return spark.createDataFrame(rows, "terminal_id string, terminal_type string, "
                                       "terminal_city string, terminal_address string")


def _apply_days(spark, snapshots, root, spec=scd2.TERMINALS):
    hist = None
    for n, (day, rows) in enumerate(snapshots):
        s = _terms(spark, rows)
        hist = stored(scd2.initial_history(s, day, spec) if hist is None else scd2.scd2_apply(hist, s, day, spec), f"{root}/{n}")
    return sorted(hist.collect(), key=lambda r: (r.terminal_id, r.effective_from))


def test_delete_flags_and_closes(spark, tmp_root):
    h = _apply_days(spark, [(D1, [("1", "POS", "A", "x"), ("2", "POS", "B", "y")]),
                            (D2, [("1", "POS", "A", "x")])], root=tmp_root)
    gone = [r for r in h if r.terminal_id == "2"]
    assert len(gone) == 1 and gone[0].deleted_flg is True
    assert gone[0].effective_to == dt.datetime(2024, 1, 2)


def test_returning_key_starts_on_batch_date(spark, tmp_root):
    h = _apply_days(spark, [(D1, [("1", "POS", "A", "x")]), (D2, []),
                            (D3, [("1", "POS", "A", "x")])], root=tmp_root)
    assert [(r.effective_from, r.effective_to, r.deleted_flg) for r in h] == [
        (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), True),
        (dt.datetime(2024, 1, 3), OPEN, False)]


def test_null_to_value_is_a_change_and_stable_after(spark, tmp_root):
    h = _apply_days(spark, [(D1, [("1", "POS", "A", None)]), (D2, [("1", "POS", "A", "addr")]),
                            (D3, [("1", "POS", "A", "addr")])], root=tmp_root)
    assert [(r.terminal_address, r.effective_from, r.effective_to) for r in h] == [
        (None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)),
        ("addr", dt.datetime(2024, 1, 2), OPEN)]


def test_flag_mode_changed_version_uses_update_dt(spark, tmp_root):
    s1 = spark.createDataFrame([("A1", "K1", dt.datetime(2023, 1, 1), None)],
                               "account_num string, client string, create_dt timestamp, "
                               "update_dt timestamp").withColumn("valid_to", F.lit(None).cast("date"))
    s2 = s1.withColumn("update_dt", F.lit("2024-01-02 08:00:00").cast("timestamp")) \
        .withColumn("client", F.lit("K2"))
    h1 = stored(scd2.initial_history(s1, D1, scd2.ACCOUNTS), tmp_root + "/1")
    h2 = stored(scd2.scd2_apply(h1, s2, D2, scd2.ACCOUNTS), tmp_root + "/2")
    h3 = scd2.scd2_apply(h2, s2, D3, scd2.ACCOUNTS)   # same row again: no new version
    rows = sorted(h3.collect(), key=lambda r: r.effective_from)
    assert [(r.client, r.effective_from, r.effective_to) for r in rows] == [
        ("K1", dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 2, 8)),
        ("K2", dt.datetime(2024, 1, 2, 8), OPEN)]


def test_null_keys_are_not_loaded(spark, tmp_root):
    h = _apply_days(spark, [(D1, [(None, "POS", "A", "x"), ("1", "POS", "A", "x")]),
                            (D2, [(None, "POS", "A", "x"), ("1", "POS", "A", "x")])], root=tmp_root)
    assert [r.terminal_id for r in h] == ["1"]


def _stats(df):
    r = df.agg(F.count("*").alias("n"),
               F.sum(F.col("deleted_flg").cast("int")).alias("deleted"),
               F.sum(((F.col("effective_to") == scd2.open_end()) & ~F.col("deleted_flg"))
                     .cast("int")).alias("current")).first()
    return r.n, r.deleted or 0, r.current


# FIXTURES.md part D, measured with the five-step plan
EXPECTED = {
    "terminals": [(9, 0, 9), (11, 1, 9), (12, 2, 9)],
    "clients": [(135, 0, 135), (167, 15, 135), (182, 32, 135)],
}


@pytest.mark.parametrize("name", ["terminals", "clients", "accounts", "cards"])
def test_three_day_sequence(spark, tmp_root, name):
    t = fx.Tables(spark, SF_SMALL)
    spec = scd2.SPECS[name]
    k = spec.key
    hist = None
    for i, day in enumerate(fx.DAYS):
        s = _staged_day(t, name, day)
        hist = scd2.initial_history(s, day, spec) if hist is None else scd2.scd2_apply(hist, s, day, spec)
        hist = stored(hist, f"{tmp_root}/{i}")
        stats = _stats(hist)
        expected = EXPECTED.get(name, EXPECTED["clients"])[i]
        assert stats == expected, (name, day, stats)
        # invariants: one current row per staged key, no repeated (key, from),
        # deleted rows closed, live keys = staged keys
        cur = scd2.dim_current(hist)
        assert cur.groupBy(k).count().where("count > 1").count() == 0
        assert cur.select(k).exceptAll(s.select(k)).count() == 0
        assert s.select(k).exceptAll(cur.select(k)).count() == 0
        assert hist.groupBy(k, "effective_from").count().where("count > 1").count() == 0
        assert hist.where(F.col("deleted_flg") & (F.col("effective_to") == scd2.open_end())).count() == 0
        # re-running the same date changes nothing
        again = scd2.scd2_apply(hist, s, day, spec)
        assert again.exceptAll(hist).count() == 0 and hist.exceptAll(again).count() == 0


def window_restitch(history, spec):
    """The definition, as a window over each key's rows."""
    order = ", ".join(["effective_from ASC NULLS LAST", *[f"{a} ASC NULLS FIRST" for a in spec.attrs],
                       "deleted_flg ASC NULLS FIRST", "effective_to ASC NULLS FIRST"])
    end = f"coalesce(nxt, {scd2.OPEN})"
    return history.selectExpr("*", f"lead(effective_from) OVER (PARTITION BY {spec.key} ORDER BY {order}) AS nxt").selectExpr(
        spec.key, *spec.attrs, "effective_from",
        f"CASE WHEN {spec.key} IS NULL OR effective_from IS NULL THEN effective_to WHEN deleted_flg THEN least(effective_to, {end}) "
        f"ELSE {end} END AS effective_to", "deleted_flg")


def test_plan_has_no_window_over_a_keys_rows(spark, tmp_root):
    t = fx.Tables(spark, SF_SMALL)
    h1 = stored(scd2.initial_history(_staged_day(t, "clients", D1), D1, scd2.CLIENTS), tmp_root + "/h1")
    # the way of keys with more than HOT_ROWS rows; those of up to HOT_ROWS are a window's work
    df = scd2.restitch(scd2._classified(h1, _staged_day(t, "clients", D2), D2, scd2.CLIENTS).drop("_kind"), scd2.CLIENTS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # distinct starts within a day, and days: never the rows themselves
    assert windows and all("_first" in w or "_day" in w for w in windows)
