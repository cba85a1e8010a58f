"""R1-R5 and W1-W5 on hand-made rows (FIXTURES.md part B)."""

from cardlake.schemas import (
    LABEL_AMOUNT_PROBE,
    LABEL_BAD_PASSPORT,
    LABEL_CITY_HOP,
)
from tests.world import flagged_rows, flags, report_rows

D = "2021-03-01"


def test_passport_expiring_on_the_day_counts_after_midnight(spark):
    f = flags(spark, [("t1", f"{D} 00:00:00", "C1", 10, "SUCCESS", "T1"),
                      ("t2", f"{D} 00:00:01", "C1", 10, "SUCCESS", "T1")],
              clients=[("K1", "A", "B", "C", "P1", D, "1")])
    assert f["t1"][0] is False
    assert f["t2"][0] is True


def test_blacklist_entry_after_the_event_still_flags(spark):
    f = flags(spark, [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1")],
              blacklist=[("2021-03-05", "P1")])
    assert f["t1"][0] is True


def test_blacklist_entry_without_date_does_not_flag(spark):
    f = flags(spark, [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1")],
              blacklist=[(None, "P1")])
    assert f["t1"][0] is False


def test_contract_expired(spark):
    f = flags(spark, [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1")],
              accounts=[("A1", "2021-02-28", "K1")])
    assert f["t1"][1] is True


def test_city_hop_hour_frame_is_inclusive(spark):
    f = flags(spark, [("a1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1"),
                      ("a2", f"{D} 11:00:00", "C1", 10, "SUCCESS", "T2"),
                      ("b1", f"{D} 10:00:00", "C2", 10, "SUCCESS", "T1"),
                      ("b2", f"{D} 11:00:01", "C2", 10, "SUCCESS", "T2")],
              cards=[("C1", "A1"), ("C2", "A1")])
    assert (f["a1"][2], f["a2"][2]) == (False, True)
    assert (f["b1"][2], f["b2"][2]) == (False, False)


def test_unknown_terminal_city_is_ignored(spark):
    f = flags(spark, [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1"),
                      ("t2", f"{D} 10:10:00", "C1", 10, "SUCCESS", "T9")])
    assert f["t2"][2] is False


def test_same_timestamp_peers_both_hop(spark):
    f = flags(spark, [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1"),
                      ("t2", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T2")])
    assert f["t1"][2] is True and f["t2"][2] is True


def _probe(spark, amounts, results, minutes):
    rows = [(f"t{i}", f"{D} 10:{m:02d}:00", "C1", a, r, "T1")
            for i, (a, r, m) in enumerate(zip(amounts, results, minutes))]
    return {k: v[3] for k, v in flags(spark, rows).items()}


def test_probe_exact_count(spark):
    p = _probe(spark, [400, 300, 200, 100], ["REJECT"] * 3 + ["SUCCESS"], [0, 5, 10, 15])
    assert p == {"t0": False, "t1": False, "t2": False, "t3": True}


def test_probe_needs_more_than_three(spark):
    p = _probe(spark, [300, 200, 100], ["REJECT", "REJECT", "SUCCESS"], [0, 5, 10])
    assert not any(p.values())


def test_probe_amounts_strictly_falling(spark):
    p = _probe(spark, [400, 300, 200, 200], ["REJECT"] * 3 + ["SUCCESS"], [0, 5, 10, 15])
    assert not any(p.values())


def test_probe_count_includes_peers_lags_reach_back(spark):
    rows = [("t1", f"{D} 08:00:00", "C1", 300, "REJECT", "T1"),
            ("t2", f"{D} 09:00:00", "C1", 200, "REJECT", "T1"),
            ("t3", f"{D} 10:00:00", "C1", 100, "SUCCESS", "T1"),
            ("t4", f"{D} 10:00:00", "C1", 90, "SUCCESS", "T1"),
            ("t5", f"{D} 10:00:00", "C1", 80, "SUCCESS", "T1"),
            ("t6", f"{D} 10:00:00", "C1", 70, "SUCCESS", "T1")]
    p = {k: v[3] for k, v in flags(spark, rows).items()}
    assert [k for k, v in sorted(p.items()) if v] == ["t3"]


def test_report_priority_first_rule_wins(spark):
    rows = [("t0", f"{D} 10:00:00", "C1", 400, "REJECT", "T1"),
            ("t1", f"{D} 10:05:00", "C1", 300, "REJECT", "T1"),
            ("t2", f"{D} 10:10:00", "C1", 200, "REJECT", "T2"),
            ("t3", f"{D} 10:15:00", "C1", 100, "SUCCESS", "T1")]
    f = flags(spark, rows, clients=[("K1", "A", "B", "C", "P1", "2020-01-01", "1")],
              accounts=[("A1", "2020-01-01", "K1")])
    assert f["t3"] == (True, True, True, True)
    rep = report_rows(spark, rows, clients=[("K1", "A", "B", "C", "P1", "2020-01-01", "1")],
                      accounts=[("A1", "2020-01-01", "K1")])
    assert [r.event_type for r in rep] == [LABEL_BAD_PASSPORT]


def test_report_is_distinct(spark):
    rows = [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1"),
            ("t2", f"{D} 12:00:00", "C1", 20, "SUCCESS", "T1")]
    rep = report_rows(spark, rows, blacklist=[("2021-01-01", "P1")])
    assert len(rep) == 1
    r = rep[0]
    assert (str(r.event_dt), r.passport, r.fio, r.phone, str(r.report_dt)) == \
        (D, "P1", "Ivanov Ivan Ivanovich", "+100", "2021-03-10")


def test_report_labels_city_hop_and_probe(spark):
    rows = [("t0", f"{D} 10:00:00", "C1", 400, "REJECT", "T1"),
            ("t1", f"{D} 10:05:00", "C1", 300, "REJECT", "T1"),
            ("t2", f"{D} 10:10:00", "C1", 200, "REJECT", "T1"),
            ("t3", f"{D} 10:15:00", "C1", 100, "SUCCESS", "T1"),
            ("u1", "2021-03-02 10:00:00", "C1", 5, "SUCCESS", "T1"),
            ("u2", "2021-03-02 10:30:00", "C1", 5, "SUCCESS", "T2")]
    labels = sorted((str(r.event_dt), r.event_type) for r in report_rows(spark, rows))
    assert labels == [(D, LABEL_AMOUNT_PROBE), ("2021-03-02", LABEL_CITY_HOP)]


def test_null_name_part_keeps_its_space(spark):
    rows = [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1")]
    rep = report_rows(spark, rows, clients=[("K1", "A", None, "C", "P1", "2020-01-01", "1")])
    assert rep[0].fio == "A  C"


def test_transaction_without_client_gets_blank_name(spark):
    rows = [("t1", f"{D} 10:00:00", "C9", 10, "SUCCESS", "T1"),
            ("t2", f"{D} 10:10:00", "C9", 10, "SUCCESS", "T2")]
    rep = report_rows(spark, rows)
    assert [(r.passport, r.fio) for r in rep] == [(None, "  ")]


def test_fan_out_is_kept_before_counting(spark):
    rows = [("t1", f"{D} 10:00:00", "C1", 10, "SUCCESS", "T1"),
            ("t2", f"{D} 10:10:00", "C1", 10, "SUCCESS", "T1")]
    out = flagged_rows(spark, rows, blacklist=[("2021-01-01", "P1"), ("2021-01-02", "P1")])
    got = sorted((r.trans_id, r.ops_20m) for r in out.collect())
    assert len(got) == 4
    assert [c for t, c in got if t == "t2"] == [4, 4]
