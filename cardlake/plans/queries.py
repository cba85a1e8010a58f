"""Registered queries: one per operator id of the inventory.

Each takes ``(spark, sf_dir)``, derives its inputs from the driver tables with
``plans.fixtures`` and returns a DataFrame rendered by ``present.for_check``.
``plans.oracle`` has the DuckDB SQL of each key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions.scalar import EVENT_DAY_SQL, FULL_NAME_SQL, date_token
from cardlake.operators import scd2
from cardlake.operators.enrich import card_profile, enrich
from cardlake.operators.report import flagged, fraud_report
from cardlake.operators.rules import RULES
from cardlake.operators.windows import LAGS, city_span, with_windows
from cardlake.plans import fixtures as fx
from cardlake.plans.daily import Warehouse, run, stage
from cardlake.plans.present import for_check
from cardlake.schemas import conform
from cardlake.session import scratch_dir
from cardlake.sources import files, staging

Query = Callable[[SparkSession, str], DataFrame]
D1, D2, D3 = fx.DAYS


# -- shared derivations -------------------------------------------------------

def _part_c_dims(t: fx.Tables):
    """Part C snapshots as loaded dimension tables: every staged row is the
    current version (the history a first batch writes; the SCD2 keys and the
    daily run cover how it is built)."""
    return dict(
        cards_hist=scd2.as_current(staging.stage_cards(fx.cards_snapshot(t)), scd2.CARDS),
        accounts_hist=scd2.as_current(staging.stage_accounts(fx.accounts_snapshot(t)),
                                      scd2.ACCOUNTS),
        clients_hist=scd2.as_current(staging.stage_clients(fx.clients_snapshot(t)), scd2.CLIENTS),
        terminals_hist=scd2.as_current(staging.stage_terminals(fx.terminals_snapshot(t)),
                                       scd2.TERMINALS),
        blacklist=staging.to_blacklist_fact(staging.stage_blacklist(fx.blacklist_snapshot(t))),
    )


def _enriched(t: fx.Tables) -> DataFrame:
    return enrich(fx.fact_transactions(t), **_part_c_dims(t))


def _skewed_fact(t: fx.Tables, card: str) -> DataFrame:
    """Two thirds of all transactions on one card (``card`` is its SQL text)."""
    f = fx.fact_transactions(t)
    return f.withColumn("card_num", F.expr(f"CASE WHEN CAST(trans_id AS BIGINT) % 3 <> 0 THEN {card} ELSE card_num END"))


_DAY_STAGERS = {
    "clients": (fx.clients_day, staging.stage_clients),
    "accounts": (fx.accounts_day, staging.stage_accounts),
    "cards": (fx.cards_day, staging.stage_cards),
    "terminals": (fx.terminals_day, staging.stage_terminals),
}


def _staged_day(t: fx.Tables, name: str, day) -> DataFrame:
    snap, stager = _DAY_STAGERS[name]
    return stager(snap(t, day))


def _history_after(t: fx.Tables, name: str, days, staged=_staged_day, hot_rows: int = scd2.HOT_ROWS) -> DataFrame:
    """The history after the given dates, each date's snapshot written and read back as the daily run does."""
    wh = Warehouse(t.spark, scratch_dir(t.spark, f"history-{name}")).batch()
    prev = None
    for day in days:
        wh.load_dim(name, day, staged(t, name, day), prev, hot_rows)
        prev = day
    return wh.read_dim(name, prev)


def _names_from_events(t: fx.Tables) -> DataFrame:
    """File names a landing folder would hold, one trio per event's calendar day,
    plus names that must be ignored (no prefix)."""
    day = F.to_date(F.col("ts").cast("timestamp"))
    tok = date_token(day)
    names = F.array(
        F.concat(F.lit("passport_blacklist_"), tok, F.lit(".xlsx")),
        F.concat(F.lit("terminals_"), tok, F.lit(".xlsx")),
        F.concat(F.lit("transactions_"), tok, F.lit(".txt")),
        F.concat(F.lit("readme_"), tok, F.lit(".txt")),
    )
    return t("events").select(F.explode(names).alias("file_name"))


# -- sources / staging --------------------------------------------------------

def q_daily_dates(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    d = files.daily_dates(_names_from_events(t))
    return for_check(d.select(F.col("file_dt").alias("load_dt"), date_token("file_dt").alias("file_token")))


def q_stage_accounts(spark, sf_dir):
    return for_check(staging.stage_accounts(fx.accounts_snapshot(fx.Tables(spark, sf_dir))))


def q_stage_clients(spark, sf_dir):
    return for_check(staging.stage_clients(fx.clients_snapshot(fx.Tables(spark, sf_dir))))


def q_stage_cards(spark, sf_dir):
    return for_check(staging.stage_cards(fx.cards_snapshot(fx.Tables(spark, sf_dir))))


def q_stage_transactions(spark, sf_dir):
    return for_check(staging.stage_transactions(fx.transactions_text(fx.Tables(spark, sf_dir))))


def q_conform_schema(spark, sf_dir):
    """K1: transactions as a fact; orders' dates with fractions as staged accounts (timestamps to the second)."""
    t = fx.Tables(spark, sf_dir)
    acc = fx.fractional_accounts(t)
    return for_check(conform(fx.fact_transactions(t), "fact_transactions")
                     .selectExpr("trans_id AS id", "trans_date AS a", "CAST(NULL AS TIMESTAMP) AS b", "card_num", "oper_type", "amt")
                     .unionByName(conform(acc, "stg_accounts").selectExpr(
                         "concat('a', account_num) AS id", "create_dt AS a", "update_dt AS b", "client AS card_num",
                         "CAST(NULL AS STRING) AS oper_type", "CAST(NULL AS DECIMAL(18,2)) AS amt")))


def q_csv_scan(spark, sf_dir):
    """The transactions as a text file in the shared scratch folder, read back with the job's reader."""
    path = scratch_dir(spark, "csv_scan")
    fx.transactions_text(fx.Tables(spark, sf_dir)).write.option("sep", ";").option("header", True).csv(path)
    return for_check(files.read_transactions(spark, path).drop("file_dt"))


def q_staging_replace(spark, sf_dir):
    """K2: the second date's staging replaces the first one's."""
    t = fx.Tables(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "staging_replace"))
    for day in (D1, D2):
        wh.write_staging("stg_clients", _staged_day(t, "clients", day), day)
    return for_check(wh.read_staging("stg_clients"))


def q_rejected_rows(spark, sf_dir):
    """Q16: staged rows without a business key are counted, not loaded."""
    t = fx.Tables(spark, sf_dir)
    staged = {f"stg_{n}": _staged_day(t, n, D1) for n in _DAY_STAGERS}
    for n, digit in (("clients", 3), ("terminals", 2)):
        key = scd2.SPECS[n].key
        staged[f"stg_{n}"] = staged[f"stg_{n}"].withColumn(key, F.expr(f"CASE WHEN CAST({key} AS BIGINT) % 10 <> {digit} THEN {key} END"))
    wh = Warehouse(spark, scratch_dir(spark, "rejected_rows"))
    stage(wh, D1, {name: lambda df=df: df for name, df in staged.items()}, parallel=1)
    return for_check(wh.read_rejected())


def q_fact_append(spark, sf_dir):
    """K4: load day 1 and day 2, then day 2 again; the table holds each once."""
    t = fx.Tables(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "fact_append"))
    for day in (D1, D2, D2):
        wh.write_fact(day, staging.to_fact(staging.stage_transactions(fx.transactions_text(t, day))))
    return for_check(wh.read_fact())


def q_blacklist_refresh(spark, sf_dir):
    """K5: each date's file is the whole blacklist; a date reads its own."""
    t = fx.Tables(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "blacklist"))
    for day in (D1, D2):
        wh.write_blacklist(day, staging.to_blacklist_fact(staging.stage_blacklist(fx.blacklist_snapshot(t, up_to=day))))
    return for_check(wh.read_blacklist(D2))


def q_ledger_pending_files(spark, sf_dir):
    """K7: files of the first ten calendar days are in the ledger; the rest are pending."""
    t = fx.Tables(spark, sf_dir)
    listing = _names_from_events(t).distinct()
    loaded = files.input_files(listing).where(F.col("file_dt") < F.lit("2024-01-11").cast("date"))
    wh = Warehouse(spark, scratch_dir(spark, "ledger"))
    wh.write_ledger(D1, loaded)
    return for_check(files.pending_files(listing, wh.read_ledger()))


def q_ledger_redelivered(spark, sf_dir):
    """K7: as above, with lengths, times and digests; then the files of the 5th come again with other content, those of the 6th with the same."""
    t = fx.Tables(spark, sf_dir)
    found = files.input_files(_names_from_events(t).groupBy("file_name").agg(F.count("*").alias("length"))) \
        .selectExpr("file_name", "file_dt", "length", "cast(file_dt as timestamp) AS modified", "sha2(cast(length as string), 256) AS digest")
    wh = Warehouse(spark, scratch_dir(spark, "ledger"))
    wh.write_ledger(D1, found.where("file_dt < DATE'2024-01-11'").drop("file_dt"))
    now = found.selectExpr("file_name", "CASE WHEN file_dt = DATE'2024-01-05' THEN length + 1 ELSE length END AS length",
                           "CASE WHEN file_dt IN (DATE'2024-01-05', DATE'2024-01-06') THEN modified + INTERVAL 1 HOUR ELSE modified END AS modified") \
        .selectExpr("*", "sha2(cast(length as string), 256) AS digest")
    pending = files.pending_files(now, wh.read_ledger())
    return for_check(pending.join(files.unchanged(pending, wh.read_ledger()), "file_name", "left_anti").select("file_name", "file_dt"))


# -- SCD2 steps (clients / terminals, day 1 history + day 2 staging) ------------

def _day2_inputs(spark, sf_dir, name):
    t = fx.Tables(spark, sf_dir)
    return _history_after(t, name, [D1]), _staged_day(t, name, D2), scd2.SPECS[name]


def q_scd2_new_keys(spark, sf_dir):
    h, s, spec = _day2_inputs(spark, sf_dir, "clients")
    return for_check(scd2.new_keys(h, s, D2, spec))


def q_scd2_vanished_keys(spark, sf_dir):
    h, s, spec = _day2_inputs(spark, sf_dir, "clients")
    return for_check(scd2.vanished_keys(h, s, spec))


def q_scd2_soft_delete(spark, sf_dir):
    h, s, spec = _day2_inputs(spark, sf_dir, "clients")
    return for_check(scd2.soft_delete(h, s, D2, spec))


def q_scd2_changed_flagged(spark, sf_dir):
    h, s, spec = _day2_inputs(spark, sf_dir, "clients")
    return for_check(scd2.changed_flagged(h, s, D2, spec))


def q_scd2_changed_compared(spark, sf_dir):
    h, s, spec = _day2_inputs(spark, sf_dir, "terminals")
    return for_check(scd2.changed_compared(h, s, D2, spec))


def q_scd2_restitch(spark, sf_dir):
    """D5 alone: the three daily terminal snapshots stacked as versions starting
    on their day, then re-stitched into intervals."""
    t = fx.Tables(spark, sf_dir)
    spec = scd2.TERMINALS
    stacked = None
    for day in fx.DAYS:
        v = _staged_day(t, "terminals", day).select(
            *spec.columns[:-3],
            F.lit(str(day)).cast("timestamp").alias("effective_from"),
            scd2.open_end().alias("effective_to"),
            F.lit(False).alias("deleted_flg"))
        stacked = v if stacked is None else stacked.unionByName(v)
    return for_check(scd2.restitch(stacked, spec))


def _q_day2(name):
    def q(spark, sf_dir):
        return for_check(_history_after(fx.Tables(spark, sf_dir), name, [D1, D2]))
    q.__name__ = f"q_scd2_{name}_day2"
    return q


def q_scd2_hot_key(spark, sf_dir):
    """D6 with two thirds of all staged rows on one key and some on none, over two dates; keys of over 32 rows count as hot."""
    def staged(t, name, day):
        key = "CAST(client_id AS BIGINT) % 9"
        return _staged_day(t, name, day).withColumn("client_id", F.expr(
            f"CASE WHEN {key} < 6 THEN '7' WHEN {key} = 6 THEN CAST(NULL AS STRING) ELSE client_id END"))
    return for_check(_history_after(fx.Tables(spark, sf_dir), "clients", [D1, D2], staged, hot_rows=32))


def q_dim_current(spark, sf_dir):
    """D8 over the clients history after all three days."""
    t = fx.Tables(spark, sf_dir)
    return for_check(scd2.dim_current(_history_after(t, "clients", fx.DAYS)))


# -- joins, windows, rules, scalars ---------------------------------------------

def q_txn_enriched(spark, sf_dir):
    e = _enriched(fx.Tables(spark, sf_dir))
    return for_check(e.select("trans_id", "card_num", "amt", "terminal_city", "account_num",
                              "valid_to", "client_id", "fio", "passport_num",
                              "passport_valid_to", "phone", "black_list_dt"))


def q_txn_enriched_deduped(spark, sf_dir):
    """J3, J9 with ``dedupe``: every fifth account, terminal and client has a second current version, every passport a second entry."""
    t = fx.Tables(spark, sf_dir)
    d = _part_c_dims(t)
    twice = lambda df, key, **changed: df.unionByName(
        df.where(f"CAST({key} AS BIGINT) % 5 = 0").withColumns({c: F.expr(sql) for c, sql in changed.items()}))
    d["accounts_hist"] = twice(d["accounts_hist"], "account_num", valid_to="date_sub(valid_to, 30)", effective_from="effective_from + INTERVAL 1 DAY")
    d["terminals_hist"] = twice(d["terminals_hist"], "terminal_id", terminal_city="'CITY_Z'")
    d["clients_hist"] = twice(d["clients_hist"], "client_id", phone="concat(phone, '0')")
    d["blacklist"] = d["blacklist"].unionByName(d["blacklist"].withColumn("entry_dt", F.expr("date_add(entry_dt, 1)")))
    return for_check(enrich(fx.fact_transactions(t), **d, dedupe=True).select(
        "trans_id", "card_num", "terminal_city", "account_num", "valid_to", "client_id", "fio", "passport_num", "phone", "black_list_dt"))


def q_blacklist_fanout(spark, sf_dir):
    """A card's profile has a row for each blacklist entry of its client's passport."""
    d = _part_c_dims(fx.Tables(spark, sf_dir))
    prof = card_profile(d["cards_hist"], d["accounts_hist"], d["clients_hist"], d["blacklist"])
    return for_check(prof.select("card_num", "client_id", "passport_num", "black_list_dt"))


def q_win_city_span_1h(spark, sf_dir):
    return for_check(city_span(_enriched(fx.Tables(spark, sf_dir)))
                     .select("trans_id", "card_num", "city_min_1h", "city_max_1h"))


def q_win_count_20m(spark, sf_dir):
    return for_check(with_windows(_enriched(fx.Tables(spark, sf_dir))).select("trans_id", "card_num", "ops_20m"))


def q_win_lag12(spark, sf_dir):
    return for_check(with_windows(_enriched(fx.Tables(spark, sf_dir))).select("trans_id", "card_num", *LAGS))


def _q_rule(rule):
    def q(spark, sf_dir):
        t = fx.Tables(spark, sf_dir)
        return for_check(flagged(fx.fact_transactions(t), **_part_c_dims(t)).select("trans_id", "card_num", rule))
    q.__name__ = f"q_rule_{rule}"
    return q


def q_scalar_full_name(spark, sf_dir):
    c = staging.stage_clients(fx.clients_snapshot(fx.Tables(spark, sf_dir)))
    return for_check(c.selectExpr("client_id", f"{FULL_NAME_SQL} AS fio"))


def q_scalar_event_day(spark, sf_dir):
    f = fx.fact_transactions(fx.Tables(spark, sf_dir))
    return for_check(f.selectExpr("trans_id", f"{EVENT_DAY_SQL} AS event_dt"))


# -- report ---------------------------------------------------------------------

def q_fraud_report(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    return for_check(fraud_report(fx.fact_transactions(t), **_part_c_dims(t),
                                  report_dt=fx.REPORT_DT))


def _q_report_skewed(card):
    def q(spark, sf_dir):
        t = fx.Tables(spark, sf_dir)
        rows = flagged(_skewed_fact(t, card), **_part_c_dims(t))
        return for_check(rows.select("trans_id", "card_num", *RULES))
    return q


def q_scd2_out_of_order(spark, sf_dir):
    """Day 2 first, then days 1 and 3; the history is that of the dates in order."""
    src = fx.FixtureSource(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "out_of_order"))
    run(spark, src, wh, dates=[D2])
    run(spark, src, wh, dates=[D1, D3], rebuild_later=True)
    return for_check(wh.read_dim("clients", D3))


def q_scd2_touched_part(spark, sf_dir):
    """The part of the terminals' history that day 2 adds, which has the touched keys only."""
    t = fx.Tables(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "touched_part")).batch()
    wh.load_dim("terminals", D1, _staged_day(t, "terminals", D1))
    wh.load_dim("terminals", D2, _staged_day(t, "terminals", D2), D1)
    return for_check(wh.read_dim_part("terminals", D2))


def q_scd2_rebuild_archived(spark, sf_dir):
    """The dates in order, then day 2 again and day 3 rebuilt, from a source that has only today's operational tables."""
    src = fx.TodaySource(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "rebuild_archived"))
    for src.today in fx.DAYS:
        run(spark, src, wh, dates=[src.today])
    run(spark, src, wh, dates=[D2], rebuild_later=True)
    return for_check(wh.read_dim("clients", D3))


def q_empty_rerun(spark, sf_dir):
    """K4-K6, Q11, Q19: day 2 is loaded with its data, then again with transactions and blacklist empty: rows of each table and date."""
    src = fx.FixtureSource(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "empty_rerun"))
    run(spark, src, wh, dates=[D1, D2])
    src.without = {D2}
    run(spark, src, wh, dates=[D2])
    n = F.count("*").alias("n_rows")
    counted = [df.groupBy(F.col(day).alias("day")).agg(n).withColumn("table_name", F.lit(name)) for name, day, df in (
        ("fact", "load_dt", wh.read_fact()), ("blacklist_day2", "entry_dt", wh.read_blacklist(D2)),
        ("blacklist_day1", "entry_dt", wh.read_blacklist(D1)))]
    report = wh.read_report().where(F.col("report_dt") == F.lit(str(D2)).cast("date")).groupBy(F.col("event_dt").alias("day")).agg(n)
    return for_check(reduce(DataFrame.unionByName, [*counted, report.withColumn("table_name", F.lit("report_day2"))]))


def q_fraud_report_accumulated(spark, sf_dir):
    """R6 + K6: three daily batches through the warehouse; the report table."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"))
    run(spark, fx.FixtureSource(spark, sf_dir), wh)
    return for_check(wh.read_report())


def q_fraud_report_day(spark, sf_dir):
    """R5, R6 with scope "day": three daily batches, each reporting its own operations from card tails."""
    wh = Warehouse(spark, scratch_dir(spark, "day_scope"))
    run(spark, fx.FixtureSource(spark, sf_dir), wh, scope="day")
    return for_check(wh.read_report())


QUERIES: dict[str, Query] = {
    "daily_dates": q_daily_dates,
    "stage_accounts": q_stage_accounts,
    "stage_clients": q_stage_clients,
    "stage_cards": q_stage_cards,
    "stage_transactions": q_stage_transactions,
    "conform_schema": q_conform_schema,
    "csv_scan": q_csv_scan,
    "staging_replace": q_staging_replace,
    "rejected_rows": q_rejected_rows,
    "fact_append": q_fact_append,
    "blacklist_refresh": q_blacklist_refresh,
    "ledger_pending_files": q_ledger_pending_files,
    "ledger_redelivered": q_ledger_redelivered,
    "scd2_new_keys": q_scd2_new_keys,
    "scd2_vanished_keys": q_scd2_vanished_keys,
    "scd2_soft_delete": q_scd2_soft_delete,
    "scd2_changed_flagged": q_scd2_changed_flagged,
    "scd2_changed_compared": q_scd2_changed_compared,
    "scd2_restitch": q_scd2_restitch,
    "scd2_clients_day2": _q_day2("clients"),
    "scd2_accounts_day2": _q_day2("accounts"),
    "scd2_cards_day2": _q_day2("cards"),
    "scd2_terminals_day2": _q_day2("terminals"),
    "scd2_hot_key": q_scd2_hot_key,
    "scd2_out_of_order": q_scd2_out_of_order,
    "scd2_rebuild_archived": q_scd2_rebuild_archived,
    "scd2_touched_part": q_scd2_touched_part,
    "empty_rerun": q_empty_rerun,
    "dim_current": q_dim_current,
    "txn_enriched": q_txn_enriched,
    "txn_enriched_deduped": q_txn_enriched_deduped,
    "blacklist_fanout": q_blacklist_fanout,
    "win_city_span_1h": q_win_city_span_1h,
    "win_count_20m": q_win_count_20m,
    "win_lag12": q_win_lag12,
    "rule_passport": _q_rule("bad_passport"),
    "rule_contract": _q_rule("bad_contract"),
    "rule_city_hop": _q_rule("city_hop"),
    "rule_amount_probe": _q_rule("amount_probe"),
    "report_hot_card": _q_report_skewed("'7'"),
    "report_null_card": _q_report_skewed("CAST(NULL AS STRING)"),
    "scalar_full_name": q_scalar_full_name,
    "scalar_event_day": q_scalar_event_day,
    "fraud_report": q_fraud_report,
    "fraud_report_accumulated": q_fraud_report_accumulated,
    "fraud_report_day": q_fraud_report_day,
}
