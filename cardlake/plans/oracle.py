"""DuckDB SQL for every registered query (the correctness oracle).

The same fixture recipes as ``plans.fixtures``, written as CTEs over the
driver's views, and the warehouse logic written the way a relational
database would run it: SCD2 as anti/semi/inner joins (the Spark side uses one
keyed window plan), the rules by joining each operation with its card's
earlier ones (the Spark side uses running aggregates). Output columns
are rendered like ``present.for_check``: dates and timestamps as text,
decimals as doubles.
"""

from __future__ import annotations

from cardlake.operators.scd2 import COMPARE, SPECS, Scd2Spec
from cardlake.plans import fixtures as fx
from cardlake.schemas import (
    LABEL_AMOUNT_PROBE,
    LABEL_BAD_CONTRACT,
    LABEL_BAD_PASSPORT,
    LABEL_CITY_HOP,
    OPEN_END_SQL,
)

OPEN = f"TIMESTAMP '{OPEN_END_SQL}'"
DAYS = [str(d) for d in fx.DAYS]


def _d(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {alias or c.split('.')[-1]}"


def _ts(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or c.split('.')[-1]}"


def _dbl(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c.split('.')[-1]}"


def _k(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


# ---------------------------------------------------------------------------
# Fixture CTEs (FIXTURES.md part C)
# ---------------------------------------------------------------------------

_TERMINAL_EXPR = (f"CASE WHEN event_id % 50 = 7 THEN '-1' "
                  f"WHEN event_id % 12 = 0 THEN {_k('event_id % 13')} "
                  f"ELSE {_k('user_id % 9')} END")

PART_C = {
    "fx_fact": f"""
        SELECT {_k('event_id')} AS trans_id,
               make_timestamp({fx.EPOCH_US} + (epoch_us(ts) - {fx.EPOCH_US}) // {fx.TIME_COMPRESSION}) AS trans_date,
               {_k('user_id')} AS card_num,
               event_type AS oper_type,
               CAST(value AS DECIMAL(18,2)) AS amt,
               CASE WHEN event_type IN ('error', 'signup') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
               {_TERMINAL_EXPR} AS terminal
        FROM events""",
    "fx_cards": f"""
        SELECT {_k('c_custkey')} AS card_num, {_k('c_custkey')} AS account_num,
               TIMESTAMP '{fx.CREATE_DT}' AS create_dt, CAST(NULL AS TIMESTAMP) AS update_dt
        FROM customer""",
    "fx_accounts": f"""
        SELECT {_k('c_custkey')} AS account_num,
               DATE '{fx.VALID_BASE}' + CAST((c_custkey * 7) % 60 AS INTEGER) AS valid_to,
               {_k('c_custkey')} AS client,
               TIMESTAMP '{fx.CREATE_DT}' AS create_dt, CAST(NULL AS TIMESTAMP) AS update_dt
        FROM customer""",
    "fx_clients": f"""
        SELECT {_k('c_custkey')} AS client_id, c_name AS last_name, c_mktsegment AS first_name,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'P' END AS patronymic,
               DATE '{fx.BIRTH_BASE}' + CAST((c_custkey * 13) % 18000 AS INTEGER) AS date_of_birth,
               'P' || {_k('c_custkey')} AS passport_num,
               DATE '{fx.VALID_BASE}' + CAST((c_custkey * 11) % 90 AS INTEGER) AS passport_valid_to,
               {_k('c_nationkey')} AS phone,
               TIMESTAMP '{fx.CREATE_DT}' AS create_dt, CAST(NULL AS TIMESTAMP) AS update_dt
        FROM customer WHERE c_custkey % 10 <> 9""",
    "fx_terminals": f"""
        SELECT {_k('s_suppkey')} AS terminal_id,
               CASE WHEN s_suppkey % 3 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
               'CITY_' || {_k('s_nationkey % 5')} AS terminal_city,
               s_name AS terminal_address
        FROM supplier""",
    "fx_blacklist": f"""
        SELECT DATE '2024-01-01' AS entry_dt, 'P' || {_k('c_custkey')} AS passport
        FROM customer WHERE c_custkey % 37 = 0
        UNION ALL
        SELECT DATE '2024-01-02' AS entry_dt, 'P' || {_k('c_custkey')} AS passport
        FROM customer WHERE c_custkey % 74 = 0""",
    # the daily text file: seconds, amount text with comma (point for id % 3 = 0)
    "fx_text": f"""
        SELECT CAST(trans_id AS BIGINT) AS transaction_id,
               strftime(trans_date, '%Y-%m-%d %H:%M:%S') AS transaction_date,
               CASE WHEN CAST(trans_id AS BIGINT) % 3 = 0 THEN CAST(amt AS VARCHAR)
                    ELSE replace(CAST(amt AS VARCHAR), '.', ',') END AS amount,
               card_num, oper_type, oper_result, terminal,
               CAST(trans_date AS DATE) AS trans_day
        FROM fx_fact""",
    "fx_stg_tx": """
        SELECT transaction_id, transaction_date,
               CAST(replace(trim(amount), ',', '.') AS DECIMAL(18,2)) AS amount,
               card_num, oper_type, oper_result, terminal, trans_day
        FROM fx_text""",
    "fx_fact_s": """
        SELECT CAST(transaction_id AS VARCHAR) AS trans_id,
               CAST(transaction_date AS TIMESTAMP) AS trans_date,
               card_num, oper_type, amount AS amt, oper_result, terminal, trans_day
        FROM fx_stg_tx""",
}


# ---------------------------------------------------------------------------
# Part D daily snapshots
# ---------------------------------------------------------------------------

def _drop(n: int, key: str) -> str:
    return f"{key} % 10 <> {fx.DROP_DIGIT[n]}"


def _chg(n: int, key: str) -> str:
    return f"({'TRUE' if n >= 2 else 'FALSE'} AND {key} % {fx.CHANGE_MOD} = {fx.CHANGE_REM})"


def _upd(n: int, key: str) -> str:
    return f"CASE WHEN {_chg(n, key)} THEN TIMESTAMP '{fx.CHANGE_DT}' END"


def part_d(n: int) -> dict[str, str]:
    k = "c_custkey"
    create = f"TIMESTAMP '{fx.CREATE_DT}' AS create_dt"
    valid = f"DATE '{fx.VALID_BASE}' + CAST((c_custkey * 7) % 60 AS INTEGER)"
    return {
        f"clients_d{n}": f"""
            SELECT {_k(k)} AS client_id, c_name AS last_name, c_mktsegment AS first_name,
                   CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'P' END AS patronymic,
                   DATE '{fx.BIRTH_BASE}' + CAST((c_custkey * 13) % 18000 AS INTEGER) AS date_of_birth,
                   'P' || {_k(k)} AS passport_num,
                   DATE '{fx.VALID_BASE}' + CAST((c_custkey * 11) % 90 AS INTEGER) AS passport_valid_to,
                   CASE WHEN {_chg(n, k)} THEN 'NEW' ELSE {_k('c_nationkey')} END AS phone,
                   {create}, {_upd(n, k)} AS update_dt
            FROM customer WHERE {_drop(n, k)}""",
        f"accounts_d{n}": f"""
            SELECT {_k(k)} AS account_num,
                   CASE WHEN {_chg(n, k)} THEN {valid} + 365 ELSE {valid} END AS valid_to,
                   {_k(k)} AS client, {create}, {_upd(n, k)} AS update_dt
            FROM customer WHERE {_drop(n, k)}""",
        f"cards_d{n}": f"""
            SELECT {_k(k)} AS card_num, {_k(k)} AS account_num, {create}, {_upd(n, k)} AS update_dt
            FROM customer WHERE {_drop(n, k)}""",
        f"terminals_d{n}": f"""
            SELECT {_k('s_suppkey')} AS terminal_id,
                   CASE WHEN s_suppkey % 3 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
                   CASE WHEN {_chg(n, 's_suppkey')} THEN 'CITY_X'
                        ELSE 'CITY_' || {_k('s_nationkey % 5')} END AS terminal_city,
                   s_name AS terminal_address
            FROM supplier WHERE {_drop(n, 's_suppkey')}""",
        f"blacklist_d{n}": f"SELECT * FROM fx_blacklist WHERE entry_dt <= DATE '{DAYS[n - 1]}'",
    }


# ---------------------------------------------------------------------------
# SCD2 in join form
# ---------------------------------------------------------------------------

def _empty_hist(spec: Scd2Spec, stg: str) -> str:
    cols = ", ".join([spec.key, *spec.attrs])
    return (f"SELECT {cols}, CAST(NULL AS TIMESTAMP) AS effective_from, "
            f"CAST(NULL AS TIMESTAMP) AS effective_to, CAST(NULL AS BOOLEAN) AS deleted_flg "
            f"FROM {stg} WHERE FALSE")


def scd2_steps(p: str, spec: Scd2Spec, hist: str, stg: str, as_of: str) -> dict[str, str]:
    """CTEs ``{p}_new``, ``{p}_gone``, ``{p}_kept``, ``{p}_changed``, ``{p}_result``."""
    k = spec.key
    attrs = ", ".join(spec.attrs)
    s_attrs = ", ".join(f"s.{a}" for a in spec.attrs)
    a_of = f"CAST(DATE '{as_of}' AS TIMESTAMP)"
    flag = spec.mode != COMPARE
    staged_from = "coalesce(s.update_dt, s.create_dt)" if flag else a_of
    new_from = f"CASE WHEN kn.{k} IS NOT NULL THEN {a_of} ELSE {staged_from} END" if flag else a_of
    ctes = {
        f"{p}_s": f"SELECT * FROM {stg} WHERE {k} IS NOT NULL",
        f"{p}_live": f"SELECT DISTINCT {k} FROM {hist} WHERE deleted_flg IS FALSE",
        f"{p}_known": f"SELECT DISTINCT {k} FROM {hist}",
        f"{p}_cur": f"SELECT * FROM {hist} WHERE effective_to = {OPEN} AND deleted_flg IS FALSE",
        f"{p}_new": f"""
            SELECT s.{k}, {s_attrs}, {new_from} AS effective_from, {OPEN} AS effective_to,
                   FALSE AS deleted_flg
            FROM {p}_s s LEFT JOIN {p}_known kn ON s.{k} = kn.{k}
            WHERE NOT EXISTS (SELECT 1 FROM {p}_live l WHERE l.{k} = s.{k})""",
        f"{p}_gone": f"""
            SELECT l.{k} FROM {p}_live l
            WHERE NOT EXISTS (SELECT 1 FROM {stg} s WHERE s.{k} = l.{k})""",
        f"{p}_kept": f"""
            SELECT h.{k}, {', '.join(f'h.{a}' for a in spec.attrs)}, h.effective_from,
                   CASE WHEN g.{k} IS NOT NULL AND h.effective_to = {OPEN} THEN {a_of}
                        ELSE h.effective_to END AS effective_to,
                   CASE WHEN g.{k} IS NOT NULL THEN TRUE ELSE h.deleted_flg END AS deleted_flg
            FROM {hist} h LEFT JOIN {p}_gone g ON h.{k} = g.{k}""",
    }
    if flag:
        ctes[f"{p}_changed"] = f"""
            SELECT s.{k}, {s_attrs}, {staged_from} AS effective_from, {OPEN} AS effective_to,
                   FALSE AS deleted_flg
            FROM {p}_s s
            JOIN (SELECT {k}, max(effective_from) AS cur_from FROM {p}_cur GROUP BY {k}) c
              ON s.{k} = c.{k}
            WHERE s.update_dt IS NOT NULL AND {staged_from} > c.cur_from"""
    else:
        same = " AND ".join(f"s.{a} IS NOT DISTINCT FROM c.{a}" for a in spec.attrs)
        ctes[f"{p}_changed"] = f"""
            SELECT s.{k}, {s_attrs}, {a_of} AS effective_from, {OPEN} AS effective_to,
                   FALSE AS deleted_flg
            FROM {p}_s s JOIN {p}_cur c ON s.{k} = c.{k}
            WHERE NOT ({same})"""
    ctes[f"{p}_union"] = (f"SELECT * FROM {p}_kept UNION ALL SELECT * FROM {p}_new "
                          f"UNION ALL SELECT * FROM {p}_changed")
    ctes[f"{p}_result"] = restitch_sql(f"{p}_union", spec)
    return ctes


def restitch_sql(src: str, spec: Scd2Spec) -> str:
    k = spec.key
    attrs = ", ".join(spec.attrs)
    order = ", ".join(["effective_from ASC NULLS LAST",
                       *[f"{a} ASC NULLS FIRST" for a in spec.attrs],
                       "deleted_flg ASC NULLS FIRST"])
    nxt = f"coalesce(nxt, {OPEN})"
    return f"""
        SELECT {k}, {attrs}, effective_from,
               CASE WHEN {k} IS NULL OR effective_from IS NULL THEN effective_to
                    WHEN deleted_flg THEN least(effective_to, {nxt})
                    ELSE {nxt} END AS effective_to,
               deleted_flg
        FROM (SELECT *, lead(effective_from) OVER (PARTITION BY {k} ORDER BY {order}) AS nxt
              FROM {src})"""


def history_ctes(name: str, ndays: int) -> tuple[dict[str, str], str]:
    """CTEs of the history of ``name`` after days 1..ndays; returns (ctes, final name)."""
    spec = SPECS[name]
    ctes: dict[str, str] = {}
    for n in range(1, ndays + 1):
        ctes.update({k: v for k, v in part_d(n).items() if k.startswith(name)})
    ctes[f"{name}_h0"] = _empty_hist(spec, f"{name}_d1")
    for n in range(1, ndays + 1):
        ctes.update(scd2_steps(f"{name}_x{n}", spec, f"{name}_h{n - 1}" if n > 1 else f"{name}_h0",
                               f"{name}_d{n}", DAYS[n - 1]))
        ctes[f"{name}_h{n}"] = f"SELECT * FROM {name}_x{n}_result"
    return ctes, f"{name}_h{ndays}"


def _hist_out(spec: Scd2Spec, src: str) -> str:
    cols = []
    for a in [spec.key, *spec.attrs]:
        cols.append(_d(a) if a in ("date_of_birth", "passport_valid_to", "valid_to") else a)
    cols += [_ts("effective_from"), _ts("effective_to"), "deleted_flg"]
    return f"SELECT {', '.join(cols)} FROM {src}"


# ---------------------------------------------------------------------------
# Enrich, windows, rules, report
# ---------------------------------------------------------------------------

def _current(hist: str) -> str:
    return f"(SELECT * FROM {hist} WHERE deleted_flg IS FALSE AND effective_to = {OPEN})"


def enrich_ctes(p: str, fact: str, cards: str, accounts: str, clients: str, terminals: str,
                blacklist: str) -> dict[str, str]:
    """The rules as they are worded: who holds a card, then each operation against the card's operations before it."""
    earlier = "b.ck = a.ck AND b.trans_date <= a.trans_date AND b.trans_date >= a.trans_date - INTERVAL"
    return {
        f"{p}_holder": f"""
            SELECT client_id, passport_num, passport_valid_to, phone, entry_dt AS black_list_dt,
                   coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') AS fio
            FROM {_current(clients)} LEFT JOIN {blacklist} ON passport = passport_num""",
        f"{p}_profile": f"""
            SELECT card_num, a.account_num, valid_to, h.*
            FROM {_current(cards)} JOIN {_current(accounts)} a USING (account_num) LEFT JOIN {p}_holder h ON h.client_id = a.client
            UNION ALL
            SELECT card_num, account_num, NULL, NULL, NULL, NULL, NULL, NULL, NULL
            FROM {_current(cards)} WHERE account_num IS NULL OR account_num NOT IN
                (SELECT account_num FROM {_current(accounts)} WHERE account_num IS NOT NULL)""",
        f"{p}_enriched": f"""
            SELECT f.trans_id, f.trans_date, f.card_num, f.amt, f.oper_result, terminal_city,
                   pr.account_num, valid_to, client_id, coalesce(fio, '  ') AS fio, passport_num, passport_valid_to, phone, black_list_dt,
                   coalesce(f.card_num, '') AS ck,
                   row_number() OVER (PARTITION BY f.card_num ORDER BY f.trans_date NULLS LAST, f.trans_id, black_list_dt, terminal_city,
                                      client_id, valid_to) AS n
            FROM {fact} f LEFT JOIN {p}_profile pr ON pr.card_num = f.card_num
                 LEFT JOIN {_current(terminals)} tr ON tr.terminal_id = f.terminal""",
        f"{p}_hour": f"""
            SELECT a.ck, a.n, min(b.terminal_city) AS city_min_1h, max(b.terminal_city) AS city_max_1h,
                   count(DISTINCT b.terminal_city) AS cities
            FROM {p}_enriched a JOIN {p}_enriched b ON {earlier} 1 HOUR GROUP BY a.ck, a.n""",
        f"{p}_minutes": f"""
            SELECT a.ck, a.n, count(b.amt) AS ops_20m
            FROM {p}_enriched a JOIN {p}_enriched b ON {earlier} 20 MINUTE GROUP BY a.ck, a.n""",
        f"{p}_windowed": f"""
            SELECT e.*, city_min_1h, city_max_1h, coalesce(cities, 0) AS cities, coalesce(ops_20m, 0) AS ops_20m,
                   one.amt AS prev_amt, one.oper_result AS prev_result, two.amt AS prev2_amt, two.oper_result AS prev2_result
            FROM {p}_enriched e LEFT JOIN {p}_hour h ON h.ck = e.ck AND h.n = e.n
                 LEFT JOIN {p}_minutes m ON m.ck = e.ck AND m.n = e.n
                 LEFT JOIN {p}_enriched one ON one.ck = e.ck AND one.n = e.n - 1
                 LEFT JOIN {p}_enriched two ON two.ck = e.ck AND two.n = e.n - 2""",
        f"{p}_flagged": f"""
            SELECT *, black_list_dt IS NOT NULL OR coalesce(passport_valid_to < trans_date, FALSE) AS bad_passport,
                   coalesce(valid_to < trans_date, FALSE) AS bad_contract,
                   cities >= 2 AS city_hop,
                   coalesce(ops_20m > 3 AND prev2_amt > prev_amt AND prev_amt > amt
                            AND [prev2_result, prev_result, oper_result] = ['REJECT', 'REJECT', 'SUCCESS'], FALSE) AS amount_probe
            FROM {p}_windowed""",
    }


def report_sql(flagged: str, report_dt: str) -> str:
    labels = ", ".join(f"'{x}'" for x in (LABEL_BAD_PASSPORT, LABEL_BAD_CONTRACT, LABEL_CITY_HOP, LABEL_AMOUNT_PROBE))
    first = "list_position([bad_passport, bad_contract, city_hop, amount_probe], TRUE)"
    return f"""
        SELECT DISTINCT CAST(trans_date AS DATE) AS event_dt, passport_num AS passport, fio, phone,
               list_extract([{labels}], {first}) AS event_type, DATE '{report_dt}' AS report_dt
        FROM {flagged} WHERE {first} > 0"""


def _as_current(src: str) -> str:
    return f"SELECT *, {OPEN} AS effective_to, FALSE AS deleted_flg FROM {src}"


PART_C_DIMS = {
    "c_cards": _as_current("fx_cards"),
    "c_accounts": _as_current("fx_accounts"),
    "c_clients": _as_current("fx_clients"),
    "c_terminals": _as_current("fx_terminals"),
}
PART_C_ENRICH = enrich_ctes("c", "fx_fact", "c_cards", "c_accounts", "c_clients", "c_terminals",
                            "fx_blacklist")


def _with(ctes: dict[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"


def _c(extra: dict[str, str] | None = None) -> dict[str, str]:
    out = dict(PART_C)
    out.update(PART_C_DIMS)
    out.update(PART_C_ENRICH)
    if extra:
        out.update(extra)
    return out


# ---------------------------------------------------------------------------
# Per-key SQL
# ---------------------------------------------------------------------------

def _accumulated(own_day: bool = False) -> str:
    """Three dates' reports over all operations so far, or only the rows that each date's own operations make."""
    ctes = _c()
    for name in SPECS:
        h, _ = history_ctes(name, 3)
        ctes.update(h)
    for n in (1, 2, 3):
        ctes.update(part_d(n))
        day = DAYS[n - 1]
        ctes[f"acc_fact{n}"] = (f"SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, "
                                f"terminal FROM fx_fact_s WHERE trans_day <= DATE '{day}'")
        ctes.update(enrich_ctes(f"r{n}", f"acc_fact{n}", f"cards_h{n}", f"accounts_h{n}",
                                f"clients_h{n}", f"terminals_h{n}", f"blacklist_d{n}"))
        of = f"trans_id IN (SELECT trans_id FROM fx_fact_s WHERE trans_day = DATE '{day}')" if own_day else "TRUE"
        ctes[f"own{n}"] = f"SELECT * FROM r{n}_flagged WHERE {of}"
        ctes[f"rep{n}"] = report_sql(f"own{n}", day)
    final = " UNION ALL ".join(
        f"SELECT {_d('event_dt')}, passport, fio, phone, event_type, {_d('report_dt')} FROM rep{n}"
        for n in (1, 2, 3))
    return _with(ctes, final)


def _deduped() -> str:
    """Lookups with second versions, of which the newest (or greatest) counts."""
    ctes = {**PART_C}
    one = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY {} DESC NULLS LAST) = 1"
    again = "UNION ALL SELECT * REPLACE ({}) FROM {} WHERE CAST({} AS BIGINT) % 5 = 0"
    ctes["two_acc"] = (f"SELECT *, 0 AS v FROM fx_accounts UNION ALL SELECT * REPLACE (CAST(valid_to - INTERVAL 30 DAY AS DATE) AS valid_to), 1 "
                       f"FROM fx_accounts WHERE CAST(account_num AS BIGINT) % 5 = 0")
    ctes["one_acc"] = f"SELECT * FROM two_acc {one.format('account_num', 'v')}"
    ctes["two_trm"] = f"SELECT * FROM fx_terminals {again.format("'CITY_Z' AS terminal_city", 'fx_terminals', 'terminal_id')}"
    ctes["one_trm"] = f"SELECT terminal_id, max(terminal_city) AS terminal_city FROM two_trm GROUP BY terminal_id"
    ctes["two_cli"] = f"SELECT * FROM fx_clients {again.format("phone || '0' AS phone", 'fx_clients', 'client_id')}"
    ctes["one_cli"] = f"SELECT * FROM two_cli {one.format('client_id', 'phone')}"
    ctes["one_bl"] = "SELECT passport, CAST(max(entry_dt) + INTERVAL 1 DAY AS DATE) AS black_list_dt FROM fx_blacklist GROUP BY passport"
    return _with(ctes, f"""
        SELECT f.trans_id, f.card_num, terminal_city, c.account_num, {_d('a.valid_to')}, client_id,
               coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') AS fio,
               passport_num, phone, {_d('black_list_dt')}
        FROM fx_fact f LEFT JOIN fx_cards c ON c.card_num = f.card_num
             LEFT JOIN one_acc a ON a.account_num = c.account_num LEFT JOIN one_cli ON client_id = a.client
             LEFT JOIN one_bl ON passport = passport_num LEFT JOIN one_trm tr ON tr.terminal_id = f.terminal""")


def _empty_rerun() -> str:
    """Day 2 reported over day 1's transactions, with no blacklist."""
    ctes = _c()
    for name in SPECS:
        ctes.update(history_ctes(name, 2)[0])
    for n in (1, 2):
        ctes.update(part_d(n))
    ctes["left_fact"] = f"SELECT * FROM fx_fact_s WHERE trans_day = DATE '{DAYS[0]}'"
    ctes["left_trans"] = "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM left_fact"
    ctes["no_blacklist"] = "SELECT * FROM fx_blacklist WHERE FALSE"
    ctes.update(enrich_ctes("e", "left_trans", "cards_h2", "accounts_h2", "clients_h2", "terminals_h2", "no_blacklist"))
    ctes["left_report"] = report_sql("e_flagged", DAYS[1])
    return _with(ctes, f"""
        SELECT 'fact' AS table_name, {_d('trans_day', 'day')}, count(*) AS n_rows FROM left_fact GROUP BY trans_day
        UNION ALL SELECT 'blacklist_day1', {_d('entry_dt', 'day')}, count(*) FROM fx_blacklist WHERE entry_dt <= DATE '{DAYS[0]}' GROUP BY entry_dt
        UNION ALL SELECT 'report_day2', {_d('event_dt', 'day')}, count(*) FROM left_report GROUP BY event_dt""")


def _skewed(card: str) -> str:
    """Rules over transactions of which two thirds are on one card."""
    ctes = {**PART_C, **PART_C_DIMS}
    ctes["fx_skewed"] = (f"SELECT * REPLACE (CASE WHEN CAST(trans_id AS BIGINT) % 3 <> 0 THEN {card} ELSE card_num END AS card_num) "
                         "FROM fx_fact")
    ctes.update(enrich_ctes("k", "fx_skewed", "c_cards", "c_accounts", "c_clients", "c_terminals", "fx_blacklist"))
    return _with(ctes, "SELECT trans_id, card_num, bad_passport, bad_contract, city_hop, amount_probe FROM k_flagged")


def _day2_step(name: str, step: str, select: str) -> str:
    h, last = history_ctes(name, 1)
    ctes = dict(h)
    ctes.update(part_d(2))
    ctes.update(scd2_steps("q", SPECS[name], last, f"{name}_d2", DAYS[1]))
    return _with(ctes, select.format(src=f"q_{step}"))


def _restitch_stacked() -> str:
    spec = SPECS["terminals"]
    ctes: dict[str, str] = {}
    parts = []
    for n in (1, 2, 3):
        ctes.update({k: v for k, v in part_d(n).items() if k.startswith("terminals")})
        parts.append(f"SELECT terminal_id, terminal_type, terminal_city, terminal_address, "
                     f"CAST(DATE '{DAYS[n - 1]}' AS TIMESTAMP) AS effective_from, "
                     f"{OPEN} AS effective_to, FALSE AS deleted_flg FROM terminals_d{n}")
    ctes["stacked"] = " UNION ALL ".join(parts)
    ctes["restitched"] = restitch_sql("stacked", spec)
    return _with(ctes, _hist_out(spec, "restitched"))


def _history_key(name: str, ndays: int, current_only: bool = False) -> str:
    h, last = history_ctes(name, ndays)
    src = last
    if current_only:
        h["cur_only"] = f"SELECT * FROM {last} WHERE effective_to = {OPEN} AND deleted_flg IS FALSE"
        src = "cur_only"
    return _with(h, _hist_out(SPECS[name], src))


def _touched_part(name: str) -> str:
    """Day 2's versions of the keys whose versions differ from day 1's."""
    h, last = history_ctes(name, 2)
    key, first = SPECS[name].key, last[:-1] + "1"
    h["touched"] = f"(FROM {last} EXCEPT ALL FROM {first}) UNION ALL (FROM {first} EXCEPT ALL FROM {last})"
    h["part"] = f"SELECT * FROM {last} WHERE {key} IN (SELECT {key} FROM touched)"
    return _with(h, _hist_out(SPECS[name], "part"))


def _hot_key() -> str:
    """Two dates of clients of which two thirds share a key; exact copies and ties as they come."""
    spec = SPECS["clients"]
    ctes: dict[str, str] = {}
    for n in (1, 2):
        ctes[f"plain{n}"] = part_d(n)["clients_d" + str(n)]
        key = "CAST(client_id AS BIGINT) % 9"
        ctes[f"hot{n}"] = (f"SELECT * REPLACE (CASE WHEN {key} < 6 THEN '7' WHEN {key} = 6 THEN NULL ELSE client_id END AS client_id) "
                           f"FROM plain{n}")
    ctes["h0"] = _empty_hist(spec, "hot1")
    ctes.update(scd2_steps("a", spec, "h0", "hot1", DAYS[0]))
    ctes["h1"] = "SELECT * FROM a_result"
    ctes.update(scd2_steps("b", spec, "h1", "hot2", DAYS[1]))
    return _with(ctes, _hist_out(spec, "b_result"))


_NAMES_CTE = {
    "names": """
        SELECT unnest([
            'passport_blacklist_' || strftime(CAST(ts AS DATE), '%d%m%Y') || '.xlsx',
            'terminals_' || strftime(CAST(ts AS DATE), '%d%m%Y') || '.xlsx',
            'transactions_' || strftime(CAST(ts AS DATE), '%d%m%Y') || '.txt',
            'readme_' || strftime(CAST(ts AS DATE), '%d%m%Y') || '.txt']) AS file_name
        FROM events""",
    "inputs": """
        SELECT file_name,
               strptime(right(split_part(file_name, '.', 1), 8), '%d%m%Y')::DATE AS file_dt
        FROM names
        WHERE starts_with(file_name, 'terminals_') OR starts_with(file_name, 'transactions_')
           OR starts_with(file_name, 'passport_blacklist_')""",
}

_CLIENT_STAGE_OUT = ("client_id, last_name, first_name, patronymic, "
                     f"{_d('date_of_birth')}, passport_num, {_d('passport_valid_to')}, phone, "
                     f"{_ts('create_dt')}, {_ts('update_dt')}")


def build() -> dict[str, str]:
    spec_c, spec_t = SPECS["clients"], SPECS["terminals"]
    return {
        "daily_dates": _with(_NAMES_CTE, f"SELECT DISTINCT {_d('file_dt', 'load_dt')}, "
                                         "strftime(file_dt, '%d%m%Y') AS file_token FROM inputs"),
        "stage_accounts": _with(PART_C, f"SELECT account_num, {_d('valid_to')}, client, "
                                        f"{_ts('create_dt')}, {_ts('update_dt')} FROM fx_accounts"),
        "stage_clients": _with(PART_C, f"SELECT {_CLIENT_STAGE_OUT} FROM fx_clients"),
        "stage_cards": _with(PART_C, f"SELECT card_num, account_num, {_ts('create_dt')}, "
                                     f"{_ts('update_dt')} FROM fx_cards"),
        "stage_transactions": _with(PART_C, f"SELECT transaction_id, transaction_date, "
                                            f"{_dbl('amount')}, card_num, oper_type, oper_result, "
                                            f"terminal FROM fx_stg_tx"),
        "conform_schema": _with(PART_C, f"""
            SELECT trans_id AS id, {_ts('trans_date', 'a')}, NULL::VARCHAR AS b, card_num, oper_type, {_dbl('amt')} FROM fx_fact
            UNION ALL
            SELECT 'a' || {_k('c_custkey')}, {_ts('stamp', 'a')}, CASE WHEN c_custkey % 3 = 0 THEN {_ts('stamp', 'b').split(' AS ')[0]} END,
                   {_k('c_custkey')}, NULL, NULL
            FROM (SELECT c_custkey, TIMESTAMP '{fx.CREATE_DT}' + to_seconds(CASE WHEN c_custkey % 20 >= 10 THEN 1 ELSE 0 END) AS stamp
                  FROM customer)"""),
        "csv_scan": _with(PART_C, "SELECT transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal "
                                  "FROM fx_text"),
        "staging_replace": _with(part_d(2), f"SELECT {_CLIENT_STAGE_OUT} FROM clients_d2"),
        "rejected_rows": _with(part_d(1), f"""
            SELECT 'stg_clients' AS table_name, 'client_id' AS key_name,
                   count(*) FILTER (WHERE CAST(client_id AS BIGINT) % 10 = 3) AS n_rows, '{DAYS[0]}' AS load_dt FROM clients_d1
            UNION ALL SELECT 'stg_accounts', 'account_num', 0, '{DAYS[0]}' FROM (SELECT count(*) FROM accounts_d1)
            UNION ALL SELECT 'stg_cards', 'card_num', 0, '{DAYS[0]}' FROM (SELECT count(*) FROM cards_d1)
            UNION ALL SELECT 'stg_terminals', 'terminal_id', count(*) FILTER (WHERE CAST(terminal_id AS BIGINT) % 10 = 2),
                             '{DAYS[0]}' FROM terminals_d1"""),
        "fact_append": _with(PART_C, f"SELECT trans_id, {_ts('trans_date')}, card_num, oper_type, "
                                     f"{_dbl('amt')}, oper_result, terminal, "
                                     f"{_d('trans_day', 'load_dt')} FROM fx_fact_s "
                                     f"WHERE trans_day IN (DATE '{DAYS[0]}', DATE '{DAYS[1]}')"),
        "blacklist_refresh": _with(PART_C, f"SELECT {_d('entry_dt')}, passport FROM fx_blacklist "
                                           f"WHERE entry_dt <= DATE '{DAYS[1]}'"),
        "ledger_pending_files": _with(_NAMES_CTE, f"""
            SELECT DISTINCT file_name, {_d('file_dt')} FROM inputs
            WHERE file_dt >= DATE '2024-01-11'"""),
        "ledger_redelivered": _with(_NAMES_CTE, f"""
            SELECT DISTINCT file_name, {_d('file_dt')} FROM inputs
            WHERE file_dt >= DATE '2024-01-11' OR file_dt = DATE '2024-01-05'"""),
        "scd2_new_keys": _day2_step("clients", "new", _hist_out(spec_c, "{src}")),
        "scd2_vanished_keys": _day2_step("clients", "gone", "SELECT client_id FROM {src}"),
        "scd2_soft_delete": _day2_step("clients", "kept", _hist_out(spec_c, "{src}")),
        "scd2_changed_flagged": _day2_step("clients", "changed", _hist_out(spec_c, "{src}")),
        "scd2_changed_compared": _day2_step("terminals", "changed", _hist_out(spec_t, "{src}")),
        "scd2_restitch": _restitch_stacked(),
        "scd2_clients_day2": _history_key("clients", 2),
        "scd2_accounts_day2": _history_key("accounts", 2),
        "scd2_cards_day2": _history_key("cards", 2),
        "scd2_terminals_day2": _history_key("terminals", 2),
        "scd2_hot_key": _hot_key(),
        "scd2_out_of_order": _history_key("clients", 3),
        "scd2_rebuild_archived": _history_key("clients", 3),
        "scd2_touched_part": _touched_part("terminals"),
        "empty_rerun": _empty_rerun(),
        "dim_current": _history_key("clients", 3, current_only=True),
        "txn_enriched": _with(_c(), f"""
            SELECT trans_id, card_num, {_dbl('amt')}, terminal_city, account_num,
                   {_d('valid_to')}, client_id, fio, passport_num, {_d('passport_valid_to')},
                   phone, {_d('black_list_dt')} FROM c_enriched"""),
        "txn_enriched_deduped": _deduped(),
        "blacklist_fanout": _with(PART_C, f"""
            SELECT card_num, client_id, passport_num, {_d('entry_dt', 'black_list_dt')}
            FROM fx_cards JOIN fx_accounts USING (account_num) LEFT JOIN fx_clients ON client_id = client
                 LEFT JOIN fx_blacklist ON passport_num = passport"""),
        "win_city_span_1h": _with(_c(), "SELECT trans_id, card_num, city_min_1h, city_max_1h FROM c_windowed"),
        "win_count_20m": _with(_c(), "SELECT trans_id, card_num, ops_20m FROM c_windowed"),
        "win_lag12": _with(_c(), f"""
            SELECT trans_id, card_num, {_dbl('prev_amt')}, prev_result, {_dbl('prev2_amt')},
                   prev2_result FROM c_windowed"""),
        "rule_passport": _with(_c(), "SELECT trans_id, card_num, bad_passport FROM c_flagged"),
        "rule_contract": _with(_c(), "SELECT trans_id, card_num, bad_contract FROM c_flagged"),
        "rule_city_hop": _with(_c(), "SELECT trans_id, card_num, city_hop FROM c_flagged"),
        "rule_amount_probe": _with(_c(), "SELECT trans_id, card_num, amount_probe FROM c_flagged"),
        "report_hot_card": _skewed("'7'"),
        "report_null_card": _skewed("NULL"),
        "scalar_full_name": _with(PART_C, """
            SELECT client_id, concat(last_name, ' ', first_name, ' ', patronymic) AS fio
            FROM fx_clients"""),
        "scalar_event_day": _with(PART_C, f"SELECT trans_id, {_d('CAST(trans_date AS DATE)', 'event_dt')} "
                                          f"FROM fx_fact"),
        "fraud_report": _with(_c({"rep": report_sql("c_flagged", str(fx.REPORT_DT))}), f"""
            SELECT {_d('event_dt')}, passport, fio, phone, event_type, {_d('report_dt')} FROM rep"""),
        "fraud_report_accumulated": _accumulated(),
        "fraud_report_day": _accumulated(own_day=True),
    }


ORACLE_SQL = build()
