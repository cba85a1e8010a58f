"""Domain frames derived from the driver's tables (FIXTURES.md parts C and D).

The driver ships TPC-H-like tables, not card data; these deterministic integer
recipes turn them into the warehouse's inputs so that every registered query
reads the given tables and its work grows with them. ``plans.oracle`` holds the
same recipes in DuckDB SQL.

Part C (one snapshot): transactions from ``events`` (time axis compressed 24x
so that cards are dense enough for the 20-minute rule), cards/accounts/clients
from ``customer`` (every 10th client missing on purpose), terminals from
``supplier``, blacklist from ``customer`` with duplicate passports on purpose.

Part D (three daily snapshots): keys ending in 9 / 8 / 7 are absent on day
1 / 2 / 3, and from day 2 every key with ``key % 7 = 3`` changes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cardlake.schemas import RESULT_REJECT, RESULT_SUCCESS

# ---------------------------------------------------------------------------
# Fixed recipe parameters (shared with plans.oracle)
# ---------------------------------------------------------------------------
EPOCH_US = 1704067200000000            # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 24
CREATE_DT = "2023-01-01 00:00:00"
VALID_BASE = "2023-12-25"
BIRTH_BASE = "1950-01-01"
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
DROP_DIGIT = {1: 9, 2: 8, 3: 7}        # key % 10 absent on day n
CHANGE_MOD, CHANGE_REM = 7, 3          # key % 7 = 3 changes from day 2
CHANGE_DT = "2024-01-02 00:00:00"
REPORT_DT = dt.date(2024, 1, 2)        # report date of the one-snapshot report
TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


# Schemas of the driver tables the recipes read (identical at every scale
# factor); declaring them spares a footer read per scan.
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


class Tables:
    """Lazy parquet readers for the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        r = self.spark.read
        if name in SOURCE_SCHEMAS:
            r = r.schema(SOURCE_SCHEMAS[name])
        return r.parquet(f"{self.sf_dir}/{name}.parquet")


def _day_n(day: dt.date) -> int:
    return DAYS.index(day) + 1


# The recipes are Spark SQL expression text: one ``selectExpr`` per frame is
# one JVM call, where a Column chain costs a call per operator.
_KEY = "CAST(c_custkey AS STRING)"
_CREATE = f"TIMESTAMP'{CREATE_DT}' AS create_dt"
_NO_UPDATE = "CAST(NULL AS TIMESTAMP) AS update_dt"


def _valid_to(mult: int, mod: int) -> str:
    return f"date_add(DATE'{VALID_BASE}', CAST((c_custkey * {mult}) % {mod} AS INT))"


# ---------------------------------------------------------------------------
# Part C
# ---------------------------------------------------------------------------

def fact_transactions(t: Tables) -> DataFrame:
    return t("events").selectExpr(
        "CAST(event_id AS STRING) AS trans_id",
        f"timestamp_micros({EPOCH_US} + "
        f"(unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US}) div {TIME_COMPRESSION}) AS trans_date",
        "CAST(user_id AS STRING) AS card_num",
        "event_type AS oper_type",
        "CAST(value AS DECIMAL(18,2)) AS amt",
        f"CASE WHEN event_type IN ('error', 'signup') THEN '{RESULT_REJECT}' "
        f"ELSE '{RESULT_SUCCESS}' END AS oper_result",
        "CASE WHEN event_id % 50 = 7 THEN '-1' "
        "WHEN event_id % 12 = 0 THEN CAST(event_id % 13 AS STRING) "
        "ELSE CAST(user_id % 9 AS STRING) END AS terminal")


def cards_snapshot(t: Tables) -> DataFrame:
    return t("customer").selectExpr(f"{_KEY} AS card_num", f"{_KEY} AS account", _CREATE,
                                    _NO_UPDATE)


def accounts_snapshot(t: Tables) -> DataFrame:
    return t("customer").selectExpr(f"{_KEY} AS account", f"{_valid_to(7, 60)} AS valid_to",
                                    f"{_KEY} AS client", _CREATE, _NO_UPDATE)


def fractional_accounts(t: Tables) -> DataFrame:
    """Accounts whose time stamps have fractions of a second (multiples of 0.05 s from 0 to 0.95)."""
    stamp = f"CAST(TIMESTAMP'{CREATE_DT}' + make_interval(0, 0, 0, 0, 0, 0, CAST((c_custkey % 20) * 0.05 AS DECIMAL(18, 6))) AS TIMESTAMP)"
    return t("customer").selectExpr(f"{_KEY} AS account_num", "CAST(NULL AS DATE) AS valid_to", f"{_KEY} AS client",
                                    f"{stamp} AS create_dt", f"CASE WHEN c_custkey % 3 = 0 THEN {stamp} END AS update_dt")


def _client_cols(phone: str = "CAST(c_nationkey AS STRING)") -> list[str]:
    return [
        f"{_KEY} AS client_id",
        "c_name AS last_name",
        "c_mktsegment AS first_name",
        "CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE 'P' END AS patronymic",
        f"date_add(DATE'{BIRTH_BASE}', CAST((c_custkey * 13) % 18000 AS INT)) AS date_of_birth",
        f"concat('P', {_KEY}) AS passport_num",
        f"{_valid_to(11, 90)} AS passport_valid_to",
        f"{phone} AS phone",
    ]


def clients_snapshot(t: Tables) -> DataFrame:
    return t("customer").where("c_custkey % 10 <> 9").selectExpr(*_client_cols(), _CREATE,
                                                                 _NO_UPDATE)


def _terminal_cols(city: str = "concat('CITY_', CAST(s_nationkey % 5 AS STRING))") -> list[str]:
    return [
        "CAST(s_suppkey AS STRING) AS terminal_id",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
        f"{city} AS terminal_city",
        "s_name AS terminal_address",
    ]


def terminals_snapshot(t: Tables) -> DataFrame:
    return t("supplier").selectExpr(*_terminal_cols())


def blacklist_snapshot(t: Tables, up_to: dt.date | None = None) -> DataFrame:
    """Staging form (``date``, ``passport``); two entry dates, the second one
    repeating passports of the first (duplicates on purpose, ledger Q1)."""
    c = t("customer")
    first = c.where("c_custkey % 37 = 0").selectExpr("DATE'2024-01-01' AS date",
                                                      f"concat('P', {_KEY}) AS passport")
    second = c.where("c_custkey % 74 = 0").selectExpr("DATE'2024-01-02' AS date",
                                                       f"concat('P', {_KEY}) AS passport")
    out = first.unionByName(second)
    if up_to is not None:
        out = out.where(f"date <= DATE'{up_to}'")
    return out


def transactions_text(t: Tables, day: dt.date | None = None) -> DataFrame:
    """The transactions as the daily text file carries them: timestamp text to
    the second, amount text with a decimal comma (a point for every third id,
    both forms are accepted)."""
    f = fact_transactions(t)
    if day is not None:
        f = f.where(f"to_date(trans_date) = DATE'{day}'")
    return f.selectExpr(
        "CAST(trans_id AS BIGINT) AS transaction_id",
        "date_format(trans_date, 'yyyy-MM-dd HH:mm:ss') AS transaction_date",
        "CASE WHEN CAST(trans_id AS BIGINT) % 3 = 0 THEN CAST(amt AS STRING) "
        "ELSE replace(CAST(amt AS STRING), '.', ',') END AS amount",
        "card_num", "oper_type", "oper_result", "terminal")


# ---------------------------------------------------------------------------
# Part D: daily snapshots (operational-table shape: accounts and cards carry
# ``account``, renamed by the stager)
# ---------------------------------------------------------------------------

def _present(key: str, day: dt.date) -> str:
    return f"{key} % 10 <> {DROP_DIGIT[_day_n(day)]}"


def _changed(key: str, day: dt.date) -> str:
    return f"({'TRUE' if _day_n(day) >= 2 else 'FALSE'} AND {key} % {CHANGE_MOD} = {CHANGE_REM})"


def _update(key: str, day: dt.date) -> str:
    return f"CASE WHEN {_changed(key, day)} THEN TIMESTAMP'{CHANGE_DT}' END AS update_dt"


def clients_day(t: Tables, day: dt.date) -> DataFrame:
    k = "c_custkey"
    phone = f"CASE WHEN {_changed(k, day)} THEN 'NEW' ELSE CAST(c_nationkey AS STRING) END"
    return t("customer").where(_present(k, day)).selectExpr(*_client_cols(phone), _CREATE,
                                                            _update(k, day))


def accounts_day(t: Tables, day: dt.date) -> DataFrame:
    k = "c_custkey"
    v = _valid_to(7, 60)
    return t("customer").where(_present(k, day)).selectExpr(
        f"{_KEY} AS account",
        f"CASE WHEN {_changed(k, day)} THEN date_add({v}, 365) ELSE {v} END AS valid_to",
        f"{_KEY} AS client", _CREATE, _update(k, day))


def cards_day(t: Tables, day: dt.date) -> DataFrame:
    """A changed card is re-issued on the same account (flag mode needs no
    attribute difference, only ``update_dt``)."""
    k = "c_custkey"
    return t("customer").where(_present(k, day)).selectExpr(
        f"{_KEY} AS card_num", f"{_KEY} AS account", _CREATE, _update(k, day))


def terminals_day(t: Tables, day: dt.date) -> DataFrame:
    k = "s_suppkey"
    city = (f"CASE WHEN {_changed(k, day)} THEN 'CITY_X' "
            f"ELSE concat('CITY_', CAST(s_nationkey % 5 AS STRING)) END")
    return t("supplier").where(_present(k, day)).selectExpr(*_terminal_cols(city))


class FixtureSource:
    """Daily inputs for ``plans.daily.run`` derived from the driver tables.

    The transactions and blacklist files of the dates ``without`` are empty.
    """

    dated_snapshots = True

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.without: set[dt.date] = set()

    def dates(self) -> list[dt.date]:
        return list(DAYS)

    def accounts(self, day):
        return accounts_day(self.t, day)

    def clients(self, day):
        return clients_day(self.t, day)

    def cards(self, day):
        return cards_day(self.t, day)

    def terminals(self, day):
        return terminals_day(self.t, day)

    def blacklist(self, day):
        rows = blacklist_snapshot(self.t, up_to=day)
        return rows.where("false") if day in self.without else rows

    def transactions(self, day):
        rows = transactions_text(self.t, day)
        return rows.where("false") if day in self.without else rows


class TodaySource(FixtureSource):
    """The same with operational tables that are always those of ``today``."""

    dated_snapshots = False
    today: dt.date

    def accounts(self, day):
        return accounts_day(self.t, self.today)

    def clients(self, day):
        return clients_day(self.t, self.today)

    def cards(self, day):
        return cards_day(self.t, self.today)
