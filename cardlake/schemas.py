"""K1: typed table definitions, fixed constants and ``conform``.

Every column is nullable and no key is declared unique, as in the source
warehouse. ``varchar(n)`` columns keep their limit as metadata; ``conform``
casts to the declared type, rounds ``timestamp(0)`` columns to the second, and fails the job (JVM-side ``raise_error``) when a
value is longer than the limit, which is what an insert into such a column does.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source job's values for identical results.
# ---------------------------------------------------------------------------
# open end of an SCD2 interval
OPEN_END = dt.datetime(3000, 1, 1, 0, 0, 0)
OPEN_END_SQL = "3000-01-01 00:00:00"
# report labels, in rule priority order: passport, contract, city hop, probing
LABEL_BAD_PASSPORT = "заблокированный паспорт"
LABEL_BAD_CONTRACT = "недействующий договор"
LABEL_CITY_HOP = "операций в разных городах за короткое время"
LABEL_AMOUNT_PROBE = "попытка подбора суммы"
# operation results tested by the probing rule
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
# input file name prefixes and the date format embedded in the names
FILE_PREFIXES = ("terminals_", "transactions_", "passport_blacklist_")
FILE_DATE_FORMAT = "ddMMyyyy"
# rule windows
CITY_WINDOW_SECONDS = 3600        # 1 hour
PROBE_WINDOW_SECONDS = 20 * 60    # 20 minutes
PROBE_MIN_COUNT = 3               # strictly more than 3 operations
# ---------------------------------------------------------------------------

DECIMAL = T.DecimalType(18, 2)


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    max_len: int | None = None     # varchar(n)
    seconds: bool = False          # timestamp(0): rounded to the second


def _vc(name: str, n: int | None = None) -> Col:
    return Col(name, T.StringType(), n)


def _ts(name: str) -> Col:
    return Col(name, T.TimestampType())


def _ts0(name: str) -> Col:
    return Col(name, T.TimestampType(), seconds=True)


def _d(name: str) -> Col:
    return Col(name, T.DateType())


SCD2_COLS = [_ts0("effective_from"), _ts0("effective_to"), Col("deleted_flg", T.BooleanType())]

TABLES: dict[str, list[Col]] = {
    # staging
    "stg_accounts": [_vc("account_num", 20), _d("valid_to"), _vc("client", 10),
                     _ts0("create_dt"), _ts0("update_dt")],
    "stg_clients": [_vc("client_id", 10), _vc("last_name", 20), _vc("first_name", 20),
                    _vc("patronymic", 20), _d("date_of_birth"), _vc("passport_num", 15),
                    _d("passport_valid_to"), _vc("phone", 16), _ts0("create_dt"), _ts0("update_dt")],
    "stg_cards": [_vc("card_num", 20), _vc("account_num", 20), _ts0("create_dt"), _ts0("update_dt")],
    "stg_blacklist": [_d("date"), _vc("passport", 20)],
    "stg_terminals": [_vc("terminal_id", 10), _vc("terminal_type", 20), _vc("terminal_city", 100),
                      _vc("terminal_address", 200)],
    # amount is parsed from text straight into a decimal (ledger Q12)
    "stg_transactions": [Col("transaction_id", T.LongType()), _vc("transaction_date", 20),
                         Col("amount", DECIMAL), _vc("card_num", 20), _vc("oper_type", 10),
                         _vc("oper_result", 10), _vc("terminal", 10)],
    # dimension history
    "dim_clients_hist": [_vc("client_id", 10), _vc("last_name", 20), _vc("first_name", 20),
                         _vc("patronymic", 20), _d("date_of_birth"), _vc("passport_num", 15),
                         _d("passport_valid_to"), _vc("phone", 16)] + SCD2_COLS,
    "dim_accounts_hist": [_vc("account_num", 20), _d("valid_to"), _vc("client", 10)] + SCD2_COLS,
    "dim_cards_hist": [_vc("card_num", 20), _vc("account_num", 20)] + SCD2_COLS,
    "dim_terminals_hist": [_vc("terminal_id", 10), _vc("terminal_type", 20),
                           _vc("terminal_city", 100), _vc("terminal_address", 200)] + SCD2_COLS,
    # facts and report
    "fact_transactions": [_vc("trans_id"), _ts("trans_date"), _vc("card_num", 20),
                          _vc("oper_type", 10), Col("amt", DECIMAL), _vc("oper_result", 10),
                          _vc("terminal", 10)],
    "fact_passport_blacklist": [_d("entry_dt"), _vc("passport", 20)],
    "rep_fraud": [_d("event_dt"), _vc("passport", 20), _vc("fio", 100), _vc("phone", 16),
                  _vc("event_type", 50), _d("report_dt")],
}


def struct_type(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.dtype, True) for c in TABLES[table]])


def _checked(c: Col, table: str) -> str:
    """SQL text of the cast (+ length check) of one column."""
    v = f"CAST(`{c.name}` AS {c.dtype.simpleString()})"
    if c.seconds:
        v = f"date_trunc('SECOND', {v} + INTERVAL '0.5' SECOND)"
    if c.max_len is not None:
        msg = f"value too long for {table}.{c.name} (varchar({c.max_len}))"
        v = f"CASE WHEN length({v}) > {c.max_len} THEN raise_error('{msg}') ELSE {v} END"
    return f"{v} AS `{c.name}`"


def conform(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the table's columns in order, cast, and enforce varchar limits.

    Missing columns are an error (a writer must supply every column, even as
    NULL); extra columns are dropped unless named in ``keep`` (e.g. a
    partition column). The length check is a lazy expression, so it costs no
    extra pass over the data.
    """
    missing = [c.name for c in TABLES[table] if c.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    # one selectExpr: the whole projection is parsed JVM-side in one call
    return df.selectExpr(*[_checked(c, table) for c in TABLES[table]], *[f"`{k}`" for k in keep])


def empty_frame(spark, schema: T.StructType) -> DataFrame:
    """A typed empty frame built JVM-side (no Python RDD, no Python worker)."""
    return spark.range(0).select(
        [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark, table: str) -> DataFrame:
    return empty_frame(spark, struct_type(table))
