"""Attach the current dimension versions to every transaction.

The source job chains five left joins off the fact table
(card -> account -> client -> blacklist, and terminal). Left joins whose
conditions only touch the previous right side re-associate, so the card chain
is resolved first into a *card profile* that is sized by the number of cards,
not by the number of transactions. The fact then meets

* the terminals, and
* the card profile on ``card_num``.

Spark broadcasts either when its size estimate allows; otherwise the joins are
sort-merge joins. The windows that follow exchange rows on their own key, so
AQE is free to split a card (or the rows without one) that is hot in the join.

Fan-out is kept on purpose (ledger Q1): a passport listed twice, or a key with
two current versions, duplicates the transaction before the windows count it.
``dedupe`` is the option against it: each lookup has one row for a key, the
newest version (blacklist: the newest entry), ties decided by the columns that
the lookup gives. Every transaction is then one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions.scalar import FULL_NAME_SQL
from cardlake.operators.scd2 import dim_current


def lookup(rows: DataFrame, key: str, columns: list[str], dedupe: bool = False, newest: str = "effective_from") -> DataFrame:
    """Key and columns of a lookup's rows; with ``dedupe`` one row for a key: the greatest by (``newest``, columns), NULLs least."""
    if not dedupe:
        return rows.select(key, *columns)
    best = F.max(F.struct(F.col(newest).alias("_newest"), *columns)).alias("_row")  # combined before the exchange, so a hot key is one row a task
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[f"_row.{c}" for c in columns])


def card_profile(cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                 blacklist: DataFrame, dedupe: bool = False) -> DataFrame:
    """card_num -> contract end, client attributes, blacklist date (1..n rows per card; one with ``dedupe``)."""
    crd = lookup(dim_current(cards_hist), "card_num", ["account_num"], dedupe)
    acc = lookup(dim_current(accounts_hist), "account_num", ["valid_to", "client"], dedupe)
    cli = lookup(dim_current(clients_hist), "client_id",
                 ["last_name", "first_name", "patronymic", "passport_num", "passport_valid_to", "phone"], dedupe)
    blc = lookup(blacklist.selectExpr("passport AS _bl_passport", "entry_dt AS black_list_dt"),
                 "_bl_passport", ["black_list_dt"], dedupe, newest="black_list_dt")
    return (crd.join(acc, "account_num", "left")
            .join(cli, F.expr("client = client_id"), "left")
            .join(blc, F.expr("passport_num = _bl_passport"), "left")
            .selectExpr("card_num", "account_num", "valid_to", "client_id", "last_name",
                        "first_name", "patronymic", "passport_num", "passport_valid_to", "phone",
                        "black_list_dt"))


def enrich(fact: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame,
           clients_hist: DataFrame, terminals_hist: DataFrame, blacklist: DataFrame,
           dedupe: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (transaction x matching current dimension rows), one per transaction with ``dedupe``;
    ``keep`` names further columns of ``fact``."""
    trm = lookup(dim_current(terminals_hist), "terminal_id", ["terminal_city"], dedupe).withColumnRenamed("terminal_id", "_trm_id")
    prof = card_profile(cards_hist, accounts_hist, clients_hist, blacklist, dedupe)
    f = fact.select("trans_id", "trans_date", "card_num", "amt", "oper_result", "terminal", *keep)
    out = (f.join(trm, F.expr("terminal = _trm_id"), "left")
           .join(prof, "card_num", "left"))
    # the name is built after the fact join: a transaction without a card,
    # account or client still gets the two separating spaces (F1)
    return out.selectExpr(
        "trans_id", "trans_date", "card_num", "amt", "oper_result", "terminal",
        "terminal_city", "account_num", "valid_to", "client_id",
        f"{FULL_NAME_SQL} AS fio",
        "passport_num", "passport_valid_to", "phone", "black_list_dt", *keep)
