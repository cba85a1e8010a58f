"""The daily fraud report rows, and the flagged-transaction plan behind it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions.scalar import EVENT_DAY_SQL
from cardlake.operators.enrich import enrich
from cardlake.operators.rules import RULES, with_flags
from cardlake.operators.windows import BUCKET_SECONDS, with_windows
from cardlake.schemas import (
    LABEL_AMOUNT_PROBE,
    LABEL_BAD_CONTRACT,
    LABEL_BAD_PASSPORT,
    LABEL_CITY_HOP,
)

# A row's label is that of its first true rule, in the order of RULES
LABELS = dict(zip(RULES, (LABEL_BAD_PASSPORT, LABEL_BAD_CONTRACT, LABEL_CITY_HOP, LABEL_AMOUNT_PROBE), strict=True))
_FIRST_LABEL = f"coalesce({', '.join(f'''if({rule}, '{label}', NULL)''' for rule, label in LABELS.items())})"


def flagged(fact: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame,
            clients_hist: DataFrame, terminals_hist: DataFrame, blacklist: DataFrame,
            bucket_seconds: int = BUCKET_SECONDS, dedupe: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """enrich (J3) -> windows (W1-W5) -> flags (R1-R4), one row per joined row."""
    return with_flags(with_windows(enrich(fact, cards_hist, accounts_hist, clients_hist, terminals_hist, blacklist, dedupe, keep),
                                   bucket_seconds))


def flagged_day(fact: DataFrame, before: DataFrame, **dims) -> DataFrame:
    """``flagged`` rows of ``fact`` alone, whose windows also see the operations ``before`` (``operators.tails``)."""
    rows = fact.withColumn("_new", F.lit(True)).unionByName(before.withColumn("_new", F.lit(False)))
    return flagged(rows, **dims, keep=("_new",)).where("_new").drop("_new")


def report(flagged_rows: DataFrame, report_dt: dt.date | str) -> DataFrame:
    """Distinct (event_dt, passport, fio, phone, event_type, report_dt) over
    rows matching any rule."""
    return (flagged_rows.where(" OR ".join(RULES))
            .selectExpr(f"{EVENT_DAY_SQL} AS event_dt", "passport_num AS passport", "fio", "phone",
                        f"{_FIRST_LABEL} AS event_type", f"DATE'{report_dt}' AS report_dt")
            .distinct())


def fraud_report(fact: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame,
                 clients_hist: DataFrame, terminals_hist: DataFrame, blacklist: DataFrame,
                 report_dt: dt.date | str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    return report(flagged(fact, cards_hist, accounts_hist, clients_hist, terminals_hist,
                          blacklist, bucket_seconds), report_dt)
