"""Card tails: the state that lets a date's report read that date's transactions only.

A card's tail is the end of its operations in the order of the windows
(time, id, every other column): those of its last hour, and the one before
them, so always the last two. Later operations see nothing older in any frame
(``operators.windows``), so windows over the tail and the new operations equal
windows over all operations, on the new ones. A tail is the tail of the
earlier tail and the new operations: it is carried from date to date.

Operations without a time come after all others. They see each other, however
many, so a tail only keeps the last of them, as a mark.

*Late cards* are those where this does not hold: a new operation is not later
than all earlier ones of its card, or both sides have operations without a
time. Their earlier operations are read from the facts, whole.

Rows without a card are one card. A tail's size is bounded by the operations
of one hour a card. No window holds a card's rows here: there are aggregates
with map-side combine, and a join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.operators.windows import HALO_SECONDS
from cardlake.schemas import struct_type

FACT = struct_type("fact_transactions").fieldNames()
_CARD = "coalesce(concat('c', card_num), '') AS _card"
_HOUR = f"INTERVAL {HALO_SECONDS} SECONDS"
#: The order of the windows (NULL ids last), as a struct that compares that way.
_ROW = "named_struct(" + ", ".join(["'trans_date', trans_date", "'no_id', trans_id IS NULL", "'trans_id', trans_id",
                                    *[f"'{c}', {c}" for c in ("amt", "oper_result", "terminal", "card_num", "oper_type")]]) + ")"


def tail(fact: DataFrame) -> DataFrame:
    """The tails of all cards: rows of ``fact``."""
    rows = fact.selectExpr(*FACT, _CARD)
    seen = rows.join(rows.groupBy("_card").agg(F.max("trans_date").alias("_newest")), "_card")
    hour = seen.where(f"trans_date >= _newest - {_HOUR}").select(FACT)
    edges = (seen.groupBy("_card")
             .agg(F.max(F.expr(f"CASE WHEN trans_date < _newest - {_HOUR} THEN {_ROW} END")).alias("before"),
                  F.max(F.expr(f"CASE WHEN trans_date IS NULL THEN {_ROW} END")).alias("undated"))
             .selectExpr("explode(array_compact(array(before, undated))) AS x").select(*[f"x.{c}" for c in FACT]))
    return hour.unionByName(edges)


def late_cards(tails: DataFrame, fact: DataFrame) -> DataFrame:
    """``_card`` of the cards whose new operations the tails do not suffice for."""
    undated = "coalesce(bool_or(trans_date IS NULL), FALSE)"
    new = fact.selectExpr("trans_date", _CARD).groupBy("_card").agg(F.min("trans_date").alias("first"), F.expr(undated).alias("new_undated"))
    old = tails.selectExpr("trans_date", _CARD).groupBy("_card").agg(F.max("trans_date").alias("newest"), F.expr(undated).alias("old_undated"))
    return new.join(old, "_card").where("first <= newest OR (new_undated AND old_undated)").select("_card")


def before(tails: DataFrame, fact: DataFrame, late: DataFrame | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """The earlier operations that those of ``fact`` can see: tails of their cards, and for ``late`` cards all of ``earlier``."""
    cards = fact.selectExpr(_CARD).distinct()
    rows = tails.where("trans_date IS NOT NULL").selectExpr(*FACT, _CARD).join(cards, "_card", "left_semi")
    if late is not None:
        whole = earlier.selectExpr(*FACT, _CARD).join(late, "_card", "left_semi")
        rows = rows.join(late, "_card", "left_anti").unionByName(whole)
    return rows.select(FACT)
