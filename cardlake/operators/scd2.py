"""Type-2 history maintenance, for keys of any size.

``scd2_apply(history, staging, as_of, spec)`` returns the next history
snapshot. History and staging rows are put in one frame, and each row learns
what both say about its key (has a live version, any history, a staged row;
the current version). A projection turns rows into kept history rows (with the
delete mark of vanished keys), new rows and changed rows, and the intervals
are re-stitched: a row ends where the key's next one starts.

*Usual keys.* One exchange on the key: the facts and the next start are
windows over the key's rows, and each input is scanned once.

*Keys with more than* ``HOT_ROWS`` *rows* (and rows without a key) are found
by a count of the key column and go another way, with the same result, that
puts no key's rows into one task:

1. per-key facts are an aggregate, with a partial sum in each task, joined
   back on the key: AQE splits a key that is hot in that join;
2. rows of a key that start together form a tie group, of which the last one
   (an aggregate) gets the key's next start and the others end where they
   start. Next starts are found among distinct starts, per key and day, and
   across days among the days' first starts.

There rows of a tie group are told apart by a number, which they get as these
keys' rows are written to the shared scratch folder; so histories and staging
may come from anywhere. ``restitch``, the second step alone, numbers rows as
they are read: it takes a history from storage.

Deliberate deviations from the source job (all reads are of the state before
the batch; see README):

* Q4  flag mode stamps a changed version with ``coalesce(update_dt, create_dt)``.
* Q5  flag mode inserts a changed version only for a key that had a current
      live version whose ``effective_from`` is earlier than the staged one.
* Q6  compare mode compares null-safely with the *current* version only.
* Q7  a delete flags all versions but closes only the open one; re-stitching
      keeps ``least(delete date, next effective_from)`` for deleted rows.
* Q16 staged rows with a NULL key are not loaded (the daily run counts them).
* Q22 a key that has history but no live version starts at the batch date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.schemas import OPEN_END_SQL, empty_frame
from cardlake.session import scratch_dir

FLAG = "flag"        # a staged row with update_dt set is a new version
COMPARE = "compare"  # a staged row differing from the current version is one


@dataclass(frozen=True)
class Scd2Spec:
    table: str
    key: str
    attrs: tuple[str, ...]
    mode: str

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attrs, "effective_from", "effective_to", "deleted_flg"]


CLIENTS = Scd2Spec("dim_clients_hist", "client_id",
                   ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                    "passport_valid_to", "phone"), FLAG)
ACCOUNTS = Scd2Spec("dim_accounts_hist", "account_num", ("valid_to", "client"), FLAG)
CARDS = Scd2Spec("dim_cards_hist", "card_num", ("account_num",), FLAG)
TERMINALS = Scd2Spec("dim_terminals_hist", "terminal_id",
                     ("terminal_type", "terminal_city", "terminal_address"), COMPARE)
SPECS = {"clients": CLIENTS, "accounts": ACCOUNTS, "cards": CARDS, "terminals": TERMINALS}


def open_end() -> Column:
    """The open-interval sentinel as a timestamp in the session zone."""
    return F.expr(OPEN)


# SQL text is used for the projections: one ``selectExpr`` is one call into the
# JVM, where Column objects cost one call per operator.
OPEN = f"TIMESTAMP'{OPEN_END_SQL}'"
CURRENT = f"effective_to = {OPEN} AND deleted_flg <=> FALSE"


def _as_of(as_of: dt.date | str) -> str:
    return f"CAST(DATE'{as_of}' AS TIMESTAMP)"


def _q(c: str) -> str:
    return f"`{c}`"


def _cols(spec: Scd2Spec) -> list[str]:
    return [_q(spec.key), *map(_q, spec.attrs)]


def dim_current(history: DataFrame) -> DataFrame:
    """Versions open to the sentinel and not deleted (``deleted_flg is false``)."""
    return history.where(CURRENT)


def _staged_from(spec: Scd2Spec) -> str:
    if spec.mode == FLAG:
        return "coalesce(update_dt, create_dt)"
    raise ValueError("compare mode stamps versions with the batch date")


def _differs(spec: Scd2Spec, other: str) -> str:
    same = " AND ".join(f"{_q(a)} <=> {other}{_q(a)}" for a in spec.attrs)
    return f"NOT ({same})"


def _new_row(df: DataFrame, spec: Scd2Spec, effective_from: str) -> DataFrame:
    return df.selectExpr(*_cols(spec), f"{effective_from} AS effective_from",
                         f"{OPEN} AS effective_to", "FALSE AS deleted_flg")


# ---------------------------------------------------------------------------
# Classify rows by facts about their key
# ---------------------------------------------------------------------------

def _keyed(df: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Add ``_k``, the key without NULLs, and ``_id``, a number for each row of the scan."""
    return df.selectExpr("*", f"coalesce(concat('k', {_q(spec.key)}), '') AS _k",
                         "monotonically_increasing_id() AS _id")


def _union_rows(history: DataFrame, staging: DataFrame, spec: Scd2Spec) -> DataFrame:
    """History (``_src`` 0) and staged rows with a key (``_src`` 1) in one frame."""
    null_ts = "CAST(NULL AS TIMESTAMP)"
    h = history.selectExpr(*_cols(spec), "effective_from", "effective_to", "deleted_flg",
                           f"{null_ts} AS create_dt", f"{null_ts} AS update_dt", "0 AS _src")
    stamps = ("create_dt", "update_dt") if spec.mode == FLAG else (f"{null_ts} AS create_dt", f"{null_ts} AS update_dt")
    s = staging.where(f"{_q(spec.key)} IS NOT NULL").selectExpr(
        *_cols(spec), f"{null_ts} AS effective_from", f"{null_ts} AS effective_to",
        "CAST(NULL AS BOOLEAN) AS deleted_flg", *stamps, "1 AS _src")
    return _keyed(h.unionByName(s), spec)


def _current_version(spec: Scd2Spec) -> str:
    """Start and attributes of a current version; of several the greatest counts, so that ties give the same in every run."""
    attrs = ", ".join(f"'{a}', {_q(a)}" for a in spec.attrs)
    return f"CASE WHEN _src = 0 AND {CURRENT} AND effective_from IS NOT NULL THEN named_struct('_from', effective_from, {attrs}) END"


def _key_facts(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    """One row for each key: what the history before the batch and staging say about it."""
    cur_from = f"CASE WHEN _src = 0 AND {CURRENT} THEN effective_from END"
    facts = ["coalesce(max(_src = 0 AND deleted_flg <=> FALSE), FALSE) AS _live", "max(_src = 0) AS _known",
             "max(_src = 1) AS _staged", f"max({cur_from}) AS _cur_from"]
    if spec.mode != FLAG:
        facts.append(f"max({_current_version(spec)}) AS _cur")
    return rows.groupBy("_k").agg(*map(F.expr, facts))


def _facts_over_key(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    """``rows`` with the facts of ``_key_facts``, as windows over the key."""
    w = "OVER (PARTITION BY _k)"
    cur_from = f"CASE WHEN _src = 0 AND {CURRENT} THEN effective_from END"
    facts = [f"max(_src = 0 AND deleted_flg <=> FALSE) {w} AS _live", f"max(_src = 0) {w} AS _known",
             f"max(_src = 1) {w} AS _staged", f"max({cur_from}) {w} AS _cur_from"]
    if spec.mode != FLAG:
        facts.append(f"max({_current_version(spec)}) {w} AS _cur")
    return rows.selectExpr("*", *facts)


def _classified(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """Rows of the next history before re-stitching, with ``_kind``: kept, new or changed."""
    rows = _union_rows(history, staging, spec)
    return _classify(rows.join(_key_facts(rows, spec), "_k"), as_of, spec)


def _classify(rows: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """The same of rows that have their key's facts."""
    a_of = _as_of(as_of)
    if spec.mode == FLAG:
        start = _staged_from(spec)
        changed = f"update_dt IS NOT NULL AND {start} > _cur_from"
        new_start = f"CASE WHEN _known THEN {a_of} ELSE {start} END"
    else:
        changed = f"_cur IS NOT NULL AND {_differs(spec, '_cur.')}"
        start = new_start = a_of
    gone = "_live AND NOT _staged"
    return rows.selectExpr("*", f"CASE WHEN _src = 0 THEN 'kept' WHEN NOT _live THEN 'new' WHEN {changed} THEN 'changed' END AS _kind") \
        .where("_kind IS NOT NULL").selectExpr(
            "_k", "_id", "_kind", *_cols(spec),
            f"CASE _kind WHEN 'kept' THEN effective_from WHEN 'new' THEN {new_start} ELSE {start} END AS effective_from",
            f"CASE WHEN _kind <> 'kept' THEN {OPEN} WHEN {gone} AND effective_to = {OPEN} THEN {a_of} ELSE effective_to END AS effective_to",
            f"CASE WHEN _kind <> 'kept' THEN FALSE WHEN {gone} THEN TRUE ELSE deleted_flg END AS deleted_flg",
            "effective_to AS _was_to", "deleted_flg AS _was_deleted")


def _kind(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec, kind: str) -> DataFrame:
    return _classified(history, staging, as_of, spec).where(F.col("_kind") == kind).select(spec.columns)


def new_keys(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """D1 (J4): staged rows without a live version -> new open versions."""
    return _kind(history, staging, as_of, spec, "new")


def vanished_keys(history: DataFrame, staging: DataFrame, spec: Scd2Spec) -> DataFrame:
    """D2 (J5): live keys absent from staging."""
    facts = _key_facts(_union_rows(history, staging, spec), spec)
    return facts.where("_live AND NOT _staged AND _k <> ''").selectExpr(f"substring(_k, 2) AS {_q(spec.key)}")


def soft_delete(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """D2 (J6 as a mark): flag every version of a vanished key, close the open one."""
    return _kind(history, staging, as_of, spec, "kept")


def changed_flagged(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """D3 (flag mode): staged rows with ``update_dt`` newer than the current version."""
    return _kind(history, staging, as_of, spec, "changed")


def changed_compared(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """D4 (J7, compare mode): staged rows differing null-safely from the current version."""
    return _kind(history, staging, as_of, spec, "changed")


# ---------------------------------------------------------------------------
# Re-stitch
# ---------------------------------------------------------------------------

DAY_US = 86400 * 1_000_000


def restitch(history: DataFrame, spec: Scd2Spec) -> DataFrame:
    """D5 (W6): ``effective_to`` = next ``effective_from`` of the key, else open end.

    A key's rows are ordered by start, then attributes, ``deleted_flg`` and
    ``effective_to``. Deleted versions keep the earlier of their delete date and the
    next start; rows with a NULL key or NULL ``effective_from`` keep their
    ``effective_to``.
    """
    return _restitch(history, spec)


def _restitch(history: DataFrame, spec: Scd2Spec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``restitch``; columns ``keep`` stay."""
    rows = history if "_id" in history.columns else _keyed(history, spec)
    tie = ", ".join(f"'{c}', {_q(c)}" for c in [*spec.attrs, "deleted_flg", "effective_to", "_id"])
    us = "unix_micros(effective_from)"
    starts = (rows.where("_k <> '' AND effective_from IS NOT NULL")
              .groupBy("_k", "effective_from").agg(F.expr(f"max(named_struct({tie}))._id AS _last"))
              .selectExpr("*", f"({us} - pmod({us}, {DAY_US})) div {DAY_US} AS _day"))
    days = (starts.groupBy("_k", "_day").agg(F.min("effective_from").alias("_first"))
            .selectExpr("_k", "_day", "lead(_first) OVER (PARTITION BY _k ORDER BY _day) AS _next_day"))
    after = (starts.selectExpr("*", "lead(effective_from) OVER (PARTITION BY _k, _day ORDER BY effective_from) AS _next")
             .join(days, ["_k", "_day"])
             .selectExpr("_k", "effective_from", "_last", f"coalesce(_next, _next_day, {OPEN}) AS _next"))
    end = "CASE WHEN _id = _last THEN _next ELSE effective_from END"
    return rows.join(after, ["_k", "effective_from"], "left").selectExpr(
        *_cols(spec), "effective_from",
        f"CASE WHEN _last IS NULL THEN effective_to WHEN deleted_flg THEN least(effective_to, {end}) ELSE {end} END AS effective_to",
        "deleted_flg", *keep)


#: Rows of a key, history and staging together, up to which they are one window's work.
HOT_ROWS = 100_000


#: What a row of the next history was before the batch, and the test for rows that the batch left as they were.
_PAST = ("_k", "_kind", "_was_to", "_was_deleted")
_SAME = "_kind = 'kept' AND effective_to <=> _was_to AND deleted_flg <=> _was_deleted"


def _restitch_over_key(rows: DataFrame, spec: Scd2Spec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``_restitch`` as a window over the key, in the same order."""
    order = ", ".join(["effective_from IS NULL", "effective_from", *map(_q, spec.attrs), "deleted_flg", "effective_to"])
    end = f"coalesce(lead(effective_from) OVER (PARTITION BY _k ORDER BY {order}), {OPEN})"
    return rows.selectExpr("*", f"{end} AS _end").selectExpr(
        *_cols(spec), "effective_from",
        "CASE WHEN effective_from IS NULL THEN effective_to WHEN deleted_flg THEN least(effective_to, _end) ELSE _end END AS effective_to",
        "deleted_flg", *keep)


def scd2_apply(history: DataFrame, staging: DataFrame, as_of, spec: Scd2Spec, hot_rows: int = HOT_ROWS, touched_only: bool = False) -> DataFrame:
    """Next history snapshot from the previous one and a full staging snapshot (runs a count of the keys).

    With ``touched_only`` the rows of those keys alone of which the batch adds or alters a row: in place of the
    keys' rows in ``history`` they make the next one.
    """
    keep = _PAST if touched_only else ()
    rows = _union_rows(history, staging, spec)
    hot = rows.groupBy("_k").count().where(f"count > {hot_rows} OR _k = ''").select("_k")
    if hot.isEmpty():
        return _usual(rows, as_of, spec, keep)
    hot = _written(hot, "hot-keys")
    usual = _usual(rows.join(hot, "_k", "left_anti"), as_of, spec, keep)
    some = _written(rows.join(hot, "_k", "left_semi"), "hot-rows")
    found = _written(_classify(some.join(_key_facts(some, spec), "_k"), as_of, spec), "hot-classified")
    stitched = _restitch(found, spec, keep)
    if touched_only:
        stitched = _written(stitched, "hot-stitched")
        altered = stitched.where(f"NOT ({_SAME})").select("_k").distinct()
        stitched = stitched.join(altered, "_k", "left_semi").select(spec.columns)
    return usual.unionByName(stitched)


def _usual(rows: DataFrame, as_of, spec: Scd2Spec, keep: tuple[str, ...]) -> DataFrame:
    """The next history of keys of usual size, or with ``keep`` of those that the batch touched, in one exchange."""
    stitched = _restitch_over_key(_classify(_facts_over_key(rows, spec), as_of, spec), spec, keep)
    if not keep:
        return stitched
    return stitched.selectExpr("*", f"max(NOT ({_SAME})) OVER (PARTITION BY _k) AS _touched").where("_touched").select(spec.columns)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(first: DataFrame, later: DataFrame, spec: Scd2Spec, several: bool = True) -> DataFrame:
    """A history from its stored parts: of each key the rows of the newest part that has it.

    The first part keeps the keys that no later one has; only the key column of the others meets it. ``later`` tells
    its parts apart by ``_level``, if it has ``several``.
    """
    key = f"coalesce(concat('k', {_q(spec.key)}), '') AS _k"
    first, later = first.selectExpr("*", key), later.selectExpr("*", key)
    kept = first.join(later.select("_k"), "_k", "left_anti")
    if several:
        later = later.join(later.groupBy("_k").agg(F.max("_level").alias("_newest")), "_k").where("_level = _newest")
    return kept.select(spec.columns).unionByName(later.select(spec.columns))


def initial_history(staging: DataFrame, as_of, spec: Scd2Spec) -> DataFrame:
    """First load: ``scd2_apply`` on an empty history."""
    schema = (staging.select(spec.key, *spec.attrs).schema
              .add("effective_from", "timestamp").add("effective_to", "timestamp")
              .add("deleted_flg", "boolean"))
    return scd2_apply(empty_frame(staging.sparkSession, schema), staging, as_of, spec)


def as_current(staging: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Staged rows as open, live versions (what a first batch of unique keys
    writes), without the keyed plan; for loaded-dimension fixtures."""
    eff = _staged_from(spec) if spec.mode == FLAG else "CAST(NULL AS TIMESTAMP)"
    return _new_row(staging, spec, eff)
