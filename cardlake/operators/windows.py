"""What each operation sees of its card's recent past, in one skew-safe plan.

A card may hold a large share of all rows, so the partition key is (card,
time bucket). A row of a bucket's last hour is also a context row of the next
bucket, which completes every frame of an hour or less. One exchange on that
key feeds everything; joins that come before it keep their own exchanges, so
AQE can split a card that is hot there.

The frames are computed with running aggregates only, so a bucket costs time
in proportion to its rows, however dense they are:

* **count of the last 20 minutes** (W3): the running count up to the row, less
  the running count up to 20 minutes before it;
* **two cities within an hour** (what W1 and W2 are compared for): rows with a
  known city, in time order, change city somewhere in the last hour exactly if
  there are two cities in it. Each change is dated by the earlier of its two
  rows; the latest date so far tells;
* **the two operations before** (W4, W5): lags in the order (time, id, every
  other column), a total order, so fan-out copies sort alike in every attempt
  (ledger Q2). The first two rows of a bucket look further back, over gaps of
  any length: for them each bucket tells its last two rows, in one narrow row,
  and lags of these per card find those of the buckets before.

``city_span`` gives the least and greatest city themselves, from running
aggregates over clock hours. Rows without a
timestamp sort last (ledger Q17); they are peers and share one bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.schemas import CITY_WINDOW_SECONDS, PROBE_WINDOW_SECONDS

US = 1_000_000
BUCKET_SECONDS = 4 * 3600
NULL_BUCKET = 1 << 62          # rows without a timestamp come after every bucket
HALO_SECONDS = max(CITY_WINDOW_SECONDS, PROBE_WINDOW_SECONDS)
LAGS = ["prev_amt", "prev_result", "prev2_amt", "prev2_result"]
WINDOW_COLUMNS = ["ops_20m", "city_change_1h", *LAGS]
_KEY = "PARTITION BY _card, _bucket"
_READ = ("trans_id", "amt", "oper_result", "terminal_city")  # columns that the windows of ``with_windows`` read


def bucketed(enriched: DataFrame, bucket_seconds: int = BUCKET_SECONDS, columns: list[str] | None = None) -> DataFrame:
    """Rows with ``_card`` (never NULL), ``_us``, ``_bucket`` and ``_own`` (not a context row), exchanged on (card, bucket).
    ``columns`` are the expressions to carry, all columns as they are if None."""
    if bucket_seconds < HALO_SECONDS:
        raise ValueError("a bucket must be at least as long as the longest frame")
    size, halo = bucket_seconds * US, HALO_SECONDS * US
    home = f"CASE WHEN _us IS NULL THEN {NULL_BUCKET} ELSE (_us - pmod(_us, {size})) div {size} END"
    late = f"_us IS NOT NULL AND pmod(_us, {size}) >= {size - halo}"
    return (enriched
            .selectExpr(*(columns or ["*"]), "unix_micros(trans_date) AS _us",
                        "coalesce(concat('c', card_num), '') AS _card")
            .selectExpr("*", f"{home} AS _home")
            .selectExpr("*", f"explode(CASE WHEN {late} THEN array(_home, _home + 1) ELSE array(_home) END) AS _bucket")
            .selectExpr("*", "_bucket = _home AS _own").drop("_home")
            .repartition("_card", "_bucket"))


def _packed(columns: list[str]) -> list[tuple[str, list[str]]]:
    """The columns in their order; neighbours that no window reads are one struct, which sorts as they do and is copied at once."""
    out: list[tuple[str, list[str]]] = []
    for c in columns:
        if c in _READ:
            out.append((c, []))
        elif out and out[-1][1]:
            out[-1][1].append(c)
        else:
            out.append((f"_rest{len(out)}", [c]))
    return out


def _order(columns) -> str:
    # every column is named, so that the windows and the lags across buckets read the same exchange
    rest = [f"`{c}` ASC NULLS FIRST" for c in columns if c != "trans_id"]
    return "ORDER BY " + ", ".join(["_us ASC NULLS LAST", "trans_id ASC NULLS LAST", *rest])


def _far_lags(rows: DataFrame, order: str) -> DataFrame:
    """(card, bucket) -> the last two operations of the card before the bucket's own rows, ``_back1`` and ``_back2``.

    A bucket's last row knows itself and the row before it, if the bucket has one (a context row is one as well);
    else that is the last row of the bucket before.
    """
    place = f"{_KEY} {order}"
    by_bucket = "PARTITION BY _card ORDER BY _bucket"
    return (rows.selectExpr("_card", "_bucket", "_own", "_op AS _end1", f"lag(_op) OVER ({place}) AS _end2", f"lead(1) OVER ({place}) AS _more")
            .where("_own AND _more IS NULL")
            .selectExpr("_card", "_bucket", f"lag(_end1) OVER ({by_bucket}) AS _back1",
                        f"coalesce(lag(_end2) OVER ({by_bucket}), lag(_end1, 2) OVER ({by_bucket})) AS _back2"))


def with_windows(enriched: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Add ``ops_20m`` (W3), ``city_change_1h`` (W1 and W2 differ) and the lags."""
    packed = _packed(enriched.columns)
    names = [name for name, _ in packed]
    rows = (bucketed(enriched, bucket_seconds, [f"struct({', '.join(f'`{c}`' for c in inner)}) AS {name}" if inner else f"`{name}`"
                                                for name, inner in packed])
            .selectExpr("*", "named_struct('amt', amt, 'oper_result', oper_result) AS _op"))  # W4, W5: one lag brings both
    order = _order(names)
    place = f"{_KEY} {order}"
    by_time = f"{_KEY} ORDER BY _us ASC NULLS LAST"
    known = "CASE WHEN terminal_city IS NOT NULL THEN named_struct('city', terminal_city, 'us', coalesce(_us, 0)) END"
    seen = (rows
            .selectExpr("*", f"lag(_op) OVER ({place}) AS _prev", f"lag(_op, 2) OVER ({place}) AS _prev2", f"row_number() OVER ({place}) AS _place", f"lag(_own) OVER ({place}) AS _after_own",
                        f"last({known}, true) OVER ({place} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _last")
            .selectExpr("*", "CASE WHEN terminal_city <> _last.city THEN _last.us END AS _change").drop("_last")
            .selectExpr("*", f"count(amt) OVER ({by_time} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto",
                        f"count(amt) OVER ({by_time} RANGE BETWEEN UNBOUNDED PRECEDING AND {PROBE_WINDOW_SECONDS * US + 1} PRECEDING) AS _before",
                        f"max(_change) OVER ({by_time} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _changed")
            .where("_own"))
    far = _far_lags(rows, order)
    whole = {c: f"{name}.`{c}` AS `{c}`" for name, inner in packed for c in inner}
    out = [whole.get(c, f"`{c}`") for c in enriched.columns]
    # the first two rows of a bucket look back over its start; a context row in front of the second one is ``_back1``
    back = {}
    for name, c in (("amt", "amt"), ("result", "oper_result")):
        back[f"prev_{name}"] = f"CASE WHEN _place = 1 THEN _back1.{c} ELSE _prev.{c} END"
        back[f"prev2_{name}"] = f"CASE WHEN _place > 2 THEN _prev2.{c} WHEN _place = 2 AND _after_own THEN _back1.{c} ELSE _back2.{c} END"
    # the join is on the key that both sides are partitioned by
    return seen.join(far, ["_card", "_bucket"], "left").selectExpr(
        *out, "CASE WHEN _us IS NULL THEN _upto ELSE _upto - _before END AS ops_20m",
        f"coalesce(_us IS NULL AND _changed IS NOT NULL OR _changed >= _us - {CITY_WINDOW_SECONDS * US}, FALSE) AS city_change_1h",
        *[f"{back[c]} AS {c}" for c in LAGS])


def city_span(enriched: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Least and greatest known city of the last hour, peers included.

    The last hour of a row is the beginning of its clock hour up to the row,
    and the end of the clock hour before it. Both are running aggregates, the
    second one with time turned round: there the row stands for itself once
    more, an hour earlier and without a city. So the cost does not depend on
    how many rows an hour has.
    """
    hour = CITY_WINDOW_SECONDS * US
    out = [f"`{c}`" for c in enriched.columns]
    running = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    upto, since = (f"{_KEY}, _hour ORDER BY _us {way} NULLS LAST {running}" for way in ("ASC", "DESC"))
    return (bucketed(enriched, bucket_seconds)
            .selectExpr("*", f"(_us - pmod(_us, {hour})) div {hour} AS _hour")
            .selectExpr("*", f"min(terminal_city) OVER ({upto}) AS _min", f"max(terminal_city) OVER ({upto}) AS _max")
            .selectExpr("*", "explode(IF(_own, array(FALSE, TRUE), array(FALSE))) AS _again")
            .selectExpr(*out, "_card", "_bucket", "_again", "_min", "_max", "IF(_again, NULL, terminal_city) AS _city",
                        f"IF(_again, _us - {hour}, _us) AS _us", "IF(_again, _hour - 1, _hour) AS _hour")
            .selectExpr("*", f"min(_city) OVER ({since}) AS _min_before", f"max(_city) OVER ({since}) AS _max_before")
            .where("_again").selectExpr(*out, "least(_min, _min_before) AS city_min_1h", "greatest(_max, _max_before) AS city_max_1h"))
