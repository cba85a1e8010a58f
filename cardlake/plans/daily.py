"""The daily load, written so that re-running a date is harmless.

Layout under the warehouse root (all Parquet). Every write goes to a new
version folder ``v=...``; ``commits`` says which of them are current
(``plans.commits``):

``stg/<table>/v=...``                    staging of each date (K2), kept as an archive; equal content is stored once
``dim/<name>/v=...``                     SCD2 history as of a batch (K3): parts, each with the keys that some batches touched
``fact_transactions/v=.../load_dt=.../src=...``  transactions of a batch, by input file (K4)
``fact_passport_blacklist/v=...``        blacklist snapshot as of a batch (K5)
``rep_fraud/v=...``                      report rows stamped with the batch (K6)
``card_tail/v=...``                      what a later date's windows see of each card (scope "day", ``operators.tails``)
``ledger/v=...``                         input files consumed by a batch, with length, time and digest (K7)
``rejected/v=...``                       staged rows without a business key, counted (Q16)

A date's tables become visible together, by one commit after its report; a run
that is lost half way is invisible. A re-run replaces the date's rows, also
when there are none (Q11), and no job overwrites what it reads. Reading the
written snapshots back also cuts the lineage between days. Dates run
sequentially -- day *n*'s history needs the history of the newest loaded date
before it -- while everything inside a date is one Spark job per table.

A date loaded after a later one makes the later one's history stale: such a
run is refused, or builds the later dates again (``rebuild_later``), from
their archived staging, not from what the operational tables hold today. A
commit names the version that its history was built on, so a rebuild that was
lost half way is known as stale too.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.operators import tails
from cardlake.operators.report import flagged_day, fraud_report, report
from cardlake.operators.scd2 import HOT_ROWS, SPECS, merged, scd2_apply
from cardlake.plans.commits import CommitLog, Entry, Key, new_id
from cardlake.schemas import conform, empty, empty_frame, struct_type
from cardlake.sources import staging as stg
from cardlake.sources.files import LEDGER_SCHEMA, expected_file_names, remove

_VERSION = re.compile(r"(.*/v=[0-9a-f]{12})")
SNAPSHOTS = ("stg_clients", "stg_accounts", "stg_cards")
#: What a date's report covers: every loaded operation up to the date (Q10), or the date's own.
SCOPES = ("all", "day")


class DailySource(Protocol):
    """What a batch date needs; see ``plans.fixtures.FixtureSource`` and
    ``sources.inputs.FileSource``. ``dated_snapshots`` (True if missing) says
    whether clients, accounts and cards of a past date can be had from it."""

    def accounts(self, day: dt.date) -> DataFrame: ...
    def clients(self, day: dt.date) -> DataFrame: ...
    def cards(self, day: dt.date) -> DataFrame: ...
    def terminals(self, day: dt.date) -> DataFrame: ...
    def blacklist(self, day: dt.date) -> DataFrame: ...
    def transactions(self, day: dt.date) -> DataFrame: ...


def _d(day) -> F.Column:
    return F.lit(str(day)).cast("date")


def _escaped(name: str) -> str:
    """A partition value as Spark writes it in a path."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in name)


class Tables:
    """Reads and writes of the warehouse's tables over a set of current entries."""

    spark: SparkSession
    root: str
    entries: dict[Key, Entry]

    def _add(self, entries: list[Entry]) -> None:
        raise NotImplementedError

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # -- generic versioned tables -------------------------------------------
    def _write(self, day, table: str, df: DataFrame, part: str = "", below: str = "", metrics: dict[str, F.Column] | None = None,
               parent: str | None = None, check: Callable[[dict], None] | None = None, without: tuple[str, ...] = ()) -> dict:
        """Write one date's rows of a table to a new folder. ``metrics`` are taken while writing, and checked before the
        folder becomes an entry; columns ``without`` are there for the metrics only."""
        version, path, got = self._version(), f"{table}/v={new_id()}{below}", {}
        if metrics:
            seen = Observation()
            df = df.observe(seen, *[c.alias(k) for k, c in metrics.items()]).drop(*without)
        df.write.parquet(self.path(path))
        if metrics:
            got = seen.get
        if check is not None:
            check(got)
        digest = f"{got['n_rows']}-{got['content']}-{got['content_2']}" if "content" in got else None
        if digest is not None:
            same = [e for e in self.entries.values() if e.table == table and e.digest == digest]
            if same:  # the content is stored already: the new copy goes
                remove(self.spark, self.path(path))
                path = same[0].path
        self._add([Entry(str(day), table, part, path, got.get("n_rows"), digest, version, parent)])
        return got

    def _version(self) -> str:
        return new_id()

    def _of(self, table: str, day=None, up_to=None, before=None) -> list[Entry]:
        """Current entries of a table, by date, without those known to have no rows."""
        return sorted((e for e in list(self.entries.values()) if e.table == table and e.n_rows != 0 and (day is None or e.load_dt == str(day))
                       and (up_to is None or e.load_dt <= str(up_to)) and (before is None or e.load_dt < str(before))), key=lambda e: e.key)

    def _read(self, table: str, schema: T.StructType, day=None) -> DataFrame:
        found = sorted({e.path for e in self._of(table, day)})
        if not found:
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*map(self.path, found))

    # -- staging (K2): replaced on every run, kept by date -----------------
    def write_staging(self, table: str, df: DataFrame, day, metrics: dict[str, F.Column] | None = None,
                      check: Callable[[dict], None] | None = None, without: tuple[str, ...] = ()) -> dict:
        """A date's staging; content that an earlier date's staging has already is stored once."""
        cols = [F.col(c) for c in struct_type(table).fieldNames()]
        whole = [*cols, *[c.isNull() for c in cols]]  # NULLs do not change a hash of their own
        hashes = {f"_hash{k}": F.xxhash64(F.lit(k), *whole) for k in ("", "_2")}
        # both halves of a hash are summed by themselves: exact as longs for 4 billion rows, where one sum would need decimals
        content = {"n_rows": F.count(F.lit(1)), **{f"content{k}": F.concat_ws("/", F.coalesce(F.sum(F.shiftright(f"_hash{k}", 32)), F.lit(0)), F.coalesce(
            F.sum(F.col(f"_hash{k}").bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)), F.lit(0))) for k in ("", "_2")}}
        df, without = df.withColumns(hashes), (*hashes, *without)
        return self._write(day, f"stg/{table}", df, metrics={**content, **(metrics or {})}, check=check, without=without)

    def read_staging(self, table: str, day=None) -> DataFrame:
        """A date's staging, or the newest date's."""
        dates = [e.load_dt for e in list(self.entries.values()) if e.table == f"stg/{table}"]
        return self._read(f"stg/{table}", struct_type(table), day if day is not None else max(dates, default=""))

    def staged(self, day) -> set[str]:
        """The staging tables that the archive has of a date."""
        return {e.table.removeprefix("stg/") for e in list(self.entries.values()) if e.load_dt == str(day) and e.table.startswith("stg/")}

    # -- dimensions --------------------------------------------------------
    def load_dim(self, name: str, day, staging: DataFrame, prev=None, hot_rows: int = HOT_ROWS) -> None:
        """Carry a dimension from the date ``prev`` on to ``day``: only the rows of touched keys are written.

        A history is a list of parts, oldest first; a key's rows are those of the newest part that has the key. Parts
        never change. A new part goes behind those of ``prev``, which both dates then share. It is put together with
        the parts before it that are less than twice its size, so sizes at least halve along the list: it has few
        parts, and a row is written again only a logarithmic number of times. A batch that touches no key adds none.
        """
        spec, table = SPECS[name], f"dim/{name}"
        base = self.entries.get((str(prev), table, "")) if prev is not None else None
        if base is None:
            self.write_dim(name, day, scd2_apply(empty(self.spark, spec.table).select(spec.columns), staging, day, spec, hot_rows), prev)
            return
        touched = scd2_apply(self.read_dim(name, prev), staging, day, spec, hot_rows, touched_only=True)
        version, parts = self._version(), list(zip(base.folders, base.sizes, strict=True))
        new = self._write_part(name, touched, len(parts))
        if new[1]:
            n, size = len(parts), new[1]
            while n and 2 * size > parts[n - 1][1]:
                n, size = n - 1, size + parts[n - 1][1]
            if n < len(parts):
                alone, new = new, self._write_part(name, self._parts(name, [p for p, _ in [*parts[n:], new]]), n)
                remove(self.spark, self.path(alone[0]))
            parts = [*parts[:n], new]
        else:
            remove(self.spark, self.path(new[0]))
        self._add([Entry.of_parts(str(day), table, parts, version, self.version_of(prev))])

    def write_dim(self, name: str, day, history: DataFrame, prev=None) -> None:
        """A whole history, as one part; ``prev`` is the date whose history it was built on."""
        version = self._version()
        self._add([Entry.of_parts(str(day), f"dim/{name}", [self._write_part(name, history, 0)], version, self.version_of(prev))])

    def _write_part(self, name: str, rows: DataFrame, level: int) -> tuple[str, int]:
        """Folder and row count of a new part, the one with number ``level`` in its list."""
        path, seen = f"dim/{name}/v={new_id()}", Observation()
        conform(rows, SPECS[name].table).withColumn("_level", F.lit(level)).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(self.path(path))
        return path, seen.get["n"]

    def _parts(self, name: str, folders: list[str]) -> DataFrame:
        """The history in some neighbouring parts, oldest first."""
        spec = SPECS[name]
        read = self.spark.read.schema(struct_type(spec.table).add("_level", T.IntegerType()))
        first = read.parquet(self.path(folders[0]))
        if len(folders) == 1:
            return first.select(spec.columns)
        return merged(first, read.parquet(*map(self.path, folders[1:])), spec, several=len(folders) > 2)

    def read_dim(self, name: str, as_of) -> DataFrame:
        found = None if as_of is None else self.entries.get((str(as_of), f"dim/{name}", ""))
        if found is None:
            return empty(self.spark, SPECS[name].table).select(SPECS[name].columns)
        return self._parts(name, found.folders)

    def read_dim_part(self, name: str, as_of) -> DataFrame:
        """The newest part of a history: whole keys that the last batches touched."""
        return self._parts(name, self.entries[(str(as_of), f"dim/{name}", "")].folders[-1:])

    def version_of(self, day, entries: dict[Key, Entry] | None = None) -> str | None:
        """The version of a date's histories (None: not loaded)."""
        entries = self.entries if entries is None else entries
        return next((e.version for n in SPECS if (e := entries.get((str(day), f"dim/{n}", ""))) is not None), None)

    # -- facts -------------------------------------------------------------
    def write_fact(self, day, fact: DataFrame) -> None:
        """The date's transactions file; a second write of the same date replaces it."""
        src = expected_file_names(_date(day))[2]
        self._write(day, "fact_transactions", conform(fact, "fact_transactions"), part=src, below=f"/load_dt={day}/src={_escaped(src)}")

    def write_fact_files(self, fact: DataFrame) -> None:
        """Fact rows with ``load_dt`` and ``src``, their input file: only the rows of these files are replaced."""
        path = f"fact_transactions/v={new_id()}"
        fact.write.partitionBy("load_dt", "src").parquet(self.path(path))
        if fact.isEmpty():
            return
        files = self.spark.read.parquet(self.path(path)).groupBy(F.col("load_dt").cast("string"), "src").count().collect()
        self._add([Entry(r.load_dt, "fact_transactions", r.src, f"{path}/load_dt={r.load_dt}/src={_escaped(r.src)}", r["count"], None, new_id())
                   for r in files])  # one row for each input file

    def read_fact(self, up_to=None, day=None, before=None) -> DataFrame:
        schema = struct_type("fact_transactions").add("load_dt", T.DateType())
        found = [self.path(e.path) for e in self._of("fact_transactions", day, up_to, before)]
        if not found:
            return empty_frame(self.spark, schema)
        read = self.spark.read.schema(schema).option("basePath", self.path("fact_transactions"))
        return read.parquet(*found).select(schema.fieldNames())

    # -- card tails: state of the reports with scope "day" -------------------
    def _covered(self, facts: list[Entry]) -> str:
        """Identity of the fact folders that a tail was taken of."""
        return hashlib.sha256("\n".join(e.path for e in facts).encode()).hexdigest()

    def tail_before(self, day) -> DataFrame:
        """Card tails of all facts loaded for dates before ``day``. They are kept with the newest of these dates; if
        they are missing, or those of other facts (loaded again or by the stream), they are taken of all facts once."""
        facts = self._of("fact_transactions", before=day)
        if not facts:
            return empty(self.spark, "fact_transactions")
        last, covered = facts[-1].load_dt, self._covered(facts)
        found = self.entries.get((last, "card_tail", ""))
        if found is None or found.parent != covered:
            self._write(last, "card_tail", tails.tail(self.read_fact(before=day)), parent=covered)
        return self._read("card_tail", struct_type("fact_transactions"), last)

    def write_tail(self, day) -> None:
        """Carry the tails on over the date's facts, which are loaded."""
        new = self.read_fact(day=day).drop("load_dt")
        self._write(day, "card_tail", tails.tail(self.tail_before(day).unionByName(new)), parent=self._covered(self._of("fact_transactions", up_to=day)))

    def write_blacklist(self, day, rows: DataFrame) -> None:
        self._write(day, "fact_passport_blacklist", rows)

    def read_blacklist(self, as_of) -> DataFrame:
        return self._read("fact_passport_blacklist", struct_type("fact_passport_blacklist"), as_of)

    # -- report and ledger -------------------------------------------------
    def write_report(self, day, rows: DataFrame) -> None:
        self._write(day, "rep_fraud", conform(rows, "rep_fraud"))

    def read_report(self) -> DataFrame:
        return self._read("rep_fraud", struct_type("rep_fraud"))

    def write_ledger(self, day, files: DataFrame) -> None:
        """The files that a date consumed: file_name and, as far as known, length, modified and digest."""
        files = files.withColumn("load_dt", _d(day))
        known = [F.col(f.name) if f.name in files.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA]
        self._write(day, "ledger", files.select(known).coalesce(1))

    def read_ledger(self) -> DataFrame:
        return self._read("ledger", LEDGER_SCHEMA)

    def write_rejected(self, day, counts: DataFrame) -> None:
        """Staged rows of each table that cannot be loaded for want of a key (``staging.REJECTED``)."""
        self._write(day, "rejected", counts.select(*stg.REJECTED.fieldNames(), _d(day).alias("load_dt")).coalesce(1))

    def read_rejected(self) -> DataFrame:
        return self._read("rejected", T.StructType([*stg.REJECTED, T.StructField("load_dt", T.DateType())]))

    def loaded_dates(self) -> list[dt.date]:
        """Batch dates in the ledger, ascending."""
        return sorted(dt.date.fromisoformat(e.load_dt) for e in list(self.entries.values()) if e.table == "ledger")

    def last_loaded_before(self, day) -> dt.date | None:
        """Newest batch date before ``day``."""
        return max((d for d in self.loaded_dates() if d < _date(day)), default=None)

    def stale_dates(self) -> list[dt.date]:
        """Loaded dates whose history was not built on the current one of the date before (a rebuild was lost half way)."""
        entries, stale = self.entries, []
        dates = sorted(e.load_dt for e in entries.values() if e.table == "ledger")
        for prev, day in zip([None, *dates], dates, strict=False):
            parents = [e.parent for n in SPECS if (e := entries.get((day, f"dim/{n}", ""))) is not None]
            if stale or any(p != self.version_of(prev, entries) for p in parents):
                stale.append(dt.date.fromisoformat(day))
        return stale


class Warehouse(Tables):
    """The published tables. Its own writes are published one by one; ``batch`` publishes several at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, self.path("commits"))

    @property
    def entries(self) -> dict[Key, Entry]:
        return self.log.state()

    def _add(self, entries: list[Entry]) -> None:
        self.log.publish(entries)

    def vacuum(self, hours: float = 24) -> list[str]:
        """Remove what the newest commit does not name: replaced and lost version folders, and earlier commits.

        Only folders without a file younger than ``hours``, which must be longer than any run or reader takes: a run
        under way has folders that no commit names yet. Files are listed, not read; returns the removed folders.
        """
        state, names = self.log.state(), self.log.names()
        if not names:
            return []
        kept = {m.group(1) for e in state.values() for f in e.folders if (m := _VERSION.match(f))}
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.root)
                  .select(F.regexp_extract("path", r"^(.*/(?:v=[0-9a-f]{12}|commits/[0-9a-f-]+))/", 1).alias("folder"), "modificationTime")
                  .groupBy("folder").agg(F.max("modificationTime").alias("newest"))
                  .where(F.col("newest") < F.current_timestamp() - F.expr(f"make_dt_interval(0, 0, 0, {hours * 3600})")).collect())
        below, gone = f"{self.root.split('://')[-1]}/", []
        for folder in sorted(r.folder.split(below, 1)[1] for r in listed if below in r.folder):
            if folder not in kept and folder != f"commits/{names[-1]}":
                remove(self.spark, self.path(folder))
                gone.append(folder)
        return gone

    def batch(self, on: Tables | None = None) -> Batch:
        """Writes to be published together; reads see what ``on`` (the published tables, or an earlier batch) has, and the batch's own."""
        return Batch(self, on or self)


class Batch(Tables):
    def __init__(self, wh: Warehouse, on: Tables):
        self.spark, self.root, self.wh, self.on = wh.spark, wh.root, wh, on
        self.entries, self.own, self.version, self.done = dict(on.entries), [], new_id(), False

    def _version(self) -> str:
        return self.version

    def _add(self, entries: list[Entry]) -> None:
        self.own += entries
        self.entries |= {e.key: e for e in entries}

    def publish(self) -> None:
        """One commit of all that was written; after the batch that this one was built on."""
        if isinstance(self.on, Batch) and self.on.own and not self.on.done:
            raise RuntimeError("the batch that this one was built on is not published")
        self.wh.log.publish(self.own)
        self.done = True


def _date(day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


class MissingSnapshot(RuntimeError):
    """A past date's operational tables can be had neither from the source nor from the archive."""


_LOOKUP = object()


def _staged(source: DailySource, day: dt.date) -> dict[str, Callable[[], DataFrame]]:
    """The six staging frames of a date (K2 content)."""
    return {
        "stg_clients": lambda: stg.stage_clients(source.clients(day)),
        "stg_accounts": lambda: stg.stage_accounts(source.accounts(day)),
        "stg_cards": lambda: stg.stage_cards(source.cards(day)),
        "stg_terminals": lambda: stg.stage_terminals(source.terminals(day)),
        "stg_blacklist": lambda: stg.stage_blacklist(source.blacklist(day)),
        "stg_transactions": lambda: stg.stage_transactions(source.transactions(day), lenient=True),
    }


def stage(to: Tables, day: dt.date, frames: dict[str, Callable[[], DataFrame]], parallel: int = 6) -> dict[str, DataFrame]:
    """Write staging tables and read them back; counts are taken while writing.

    Unparsable amounts fail the date before anything of it is published, with
    their number and the first of them (Q13); rows without a business key are
    counted in ``rejected`` (Q16).
    """
    keys = {f"stg_{name}": spec.key for name, spec in SPECS.items()}

    def one(table: str, df: DataFrame) -> int | None:
        if table == "stg_transactions":
            to.write_staging(table, df, day, stg.bad_amounts(), check=lambda got: stg.refuse_bad_amounts(day, got), without=(stg.BAD,))
            return None
        null = {"no_key": F.count_if(F.col(keys[table]).isNull())} if table in keys else {}
        return to.write_staging(table, df, day, null).get("no_key")

    counts = dict(zip(frames, _each([lambda t=t, f=f: one(t, f()) for t, f in frames.items()], parallel), strict=True))
    rejected = [(t, keys[t], n) for t, n in counts.items() if n is not None]
    if rejected:
        to.write_rejected(day, to.spark.createDataFrame(rejected, stg.REJECTED))
    return {t: to.read_staging(t, day) for t in frames}


def run_day(spark: SparkSession, source: DailySource, wh: Warehouse, day: dt.date,
            prev=_LOOKUP, parallel: int = 6, scope: str = "all") -> None:
    """One date: ``load_day``, ``report_day``, and the commit that publishes both."""
    batch = wh.batch()
    load_day(spark, source, batch, day, prev, parallel, scope=scope)
    report_day(spark, source, batch, day, scope=scope)
    batch.publish()


def load_day(spark: SparkSession, source: DailySource, batch: Tables, day: dt.date,
             prev=_LOOKUP, parallel: int = 6, archived: Iterable[str] = (), scope: str = "all") -> None:
    """Stage, maintain the four dimensions, load the facts and the blacklist; with scope "day" the card tails too.

    ``prev`` is the previous batch date (the newest loaded one before ``day``
    when not given). The staging tables of the date are written first (K2),
    but for the ``archived`` ones, which are those of an earlier load of the
    date; every load reads them back, so all loads of the date see one
    snapshot of the operational tables, read once. The loads are independent
    Spark jobs and are submitted from ``parallel`` driver threads.
    """
    if prev is _LOOKUP:
        prev = batch.last_loaded_before(day)
    if hasattr(source, "check") and len(set(archived)) < 6:
        source.check(day)          # every input of the date exists before any write (Q19)
    frames = {t: f for t, f in _staged(source, day).items() if t not in set(archived)}
    staged = stage(batch, day, frames, parallel) | {t: batch.read_staging(t, day) for t in archived}
    loads = [lambda name=name: batch.load_dim(name, day, staged[f"stg_{name}"], prev) for name in SPECS]

    def facts() -> None:
        batch.write_fact(day, stg.to_fact(staged["stg_transactions"]))
        if scope == "day":
            batch.write_tail(day)

    loads.append(facts)
    loads.append(lambda: batch.write_blacklist(day, stg.to_blacklist_fact(staged["stg_blacklist"])))
    _each(loads, parallel)


def day_report(batch: Tables, day: dt.date) -> DataFrame:
    """The report of the operations loaded for ``day`` alone, with the dimensions as of ``day``.

    It equals the part of the full report that these operations make. Earlier
    dates' facts are read only if there are late cards, and for them only.
    """
    fact, carried = batch.read_fact(day=day).drop("load_dt"), batch.tail_before(day)
    late, earlier = tails.late_cards(carried, fact), None
    if late.isEmpty():
        late = None
    else:
        earlier = batch.read_fact(before=day)
    return report(flagged_day(fact, tails.before(carried, fact, late, earlier), **_dims(batch, day)), day)


def _dims(batch: Tables, day: dt.date) -> dict[str, DataFrame]:
    return {**{f"{n}_hist": batch.read_dim(n, day) for n in ("cards", "accounts", "clients", "terminals")}, "blacklist": batch.read_blacklist(day)}


def report_day(spark: SparkSession, source: DailySource, batch: Tables, day: dt.date, keep_ledger: bool = False, scope: str = "all") -> None:
    """The report over every fact loaded up to ``day`` (scope "day":
    the date's own) with the dimensions as of ``day``, then the ledger entry of
    the date (but not for a date that is built again from the archive: it
    consumed no file)."""
    if scope == "day":
        rep = day_report(batch, day)
    else:
        rep = fraud_report(batch.read_fact(up_to=day).drop("load_dt"), **_dims(batch, day), report_dt=day)
    batch.write_report(day, rep)
    if not keep_ledger:
        batch.write_ledger(day, source.consumed(day) if hasattr(source, "consumed") else
                           spark.createDataFrame([(n,) for n in expected_file_names(day)], "file_name string"))


def _each(jobs, parallel: int) -> list:
    """Run independent Spark jobs, concurrently from driver threads."""
    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return [fut.result() for fut in [pool.submit(f) for f in jobs]]
    return [f() for f in jobs]


class StaleHistory(RuntimeError):
    pass


def run(spark: SparkSession, source: DailySource, wh: Warehouse, dates=None,
        parallel: int = 6, rebuild_later: bool = False, scope: str = "all") -> list[dt.date]:
    """Every date in ascending order (``source.dates()`` when not given); returns the dates loaded.

    A date's history builds on the newest date before it that is loaded, or in
    this run. Loaded dates that are later than one of ``dates`` build on what
    is about to change, as do dates that an interrupted rebuild left stale:
    unless they are among ``dates``, the run is refused (``StaleHistory``),
    or, with ``rebuild_later``, builds them again from their archived staging.

    A source whose operational tables are always today's
    (``dated_snapshots`` False) cannot serve a date before a loaded one: such
    a date takes clients, accounts and cards from the archive, and is refused
    (``MissingSnapshot``) before anything is written if it was never staged.

    ``scope`` says what each report covers (``SCOPES``). With "day" its cost
    does not grow with the dates loaded before.

    The report of day *n* only reads what day *n*'s loads wrote (facts up to
    *n*, snapshots as of *n*), so it runs in the background while day *n+1*
    loads. A date is published when its report is written, and dates are
    published in order; a failure surfaces before the next report starts, and
    a re-run resumes at the first date that is not published.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope {scope!r} is none of {SCOPES}")
    days = sorted(set(dates if dates is not None else source.dates()))
    if not days:
        return []
    now = wh.batch()
    loaded, stale, archive, asked = now.loaded_dates(), now.stale_dates(), {}, set(days)
    later = [d for d in loaded if (d > days[0] or d in stale) and d not in asked]
    if later and not rebuild_later:
        raise StaleHistory(f"{', '.join(map(str, later))}: loaded already and built on earlier dates than {days[0]}, or on others than "
                           "are loaded now; build them again too (rebuild_later)")
    days = sorted({*days, *later})
    for day in days:
        if day in asked:
            past = any(d > day for d in loaded) and not getattr(source, "dated_snapshots", True)
            archive[day] = set(SNAPSHOTS) if past else set()
        else:
            archive[day] = set(_staged(source, day))
        if missing := sorted(archive[day] - now.staged(day)):
            raise MissingSnapshot(f"{day}: {', '.join(missing)} not archived, and the source has only today's")
    with ThreadPoolExecutor(max_workers=1) as background:
        pending, on = None, now
        for k, day in enumerate(days):
            prev = max([d for d in [*loaded, *days[:k]] if d < day], default=None)
            batch = wh.batch(on)
            load_day(spark, source, batch, day, prev, parallel, archive[day], scope)
            if pending is not None:
                pending.result()

            def finish(batch=batch, day=day):
                report_day(spark, source, batch, day, keep_ledger=day not in asked, scope=scope)
                batch.publish()

            pending, on = background.submit(finish), batch
        pending.result()
    return days
