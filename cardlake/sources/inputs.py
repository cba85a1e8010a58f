"""A ``DailySource`` over a landing folder of dated files plus snapshot tables.

Per date: ``transactions_DDMMYYYY.txt`` (S2), ``terminals_DDMMYYYY.xlsx`` and
``passport_blacklist_DDMMYYYY.xlsx`` (S3); accounts, clients and cards come
from snapshot readers (S4, e.g. ``snapshot_reader(spark, "jdbc", ...)``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.schemas import struct_type
from cardlake.sources.files import (
    batch_dates,
    expected_file_names,
    input_files,
    list_files,
    pending_files,
    read_transactions,
    unchanged,
    with_digests,
)
from cardlake.sources.workbook import read_workbooks

Snapshot = Callable[[dt.date], DataFrame]


class MissingInput(RuntimeError):
    pass


class UnknownInput(RuntimeError):
    pass


class FileSource:
    """``dated_snapshots``: the snapshot readers serve a past date's tables for a past date (else they serve today's)."""

    def __init__(self, spark: SparkSession, landing: str, accounts: Snapshot,
                 clients: Snapshot, cards: Snapshot, dated_snapshots: bool = False):
        self.spark = spark
        self.dated_snapshots = dated_snapshots
        self.landing = landing.rstrip("/")
        self._snap = {"accounts": accounts, "clients": clients, "cards": cards}

    def listing(self) -> DataFrame:
        return list_files(self.spark, self.landing)

    def dates(self, ledger: DataFrame | None = None) -> list[dt.date]:
        """Batch dates in the folder, ascending; with a ledger, only dates
        that still have unconsumed files (K7).

        A file of a known name that was delivered again counts as unconsumed
        if its content has changed; only such files are read for it.
        """
        names = self.listing()
        if ledger is not None:
            names = pending_files(names, ledger)
            known = names.join(ledger.select("file_name").distinct(), "file_name", "left_semi")
            if again := [r.path for r in known.select("path").collect()]:  # files delivered again since the last run
                names = names.join(unchanged(with_digests(self.spark, again), ledger), "file_name", "left_anti")
        return batch_dates(names.select("file_name"))

    def file_names(self, day: dt.date) -> list[str]:
        return expected_file_names(day)

    def consumed(self, day: dt.date) -> DataFrame:
        """The date's files as the ledger keeps them: name, length, time and digest."""
        return with_digests(self.spark, [self._path(n) for n in self.file_names(day)]).drop("path")

    def check(self, day: dt.date) -> None:
        """Q19: all three files of a date must be present before anything is written.

        Any other input file of that date is refused: it would be neither
        loaded nor entered in the ledger, and its date would stay pending.
        Only names with the date's token are listed.
        """
        want = set(self.file_names(day))
        listed = list_files(self.spark, self.landing, f"*{day.strftime('%d%m%Y')}*")
        have = {r.file_name for r in input_files(listed).where(F.col("file_dt") == F.lit(str(day)).cast("date"))
                .select("file_name").collect()}
        if missing := sorted(want - have):
            raise MissingInput(f"{day}: missing {missing}")
        if unknown := sorted(have - want):
            raise UnknownInput(f"{day}: not known {unknown}")

    def _path(self, name: str) -> str:
        return f"{self.landing}/{name}"

    def transactions(self, day: dt.date) -> DataFrame:
        return read_transactions(self.spark, self._path(self.file_names(day)[2])) \
            .drop("file_dt")

    def terminals(self, day: dt.date) -> DataFrame:
        return read_workbooks(self.spark, self._path(self.file_names(day)[1]),
                              struct_type("stg_terminals")).drop("file_name")

    def blacklist(self, day: dt.date) -> DataFrame:
        return read_workbooks(self.spark,
                              self._path(self.file_names(day)[0]),
                              struct_type("stg_blacklist")).drop("file_name")

    def accounts(self, day: dt.date) -> DataFrame:
        return self._snap["accounts"](day)

    def clients(self, day: dt.date) -> DataFrame:
        return self._snap["clients"](day)

    def cards(self, day: dt.date) -> DataFrame:
        return self._snap["cards"](day)
