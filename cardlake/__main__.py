"""Daily run from the command line (what a scheduler calls once a day).

    spark-submit -m cardlake --landing s3://landing/cards --warehouse s3://wh/cards \\
        --snapshot-format jdbc --option url=jdbc:postgresql://... --option user=... \\
        --accounts ops.accounts --clients ops.clients --cards ops.cards

Without ``--date`` every date that still has unconsumed files in the landing
folder is loaded, oldest first.
"""

from __future__ import annotations

import argparse
import datetime as dt

from cardlake.plans.daily import SCOPES, Warehouse, run
from cardlake.session import get_spark
from cardlake.sources.inputs import FileSource
from cardlake.sources.staging import snapshot_reader


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cardlake", description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True, help="folder with the dated input files")
    ap.add_argument("--warehouse", required=True, help="warehouse root")
    ap.add_argument("--snapshot-format", default="parquet",
                    help="reader of the operational tables: jdbc, table, parquet, orc, ...")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="snapshot reader option (repeatable), e.g. url=, numPartitions=")
    ap.add_argument("--accounts", required=True)
    ap.add_argument("--clients", required=True)
    ap.add_argument("--cards", required=True)
    ap.add_argument("--date", action="append", default=[], help="YYYY-MM-DD (repeatable)")
    ap.add_argument("--rebuild-later", action="store_true",
                    help="also build every later date again that is already loaded (its history builds on these dates), from its archived staging")
    ap.add_argument("--report-scope", choices=SCOPES, default="all",
                    help="what a date's report covers: every operation loaded so far, or the date's own")
    ap.add_argument("--vacuum-hours", type=float, metavar="HOURS",
                    help="after the run, remove folders that no commit names any more and that nothing was written to for so long")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = get_spark(a.master)
    opts = dict(o.split("=", 1) for o in a.option)

    def snap(name):
        return lambda day: snapshot_reader(spark, a.snapshot_format, name, **opts)

    src = FileSource(spark, a.landing, snap(a.accounts), snap(a.clients), snap(a.cards))
    wh = Warehouse(spark, a.warehouse)
    dates = ([dt.date.fromisoformat(d) for d in a.date] if a.date
             else src.dates(ledger=wh.read_ledger()))
    dates = run(spark, src, wh, dates=dates, rebuild_later=a.rebuild_later, scope=a.report_scope)
    print(f"loaded {len(dates)} date(s): {', '.join(map(str, dates)) or '-'}")
    if a.vacuum_hours is not None:
        print(f"removed {len(wh.vacuum(a.vacuum_hours))} folder(s)")


if __name__ == "__main__":
    main()
