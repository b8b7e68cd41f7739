"""Run one day: spark-submit run_daily.py <folder with the CSV files> <root of the tables> [YYYY-MM-DD]"""

from __future__ import annotations

import datetime as dt
import sys

from ledgerloom.plans.daily import run_daily
from ledgerloom.session import build_session
from ledgerloom.sources.tables import TableStore


def main(arguments: list[str]) -> None:
    data_dir, root, *rest = arguments
    as_of = dt.date.fromisoformat(rest[0]) if rest else None
    spark = build_session("ledgerloom-daily")
    run_daily(TableStore(spark, root), data_dir, as_of).show(truncate=False)


if __name__ == "__main__":
    if len(sys.argv) not in (3, 4):
        sys.exit(__doc__)
    main(sys.argv[1:])
