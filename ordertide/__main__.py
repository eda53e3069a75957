"""One daily run from the shell: spark-submit, or python -m ordertide ORDERS.csv ROOT."""

import argparse
import datetime as dt

from ordertide.plans.refresh import refresh
from ordertide.session import session
from ordertide.sources.orders import load_csv


def main() -> int:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    parser = argparse.ArgumentParser(prog="ordertide", description=__doc__)
    parser.add_argument("orders", help="CSV file or folder of raw orders")
    parser.add_argument("root", help="folder of the stored tables, shared by all executors")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, default=now,
                        help="moment of the run (default: now, UTC)")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild the marts")
    parser.add_argument("--replace-window", action="store_true",
                        help="drop days and countries that vanished inside the lookback")
    parser.add_argument("--multiline", action="store_true",
                        help="allow line breaks inside quoted cells (one task per file)")
    args = parser.parse_args()

    spark = session()
    raw = load_csv(spark, args.orders, args.multiline)
    report = refresh(spark, args.root, raw, args.as_of, args.as_of, args.full_refresh,
                     args.replace_window)
    print(f"freshness: {report.freshness}")
    for name, rows in report.rows.items():
        print(f"{name}: {rows} rows written")
    if report.checks is None:
        return 1
    failed = report.checks.filter("status <> 'pass'").collect()
    for check in failed:
        print(f"{check.table}.{check.column} {check.check}: {check.failing_rows} failing")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
