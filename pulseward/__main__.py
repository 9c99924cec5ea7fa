"""Run catalogue queries: ``python -m pulseward list`` or ``python -m pulseward run NAME DATA_DIR [--out PATH]``.

``run`` writes the full result as parquet to ``--out`` (executed on the cluster, nothing collected), or
prints the first ``--show`` rows when no output is given.
"""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m pulseward")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the catalogue queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name")
    run.add_argument("data_dir", help="folder with the input parquet tables")
    run.add_argument("--out", help="write the result here as parquet")
    run.add_argument("--show", type=int, default=20)
    run.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from .plans.catalog import QUERIES
    if args.cmd == "list":
        for name, fn in QUERIES.items():
            print(f"{name:26s} {(fn.__doc__ or '').strip().splitlines()[0]}")
        return 0
    if args.name not in QUERIES:
        ap.error(f"unknown query {args.name!r}; see 'python -m pulseward list'")
    from .session import get_spark
    spark = get_spark(master=args.master)
    df = QUERIES[args.name](spark, args.data_dir)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
