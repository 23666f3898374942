"""python -m hustings list | explain QUERY FOLDER | run QUERY FOLDER OUT: the catalogue from the command line."""

from __future__ import annotations

import argparse

from hustings.queries import queries
from hustings.session import local_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hustings", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    for name in ("explain", "run"):
        one = commands.add_parser(name)
        one.add_argument("query", choices=sorted(queries()))
        one.add_argument("folder")
        if name == "run":
            one.add_argument("out")
    args = parser.parse_args(argv)
    if args.command == "list":
        for name, function in sorted(queries().items()):
            print(f"{name}: {(function.__doc__ or '').splitlines()[0] if function.__doc__ else ''}".rstrip(": "))
        return
    spark = local_session("hustings")
    result = queries()[args.query](spark, args.folder)
    if args.command == "explain":
        result.explain("formatted")
    else:
        result.write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
