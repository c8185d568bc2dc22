"""Command line: generate raw rows, run the daily refresh, train a model, price requests.

    python -m tarifa generate --root /data/fares --records 1000
"""

from __future__ import annotations

import argparse

from tarifa.plans import refresh
from tarifa.session import build_session
from tarifa.sources.requests import read_requests


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tarifa", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("generate", "refresh", "train", "price"):
        command = commands.add_parser(name)
        command.add_argument("--root", help="folder of the tables")
        if name == "generate":
            command.add_argument("--records", type=int, default=1000)
            command.add_argument("--search-date")
            command.add_argument("--seed", type=int)
        if name in ("train", "price"):
            command.add_argument("--model", required=True)
        if name == "train":
            command.add_argument("--sample", type=float, default=0.3)
            command.add_argument("--trees", type=int, default=1500)
            command.add_argument("--depth", type=int, default=10)
        if name == "price":
            command.add_argument("--requests", required=True, help="JSON lines, one request each")
            command.add_argument("--output", required=True)
    options = parser.parse_args(arguments)
    spark = build_session()
    if options.command == "generate":
        added = refresh.ingest(spark, options.root, options.records, options.search_date, options.seed)
        print(f"{added} rows added")
    elif options.command == "refresh":
        print(f"published {refresh.refresh(spark, options.root)}")
    elif options.command == "train":
        refresh.train(
            spark, options.root, options.model, options.sample, trees=options.trees, depth=options.depth
        )
    else:
        requests = read_requests(spark, options.requests)
        refresh.price(spark, requests, options.model, ["request_id"]).write.json(options.output)


if __name__ == "__main__":
    main()
