"""Streaming job from a topic, for spark-submit.

    spark-submit --packages <kafka connector> --py-files txrisk.zip \\
        txrisk/__main__.py --servers HOST:PORT --root PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse
import logging
import os

from txrisk.session import build_session
from txrisk.sources.messages import topic_stream
from txrisk.sources.tables import create_tables
from txrisk.streaming.job import TRIGGER, run, start
from txrisk.streaming.ledger import Ledger
from txrisk.streaming.sinks import jdbc_sink, parquet_sink


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="txrisk")
    parser.add_argument("--servers", required=True, help="message broker addresses")
    parser.add_argument("--topic", default="transactions")
    parser.add_argument("--checkpoint", required=True, help="folder all executors share")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--root", help="folder of the Parquet tables")
    target.add_argument("--jdbc-url", help="database of the tables")
    parser.add_argument("--jdbc-user", default="")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument(
        "--plain-append", action="store_true",
        help="database tables hold the contract's columns only; a retried batch repeats rows",
    )
    parser.add_argument("--interval", default=TRIGGER, help="time between batches")
    parser.add_argument(
        "--guard", metavar="TIME",
        help="leave out messages delivered again within this time, such as '10 minutes'",
    )
    parser.add_argument(
        "--source-option", action="append", default=[], metavar="NAME=VALUE",
        help="further option of the topic source, may be repeated",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = arguments(argv)
    spark = build_session()
    ledger = None
    if args.root:
        create_tables(spark, args.root)
        sink, ledger = parquet_sink(args.root), Ledger(spark, args.root)
        ledger.create()
    else:
        properties = {
            "user": args.jdbc_user,
            "password": os.environ.get("JDBC_PASSWORD", ""),
            "driver": args.jdbc_driver,
        }
        sink = jdbc_sink(args.jdbc_url, properties, replay_safe=not args.plain_append)
    options = dict(option.split("=", 1) for option in args.source_option)
    raw = topic_stream(spark, args.servers, args.topic, **options)
    query = start(
        raw, sink, args.checkpoint, interval=args.interval, guard=args.guard, ledger=ledger
    )
    run(spark, query)


if __name__ == "__main__":
    main()
