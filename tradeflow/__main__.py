"""Jobs for ``spark-submit`` or ``python -m tradeflow``.

    hot       --messages DIR --store DIR --checkpoint DIR [--lines] [--once]
    move      --store DIR [--checkpoint DIR --every S] [--delay S]
    compact   --store DIR [--before MS]
    universe  --pages DIR --out DIR
    train     --trades CSV --model DIR
    predict   --model DIR --volume N [--volume N ..]

``hot`` and ``move`` run until they are stopped, except ``hot --once``, which ends
when the folder is read, and ``move`` without a checkpoint, which moves once.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from tradeflow.constants import MOVE_SECONDS
from tradeflow.functions.time import cutoff_ms
from tradeflow.operators import forecast
from tradeflow.operators.universe import universe_from_pages
from tradeflow.session import configure
from tradeflow.sources.html import read_pages
from tradeflow.sources.messages import stream_messages
from tradeflow.sources.store import TradeStore
from tradeflow.sources.tables import overwrite_parquet, read_training
from tradeflow.streaming.flows import start_hot_trades, start_moves


def hot(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = stream_messages(
        spark, args.messages, multi_line=not args.lines, max_bytes=args.max_bytes
    )
    trigger = {"availableNow": True} if args.once else {}
    start_hot_trades(messages, args.store, args.checkpoint, **trigger).awaitTermination()


def move(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.checkpoint:
        start_moves(spark, args.store, args.checkpoint, args.every, args.delay).awaitTermination()
    else:
        cutoff = cutoff_ms(round(time.time() * 1000), args.delay)
        print(TradeStore(spark, args.store).move(cutoff))


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    before = round(time.time() * 1000) if args.before is None else args.before
    print(TradeStore(spark, args.store).compact(before))


def universe(spark: SparkSession, args: argparse.Namespace) -> None:
    overwrite_parquet(universe_from_pages(read_pages(spark, args.pages)), args.out)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    forecast.save_leaves(forecast.leaves(read_training(spark, args.trades)), args.model)


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.createDataFrame([(v,) for v in args.volume], "volume int")
    for row in forecast.nearest_leaf(forecast.load_leaves(spark, args.model), requests).collect():
        print(row.volume, row.prediction)


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradeflow", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(required=True)

    def job(f, *names: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(f.__name__)
        sub.set_defaults(job=f)
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        return sub

    one = job(hot, "messages", "store", "checkpoint")
    one.add_argument(
        "--lines", action="store_true", help="files hold one message a line, not one message"
    )
    one.add_argument("--once", action="store_true")
    one.add_argument("--max-bytes", type=int, help="bound of one micro-batch")
    one = job(move, "store")
    one.add_argument("--checkpoint")
    one.add_argument("--every", type=float, default=MOVE_SECONDS)
    one.add_argument("--delay", type=int, default=MOVE_SECONDS)
    job(compact, "store").add_argument("--before", type=int, help="epoch ms")
    job(universe, "pages", "out")
    job(train, "trades", "model")
    job(predict, "model").add_argument("--volume", type=int, action="append", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    args.job(configure(SparkSession.builder.appName("tradeflow").getOrCreate()), args)


if __name__ == "__main__":
    main()
