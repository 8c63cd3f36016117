"""Run a stream from the command line.

    spark-submit ... -m brooktext train --source text --path DIR --models-dir DIR
    spark-submit ... -m brooktext score --source kafka --option subscribe=t ... --models-dir DIR
    spark-submit ... -m brooktext count --source socket --port 9009 --out DIR
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from brooktext.sources import feed
from brooktext.sources.workspace import new_folder
from brooktext.streaming.keyed_counts import keyed_lines, read_counts, start_batch_counts, start_running_counts
from brooktext.streaming.learners import MODELS, PASSES
from brooktext.streaming.scorer import StreamScorer
from brooktext.streaming.trainer import LABEL_MODES, MODES, StreamTrainer


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="brooktext")
    parser.add_argument("command", choices=("train", "score", "count"))
    parser.add_argument("--source", choices=("text", "socket", "kafka"), default="text")
    parser.add_argument("--path", help="folder of a text source")
    parser.add_argument("--host", default="localhost")
    parser.add_argument("--port", type=int)
    parser.add_argument("--option", action="append", default=[], help="further source option, name=value")
    parser.add_argument("--models-dir", help="folder of the models, for train and score")
    parser.add_argument("--out", help="folder of the counts, for count")
    parser.add_argument("--checkpoint", help="stream checkpoint; a new one if not given")
    parser.add_argument("--interval", help="trigger interval; without it, files are read to their end")
    parser.add_argument("--keep-versions", type=int, help="model versions kept by train")
    parser.add_argument("--timeout", type=float, help="seconds to run")
    parser.add_argument("--max-batches", type=int, help="non-empty batches to end after; without it, no limit")
    parser.add_argument("--models", nargs="+", choices=MODELS, default=list(MODELS))
    parser.add_argument("--width", type=int)
    parser.add_argument("--loss", choices=("log", "hinge"), default="log")
    parser.add_argument("--mode", choices=MODES, default="post_fit")
    parser.add_argument("--label-mode", choices=LABEL_MODES, default="stable")
    parser.add_argument("--labels", nargs=2, metavar=("CLASS0", "CLASS1"), help="the two labels, for a stable mapping")
    parser.add_argument("--passes", type=int, default=PASSES, help="passes of SGD and MLP over each batch")
    parser.add_argument("--tasks", type=int, help="most tasks for the passes over a batch")
    parser.add_argument("--keep-predictions", action="store_true", help="score: store a row per model and record")
    parser.add_argument("--literal-divisor", action="store_true", help="score: divide mean accuracy by one more batch")
    parser.add_argument("--counts", choices=("running", "batch"), default="running", help="count: since the start or per batch")
    parser.add_argument("--emit", choices=("all", "changed"), default="all", help="count: keys written by each batch")
    parser.add_argument("--parser", choices=("decode", "literal"), default="decode")
    parser.add_argument("--key-position", type=int, default=0)
    return parser.parse_args(argv)


def source_options(args: argparse.Namespace) -> dict[str, str]:
    options = dict(pair.split("=", 1) for pair in args.option)
    if args.source == "text":
        options["path"] = args.path
    elif args.source == "socket":
        port = args.port or (feed.COUNT_PORT if args.command == "count" else feed.MODEL_PORT)
        options |= {"host": args.host, "port": str(port)}
    return options


def trigger_of(args: argparse.Namespace) -> dict | None:
    """The given interval; the usual one for a source that has no end."""
    interval = args.interval
    if interval is None and args.source != "text":
        interval = feed.COUNT_INTERVAL if args.command == "count" else feed.MODEL_INTERVAL
    return {"processingTime": interval} if interval else None


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = feed.line_stream(spark, args.source, **source_options(args))
    checkpoint = args.checkpoint or new_folder(spark, "checkpoint")
    limits = {"trigger": trigger_of(args), "max_batches": args.max_batches}
    if args.command == "count":
        keys = keyed_lines(lines, args.key_position)
        if args.counts == "batch":
            counting = start_batch_counts(keys, args.out, checkpoint, **limits)
        else:
            counting = start_running_counts(keys, args.out, checkpoint, emit=args.emit, **limits)
        counting.wait(args.timeout)
        value = "n" if args.counts == "batch" else "total"
        read_counts(spark, args.out, value).orderBy("batch_id", "key").show()
        return
    common = {"models": tuple(args.models), "label_mode": args.label_mode, "parser": args.parser}
    common |= {"labels": args.labels, "tasks": args.tasks}
    if args.command == "train":
        worker = StreamTrainer(
            spark, args.models_dir, **({"width": args.width} if args.width else {}),
            loss=args.loss, mode=args.mode, passes=args.passes, keep_versions=args.keep_versions, **common,
        )
    else:
        worker = StreamScorer(spark, args.models_dir, args.width, keep_predictions=args.keep_predictions, **common)
    run = worker.start(lines, checkpoint, **limits)
    run.wait(args.timeout)
    if run.limited:
        print(f"stopped after {run.batches} batches as told by --max-batches; input may be left")
    worker.metrics().orderBy("batch_id", "model").show(truncate=False)
    if args.command == "score":
        worker.leaderboard(args.literal_divisor).show()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    run(SparkSession.builder.appName("brooktext").getOrCreate(), arguments())
