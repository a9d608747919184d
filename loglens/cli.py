"""Command-line jobs, one per program a user of the classic jobs ran.

    python -m loglens word-count PATH [--out DIR]
    python -m loglens longest-line PATH
    python -m loglens member-filter PATH --keys one,two,three
    python -m loglens regex-filter PATH --regex '\\d+'
    python -m loglens sum PATH            (one integer per line)
    python -m loglens concat PATH         (lines in read order, in chunks of --chunk lines)
    python -m loglens stream-hits --source kafka --props FILE --length '30 seconds' --slide '10 seconds'
    python -m loglens stream-hits --source files --path DIR --available-now ...
    python -m loglens stream-count --source files --path DIR --trigger '5 seconds'

Batch jobs compute the whole result; without ``--out`` every row is printed,
with it the result is written as parquet.  Stream jobs need a checkpoint folder
(``--checkpoint``: a restart on the same one goes on where it stopped) and write
each micro-batch through the idempotent sinks of :mod:`loglens.streaming`;
``stream-print`` prints every value.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.operators import (
    concat_ordered, longest_line, member_filter, regex_filter, total_sum, word_count_sorted,
)
from loglens.session import build_session
from loglens.sources import load_properties, read_kafka_stream, text_lines
from loglens.streaming.jobs import ROCKSDB_PROVIDER
from loglens.streaming import (
    batch_count_sink, leaderboard_sink, print_values, run_available, socket_stream,
    text_stream, windowed_hits,
)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    # Read position: line order within a split, splits in partition order.
    return text_lines(spark, path).select(
        F.monotonically_increasing_id().alias("pos"), "value")


def batch_job(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The DataFrame of a batch subcommand (separate for tests)."""
    lines = text_lines(spark, args.path)
    if args.cmd == "word-count":
        return word_count_sorted(lines)
    if args.cmd == "longest-line":
        return longest_line(lines)
    if args.cmd == "member-filter":
        return member_filter(lines, "value", [k.strip() for k in args.keys.split(",")])
    if args.cmd == "regex-filter":
        return regex_filter(lines, "value", args.regex)
    if args.cmd == "sum":
        return total_sum(lines.select(F.trim("value").cast("bigint").alias("v")), "v")
    if args.cmd == "concat":
        # ids are unique, so a chunk holds at most --chunk lines
        return concat_ordered(_numbered_lines(spark, args.path), "value", "pos",
                              chunk_width=args.chunk).orderBy("chunk")
    raise ValueError(args.cmd)


def _stream_source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source == "kafka":
        return read_kafka_stream(spark, load_properties(args.props)).select("value")
    if args.source == "socket":
        return socket_stream(spark, args.host, args.port)
    return text_stream(spark, args.path)


def stream_job(spark: SparkSession, args: argparse.Namespace) -> None:
    root = args.checkpoint
    source = _stream_source(spark, args)
    if args.cmd == "stream-hits":
        stream = windowed_hits(source, args.length, args.slide, args.watermark, args.time)
        sink = leaderboard_sink(f"{root}/snapshots", args.top, args.by, args.min_hits)
        mode = "append"
    elif args.cmd == "stream-print":
        stream, sink, mode = source, print_values(), "append"
    else:
        stream, sink, mode = source, batch_count_sink(f"{root}/out"), "append"
    if args.available_now:
        run_available(stream, sink, f"{root}/checkpoint", output_mode=mode,
                      state_partitions=args.state_partitions, state_store=args.state_store)
        return
    if args.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.state_partitions))
    if args.state_store == "rocksdb":
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    q = (stream.writeStream.foreachBatch(sink).outputMode(mode)
               .option("checkpointLocation", f"{root}/checkpoint")
               .trigger(processingTime=args.trigger).start())
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loglens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("word-count", "longest-line", "member-filter", "regex-filter", "sum", "concat"):
        b = sub.add_parser(name)
        b.add_argument("path")
        b.add_argument("--out")
        if name == "member-filter":
            b.add_argument("--keys", required=True)
        if name == "regex-filter":
            b.add_argument("--regex", required=True)
        if name == "concat":
            b.add_argument("--chunk", type=int, default=1000)
    for name in ("stream-hits", "stream-count", "stream-print"):
        s = sub.add_parser(name)
        s.add_argument("--source", choices=("kafka", "socket", "files"), default="files")
        s.add_argument("--props", help="Kafka consumer property file")
        s.add_argument("--host", default="localhost")
        s.add_argument("--port", type=int, default=9999)
        s.add_argument("--path", help="folder watched for new text files")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", default="1 second")
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--state-store", choices=("memory", "rocksdb"), default="rocksdb")
        s.add_argument("--state-partitions", type=int, help="fixed for the life of the checkpoint")
        if name == "stream-hits":
            s.add_argument("--length", default="30 seconds")
            s.add_argument("--slide", default="10 seconds")
            s.add_argument("--watermark", default="60 seconds")
            s.add_argument("--time", choices=("event", "arrival"), default="event")
            s.add_argument("--top", type=int, default=50)
            s.add_argument("--by", choices=("hits", "key"), default="key")
            s.add_argument("--min-hits", type=int)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(app_name=f"loglens-{args.cmd}")
    if args.cmd.startswith("stream-"):
        stream_job(spark, args)
        return 0
    df = batch_job(spark, args)
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        print("\t".join(df.columns))
        for row in df.toLocalIterator():  # one partition at a time
            print("\t".join("NULL" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
