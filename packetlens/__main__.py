"""Command line for spark-submit; ``--help`` lists the commands."""

from __future__ import annotations

import argparse

from packetlens.functions.packet import parse_packets
from packetlens.operators.windows import DURATION
from packetlens.plans import batch_jobs
from packetlens.session import build_session
from packetlens.sources import archive, capture, topic
from packetlens.streaming import jobs
from packetlens.streaming.serving import SERVING, Serving


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def _source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--format", default="kafka", help="kafka or parquet")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    parser.add_argument("--trigger", default=None, help='for example "10 seconds"')


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="packetlens")
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="run a batch job over an archive")
    batch.add_argument("job", choices=batch_jobs.NAMES)
    batch.add_argument("--input_path", required=True)
    batch.add_argument("--input_format", choices=["json", "table"], default="json",
                       help="an archive, or a packet table made from one")
    batch.add_argument("--output_path")
    batch.add_argument("--serving")

    stream = commands.add_parser("stream", help="run streaming jobs over the topic")
    stream.add_argument("job", choices=[*jobs.JOBS, "window_totals"], nargs="+",
                        help="one stateful job, counting jobs that share the stream, or "
                             "window_totals, which fills four window tables")
    stream.add_argument("--serving", required=True)
    stream.add_argument("--duration", default=DURATION)
    stream.add_argument("--watermark", default=jobs.WATERMARK, help="a delay, or none")
    _source(stream)

    ingest = commands.add_parser("ingest", help="publish the CSV files of a folder")
    ingest.add_argument("--watch", required=True)
    _source(ingest)

    keep = commands.add_parser("archive", help="append the topic to a JSON archive")
    keep.add_argument("--output_path", required=True)
    _source(keep)

    table = commands.add_parser("table", help="parse an archive once into a packet table")
    table.add_argument("--input_path", required=True)
    table.add_argument("--output_path", required=True)

    chunk = commands.add_parser("chunk", help="cut captures into chunk files")
    chunk.add_argument("--input_path", required=True, nargs="+")
    chunk.add_argument("--output_path", required=True)
    chunk.add_argument("--exact", action="store_true",
                       help="full chunks of consecutive rows, one folder each")

    create = commands.add_parser("create", help="make serving tables exist and empty")
    create.add_argument("--serving", required=True)
    create.add_argument("tables", nargs="*", default=list(SERVING))

    compact = commands.add_parser("compact", help="fold the epochs of serving tables")
    compact.add_argument("--serving", required=True)
    compact.add_argument("tables", nargs="*", default=list(SERVING))
    return parser


def _run(writer, args: argparse.Namespace) -> None:
    if args.once:
        jobs.run_available(writer)
        return
    if args.trigger:
        writer = writer.trigger(processingTime=args.trigger)
    writer.start().awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session(f"packetlens {args.command}")
    if args.command == "batch":
        serving = Serving(spark, args.serving) if args.serving else None
        batch_jobs.run(
            spark, args.job, args.input_path, args.output_path, serving, args.input_format
        )
    elif args.command == "table":
        packets = parse_packets(archive.read_archive(spark, args.input_path))
        archive.write_packet_table(packets, args.output_path)
    elif args.command == "stream":
        source = topic.read_topic(spark, args.format, **_options(args.option))
        packets, serving = topic.topic_packets(source), Serving(spark, args.serving)
        watermark = None if args.watermark == "none" else args.watermark
        if args.job == ["window_totals"]:
            _run(jobs.totals_writer(packets, serving, args.checkpoint, args.duration, watermark), args)
            return
        chosen = [jobs.JOBS[name] for name in args.job]
        if len(chosen) == 1:
            writer = jobs.writer(chosen[0], packets, serving, args.checkpoint, args.duration, watermark)
        else:
            writer = jobs.shared_writer(chosen, packets, serving, args.checkpoint)
        _run(writer, args)
    elif args.command == "ingest":
        lines = capture.watch_lines(spark, args.watch)
        _run(topic.topic_writer(lines, args.checkpoint, args.format, **_options(args.option)), args)
    elif args.command == "archive":
        source = topic.read_topic(spark, args.format, **_options(args.option))
        _run(archive.archive_writer(source, args.output_path, args.checkpoint), args)
    elif args.command == "chunk":
        if args.exact:
            numbered = capture.numbered_captures(spark, args.input_path)
            capture.write_exact_chunks(numbered, args.output_path)
        else:
            capture.write_chunks(capture.read_captures(spark, args.input_path), args.output_path)
    else:
        serving = Serving(spark, args.serving)
        action = serving.create if args.command == "create" else serving.compact
        for name in args.tables:
            action(SERVING[name])


if __name__ == "__main__":
    main()
