"""Job entry points: ``spark-submit`` this package's ``__main__`` with a job name."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession, functions as F

from roadpulse.config import CONSTANT_KEY, FEEDS, FIT_PARTS, Settings
from roadpulse.plans.compaction import compact
from roadpulse.plans.consolidation import consolidate
from roadpulse.plans.layers import layer_from_scored
from roadpulse.plans.replaying import replay
from roadpulse.plans.scoring import score_topics
from roadpulse.plans.training import train
from roadpulse.schemas import QUARANTINED, with_event_time
from roadpulse.sinks.delivery import await_delivery
from roadpulse.sinks.files import write_table
from roadpulse.sinks.manifest import MALFORMED, SCORED
from roadpulse.streaming.paced import land_recording, replay_in_order
from roadpulse.streaming.replay import ON_RAGGED, start_replay
from roadpulse.streaming.windows import DURATION, LATENESS
from roadpulse.workspace import discard


def parser(settings: Settings) -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="roadpulse")
    jobs = root.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("replay", help="send a recorded feed as messages")
    job.add_argument("feed", choices=sorted(FEEDS))
    job.add_argument("source")
    job.add_argument("--servers", default=settings.kafka_url)
    job.add_argument("--lines")
    job.add_argument("--checkpoint", help="replay as a stream that a restart continues")
    job.add_argument("--files-per-trigger", type=int, help="pace of the stream: files per batch")
    job.add_argument("--every", help="pace of the stream: time between batches, as '1 second'")
    job.add_argument("--rows-per-batch", type=int, help="replay in recorded order, in batches of so many messages")
    job.add_argument("--progress", help="where a replay in recorded order keeps what it has sent")
    job.add_argument("--on-ragged", choices=ON_RAGGED, default="fail", help="lines with fewer or more cells than the header")
    job.add_argument("--rejected", help="folder for such lines, with --on-ragged quarantine")
    keys = job.add_mutually_exclusive_group()
    keys.add_argument("--key", help="column that keys the messages; the record's identity otherwise")
    keys.add_argument("--constant-key", nargs="?", const=CONSTANT_KEY, help="one key for all, hence one Kafka partition")

    job = jobs.add_parser("train", help="fit, evaluate and store both models")
    job.add_argument("fcd")
    job.add_argument("emission")
    job.add_argument("--cluster-model", default=settings.cluster_model, required=not settings.cluster_model)
    job.add_argument("--regression-model", default=settings.regression_model, required=not settings.regression_model)
    job.add_argument("--max-rows", type=int)
    job.add_argument("--missing", choices=("zero", "null", "drop"), default="zero")
    job.add_argument("--with-type", action="store_true", help="the kind of vehicle as a further feature of the forest")
    job.add_argument("--parts", type=int, default=FIT_PARTS, help="partitions that rows are dealt into for a fit")

    job = jobs.add_parser("score", help="score both topics continuously")
    job.add_argument("clustered")
    job.add_argument("predicted")
    job.add_argument("checkpoints")
    job.add_argument("--servers", default=settings.kafka_url, required=not settings.kafka_url)
    job.add_argument("--cluster-model", default=settings.cluster_model, required=not settings.cluster_model)
    job.add_argument("--regression-model", default=settings.regression_model, required=not settings.regression_model)
    job.add_argument("--no-event-time", action="store_true")
    job.add_argument("--on-malformed", choices=("quarantine", "skip", "fail"), default="quarantine")
    job.add_argument("--format", choices=("csv", "parquet"), default="csv")
    job.add_argument("--every", help="time between batches, as '1 minute': fewer and larger files")
    job.add_argument("--starting-offsets", help="where a new query starts; Spark's default is latest")
    job.add_argument("--max-offsets-per-trigger", type=int)
    job.add_argument("--min-partitions", type=int)
    job.add_argument("--with-type", action="store_true", help="the forest was trained with the kind of vehicle")
    job.add_argument("--windows", help="folder for counts and means by windows of time, one below it for each feed")
    job.add_argument("--window", default=settings.window_duration or DURATION, help="how long a window is, as '1 minute'")
    job.add_argument("--lateness", default=LATENESS, help="how late a message may come and still count")

    job = jobs.add_parser("compact", help="merge the small batches of a scoring job that quarantines")
    job.add_argument("feed", choices=sorted(FEEDS))
    job.add_argument("output")
    job.add_argument("--format", choices=("csv", "parquet"), default="csv", help="what score wrote")
    job.add_argument("--no-event-time", action="store_true")
    job.add_argument("--files", type=int)
    job.add_argument("--keep-seconds", type=float, default=3600, help="how long readers may use what was replaced")
    job.add_argument("--retention-days", type=float, help="forget batches older than this")

    job = jobs.add_parser("consolidate", help="merge streamed part files")
    job.add_argument("feed", choices=sorted(FEEDS))
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--mode", choices=("append", "overwrite"), default="append")
    job.add_argument("--format", choices=("csv", "parquet"), default="csv")
    job.add_argument("--files", type=int)
    job.add_argument("--source-format", choices=("csv", "parquet"), default="csv", help="what score wrote")
    job.add_argument("--no-event-time", action="store_true")

    job = jobs.add_parser("layer", help="scored positions to a marker table")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--format", choices=("csv", "parquet"), default="csv")
    job.add_argument("--mode", choices=("append", "overwrite"), default="overwrite")
    job.add_argument("--source-format", choices=("csv", "parquet"), default="csv", help="what score wrote")
    job.add_argument("--no-event-time", action="store_true")
    return root


def _pace(every: str | None) -> dict | None:
    return {"processingTime": every} if every else None


def _replay(spark: SparkSession, args: argparse.Namespace) -> dict | int:
    feed, target = FEEDS[args.feed], {"lines": args.lines} if args.lines else {"servers": args.servers}
    target["key"] = F.col(args.key) if args.key else F.lit(args.constant_key) if args.constant_key else None
    ragged = {"on_ragged": args.on_ragged, "rejected": args.rejected}
    if args.rows_per_batch:
        if not args.progress or args.on_ragged == "quarantine":
            raise SystemExit("a replay in recorded order needs --progress, and refuses or keeps ragged lines")
        seconds = spark.sql(f"SELECT CAST(INTERVAL {args.every or '0 seconds'} AS INTERVAL SECOND)").first()[0].total_seconds()
        recording = land_recording(spark, args.source, feed, args.rows_per_batch, args.on_ragged)
        try:
            return replay_in_order(spark, recording, feed, args.progress, every=seconds, **target)
        finally:
            discard(spark, recording)
    if not args.checkpoint:
        return replay(spark, args.source, feed, **target, **ragged)
    trigger = _pace(args.every) or {"availableNow": True}
    pace = {"files_per_trigger": args.files_per_trigger, "trigger": trigger}
    return await_delivery(start_replay(spark, args.source, feed, args.checkpoint, **pace, **target, **ragged))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "replay":
        print(_replay(spark, args))
    elif args.job == "train":
        metrics = train(
            spark,
            args.fcd,
            args.emission,
            args.cluster_model,
            args.regression_model,
            max_rows=args.max_rows,
            missing=args.missing,
            parts=args.parts,
            with_type=args.with_type,
        )
        print(metrics)
    elif args.job == "score":
        score_topics(
            spark,
            args.servers,
            args.cluster_model,
            args.regression_model,
            args.clustered,
            args.predicted,
            args.checkpoints,
            fmt=args.format,
            event_time=not args.no_event_time,
            on_malformed=args.on_malformed,
            trigger=_pace(args.every),
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
            with_type=args.with_type,
            windows=args.windows,
            window=args.window,
            lateness=args.lateness,
        )
    elif args.job == "compact":
        scored = FEEDS[args.feed].scored
        layouts = {
            SCORED: (scored if args.no_event_time else with_event_time(scored), args.format),
            MALFORMED: (QUARANTINED, "json"),
        }
        retention = args.retention_days and args.retention_days * 86400
        ways = {"files": args.files, "keep_seconds": args.keep_seconds, "retention_seconds": retention}
        print(compact(spark, args.output, layouts, **ways))
    else:
        scored = FEEDS[args.feed if args.job == "consolidate" else "fcd"].scored
        schema = scored if args.no_event_time else with_event_time(scored)
        if args.job == "consolidate":
            consolidate(
                spark,
                args.source,
                args.target,
                schema,
                mode=args.mode,
                fmt=args.format,
                files=args.files,
                source_fmt=args.source_format,
            )
        else:
            markers = layer_from_scored(spark, args.source, schema, args.source_format)
            write_table(markers, args.target, fmt=args.format, mode=args.mode)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser(Settings.from_env()).parse_args(argv)
    run(SparkSession.builder.appName(f"roadpulse-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
