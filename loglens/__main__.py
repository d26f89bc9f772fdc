"""Command line: run one operator over a folder of JSON log files.

    python -m loglens --source DIR --task NAME [--config FILE] [--order mtime|name] [--out DIR [--format csv|parquet]]
    python -m loglens --stream --out DIR --source DIR --task NAME [--available-now] [--checkpoint DIR] [--log DIR]

Batches are the files, numbered by modification time (or name).  The full
result goes to ``--out`` (with a preview on the console), or, without it, to
the console in full.  The Bloom operators take ``filter_file``, ``m_bits`` and
``k_hashes`` from the config, as the shipped configuration does.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from loglens.registry import load_options, run
from loglens.session import build_session, clean_scratch
from loglens.sinks import print_results, show_results, write_results
from loglens.sources.files import file_batches, number_files, read_logs


def stream(spark, args, opts) -> None:
    """Start the streaming form of ``args.task``; results go to ``args.out``."""
    from loglens.streaming import run_until_signal
    from loglens.streaming import operators as S

    if not args.out:
        raise SystemExit("--stream needs --out")
    trigger = {"availableNow": True} if args.available_now else None
    common = {"trigger": trigger, "glob": args.glob, "checkpoint": args.checkpoint}
    logged = common | {"log": args.log}
    task = args.task
    if task == "windowed_success_rate":
        q = S.start_windowed_success_rate(
            spark, args.source, args.out, **common,
            **{k: v for k, v in opts.items() if k in ("window_duration", "slide_duration", "watermark",
                                                       "output_mode", "max_files_per_trigger")})
    elif task == "running_success_rate_target":
        q = S.start_running_success_rate(spark, args.source, args.out, **logged)
    elif task == "running_success_rate_by_file":
        q = S.start_running_by_file(spark, args.source, args.out, **logged)
    elif task == "sliding_failures":
        q = S.start_sliding_failures(spark, args.source, args.out, **logged)
    elif task == "sliding_failure_rate":
        q = S.start_sliding_failures(spark, args.source, args.out, rate=True, **logged)
    elif task == "reservoir_mode":
        q = S.start_reservoir(spark, args.source, args.out, k=int(opts.get("reservoir_size", 10)), **logged)
    elif task == "bloom_hit_ratio":
        from loglens.operators import bloom
        from loglens.sources.patterns import read_patterns

        m = int(opts.get("m_bits", bloom.BLOOM_BITS))
        k = int(opts.get("k_hashes", bloom.BLOOM_HASHES))
        words = bloom.bloom_build(read_patterns(spark, opts["filter_file"]), m_bits=m, k_hashes=k)
        q = S.start_bloom_ratio(spark, args.source, args.out, words, m_bits=m, k_hashes=k, **common)
    else:
        raise SystemExit(f"no streaming form for {task!r}")
    run_until_signal([q], drain=args.drain)  # SIGTERM or Ctrl-C: after the current micro-batch


def main(argv: list[str] | None = None) -> None:
    import sys

    argv = sys.argv[1:] if argv is None else argv
    ap = argparse.ArgumentParser(prog="loglens")
    ap.add_argument("--source", required=True)
    ap.add_argument("--task", default="running_success_rate_target")
    ap.add_argument("--config", default=None)
    ap.add_argument("--glob", default="*.json")
    ap.add_argument("--order", choices=["mtime", "name"], default="mtime")
    ap.add_argument("--master", default=None)
    ap.add_argument("--stream", action="store_true", help="run the Structured Streaming form")
    ap.add_argument("--out", default=None, help="folder for the full result (stream: results/epoch=N)")
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv", help="of --out in batch runs")
    ap.add_argument("--checkpoint", default=None, help="stream checkpoint (default: in the --out folder)")
    ap.add_argument("--log", default=None, help="result log that a stream appends to")
    ap.add_argument("--drain", action="store_true", help="on a signal, process what exists before a stream stops")
    ap.add_argument("--available-now", action="store_true", help="process what exists, then stop")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    opts = load_options(args.config)
    if args.stream:
        stream(spark, args, opts)
        return
    events = read_logs(spark, args.source, glob=args.glob, require_files=True)
    order = ("file_modified", "file_path") if args.order == "mtime" else ("file_path",)
    numbers = number_files(spark, args.source, glob=args.glob, order=order)
    if args.task.startswith("reservoir"):
        events = events.withColumn("event_id", F.concat_ws(":", "file_path", F.col("pos").cast("string")))
    result = run(args.task, file_batches(events, numbers=numbers), **opts)
    if "batch_id" in result.columns and not args.task.endswith("forward"):
        result = result.orderBy("batch_id", *(["service"] if "service" in result.columns else []))
    if args.out:
        write_results(result, args.out, args.format)
        print(f"full result in {args.out}; its first rows:")
        saved = spark.read.parquet(args.out) if args.format == "parquet" else spark.read.csv(args.out, header=True)
        show_results(saved)
    else:
        print_results(result)
    clean_scratch(spark, "mat-")


if __name__ == "__main__":
    main()
