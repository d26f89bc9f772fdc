"""Streaming operators.

* ``windowed_success_rate_stream``: watermark + (window, service) aggregate;
  ``complete`` mode re-emits every window (and, as a consequence, never drops
  late rows); ``update``/``append`` keep state bounded by the watermark.
* ``running_success_rate_stream``: one streaming aggregate per service
  (state = one row per service); ``foreachBatch`` rolls the per-service
  spans up to the global running span and emits the target's result.
* ``start_running_by_file``: the running rate after every file, in name order.
* ``start_sliding_failures``: window counts per service in a versioned state table, the events by
  time in a table per micro-batch; ``start_reservoir``: the ``k`` sampled rows as versioned state.
* ``bloom_ratio_stream``: stateless; one ratio per file per micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loglens.functions import (
    epoch_to_timestamp,
    error_4xx_5xx,
    failure_not_ok_message,
    safe_ratio,
    status_regex,
    status_strict,
    success_2xx,
    success_below_400,
)
from loglens.operators.bloom import bloom_hit_ratio, bloom_test
from loglens.operators.running import running_target_rows, running_target_scan
from loglens.operators.sample import sample_key
from loglens.operators.windowed import window_success_stats
from loglens.plans.materialize import materialize
from loglens.plans.rank import with_rank
from loglens.schema import (
    DEFAULT_SERVICE,
    DEFAULT_TIMESTAMP,
    GENERATOR_SEED,
    RESERVOIR_SIZE,
    SLIDE_DURATION,
    SLIDING_WINDOW_SECONDS,
    TARGET_SERVICE,
    TRIGGER_INTERVAL,
    WATERMARK,
    WINDOW_DURATION,
)
from loglens.sinks import write_log_epoch
from loglens.streaming.state import RETAIN_VERSIONS, read_state, run_checkpoint, write_result, write_state

SHUFFLE_CONF = "spark.sql.shuffle.partitions"
STATE_TASKS_A_CORE = 2

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _ntz(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock) without the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))


# --- windowed success rate ---------------------------------------------------

def windowed_success_rate_stream(events: DataFrame, window_duration: str = WINDOW_DURATION,
                                 slide_duration: str | None = SLIDE_DURATION,
                                 watermark: str = WATERMARK) -> DataFrame:
    """Streaming (window, service) success rate; event time truncated to the second.

    The watermark needs a ``TIMESTAMP`` column: ``timestamp_seconds`` of the
    truncated epoch (instant, zone-free).  An incomplete row has no event time
    here, so it neither moves the watermark nor opens a window in the state.
    """
    status = status_regex("message")
    event_time = F.timestamp_seconds(F.col("timestamp").try_cast("bigint"))
    seen = events.select("service", status.alias("status"), event_time.alias("_at"))
    ok = F.col("service").isNotNull() & F.col("status").isNotNull() & F.col("_at").isNotNull()
    parsed = (
        seen.select("service", ok.alias("_ok"), success_below_400("status").alias("is_success"),
                    F.when(ok, F.col("_at")).alias("event_time"))
        .observe(SEEN, F.count(F.when(F.col("_ok"), 1)).alias("rows"))
        .withWatermark("event_time", watermark)
    )
    stats = window_success_stats(parsed, window_duration, slide_duration)
    return stats.withColumns({"window_start": _ntz(F.col("window_start")),
                              "window_end": _ntz(F.col("window_end"))})


def _result(df: DataFrame, out: str, epoch: int, log: str | None) -> None:
    """One micro-batch's result rows, also in the result log ``log`` (once per epoch)."""
    write_result(df, out, epoch)
    if log:
        write_log_epoch(df.sparkSession.read.parquet(f"{out}/results/epoch={epoch}"), log, epoch)


def _start(df: DataFrame, fn: Callable[[DataFrame, int], None], *, checkpoint: str,
           output_mode: str, trigger: dict, name: str | None) -> StreamingQuery:
    """Start the stream with at most ``STATE_TASKS_A_CORE`` shuffle partitions a core: each keeps a state of its
    own, written in every micro-batch even if empty.  A query takes the setting over when it starts (and
    from its checkpoint when it goes on), so the session's own is put back."""
    spark = df.sparkSession
    session = int(spark.conf.get(SHUFFLE_CONF))
    w = df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger)
    if name:
        w = w.queryName(name)
    spark.conf.set(SHUFFLE_CONF, str(min(session, STATE_TASKS_A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        return w.start()
    finally:
        spark.conf.set(SHUFFLE_CONF, str(session))


def start_windowed_success_rate(spark: SparkSession, source: str, out: str, *,
                                checkpoint: str | None = None, output_mode: str = "complete",
                                trigger: dict | None = None, glob: str | None = "*.json",
                                max_files_per_trigger: int | None = 10,
                                window_duration: str = WINDOW_DURATION,
                                slide_duration: str | None = SLIDE_DURATION,
                                watermark: str = WATERMARK) -> StreamingQuery:
    """Run the windowed stream; every micro-batch's rows (service kept) go to
    ``out/results/epoch=<id>``."""
    from loglens.streaming.source import read_log_stream

    events = read_log_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)
    stats = windowed_success_rate_stream(events, window_duration, slide_duration, watermark)

    retain = RETAIN_VERSIONS if output_mode == "complete" else None

    def sink(df: DataFrame, epoch: int) -> None:
        write_result(df.withColumn("success_rate", F.coalesce("success_rate", F.lit(0.0))), out, epoch,
                     retain=retain)

    return _start(stats, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode=output_mode, trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


#: Name of the metric that counts the complete rows of each micro-batch, before the watermark drops late ones.
SEEN = "complete_rows"


def late_account(query: StreamingQuery, out: str) -> DataFrame:
    """``epoch, watermark, seen, kept, dropped`` of a tumbling ``update`` query: the complete rows of each
    micro-batch, those that its windows gained, and the rest, whose windows the watermark
    had closed in an earlier micro-batch.

    Seen rows come from the progress that Spark keeps of the last micro-batches
    (``spark.sql.streaming.numRecentProgressUpdates``), kept ones from the results."""
    spark = SparkSession.active()
    seen = [(p.batchId, p.eventTime.get("watermark"), int(p.observedMetrics[SEEN].rows)) for p in query.recentProgress
            if p.observedMetrics.get(SEEN)]
    rows = {e: (e, w, n) for e, w, n in seen if n}  # a micro-batch without data only moves the watermark
    epochs = spark.createDataFrame(list(rows.values()), "epoch bigint, watermark string, seen bigint")
    order = Window.partitionBy("window_start", "service").orderBy("epoch")
    gained = F.col("total") - F.coalesce(F.lag("total").over(order), F.lit(0))
    kept = spark.read.parquet(f"{out}/results").withColumn("gained", gained).groupBy("epoch").agg(F.sum("gained").alias("kept"))
    return epochs.join(kept.select(F.col("epoch").cast("bigint").alias("epoch"), "kept"), "epoch", "left").select(
        "epoch", _ntz(F.to_timestamp("watermark")).alias("watermark"), "seen", F.coalesce("kept", F.lit(0)).alias("kept"),
        (F.col("seen") - F.coalesce("kept", F.lit(0))).alias("dropped"))


# --- running success rate ----------------------------------------------------

def running_counts_stream(events: DataFrame) -> DataFrame:
    """Streaming per-service running counts and per-service span inputs."""
    ts = F.coalesce(F.col("timestamp"), F.lit(DEFAULT_TIMESTAMP))
    code = status_strict("message")
    svc = F.coalesce(F.col("service"), F.lit(DEFAULT_SERVICE))
    return (events.select(svc.alias("service"), code.alias("code"), ts.alias("ts"))
            .groupBy("service")
            .agg(F.count("code").alias("total"),
                 F.sum(F.when(success_2xx("code"), 1).otherwise(0)).alias("successes"),
                 F.max(F.when(F.col("ts") > 0, F.col("ts"))).alias("newest"),
                 F.min(F.when(F.col("ts") != 0, F.col("ts"))).alias("oldest")))


def running_result(state: DataFrame, service: str = TARGET_SERVICE) -> DataFrame:
    """Roll the per-service state (a few rows) up to the single result."""
    mine = F.col("service") == F.lit(service)
    agg = state.agg(
        F.sum(F.when(mine, F.col("successes")).otherwise(0)).alias("s"),
        F.sum(F.when(mine, F.col("total")).otherwise(0)).alias("n"),
        F.max("newest").alias("nw"), F.min("oldest").alias("od"))
    return agg.where(F.col("nw").isNotNull() & F.col("od").isNotNull()).select(
        safe_ratio("s", "n").alias("value"),
        epoch_to_timestamp(F.col("nw")).alias("newest_considered"),
        epoch_to_timestamp(F.col("od")).alias("oldest_considered"))


def start_running_success_rate(spark: SparkSession, source: str, out: str, *,
                               checkpoint: str | None = None, trigger: dict | None = None,
                               glob: str | None = "*.json", max_files_per_trigger: int | None = 1,
                               service: str = TARGET_SERVICE, log: str | None = None) -> StreamingQuery:
    """Running rate per micro-batch: ``out/results`` holds the target's result,
    ``out/per_service`` the rate, counts and span of every service; ``log`` names a
    result log that gets a line per micro-batch."""
    from loglens.streaming.source import read_log_stream

    events = read_log_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)
    counts = running_counts_stream(events)

    def sink(df: DataFrame, epoch: int) -> None:
        write_result(df.withColumn("value", safe_ratio("successes", "total")), out, epoch, "per_service",
                     retain=RETAIN_VERSIONS)
        # a few rows, read back: the streaming aggregate runs once per micro-batch
        _result(running_result(spark.read.parquet(f"{out}/per_service/epoch={epoch}"), service), out, epoch, log)

    return _start(counts, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode="complete", trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


RUNNING_FILES_STATE = T.StructType([
    T.StructField("files", T.LongType()), T.StructField("total", T.LongType()), T.StructField("successes", T.LongType()),
    T.StructField("newest", T.DoubleType()), T.StructField("oldest", T.DoubleType())])


def start_running_by_file(spark: SparkSession, source: str, out: str, *, checkpoint: str | None = None,
                          trigger: dict | None = None, glob: str | None = "*.json", service: str = TARGET_SERVICE,
                          log: str | None = None) -> StreamingQuery:
    """The target's running rate after every *file*: the new files of a micro-batch (all that a listing finds)
    are taken in name order, whatever their modification times, and numbered on from those before.

    Files are numbered from their paths, events summed per file, and the sums scanned in that
    order on top of the counts and span that the last micro-batch left."""
    from loglens.sources.files import parse_log_files
    from loglens.streaming.source import read_raw_stream

    raw = read_raw_stream(spark, source, glob=glob, max_files_per_trigger=None)

    def sink(files: DataFrame, epoch: int) -> None:
        state = read_state(spark, out, epoch, RUNNING_FILES_STATE).first()
        before, total, successes, newest, oldest = state or (0, 0, 0, None, None)
        paths = materialize(files.select("file_path"), "stream-paths")  # ranking samples them, which would read the files again
        numbers = with_rank(paths, [F.asc("file_path")], "stream-files", "batch_id")
        numbers = materialize(numbers.select("file_path", (F.col("batch_id") + before).alias("batch_id")), "stream-numbers")
        scanned = running_target_scan(parse_log_files(files), service, numbers=numbers)
        scanned = materialize(scanned.select(
            "file_path", "batch_id", (F.col("total") + total).alias("total"), (F.col("successes") + successes).alias("successes"),
            F.greatest("_newest", F.lit(newest).cast("double")).alias("_newest"),
            F.least("_oldest", F.lit(oldest).cast("double")).alias("_oldest")), "stream-running")
        n = numbers.count()
        if not n:
            return
        last = scanned.agg(F.max("total"), F.max("successes"), F.max("_newest"), F.min("_oldest")).first()
        now = (before + n, total if last[0] is None else last[0], successes if last[1] is None else last[1],
               newest if last[2] is None else last[2], oldest if last[3] is None else last[3])
        names = scanned.select("batch_id", "file_path")
        _result(running_target_rows(scanned).join(names, "batch_id"), out, epoch, log)
        write_state(spark.createDataFrame([now], RUNNING_FILES_STATE), out, epoch)

    return _start(raw, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode="append", trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


# --- sliding failure count (versioned state) --------------------------------

SLIDING_STATE = T.StructType([
    T.StructField("service", T.StringType()),   # null: the run as a whole
    T.StructField("failures", T.LongType()),    # events in the window whose message lacks the ok code
    T.StructField("errors", T.LongType()),      # ... with a 4xx or 5xx code
    T.StructField("total", T.LongType()),
    T.StructField("newest", T.DoubleType()),    # of all services
    # micro-batches that hold events of the window, with their times
    T.StructField("live", T.ArrayType(T.StructType([
        T.StructField("epoch", T.LongType()), T.StructField("first", T.DoubleType()), T.StructField("last", T.DoubleType())]))),
])


def sliding_state_result(state: DataFrame, window_seconds: float, rate: bool = False,
                         service: str | None = TARGET_SERVICE) -> DataFrame:
    """The result as of the state, whatever order the events arrived in: newest time and value of the
    window, of one service or (``service`` None, with a column ``service``) of each seen so far; none before the first event."""
    row = state.where("service is null").first()
    newest = row["newest"] if row else 0.0
    value = safe_ratio("errors", "total") if rate else F.col("failures").cast("double")
    counts = state.where("service is not null")
    if service is not None:  # a service without events has a window too
        counts = counts.where(F.col("service") == service).select("failures", "errors", "total").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("failures", "errors", "total")])
    if not newest:
        counts = counts.where("false")
    return counts.select(
        *(["service"] if service is None else []), value.alias("value"),
        epoch_to_timestamp(F.lit(float(newest))).alias("newest_considered"),
        epoch_to_timestamp(F.lit(float(newest - window_seconds))).alias("oldest_considered"))


def sliding_step(spark: SparkSession, out: str, epoch: int, batch: DataFrame, window_seconds: float) -> bool:
    """One micro-batch of the sliding window: writes its state, tells whether the newest time rose.

    The events are summed by (service, time) once, into ``out/events/epoch=<epoch>``.  The window's counts per service
    then gain those in the window and lose those of earlier micro-batches that the new
    window leaves behind: only micro-batches with times between the old and the new edge
    are read, so state read and written follows the events that enter and leave."""
    ts = F.coalesce(F.col("timestamp"), F.lit(DEFAULT_TIMESTAMP))
    sums = {"failures": failure_not_ok_message("message"),
            "errors": F.coalesce(error_4xx_5xx(status_regex("message")), F.lit(False)), "total": F.lit(True)}
    here = f"{out}/events/epoch={epoch}"
    (batch.select("service", ts.alias("ts"), *[c.alias(n) for n, c in sums.items()]).groupBy("service", "ts")
     .agg(*[F.count(F.when(F.col(n), 1)).alias(n) for n in sums])
     .write.mode("overwrite").parquet(here))
    mine = spark.read.parquet(here)
    first, last = mine.agg(F.min("ts"), F.max("ts")).first()
    if last is None:
        return False
    old = read_state(spark, out, epoch, SLIDING_STATE)
    run = old.where("service is null").first()
    before, live = (run["newest"], run["live"]) if run else (DEFAULT_TIMESTAMP, [])
    newest = max(before, last)
    low, was = newest - window_seconds, before - window_seconds
    left = [x for x in live if x["last"] >= was and x["first"] < low]
    rows = [mine.where(F.col("ts") >= low), old.withColumn("ts", F.lit(0.0))]
    if left and low > was:
        gone = spark.read.parquet(*[f"{out}/events/epoch={x['epoch']}" for x in left])
        rows.append(gone.where((F.col("ts") >= was) & (F.col("ts") < low)).select(
            "service", "ts", *[(-F.col(n)).alias(n) for n in sums]))
    # every service seen so far keeps a row, also with an empty window
    rows.append(mine.select("service", "ts", *[F.lit(0).cast("bigint").alias(n) for n in sums]))
    both = rows[0].select("service", *sums)
    for r in rows[1:]:
        both = both.unionByName(r.select("service", *sums))
    counts = both.where("service is not null").groupBy("service").agg(*[F.sum(n).alias(n) for n in sums])
    live = [tuple(x) for x in live if x["last"] >= low] + ([(epoch, first, last)] if last >= low else [])
    # not createDataFrame, whose tasks start Python workers for one row
    whole = json.dumps({"failures": 0, "errors": 0, "total": 0, "newest": float(newest),
                        "live": [{"epoch": e, "first": f, "last": l} for e, f, l in live]})
    whole = spark.range(1).select(F.from_json(F.lit(whole), SLIDING_STATE).alias("s")).select("s.*")
    write_state(counts.select("*", F.lit(None).cast("double").alias("newest"),
                              F.lit(None).cast(SLIDING_STATE["live"].dataType).alias("live")).unionByName(whole), out, epoch)
    return newest > before and newest > 0.0


def start_sliding_failures(spark: SparkSession, source: str, out: str, *,
                           checkpoint: str | None = None, trigger: dict | None = None,
                           glob: str | None = None, max_files_per_trigger: int | None = None,
                           window_seconds: float = SLIDING_WINDOW_SECONDS,
                           service: str | None = TARGET_SERVICE, rate: bool = False,
                           log: str | None = None) -> StreamingQuery:
    """Sliding failure count (with ``rate`` the documented 4xx/5xx share) per
    micro-batch (a poll of all new files), of one service or, with ``service`` None, of every one."""
    from loglens.streaming.source import read_log_stream

    events = read_log_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)

    def sink(df: DataFrame, epoch: int) -> None:
        if sliding_step(spark, out, epoch, df, window_seconds):
            state = read_state(spark, out, epoch + 1, SLIDING_STATE)
            _result(sliding_state_result(state, window_seconds, rate, service), out, epoch, log)

    return _start(events, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode="append", trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


# --- reservoir sample at every micro-batch (versioned state) ----------------

RESERVOIR_STATE = T.StructType([
    T.StructField("sample_key", T.StringType()),
    T.StructField("ident", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("code", T.StringType()),
    T.StructField("newest", T.DoubleType()),
    T.StructField("oldest", T.DoubleType()),
])


def reservoir_step(state: DataFrame, batch: DataFrame, *, k: int, seed: int,
                   identity: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge the batch into the ``k``-row sample; the span rides along.

    ``identity`` names an event (default ``file_path:pos``); the key is
    ``md5(identity:seed)``, as in the batch sample.
    """
    from loglens.functions import status_last_segment

    ident = identity if identity is not None else F.concat_ws(
        ":", F.col("file_path"), F.col("pos").cast("string"))
    rows = batch.select(sample_key(ident, seed).alias("sample_key"), ident.cast("string").alias("ident"),
                        "file_path", "pos",
                        status_last_segment("message").alias("code"),
                        F.col("timestamp").alias("newest"), F.col("timestamp").alias("oldest"))
    span = state.select("newest", "oldest").unionByName(rows.select("newest", "oldest")).agg(
        F.max("newest").alias("nw"), F.min("oldest").alias("od")).first()
    sample = (state.unionByName(rows).orderBy("sample_key", "ident").limit(k)
              .withColumns({"newest": F.lit(span["nw"]).cast("double"),
                            "oldest": F.lit(span["od"]).cast("double")}))
    mode = (sample.groupBy("code").agg(F.count(F.lit(1)).alias("sample_count"))
            .orderBy(F.desc("sample_count"), F.asc_nulls_last("code")).limit(1)
            .select(F.col("code").try_cast("double").alias("value"), "code", "sample_count",
                    epoch_to_timestamp(F.lit(span["nw"]).cast("double")).alias("newest_considered"),
                    epoch_to_timestamp(F.lit(span["od"]).cast("double")).alias("oldest_considered")))
    return sample, mode


def start_reservoir(spark: SparkSession, source: str, out: str, *, k: int = RESERVOIR_SIZE,
                    seed: int = GENERATOR_SEED, checkpoint: str | None = None,
                    trigger: dict | None = None, glob: str | None = "*.json",
                    max_files_per_trigger: int | None = None,
                    identity: Column | None = None, log: str | None = None) -> StreamingQuery:
    from loglens.streaming.source import read_log_stream

    events = read_log_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)

    def sink(df: DataFrame, epoch: int) -> None:
        if df.isEmpty():
            return
        df.persist()
        try:
            state = read_state(spark, out, epoch, RESERVOIR_STATE)
            sample, mode = reservoir_step(state, df, k=k, seed=seed, identity=identity)
            write_state(sample, out, epoch)
            _result(mode, out, epoch, log)
        finally:
            df.unpersist()

    return _start(events, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode="append", trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


# --- Bloom hit ratio per file (stateless) -----------------------------------

def start_bloom_ratio(spark: SparkSession, source: str, out: str, words: DataFrame, *,
                      m_bits: int, k_hashes: int, checkpoint: str | None = None,
                      trigger: dict | None = None, glob: str | None = "*.json",
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    from loglens.streaming.source import read_log_stream

    events = read_log_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)
    # the filter (at most m/8 bytes) is built once, not once per micro-batch
    words = materialize(words, "bloom-filter")
    test = bloom_test(words, m_bits, k_hashes)

    def sink(df: DataFrame, epoch: int) -> None:
        write_result(bloom_hit_ratio(df, words, batch="file_path", m_bits=m_bits,
                                     k_hashes=k_hashes, test=test), out, epoch)

    return _start(events, sink, checkpoint=run_checkpoint(spark, out, checkpoint),
                  output_mode="append", trigger=trigger or {"processingTime": TRIGGER_INTERVAL},
                  name=None)


# --- malformed files (quarantine) --------------------------------------------

def start_quarantine(spark: SparkSession, source: str, out: str, *,
                     checkpoint: str | None = None, trigger: dict | None = None,
                     glob: str | None = "*.json",
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Malformed files of the stream (path, name, text) appended to a Parquet
    table at ``out``: reported once, never fatal (exactly-once file sink)."""
    from loglens.sources.files import quarantine_files
    from loglens.streaming.source import read_raw_stream

    raw = read_raw_stream(spark, source, glob=glob, max_files_per_trigger=max_files_per_trigger)
    w = (quarantine_files(raw).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint or f"{out.rstrip('/')}/_checkpoint")
         .outputMode("append").trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL})))
    return w.start()
