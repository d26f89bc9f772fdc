"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)``, reads the driver tables (or data
Spark derives from them) and returns the operator's result over the whole
tables.  The oracle SQL runs on DuckDB views of the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens import functions as LF
from loglens import oracle as O
from loglens.operators.bloom import (
    WORD_BITS,
    bloom_build,
    bloom_contains,
    bloom_forward,
    bloom_hit_ratio,
    exact_forward,
)
from loglens.operators.parse import log_defaults, outcome_flags, parse_for_rates
from loglens.operators.running import (
    running_success_rate,
    running_success_rate_target,
    running_time_span,
)
from loglens.operators.sample import (
    reservoir_mode,
    reservoir_mode_by_batch,
    reservoir_sample,
    reservoir_sample_by_batch,
)
from loglens.operators.sliding import sliding_failure_rate, sliding_failures
from loglens.operators.summary import service_success_summary
from loglens.operators.windowed import hopping_success_rate, windowed_success_rate
from loglens.registry import run
from loglens.session import scratch_path
from loglens.sinks import CSV_OPTIONS, read_results_log, result_log_rows, write_results
from loglens.sources.files import (
    json_array_lines,
    number_files,
    parse_log_files,
    quarantine_files,
    quarantine_files_multiline,
    read_logs,
    read_raw_files,
    unprocessed_files,
    write_batch_files,
    write_log_files,
)
from loglens.sources.manifest import read_runs, run_new_files
from loglens.sources.patterns import read_patterns
from loglens.sources.views import BATCH_SIZE, load_log_view, read_table
from loglens.streaming.operators import (
    RESERVOIR_STATE,
    SLIDING_STATE,
    late_account,
    sliding_state_result,
    start_bloom_ratio,
    start_reservoir,
    start_running_by_file,
    start_running_success_rate,
    start_sliding_failures,
    start_windowed_success_rate,
)
from loglens.streaming import run_available
from loglens.streaming.state import last_epoch, read_results, read_state

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- A6: batch summary per service ------------------------------------------

@register("service_success_summary", O.with_view(f"""
SELECT service, min(event_time) AS window_start, max(event_time) AS window_end,
       count(*) AS total, CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS BIGINT) AS successes,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS success_rate
FROM (SELECT service, {O.status_regex()} AS status, {O.ts_micros('"timestamp"')} AS event_time FROM v)
WHERE service IS NOT NULL AND status IS NOT NULL AND event_time IS NOT NULL
GROUP BY service ORDER BY service""", dirty=True))
def q_service_success_summary(spark, sf_dir):
    return service_success_summary(load_log_view(spark, sf_dir, dirty=True))


# --- A7: tumbling and hopping windows ---------------------------------------

def _window_sql(duration_s: int, slide_s: int) -> str:
    hops = duration_s // slide_s
    return O.with_view(f"""
, p AS (SELECT service, {O.status_regex()} AS status,
               TRY_CAST(trunc("timestamp") AS BIGINT) AS t FROM v),
c AS (SELECT service, status, t FROM p
      WHERE service IS NOT NULL AND status IS NOT NULL AND t IS NOT NULL),
w AS (SELECT service, status, (floor(t / {slide_s}) - h.j) * {slide_s} AS ws
      FROM c, range(0, {hops}) AS h(j))
SELECT make_timestamp(CAST(ws AS BIGINT) * 1000000) AS window_start,
       make_timestamp(CAST(ws + {duration_s} AS BIGINT) * 1000000) AS window_end,
       service, count(*) AS total,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS BIGINT) AS successes,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS success_rate
FROM w GROUP BY ws, service ORDER BY window_start, service""", dirty=True)


@register("windowed_success_rate", _window_sql(10, 10))
def q_windowed_success_rate(spark, sf_dir):
    return windowed_success_rate(load_log_view(spark, sf_dir, dirty=True), "10 seconds")


@register("windowed_success_rate_hourly", _window_sql(3600, 3600))
def q_windowed_success_rate_hourly(spark, sf_dir):
    return windowed_success_rate(load_log_view(spark, sf_dir, dirty=True), "1 hour")


@register("hopping_success_rate", _window_sql(3600, 600))
def q_hopping_success_rate(spark, sf_dir):
    return hopping_success_rate(load_log_view(spark, sf_dir, dirty=True), "1 hour", "10 minutes")


# --- P1-P6, F2: per-event projections on the dirty view ---------------------


@register("status_strict", O.with_view(
    f"SELECT event_id, message, {O.status_strict()} AS status FROM v", dirty=True))
def q_status_strict(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    return v.select("event_id", "message", LF.status_strict("message").alias("status"))


@register("status_regex", O.with_view(
    f"SELECT event_id, message, {O.status_regex()} AS status FROM v", dirty=True))
def q_status_regex(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    return v.select("event_id", "message", LF.status_regex("message").alias("status"))


@register("status_last_segment", O.with_view(
    f"SELECT event_id, message, {O.status_last()} AS code, "
    f"TRY_CAST({O.status_last()} AS DOUBLE) AS code_value FROM v", dirty=True))
def q_status_last_segment(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    code = LF.status_last_segment("message")
    return v.select("event_id", "message", code.alias("code"),
                    code.try_cast("double").alias("code_value"))


@register("outcome_flags", O.with_view(f"""
SELECT event_id, message,
       starts_with({O.status_strict()}, '2') AS success_2xx,
       {O.failure_not_ok()} AS failure_not_200,
       CAST({O.status_regex()} < 400 AS INTEGER) AS success_below_400,
       {O.status_regex()} BETWEEN 400 AND 599 AS error_4xx_5xx
FROM v""", dirty=True))
def q_outcome_flags(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True).select("event_id", "message")
    return outcome_flags(v)


@register("event_time", O.with_view(f"""
SELECT event_id, "timestamp", {O.ts_seconds('"timestamp"')} AS event_time_second,
       {O.ts_micros('"timestamp"')} AS event_time
FROM v""", dirty=True))
def q_event_time(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    return v.select("event_id", "timestamp",
                    LF.epoch_to_timestamp_seconds("timestamp").alias("event_time_second"),
                    LF.epoch_to_timestamp("timestamp").alias("event_time"))


@register("log_defaults", O.with_view("""
SELECT event_id, batch_id, pos, coalesce(service, 'unknown_service') AS service,
       coalesce(message, '') AS message, coalesce("timestamp", 0.0) AS "timestamp"
FROM v""", dirty=True))
def q_log_defaults(spark, sf_dir):
    return log_defaults(load_log_view(spark, sf_dir, dirty=True))


@register("drop_incomplete")
def q_drop_incomplete(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True).select("event_id", "service", "timestamp", "message")
    return parse_for_rates(v).select("event_id", "service", "status", "event_time", "is_success")


ORACLE["drop_incomplete"] = O.with_view(f"""
, p AS (SELECT event_id, service, {O.status_regex()} AS status,
               {O.ts_seconds('"timestamp"')} AS event_time FROM v)
SELECT event_id, service, status, event_time, CAST(status < 400 AS INTEGER) AS is_success
FROM p WHERE service IS NOT NULL AND status IS NOT NULL AND event_time IS NOT NULL""", dirty=True)


# --- A1, A2: running success rate and span (late + dirty view) --------------


_RUN_EVENTS = f"""
, e AS (SELECT batch_id, coalesce(service, 'unknown_service') AS svc,
               {O.status_strict()} AS code, coalesce("timestamp", 0.0) AS ts FROM v)"""
_SPAN = """
, sb AS (SELECT batch_id, max(CASE WHEN ts > 0 THEN ts END) AS bnew,
                min(CASE WHEN ts <> 0 THEN ts END) AS bold FROM e GROUP BY batch_id)
, sp AS (SELECT batch_id,
                max(bnew) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest,
                min(bold) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS oldest
         FROM sb)"""


@register("running_time_span", O.with_view(_RUN_EVENTS + _SPAN + f"""
SELECT batch_id, {O.ts_micros('newest')} AS newest_considered, {O.ts_micros('oldest')} AS oldest_considered
FROM sp WHERE newest IS NOT NULL AND oldest IS NOT NULL""", dirty=True, late=True))
def q_running_time_span(spark, sf_dir):
    return running_time_span(load_log_view(spark, sf_dir, dirty=True, late=True))


@register("running_success_rate", O.with_view(_RUN_EVENTS + _SPAN + f"""
, pb AS (SELECT batch_id, svc, count(code) AS n,
                sum(CASE WHEN starts_with(code, '2') THEN 1 ELSE 0 END) AS s
         FROM e GROUP BY batch_id, svc)
, c AS (SELECT batch_id, svc,
               sum(n) OVER w AS total, sum(s) OVER w AS successes
        FROM pb WINDOW w AS (PARTITION BY svc ORDER BY batch_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT c.batch_id, c.svc AS service, CAST(successes AS BIGINT) AS successes,
       CAST(total AS BIGINT) AS total,
       coalesce(CAST(successes AS DOUBLE) / NULLIF(total, 0), 0.0) AS value,
       {O.ts_micros('newest')} AS newest_considered, {O.ts_micros('oldest')} AS oldest_considered
FROM c JOIN sp ON c.batch_id = sp.batch_id
WHERE newest IS NOT NULL AND oldest IS NOT NULL""", dirty=True, late=True))
def q_running_success_rate(spark, sf_dir):
    return running_success_rate(load_log_view(spark, sf_dir, dirty=True, late=True))


_RUNNING_TARGET_TAIL = f"""
, pb AS (SELECT batch_id, count(CASE WHEN svc = 'monitoring' THEN code END) AS n,
                sum(CASE WHEN svc = 'monitoring' AND starts_with(code, '2') THEN 1 ELSE 0 END) AS s
         FROM e GROUP BY batch_id)
, c AS (SELECT batch_id, sum(n) OVER w AS total, sum(s) OVER w AS successes
        FROM pb WINDOW w AS (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT c.batch_id, CAST(successes AS BIGINT) AS successes, CAST(total AS BIGINT) AS total,
       coalesce(CAST(successes AS DOUBLE) / NULLIF(total, 0), 0.0) AS value,
       {O.ts_micros('newest')} AS newest_considered, {O.ts_micros('oldest')} AS oldest_considered
FROM c JOIN sp ON c.batch_id = sp.batch_id
WHERE newest IS NOT NULL AND oldest IS NOT NULL"""


def _running_target_sql(late: bool) -> str:
    return O.with_view(_RUN_EVENTS + _SPAN + _RUNNING_TARGET_TAIL, dirty=True, late=late)


@register("running_success_rate_target", _running_target_sql(late=True))
def q_running_success_rate_target(spark, sf_dir):
    return running_success_rate_target(load_log_view(spark, sf_dir, dirty=True, late=True))


# --- A3, A3b: trailing window anchored on the newest event ------------------


_EMITS = """
, b AS (SELECT batch_id, max(coalesce("timestamp", 0.0)) AS bmax FROM v GROUP BY batch_id)
, c AS (SELECT batch_id, bmax,
               coalesce(max(bmax) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0.0) AS prev FROM b)
, em AS (SELECT batch_id, bmax AS nw FROM c WHERE bmax > prev)"""


def _sliding_sql(window_s: int, rate: bool) -> str:
    if rate:
        ev = f"""
, f AS (SELECT batch_id, coalesce("timestamp", 0.0) AS ts,
               CASE WHEN {O.status_regex()} BETWEEN 400 AND 599 THEN 1 ELSE 0 END AS err
        FROM v WHERE service = 'monitoring')"""
        value = "coalesce(CAST(sum(f.err) AS DOUBLE) / NULLIF(count(f.ts), 0), 0.0)"
    else:
        ev = f"""
, f AS (SELECT batch_id, coalesce("timestamp", 0.0) AS ts FROM v
        WHERE service = 'monitoring' AND {O.failure_not_ok()})"""
        value = "CAST(count(f.ts) AS DOUBLE)"
    return O.with_view(_EMITS + ev + f"""
SELECT em.batch_id, {value} AS value, {O.ts_micros('em.nw')} AS newest_considered,
       {O.ts_micros(f'em.nw - {float(window_s)}')} AS oldest_considered
FROM em LEFT JOIN f ON f.batch_id <= em.batch_id AND f.ts >= em.nw - {float(window_s)}
GROUP BY em.batch_id, em.nw""", dirty=True, late=True)


@register("sliding_failures", _sliding_sql(60, False))
def q_sliding_failures(spark, sf_dir):
    return sliding_failures(load_log_view(spark, sf_dir, dirty=True, late=True), window_seconds=60)


@register("sliding_failures_6h", _sliding_sql(21600, False))
def q_sliding_failures_6h(spark, sf_dir):
    return sliding_failures(load_log_view(spark, sf_dir, dirty=True, late=True), window_seconds=21600)


@register("sliding_failure_rate", _sliding_sql(60, True))
def q_sliding_failure_rate(spark, sf_dir):
    return sliding_failure_rate(load_log_view(spark, sf_dir, dirty=True, late=True), window_seconds=60)


@register("sliding_failure_rate_6h", _sliding_sql(21600, True))
def q_sliding_failure_rate_6h(spark, sf_dir):
    return sliding_failure_rate(load_log_view(spark, sf_dir, dirty=True, late=True),
                                window_seconds=21600)


# --- A4, A4b, A5: uniform sample and its mode -------------------------------


_KEYED = f"""
, k AS (SELECT event_id, batch_id, service, {O.status_last()} AS code,
               md5(CAST(event_id AS VARCHAR) || ':42') AS sample_key FROM v)"""
_SAMPLE = _KEYED + """
, s AS (SELECT * FROM k ORDER BY sample_key, event_id LIMIT 10)"""


@register("reservoir_sample", O.with_view(
    _SAMPLE + " SELECT event_id, batch_id, service, code, sample_key FROM s", dirty=True))
def q_reservoir_sample(spark, sf_dir):
    return reservoir_sample(load_log_view(spark, sf_dir, dirty=True), k=10, seed=42)


@register("reservoir_mode", O.with_view(_SAMPLE + f"""
, m AS (SELECT code, count(*) AS sample_count FROM s GROUP BY code
        ORDER BY sample_count DESC, code ASC NULLS LAST LIMIT 1)
, sp AS (SELECT max("timestamp") AS nw, min("timestamp") AS od FROM v)
SELECT TRY_CAST(code AS DOUBLE) AS value, code, sample_count,
       {O.ts_micros('nw')} AS newest_considered, {O.ts_micros('od')} AS oldest_considered
FROM m, sp""", dirty=True))
def q_reservoir_mode(spark, sf_dir):
    return reservoir_mode(load_log_view(spark, sf_dir, dirty=True), k=10, seed=42)


@register("reservoir_sample_by_batch", O.with_view(_KEYED + """
, cand AS (SELECT * FROM k
           QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY sample_key, event_id) <= 10)
, b AS (SELECT DISTINCT batch_id FROM v)
SELECT b.batch_id, cand.event_id, cand.code, cand.sample_key
FROM b JOIN cand ON cand.batch_id <= b.batch_id
QUALIFY row_number() OVER (PARTITION BY b.batch_id ORDER BY cand.sample_key, cand.event_id) <= 10""",
    dirty=True, late=True))
def q_reservoir_sample_by_batch(spark, sf_dir):
    return reservoir_sample_by_batch(load_log_view(spark, sf_dir, dirty=True, late=True), k=10, seed=42)


_BY_BATCH_SQL = _KEYED + """
, cand AS (SELECT * FROM k
           QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY sample_key, event_id) <= 10)
, b AS (SELECT DISTINCT batch_id FROM v)
, sb AS (SELECT b.batch_id, cand.event_id, cand.code, cand.sample_key
         FROM b JOIN cand ON cand.batch_id <= b.batch_id
         QUALIFY row_number() OVER (PARTITION BY b.batch_id ORDER BY cand.sample_key, cand.event_id) <= 10)"""


@register("reservoir_mode_by_batch", O.with_view(_BY_BATCH_SQL + f"""
, cnt AS (SELECT batch_id, code, count(*) AS sample_count FROM sb GROUP BY batch_id, code)
, md AS (SELECT * FROM cnt QUALIFY row_number() OVER (PARTITION BY batch_id
         ORDER BY sample_count DESC, code ASC NULLS LAST) = 1)
, pb AS (SELECT batch_id, max("timestamp") AS bmax, min("timestamp") AS bmin FROM v GROUP BY batch_id)
, sp AS (SELECT batch_id,
                max(bmax) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nw,
                min(bmin) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS od
         FROM pb)
SELECT md.batch_id, TRY_CAST(code AS DOUBLE) AS value, code, sample_count,
       {O.ts_micros('nw')} AS newest_considered, {O.ts_micros('od')} AS oldest_considered
FROM md JOIN sp ON md.batch_id = sp.batch_id""", dirty=True, late=True))
def q_reservoir_mode_by_batch(spark, sf_dir):
    return reservoir_mode_by_batch(load_log_view(spark, sf_dir, dirty=True, late=True), k=10, seed=42)


@register("reservoir_mode_by_options", ORACLE["reservoir_mode"].replace("LIMIT 10)", "LIMIT 25)"))
def q_reservoir_mode_by_options(spark, sf_dir):
    """An operator by its name in the registry, with options as a config file gives them: one under
    its config name, one that the operator does not know."""
    return run("reservoir_mode", load_log_view(spark, sf_dir, dirty=True), reservoir_size=25, refresh="0.3")


_LARGE_K = 10_000


@register("reservoir_mode_by_batch_large", ORACLE["reservoir_mode_by_batch"].replace("<= 10)", f"<= {_LARGE_K})"))
def q_reservoir_mode_by_batch_large(spark, sf_dir):
    """The mode of a sample of ten thousand events after every batch."""
    return reservoir_mode_by_batch(load_log_view(spark, sf_dir, dirty=True, late=True), k=_LARGE_K, seed=42)


# --- A8, F7, A9: Bloom filter ------------------------------------------------


def _idx_sql(text: str, i: str, m: int) -> str:
    return (f"((('0x' || substr(sha256(unhex(lpad(to_hex({i}), 4, '0')) || encode({text})), 1, 8))"
            f"::BIGINT) % {m})")


def _log_patterns(v):
    """Patterns of interest derived from the stream: the messages of the
    monitoring service's 4xx/5xx events."""
    return (v.where((F.col("service") == "monitoring") & (LF.status_regex("message") >= 400))
            .select(F.col("message").alias("pattern")).distinct())


_LOG_PATTERNS_SQL = f"""
, pat AS (SELECT DISTINCT message AS pattern FROM v
          WHERE service = 'monitoring' AND {O.status_regex()} >= 400)"""


def _bits_sql(pat: str, m: int, k: int) -> str:
    return f"""
, bits AS (SELECT DISTINCT {_idx_sql('p.pattern', 'r.i', m)} AS bit
           FROM {pat} p, range(0, {k}) r(i) WHERE p.pattern IS NOT NULL)"""


def _probe_sql(src: str, id_cols: str, text: str, m: int, k: int) -> str:
    return f"""
, probe AS (SELECT {id_cols}, bool_and(b.bit IS NOT NULL) AS hit
            FROM {src} t CROSS JOIN range(0, {k}) r(i)
            LEFT JOIN bits b ON b.bit = {_idx_sql(text, 'r.i', m)}
            GROUP BY {id_cols})"""


@register("bloom_indices", f"""
SELECT item_id, r.i AS hash_number, {_idx_sql('text', 'r.i', 1_000_000)} AS bit
FROM benchmark, range(0, 7) r(i)""")
def q_bloom_indices(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark")
    return b.select("item_id", F.posexplode(F.array(*LF.bloom_indices("text", 7, 1_000_000)))).select(
        "item_id", F.col("pos").cast("bigint").alias("hash_number"), F.col("col").alias("bit"))


@register("bloom_build", f"""
WITH pat AS (SELECT text AS pattern FROM benchmark) {_bits_sql('pat', 1_000_000, 7)}
SELECT CAST(bit // {WORD_BITS} AS BIGINT) AS word, count(*) AS bits_set
FROM bits GROUP BY bit // {WORD_BITS}""")
def q_bloom_build(spark, sf_dir):
    pats = read_table(spark, sf_dir, "benchmark").select(F.col("text").alias("pattern"))
    return bloom_build(pats, m_bits=1_000_000, k_hashes=7).select(
        "word", F.bit_count("bits").cast("bigint").alias("bits_set"))


@register("bloom_forward", O.with_view(_LOG_PATTERNS_SQL + _bits_sql("pat", 64, 3)
                                       + _probe_sql("v", "t.event_id", "coalesce(t.message, '')", 64, 3) + """
SELECT v.event_id, v.batch_id, v.service, v.message FROM v JOIN probe p ON v.event_id = p.event_id
WHERE p.hit""", dirty=True))
def q_bloom_forward(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    filt = bloom_build(_log_patterns(v), m_bits=64, k_hashes=3)
    return bloom_forward(v, filt, m_bits=64, k_hashes=3).select("event_id", "batch_id", "service", "message")


@register("exact_forward", O.with_view(_LOG_PATTERNS_SQL + """
SELECT event_id, batch_id, service, message FROM v WHERE coalesce(message, '') IN (SELECT pattern FROM pat)""", dirty=True))
def q_exact_forward(spark, sf_dir):
    """The twin of ``bloom_forward`` without false positives."""
    v = load_log_view(spark, sf_dir, dirty=True)
    return exact_forward(v, _log_patterns(v)).select("event_id", "batch_id", "service", "message")


@register("bloom_hit_ratio", O.with_view(_LOG_PATTERNS_SQL + _bits_sql("pat", 500_000, 8)
                                         + _probe_sql("v", "t.event_id", "coalesce(t.message, '')", 500_000, 8) + f"""
SELECT v.batch_id, CAST(sum(CASE WHEN p.hit THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(*) AS events,
       CAST(sum(CASE WHEN p.hit THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS value,
       {O.ts_micros('max(v."timestamp")')} AS newest_considered,
       {O.ts_micros('min(v."timestamp")')} AS oldest_considered
FROM v JOIN probe p ON v.event_id = p.event_id
GROUP BY v.batch_id HAVING count(v."timestamp") > 0""", dirty=True, late=True))
def q_bloom_hit_ratio(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True, late=True)
    filt = bloom_build(_log_patterns(v), m_bits=500_000, k_hashes=8)
    return bloom_hit_ratio(v, filt, m_bits=500_000, k_hashes=8)


@register("bloom_documents", f"""
WITH pat AS (SELECT text AS pattern FROM benchmark) {_bits_sql('pat', 1_000_000, 7)}
{_probe_sql('documents', 't.doc_id', "coalesce(t.text, '')", 1_000_000, 7)}
SELECT doc_id, hit FROM probe""")
def q_bloom_documents(spark, sf_dir):
    pats = read_table(spark, sf_dir, "benchmark").select(F.col("text").alias("pattern"))
    filt = bloom_build(pats, m_bits=1_000_000, k_hashes=7)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bloom_contains(docs, filt, F.coalesce(F.col("text"), F.lit("")), "hit",
                          m_bits=1_000_000, k_hashes=7).select("doc_id", "hit")


# --- S1-S7, U2: file sources (write the view as files, read them back) -----


_STAGED: dict[tuple, str] = {}
FILES_PER_TASK = 250


def n_files(spark, sf_dir: str) -> int:
    """Log files that the table makes, about (from the row count in its metadata)."""
    return -(-read_table(spark, sf_dir, "events").count() // BATCH_SIZE)


def write_tasks(spark, sf_dir: str, waves: int = 1) -> int:
    """Tasks that write the table's log files (in ``waves`` parts): ``FILES_PER_TASK`` each, at least one a core."""
    n = -(-n_files(spark, sf_dir) // waves)
    return max(1, -(-n // FILES_PER_TASK), min(n, spark.sparkContext.defaultParallelism))


def staged_log_files(spark, sf_dir: str) -> str:
    """The dirty view written as JSON-array log files, once per session and
    table directory, in the shared checkpoint folder (the input of the file
    and stream queries)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, "staged-logs")
        write_log_files(load_log_view(spark, sf_dir, dirty=True), path, tasks=write_tasks(spark, sf_dir))
        _STAGED[key] = path
    return path


def staged_stream_files(spark, sf_dir: str) -> str:
    """The same files for streams, which look them up recursively: in a folder a task, not one a file."""
    key = (spark.sparkContext.applicationId, sf_dir, "stream")
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, "staged-stream")
        write_log_files(load_log_view(spark, sf_dir, dirty=True), path, tasks=write_tasks(spark, sf_dir), folder_a_batch=False)
        _STAGED[key] = path
    return path


@register("read_logs", O.with_view(
    'SELECT batch_id, pos, service, "timestamp", message FROM v', dirty=True))
def q_read_logs(spark, sf_dir):
    logs = read_logs(spark, staged_log_files(spark, sf_dir), glob="*.txt", require_files=True)
    return logs.select(F.col("batch_id").cast("bigint").alias("batch_id"), "pos", "service",
                       "timestamp", "message")


@register("read_logs_multiline", ORACLE["read_logs"])
def q_read_logs_multiline(spark, sf_dir):
    """Same files through the streaming JSON parser (large-file mode)."""
    logs = read_logs(spark, staged_log_files(spark, sf_dir), glob="*.txt", parser="multiline")
    batch = F.regexp_extract("file_path", r"batch_id=(\d+)", 1).cast("bigint")
    return logs.select(batch.alias("batch_id"), "pos", "service", "timestamp", "message")


@register("running_success_rate_files", _running_target_sql(late=False))
def q_running_success_rate_files(spark, sf_dir):
    """End to end from files: the staged log files read back, each file's
    ``batch_id=N`` folder giving its batch, into the running rate."""
    logs = read_logs(spark, staged_log_files(spark, sf_dir), glob="*.txt")
    return running_success_rate_target(logs.withColumn("batch_id", F.col("batch_id").cast("bigint")))


_FILE_ORDER_SQL = """
, names AS (SELECT DISTINCT batch_id AS b0 FROM v)
, nr AS (SELECT b0, CAST(row_number() OVER (ORDER BY 'batch_id=' || CAST(b0 AS VARCHAR) || '/') - 1 AS BIGINT) AS nb FROM names)
, f AS (SELECT v.* REPLACE (nr.nb AS batch_id) FROM v JOIN nr ON nr.b0 = v.batch_id)"""


def _files_by_name(spark, sf_dir):
    """The staged files' events, and the files numbered by path from metadata alone."""
    src = staged_log_files(spark, sf_dir)
    return read_logs(spark, src, glob="*.txt").drop("batch_id"), number_files(spark, src, glob="*.txt", order=("file_path",))


@register("running_success_rate_by_file_name", O.with_view(
    _FILE_ORDER_SQL + _RUN_EVENTS.replace("FROM v)", "FROM f)") + _SPAN + _RUNNING_TARGET_TAIL, dirty=True))
def q_running_success_rate_by_file_name(spark, sf_dir):
    """Running rate with files as batches in name order: numbered from metadata,
    summed per file, then joined to the numbers."""
    events, numbers = _files_by_name(spark, sf_dir)
    return running_success_rate_target(events, numbers=numbers)


@register("reservoir_sample_by_file_name", O.with_view(_FILE_ORDER_SQL + f"""
, k AS (SELECT event_id, batch_id, {O.status_last()} AS code,
               md5(CAST(event_id AS VARCHAR) || ':42') AS sample_key FROM f)
, cand AS (SELECT * FROM k
           QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY sample_key, event_id) <= 10)
, b AS (SELECT DISTINCT batch_id FROM f)
SELECT b.batch_id, cand.event_id, cand.code, cand.sample_key
FROM b JOIN cand ON cand.batch_id <= b.batch_id
QUALIFY row_number() OVER (PARTITION BY b.batch_id ORDER BY cand.sample_key, cand.event_id) <= 10""", dirty=True))
def q_reservoir_sample_by_file_name(spark, sf_dir):
    events, numbers = _files_by_name(spark, sf_dir)
    batch = F.regexp_extract("file_path", r"batch_id=(\d+)", 1).cast("bigint")
    ids = events.withColumn("event_id", batch * BATCH_SIZE + F.col("pos"))
    return reservoir_sample_by_batch(ids, k=10, seed=42, numbers=numbers)


def damaged_log_lines(v, tasks=None):
    """The view as file lines, some files damaged: an unterminated array
    (batch mod 11 = 5) and JSON lines instead of an array (batch mod 13 = 7).
    Every event is still written."""
    lines = json_array_lines(v, tasks=tasks)
    b = F.col("batch_id")
    line = (F.when(b % 11 == 5, F.regexp_replace("line", r"\]$", ""))
            .when(b % 13 == 7, F.regexp_replace(F.regexp_replace("line", r"^[\[,]", ""), r"\]$", ""))
            .otherwise(F.col("line")))
    return lines.withColumn("line", line)


def staged_damaged_files(spark, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, "damaged")
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, "staged-damaged")
        v = load_log_view(spark, sf_dir, dirty=True)
        write_batch_files(damaged_log_lines(v, write_tasks(spark, sf_dir)), path, clustered=True)
        _STAGED[key] = path
    return path


@register("quarantine_files", O.with_view("""
SELECT DISTINCT batch_id FROM v WHERE batch_id % 11 = 5 OR batch_id % 13 = 7""", dirty=True))
def q_quarantine_files(spark, sf_dir):
    raw = read_raw_files(spark, staged_damaged_files(spark, sf_dir), glob="*.txt")
    return quarantine_files(raw).select(F.col("batch_id").cast("bigint").alias("batch_id"))


def odd_log_lines(v):
    """The view as file lines, files odd in more ways, first match wins: unterminated (batch mod 11 = 5),
    JSON lines (13, 7), a number among the elements (19, 2), nulls among them (17, 3), braces and
    quotes in a string of each event (31, 8).  Besides, empty arrays (23, 4) and bare objects, a batch's
    first event (29, 6), as files of their own."""
    b, line = F.col("batch_id"), F.col("line")
    odd = (F.when(b % 11 == 5, F.regexp_replace("line", r"\]$", ""))
           .when(b % 13 == 7, F.regexp_replace(F.regexp_replace("line", r"^[\[,]", ""), r"\]$", ""))
           .when(b % 19 == 2, F.regexp_replace("line", r"^\[", "[1,"))
           .when((b % 17 == 3) & (F.col("pos") % 7 == 0), F.regexp_replace("line", r"^([\[,])", "$1null, "))
           .when(b % 31 == 8, F.regexp_replace("line", r"^([\[,])\{", r"$1 {" + '"note": "}{ \\\\"]}", "more": {"x": [{}]}, '))
           .otherwise(line))
    lines = json_array_lines(v)
    empty = lines.where((b % 23 == 4) & (F.col("pos") == 0)).select((b + 1_000_000).alias("batch_id"), "pos", F.lit("[ ]").alias("line"))
    bare = (v.where((b % 29 == 6) & (F.col("pos") == 0))
            .select((b + 2_000_000).alias("batch_id"), "pos", F.to_json(F.struct("service", "timestamp", "message")).alias("line")))
    return lines.withColumn("line", odd).unionByName(empty).unionByName(bare)


def staged_odd_files(spark, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, "odd")
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, "staged-odd")
        write_batch_files(odd_log_lines(load_log_view(spark, sf_dir, dirty=True)), path, tasks=write_tasks(spark, sf_dir))
        _STAGED[key] = path
    return path


_ODD_BAD = "batch_id % 11 = 5 OR batch_id % 13 = 7 OR batch_id % 19 = 2"
_ODD_EVENTS_SQL = O.with_view(f"""
SELECT batch_id, CAST(pos + CASE WHEN batch_id % 17 = 3 THEN pos // 7 + 1 ELSE 0 END AS BIGINT) AS pos,
       service, "timestamp", message FROM v WHERE NOT ({_ODD_BAD})
UNION ALL SELECT batch_id + 2000000, pos, service, "timestamp", message FROM v WHERE batch_id % 29 = 6 AND pos = 0""", dirty=True)
_ODD_FILES_SQL = O.with_view(f"SELECT DISTINCT batch_id FROM v WHERE {_ODD_BAD}", dirty=True)


def _file_batch():
    return F.regexp_extract("file_path", r"batch_id=(\d+)", 1).cast("bigint").alias("batch_id")


def _odd_events(spark, sf_dir, parser):
    logs = read_logs(spark, staged_odd_files(spark, sf_dir), glob="*.txt", parser=parser)
    return logs.select(_file_batch(), "pos", "service", "timestamp", "message")


@register("read_odd_logs", _ODD_EVENTS_SQL)
def q_read_odd_logs(spark, sf_dir):
    """Events of odd files: nulls among elements, bare objects, empty arrays, malformed files."""
    return _odd_events(spark, sf_dir, "wholetext")


@register("read_odd_logs_multiline", _ODD_EVENTS_SQL)
def q_read_odd_logs_multiline(spark, sf_dir):
    """The same files read in pieces, by the same contract."""
    return _odd_events(spark, sf_dir, "multiline")


@register("quarantine_odd_files", _ODD_FILES_SQL)
def q_quarantine_odd_files(spark, sf_dir):
    return quarantine_files(read_raw_files(spark, staged_odd_files(spark, sf_dir), glob="*.txt")).select(_file_batch())


@register("quarantine_odd_files_multiline", _ODD_FILES_SQL)
def q_quarantine_odd_files_multiline(spark, sf_dir):
    return quarantine_files_multiline(spark, staged_odd_files(spark, sf_dir), glob="*.txt").select(_file_batch())


@register("unprocessed_files", O.with_view("""
SELECT DISTINCT batch_id FROM v
WHERE batch_id NOT IN (SELECT batch_id FROM v WHERE pos = 0 AND service = 'training')""", dirty=True))
def q_unprocessed_files(spark, sf_dir):
    raw = read_raw_files(spark, staged_log_files(spark, sf_dir), glob="*.txt")
    listed = raw.select("file_path", "batch_id")
    events = parse_log_files(raw)
    # the manifest of processed files: those whose first event is from 'training'
    processed = events.where((F.col("pos") == 0) & (F.col("service") == "training")).select("file_path")
    return unprocessed_files(listed, processed).select(F.col("batch_id").cast("bigint").alias("batch_id"))


@register("read_patterns", O.with_view("""
SELECT message AS pattern FROM v WHERE message IS NOT NULL AND message <> ''""", dirty=True))
def q_read_patterns(spark, sf_dir):
    v = load_log_view(spark, sf_dir, dirty=True)
    out = scratch_path(spark, "patterns")
    padded = F.concat(F.lit("  "), F.coalesce("message", F.lit("")), F.lit(" \t"))
    v.select(padded.alias("value")).write.text(out)
    return read_patterns(spark, out)


# --- K1/P8: result log ------------------------------------------------------


def _fmt_ts_sql(x: str) -> str:
    return (f"strftime({x}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({x}) % 1000000 <> 0 "
            f"THEN '.' || lpad(CAST(epoch_us({x}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END")


@register("results_log")
def q_results_log(spark, sf_dir):
    return result_log_rows(q_running_success_rate_target(spark, sf_dir))


ORACLE["results_log"] = (
    "SELECT batch_id, printf('%.4f', value) AS value_text, "
    f"{_fmt_ts_sql('newest_considered')} AS newest_text, {_fmt_ts_sql('oldest_considered')} AS oldest_text "
    f"FROM ({ORACLE['running_success_rate_target']})")


@register("summary_written", ORACLE["service_success_summary"])
def q_summary_written(spark, sf_dir):
    """A full result handed out as CSV files with a header, read back."""
    result, out = q_service_success_summary(spark, sf_dir), scratch_path(spark, "summary-out")
    write_results(result, out, "csv")
    return spark.read.schema(result.schema).options(**CSV_OPTIONS).csv(out)


# --- Streaming forms (file stream, availableNow) -----------------------------


# files per micro-batch when replaying a whole table through a stream: 1,000
# files of 100 events at sf0.1 make 4 micro-batches, and more data makes more, up to
# MICRO_BATCHES; beyond, they grow with the backlog, since each costs seconds besides its files
FILES_PER_TRIGGER = 250
MICRO_BATCHES = 8


def files_per_trigger(spark, sf_dir: str) -> int:
    """``FILES_PER_TRIGGER``, fewer where the table has too few files for four micro-batches,
    more where it has too many for ``MICRO_BATCHES``."""
    n = n_files(spark, sf_dir)
    return max(1, min(FILES_PER_TRIGGER, -(-n // 4)), -(-n // MICRO_BATCHES))


@register("stream_windowed_success_rate", ORACLE["windowed_success_rate"])
def q_stream_windowed_success_rate(spark, sf_dir):
    src = staged_stream_files(spark, sf_dir)
    out = scratch_path(spark, "stream-windowed-out")
    q = start_windowed_success_rate(spark, src, out, glob="*.txt", output_mode="complete",
                                    trigger={"availableNow": True}, max_files_per_trigger=files_per_trigger(spark, sf_dir),
                                    window_duration="10 seconds", slide_duration="10 seconds")
    run_available(q)
    return last_epoch(spark, out).select("window_start", "window_end", "service", "total",
                                         "successes", "success_rate")


@register("stream_running_counts", O.with_view(f"""
SELECT service, total, successes, coalesce(CAST(successes AS DOUBLE) / NULLIF(total, 0), 0.0) AS value
FROM (SELECT coalesce(service, 'unknown_service') AS service, count({O.status_strict()}) AS total,
             CAST(sum(CASE WHEN starts_with({O.status_strict()}, '2') THEN 1 ELSE 0 END) AS BIGINT) AS successes
      FROM v GROUP BY 1)""", dirty=True))
def q_stream_running_counts(spark, sf_dir):
    src = staged_stream_files(spark, sf_dir)
    out = scratch_path(spark, "stream-running-out")
    q = start_running_success_rate(spark, src, out, glob="*.txt", trigger={"availableNow": True},
                                   max_files_per_trigger=files_per_trigger(spark, sf_dir))
    run_available(q)
    return last_epoch(spark, out, "per_service").select("service", "total", "successes", "value")


@register("stream_windowed_success_rate_append", O.with_view(f"""
, p AS (SELECT service, {O.status_regex()} AS status, TRY_CAST(trunc("timestamp") AS BIGINT) AS t FROM v)
, c AS (SELECT * FROM p WHERE service IS NOT NULL AND status IS NOT NULL AND t IS NOT NULL)
SELECT make_timestamp(CAST(floor(t / 3600) * 3600 AS BIGINT) * 1000000) AS window_start,
       make_timestamp(CAST(floor(t / 3600) * 3600 + 3600 AS BIGINT) * 1000000) AS window_end,
       service, count(*) AS total, CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS BIGINT) AS successes,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS success_rate
FROM c WHERE floor(t / 3600) * 3600 + 3600 <= (SELECT max(t) FROM c) - 21600
GROUP BY floor(t / 3600), service""", dirty=True))
def q_stream_windowed_success_rate_append(spark, sf_dir):
    """Append mode: the windows that a 6-hour watermark has closed, each once.  Files
    carry no order of time, so they come in one micro-batch, which drops no row;
    the watermark closes the windows in the next."""
    out = scratch_path(spark, "stream-append-out")
    q = start_windowed_success_rate(spark, staged_stream_files(spark, sf_dir), out, glob="*.txt", output_mode="append",
                                    trigger={"availableNow": True}, max_files_per_trigger=None,
                                    window_duration="1 hour", slide_duration="1 hour", watermark="6 hours")
    run_available(q)
    return read_results(spark, out).select("window_start", "window_end", "service", "total", "successes", "success_rate")


def _sliding_state_sql(rate: bool) -> str:
    if rate:
        rows = f"""SELECT coalesce("timestamp", 0.0) AS ts,
               CASE WHEN {O.status_regex()} BETWEEN 400 AND 599 THEN 1 ELSE 0 END AS err
        FROM v WHERE service = 'monitoring'"""
        value = "coalesce(CAST(sum(f.err) AS DOUBLE) / NULLIF(count(f.ts), 0), 0.0)"
    else:
        rows = f"""SELECT coalesce("timestamp", 0.0) AS ts FROM v
        WHERE service = 'monitoring' AND {O.failure_not_ok()}"""
        value = "CAST(count(f.ts) AS DOUBLE)"
    return O.with_view(f"""
, m AS (SELECT max(coalesce("timestamp", 0.0)) AS nw FROM v), f AS ({rows})
SELECT {value} AS value, {O.ts_micros('m.nw')} AS newest_considered,
       {O.ts_micros('m.nw - 21600.0')} AS oldest_considered
FROM m LEFT JOIN f ON f.ts >= m.nw - 21600.0 GROUP BY m.nw""", dirty=True)


def _stream_sliding(spark, sf_dir, rate: bool):
    """The final state over several micro-batches: the newest time and its window do
    not depend on the order in which files arrive."""
    src = staged_stream_files(spark, sf_dir)
    out = scratch_path(spark, "stream-sliding-out")
    q = start_sliding_failures(spark, src, out, glob="*.txt", trigger={"availableNow": True}, rate=rate,
                               max_files_per_trigger=files_per_trigger(spark, sf_dir), window_seconds=21600)
    run_available(q)
    return sliding_state_result(read_state(spark, out, 1 << 62, SLIDING_STATE), 21600, rate)


@register("stream_sliding_failures_6h", _sliding_state_sql(rate=False))
def q_stream_sliding_failures_6h(spark, sf_dir):
    return _stream_sliding(spark, sf_dir, rate=False)


@register("stream_sliding_failure_rate_6h", _sliding_state_sql(rate=True))
def q_stream_sliding_failure_rate_6h(spark, sf_dir):
    return _stream_sliding(spark, sf_dir, rate=True)


@register("stream_bloom_hit_ratio", O.with_view(_LOG_PATTERNS_SQL + _bits_sql("pat", 500_000, 8)
                                                + _probe_sql("v", "t.event_id", "coalesce(t.message, '')", 500_000, 8) + f"""
SELECT v.batch_id, CAST(sum(CASE WHEN p.hit THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(*) AS events,
       CAST(sum(CASE WHEN p.hit THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS value,
       {O.ts_micros('max(v."timestamp")')} AS newest_considered,
       {O.ts_micros('min(v."timestamp")')} AS oldest_considered
FROM v JOIN probe p ON v.event_id = p.event_id
GROUP BY v.batch_id HAVING count(v."timestamp") > 0""", dirty=True))
def q_stream_bloom_hit_ratio(spark, sf_dir):
    """Per-file hit ratio from the file stream (stateless, one row per file)."""
    filt = bloom_build(_log_patterns(load_log_view(spark, sf_dir, dirty=True)), m_bits=500_000, k_hashes=8)
    src = staged_stream_files(spark, sf_dir)
    out = scratch_path(spark, "stream-bloom-out")
    q = start_bloom_ratio(spark, src, out, filt, m_bits=500_000, k_hashes=8, glob="*.txt",
                          trigger={"availableNow": True}, max_files_per_trigger=files_per_trigger(spark, sf_dir))
    run_available(q)
    res = spark.read.parquet(f"{out}/results")
    return res.select(
        F.regexp_extract("file_path", r"batch_id=(\d+)", 1).cast("bigint").alias("batch_id"),
        "hits", "events", "value", "newest_considered", "oldest_considered")


@register("stream_reservoir_sample", O.with_view(
    _SAMPLE + " SELECT event_id, code, sample_key FROM s", dirty=True))
def q_stream_reservoir_sample(spark, sf_dir):
    """The sample carried across micro-batches in the versioned state table;
    events are named by their id (``batch * 100 + pos``), so the final state
    equals the batch bottom-k."""
    src = staged_stream_files(spark, sf_dir)
    out = scratch_path(spark, "stream-reservoir-out")
    batch = F.regexp_extract("file_path", r"batch_id=(\d+)", 1).cast("bigint")
    ident = batch * BATCH_SIZE + F.col("pos")
    q = start_reservoir(spark, src, out, k=10, seed=42, glob="*.txt", trigger={"availableNow": True},
                        max_files_per_trigger=files_per_trigger(spark, sf_dir), identity=ident)
    run_available(q)
    state = read_state(spark, out, 1 << 62, RESERVOIR_STATE)
    return state.select(F.col("ident").cast("bigint").alias("event_id"), "code", "sample_key")


# --- Folders that grow: name order, result log, restarts, runs by manifest ---


def _write_wave(v, path: str, keep, tasks: int) -> None:
    write_log_files(v.where(keep), path, mode="append", tasks=tasks)


def _polled_by_name(spark, sf_dir):
    """The running rate by file over a folder that grows between two polls: first the even batches' files,
    then, by a stream continued from its checkpoint, the odd ones'."""
    v = load_log_view(spark, sf_dir, dirty=True)
    src, out, log = (scratch_path(spark, f"stream-by-name-{x}") for x in ("src", "out", "log"))
    tasks = write_tasks(spark, sf_dir, 2)
    for odd in (0, 1):
        _write_wave(v, src, F.col("batch_id") % 2 == odd, tasks)
        run_available(start_running_by_file(spark, src, out, glob="*.txt", trigger={"availableNow": True}, log=log))
    return out, log


_POLL_ORDER_SQL = """
, names AS (SELECT DISTINCT batch_id AS b0 FROM v)
, nr AS (SELECT b0, CAST(row_number() OVER (ORDER BY b0 % 2, 'batch_id=' || CAST(b0 AS VARCHAR) || '/') - 1 AS BIGINT) AS nb FROM names)
, f AS (SELECT v.* REPLACE (nr.nb AS batch_id) FROM v JOIN nr ON nr.b0 = v.batch_id)"""
_BY_POLL_AND_NAME = O.with_view(_POLL_ORDER_SQL + _RUN_EVENTS.replace("FROM v)", "FROM f)") + _SPAN + _RUNNING_TARGET_TAIL, dirty=True)


@register("stream_running_by_file_name", _BY_POLL_AND_NAME)
def q_stream_running_by_file_name(spark, sf_dir):
    """New files of a poll in name order: a result after each file, numbered on over the polls."""
    out, _ = _polled_by_name(spark, sf_dir)
    return read_results(spark, out).select("batch_id", "successes", "total", "value", "newest_considered", "oldest_considered")


@register("stream_results_log", f"""
SELECT CASE WHEN batch_id < (SELECT count(DISTINCT event_id // {BATCH_SIZE}) FROM events WHERE (event_id // {BATCH_SIZE}) % 2 = 0)
            THEN 0 ELSE 1 END AS epoch, printf('%.4f', value) AS value_text, {_fmt_ts_sql('newest_considered')} AS newest_text,
       {_fmt_ts_sql('oldest_considered')} AS oldest_text FROM ({_BY_POLL_AND_NAME})""")
def q_stream_results_log(spark, sf_dir):
    """The result log of that stream, read back: the lines of each epoch once."""
    _, log = _polled_by_name(spark, sf_dir)
    return read_results_log(spark, log).select(F.col("epoch").cast("int").alias("epoch"), "value_text", "newest_text", "oldest_text")


WAVES = 4


def _late_waves(spark, sf_dir):
    """An ``update`` query over four micro-batches in a fixed order of arrival: the late view's files, written in
    four waves of the same number of files one after the other, which the file source takes by time."""
    # late rows share a batch with others of the same place: their ids order a file
    v = load_log_view(spark, sf_dir, dirty=True, late=True).withColumn("pos", F.col("event_id"))
    files = -(-v.select("batch_id").distinct().count() // WAVES)
    src, out = scratch_path(spark, "stream-late-src"), scratch_path(spark, "stream-late-out")
    tasks = write_tasks(spark, sf_dir, WAVES)
    for wave in range(WAVES):
        _write_wave(v, src, F.floor(F.col("batch_id") / files) == wave, tasks)
    q = start_windowed_success_rate(spark, src, out, glob="*.txt", output_mode="update", trigger={"availableNow": True},
                                    max_files_per_trigger=files, window_duration="1 hour", slide_duration="1 hour", watermark="6 hours")
    run_available(q)
    return q, out


_LATE_SQL = f"""
, k AS (SELECT (count(DISTINCT batch_id) + {WAVES - 1}) // {WAVES} AS files FROM v)
, p AS (SELECT batch_id // files AS wave, service, {O.status_regex()} AS status, TRY_CAST(trunc("timestamp") AS BIGINT) AS t FROM v, k)
, c AS (SELECT *, CAST(floor(t / 3600) * 3600 AS BIGINT) AS ws FROM p WHERE service IS NOT NULL AND status IS NOT NULL AND t IS NOT NULL)
, m AS (SELECT wave, max(t) AS newest FROM c GROUP BY wave)
, wm AS (SELECT wave, greatest(0, coalesce(max(newest) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 21600, 0)) AS wm FROM m)
, lm AS (SELECT wave, wm, lag(wm, 1, 0) OVER (ORDER BY wave) AS late FROM wm)
, r AS (SELECT c.*, wm, ws + 3600 > late AS kept FROM c JOIN lm USING (wave))"""


@register("stream_windowed_update_late", O.with_view(_LATE_SQL + """
SELECT make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 3600) * 1000000) AS window_end, service, count(*) AS total,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS BIGINT) AS successes,
       CAST(sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS success_rate
FROM r WHERE kept GROUP BY ws, service""", dirty=True, late=True))
def q_stream_windowed_update_late(spark, sf_dir):
    """Windows after four micro-batches with late rows.  Spark closes windows by the watermark of a
    micro-batch after its rows are in, and drops the rows of closed windows from the next on."""
    _, out = _late_waves(spark, sf_dir)
    cols = ["total", "successes", "success_rate"]
    last = read_results(spark, out).groupBy("window_start", "window_end", "service").agg(F.max_by(F.struct(*cols), "epoch").alias("r"))
    return last.select("window_start", "window_end", "service", *[F.col(f"r.{c}").alias(c) for c in cols])


@register("stream_late_account", O.with_view(_LATE_SQL + """
SELECT wave AS epoch, make_timestamp(wm * 1000000) AS watermark, count(*) AS seen, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN kept THEN 0 ELSE 1 END) AS BIGINT) AS dropped FROM r GROUP BY wave, wm""", dirty=True, late=True))
def q_stream_late_account(spark, sf_dir):
    """Per micro-batch the rows seen, kept and dropped by the watermark."""
    return late_account(*_late_waves(spark, sf_dir))


@register("stream_sliding_by_service_6h", O.with_view(f"""
, m AS (SELECT max(coalesce("timestamp", 0.0)) AS nw FROM v)
, f AS (SELECT service, coalesce("timestamp", 0.0) AS ts, {O.failure_not_ok()} AS bad FROM v WHERE service IS NOT NULL)
SELECT service, CAST(count(CASE WHEN bad AND ts >= nw - 21600.0 THEN 1 END) AS DOUBLE) AS value, {O.ts_micros('nw')} AS newest_considered,
       {O.ts_micros('nw - 21600.0')} AS oldest_considered FROM f, m GROUP BY service, nw""", dirty=True))
def q_stream_sliding_by_service_6h(spark, sf_dir):
    """One stream, the window count of every service."""
    src, out = staged_stream_files(spark, sf_dir), scratch_path(spark, "stream-sliding-services-out")
    run_available(start_sliding_failures(spark, src, out, glob="*.txt", trigger={"availableNow": True}, service=None,
                                         max_files_per_trigger=files_per_trigger(spark, sf_dir), window_seconds=21600))
    return sliding_state_result(read_state(spark, out, 1 << 62, SLIDING_STATE), 21600, service=None)


def _stopped_halfway(start) -> None:
    """Run a stream until its first micro-batches are through, stop it, and finish it from its checkpoint."""
    import time

    q = start({"processingTime": "0 seconds"})
    while q.isActive and not any(p.numInputRows for p in q.recentProgress):
        time.sleep(0.05)
    q.stop()
    if q.exception() is not None:
        raise q.exception()
    run_available(start({"availableNow": True}))


@register("stream_windowed_restart", ORACLE["windowed_success_rate"])
def q_stream_windowed_restart(spark, sf_dir):
    """The windowed stream, stopped halfway and continued from its checkpoint."""
    src, out, files = staged_stream_files(spark, sf_dir), scratch_path(spark, "stream-restart-out"), files_per_trigger(spark, sf_dir)
    _stopped_halfway(lambda trigger: start_windowed_success_rate(
        spark, src, out, glob="*.txt", output_mode="complete", trigger=trigger, max_files_per_trigger=files,
        window_duration="10 seconds", slide_duration="10 seconds"))
    return last_epoch(spark, out).select("window_start", "window_end", "service", "total", "successes", "success_rate")


@register("stream_sliding_restart", ORACLE["stream_sliding_failures_6h"])
def q_stream_sliding_restart(spark, sf_dir):
    """The sliding stream, stopped halfway and continued from its checkpoint."""
    src, out, files = staged_stream_files(spark, sf_dir), scratch_path(spark, "stream-restart-out"), files_per_trigger(spark, sf_dir)
    _stopped_halfway(lambda trigger: start_sliding_failures(
        spark, src, out, glob="*.txt", trigger=trigger, max_files_per_trigger=files, window_seconds=21600))
    return sliding_state_result(read_state(spark, out, 1 << 62, SLIDING_STATE), 21600)


@register("runs_by_manifest", O.with_view("""
SELECT batch_id, count(*) AS events, CAST(CASE WHEN batch_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS run FROM v GROUP BY batch_id""", dirty=True))
def q_runs_by_manifest(spark, sf_dir):
    """Three batch runs over a folder that grows after the first: the second reads only the new files,
    the third finds none."""
    v = load_log_view(spark, sf_dir, dirty=True)
    src, manifest, out = (scratch_path(spark, f"runs-{x}") for x in ("src", "manifest", "out"))

    def per_file(events):
        return events.groupBy("file_path").agg(F.count("*").alias("events"))

    for wave in (F.col("batch_id") % 3 != 0, F.col("batch_id") % 3 == 0, F.lit(False)):
        _write_wave(v, src, wave, write_tasks(spark, sf_dir, 3))
        run_new_files(spark, src, manifest, out, per_file, glob="*.txt")
    return read_runs(spark, manifest, out).select(_file_batch(), "events", "run")
