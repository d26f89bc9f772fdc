"""Streaming forms: equal to the batch forms on the same files."""

import os

from pyspark.sql import functions as F

from loglens.operators.bloom import bloom_build
from loglens.operators.running import running_success_rate_target
from loglens.operators.sliding import sliding_failures
from loglens.operators.windowed import windowed_success_rate
from loglens.sources.files import read_logs
from loglens.streaming.operators import (
    start_bloom_ratio,
    start_reservoir,
    start_running_success_rate,
    start_sliding_failures,
    start_windowed_success_rate,
)
from loglens.streaming.state import last_epoch, read_results

from .conftest import BASE, ev, events_df, write_json


def _feed(spark, q, src, batches, name="b"):
    """Write one file per trigger so micro-batch = file, in order."""
    for i, batch in enumerate(batches):
        write_json(src, f"{name}_{i:03d}.json", batch)
        q.processAllAvailable()


def test_windowed_complete_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batches = [[ev(service=s, t=t, code=c) for s, t, c in
                [("a", 1, 200), ("b", 7, 500), ("a", 13, 404)]],
               [ev(service="a", t=25, code=201), ev(service="b", t=2, code=200)]]
    for i, b in enumerate(batches):
        write_json(src, f"f{i}.json", b)
    q = start_windowed_success_rate(spark, src, out, trigger={"availableNow": True},
                                    checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in last_epoch(spark, out).collect())
    want = sorted(tuple(r) for r in windowed_success_rate(read_logs(spark, src)).collect())
    assert got == want


def test_watermark_late_row_by_mode(spark, tmp_path):
    rows = [[ev(service="s", t=t, code=200)] for t in (100, 500, 101, 600)]
    results = {}
    for mode in ("complete", "update", "append"):
        src, out = str(tmp_path / f"src-{mode}"), str(tmp_path / f"out-{mode}")
        os.makedirs(src)
        q = start_windowed_success_rate(spark, src, out, output_mode=mode,
                                        checkpoint=str(tmp_path / f"ck-{mode}"),
                                        trigger={"processingTime": "100 milliseconds"},
                                        max_files_per_trigger=1)
        try:
            _feed(spark, q, src, rows)
        finally:
            q.stop()
        res = read_results(spark, out)
        start = F.to_timestamp(F.lit("1970-01-01 00:00:00")).cast("timestamp_ntz")
        w100 = res.where(F.col("window_start") == F.timestamp_add(
            "SECOND", F.lit(int(BASE) + 100), start))
        results[mode] = w100.agg(F.max("total")).first()[0]
    assert results["complete"] == 2
    assert results["update"] == 1
    assert results["append"] == 1


def test_running_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    batches = [[ev(t=48, code=200), ev(t=96, code=500)], [ev(t=144, code=200)],
               [ev(service="training", t=150, code=404)]]
    q = start_running_success_rate(spark, src, out, checkpoint=str(tmp_path / "ck"),
                                   trigger={"processingTime": "100 milliseconds"})
    try:
        _feed(spark, q, src, batches)
    finally:
        q.stop()
    got = [r.value for r in read_results(spark, out).orderBy("epoch").collect()]
    want = [r.value for r in running_success_rate_target(events_df(spark, batches)).orderBy("batch_id").collect()]
    assert got == want


def test_sliding_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    batches = [[ev(t=30, code=200), ev(t=90, code=500)], [ev(t=100, code=503)], [ev(t=50, code=500)],
               [ev(t=155, code=504)], [ev(service="training", t=400, code=200)]]
    q = start_sliding_failures(spark, src, out, checkpoint=str(tmp_path / "ck"),
                               trigger={"processingTime": "100 milliseconds"})
    try:
        _feed(spark, q, src, batches)
    finally:
        q.stop()
    res = read_results(spark, out).orderBy("epoch").collect()
    want = sliding_failures(events_df(spark, batches)).orderBy("batch_id").collect()
    assert [r.value for r in res] == [r.value for r in want] == [1.0, 2.0, 2.0, 0.0]
    assert [r.newest_considered for r in res] == [r.newest_considered for r in want]


def test_reservoir_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    q = start_reservoir(spark, src, out, k=20, checkpoint=str(tmp_path / "ck"),
                        trigger={"processingTime": "100 milliseconds"})
    try:
        _feed(spark, q, src, [[ev(t=i, code=200) for i in range(80)],
                              [ev(t=100 + i, code=500) for i in range(20)]])
    finally:
        q.stop()
    res = read_results(spark, out).orderBy("epoch").collect()
    assert [r.value for r in res] == [200.0, 200.0]
    assert spark.read.parquet(f"{out}/state/v=1").count() == 20


def test_bloom_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    filt = bloom_build(spark.createDataFrame([("HTTP Status Code: 500",)], "pattern string"),
                       m_bits=8192, k_hashes=3)
    q = start_bloom_ratio(spark, src, out, filt, m_bits=8192, k_hashes=3,
                          checkpoint=str(tmp_path / "ck"), trigger={"processingTime": "100 milliseconds"})
    try:
        _feed(spark, q, src, [[ev(service="s", t=0, code=200), ev(service="s", t=0, code=500)]])
    finally:
        q.stop()
    assert [r.value for r in read_results(spark, out).collect()] == [0.5]


def test_reservoir_stream_state_equals_batch_bottom_k(spark, tmp_path):
    from loglens.operators.sample import reservoir_sample

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    q = start_reservoir(spark, src, out, k=7, seed=3, checkpoint=str(tmp_path / "ck"),
                        trigger={"processingTime": "100 milliseconds"})
    batches = [[ev(t=i * 10 + j, code=200 + j) for j in range(9)] for i in range(4)]
    try:
        _feed(spark, q, src, batches)
    finally:
        q.stop()
    state = {(r.file_path, r.pos) for r in spark.read.parquet(f"{out}/state/v=3").collect()}
    logs = read_logs(spark, src).withColumn(
        "event_id", F.concat_ws(":", "file_path", F.col("pos").cast("string"))).withColumn("batch_id", F.lit(0))
    want = {tuple(r.event_id.rsplit(":", 1)) for r in reservoir_sample(logs, k=7, seed=3).collect()}
    assert {(p, str(n)) for p, n in state} == want


def test_stop_after_drain(spark, tmp_path):
    from loglens.streaming import stop_after_drain

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    q = start_running_success_rate(spark, src, out, checkpoint=str(tmp_path / "ck"),
                                   trigger={"processingTime": "10 seconds"})
    write_json(src, "a.json", [ev(t=1, code=200), ev(t=2, code=500)])
    stop_after_drain(q)
    assert not q.isActive
    assert [r.value for r in read_results(spark, out).collect()] == [0.5]


def test_quarantine_stream(spark, tmp_path):
    from loglens.streaming.operators import start_quarantine

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write_json(src, "good.json", [ev(t=1, code=200)])
    write_json(src, "bad.json", '[{"service": "x"', raw=True)
    write_json(src, "lines.json", '{"service": "a"}\n{"service": "b"}', raw=True)
    q = start_quarantine(spark, src, out, checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.file_name for r in spark.read.parquet(out).collect()) == ["bad.json", "lines.json"]


def test_multiline_stream_source(spark, tmp_path):
    from loglens.streaming.source import read_log_stream

    src = str(tmp_path / "src")
    write_json(src, "a.json", [ev(t=i, code=200) for i in range(5)])
    write_json(src, "b.json", '[\n {"service": "x", "timestamp": 9.0}\n]', raw=True)
    stream = read_log_stream(spark, src, parser="multiline")
    q = (stream.writeStream.format("memory").queryName("ml_stream").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.file_name, r.pos) for r in spark.sql("select * from ml_stream").collect())
    assert got == [("a.json", i) for i in range(5)] + [("b.json", 0)]


def test_state_versions_read_and_retention(spark, tmp_path):
    from pyspark.sql import types as T

    from loglens.streaming.state import read_state, write_state

    root = str(tmp_path / "st")
    schema = T.StructType([T.StructField("x", T.LongType())])
    assert read_state(spark, root, 0, schema).count() == 0
    for e in (0, 3, 4, 9):  # epochs 1, 2, 5-8 were empty
        write_state(spark.createDataFrame([(e,)], schema), root, e, retain=4)
    assert [r.x for r in read_state(spark, root, 9, schema).collect()] == [4]
    assert [r.x for r in read_state(spark, root, 10, schema).collect()] == [9]
    # v=4 stays: it is the predecessor a replay of epoch 9 reads
    assert sorted(d for d in os.listdir(os.path.join(root, "state")) if d.startswith("v=")) == ["v=4", "v=9"]


def test_incomplete_rows_do_not_move_the_watermark(spark, tmp_path):
    """A coded row at 100 s, an uncoded one at 500 s, a coded one at 101 s: both coded rows count."""
    rows = [[ev(service="s", t=100, code=200)], [ev(service="s", t=500, message="no code")], [ev(service="s", t=101, code=200)]]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    q = start_windowed_success_rate(spark, src, out, output_mode="update", trigger={"processingTime": "100 milliseconds"},
                                    max_files_per_trigger=1)
    try:
        _feed(spark, q, src, rows)
    finally:
        q.stop()
    assert read_results(spark, out).agg(F.max("total")).first()[0] == 2


def test_restart_continues_and_equals_one_run(spark, tmp_path):
    from loglens.streaming.operators import SLIDING_STATE, sliding_state_result
    from loglens.streaming.state import read_state

    batches = [[ev(t=10, code=200), ev(t=20, code=500)], [ev(t=40, code=404)], [ev(t=75, code=200), ev(t=70, code=500)]]
    starts = {"window": start_windowed_success_rate, "running": start_running_success_rate,
              "sliding": start_sliding_failures, "sample": start_reservoir}
    for name, start in starts.items():
        src, out, one = (str(tmp_path / f"{name}-{x}") for x in ("src", "out", "one"))
        for i, b in enumerate(batches):
            write_json(src, f"b{i}.json", b)
            q = start(spark, src, out, trigger={"availableNow": True})
            q.awaitTermination()
        q = start(spark, src, one, trigger={"availableNow": True}, max_files_per_trigger=None)
        q.awaitTermination()
        if name == "sliding":
            a, b = (sliding_state_result(read_state(spark, x, 1 << 62, SLIDING_STATE), 60).collect() for x in (out, one))
        else:
            a, b = (sorted(map(tuple, last_epoch(spark, x).collect())) for x in (out, one))
        assert a == b, name


def test_results_without_their_checkpoint_are_refused(spark, tmp_path):
    import pytest

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write_json(src, "a.json", [ev(t=1, code=200)])
    start_running_success_rate(spark, src, out, checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True}).awaitTermination()
    with pytest.raises(FileExistsError):
        start_running_success_rate(spark, src, out, trigger={"availableNow": True})


def test_sliding_rate_stream_and_result_log(spark, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    os.makedirs(src)
    q = start_sliding_failures(spark, src, out, rate=True, log=log, trigger={"processingTime": "100 milliseconds"})
    try:
        _feed(spark, q, src, [[ev(t=10, code=200), ev(t=20, code=500)], [ev(t=75, code=404)]])
    finally:
        q.stop()
    assert [r.value for r in read_results(spark, out).orderBy("epoch").collect()] == [0.5, 1.0]
    assert sorted(r.value.split(",")[1] for r in spark.read.text(log).collect()) == ["0.5000", "1.0000"]


def test_per_service_rates(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write_json(src, "a.json", [ev(t=1, code=200), ev(t=2, code=500), ev(service="training", t=3, code=201)])
    start_running_success_rate(spark, src, out, trigger={"availableNow": True}).awaitTermination()
    got = {r.service: r.value for r in last_epoch(spark, out, "per_service").collect()}
    assert got == {"monitoring": 0.5, "training": 1.0}


def test_backlog_makes_a_bounded_number_of_micro_batches(spark, monkeypatch):
    from loglens import catalog

    for files, batches in ((10, 4), (1000, 4), (2000, 8), (60_000, 8), (360_000, 8)):
        monkeypatch.setattr(catalog, "n_files", lambda *_, n=files: n)
        per_trigger = catalog.files_per_trigger(spark, "")
        assert -(-files // per_trigger) <= batches
        assert 1 <= catalog.write_tasks(spark, "") <= max(files, 1)


def test_state_has_few_partitions_and_the_session_keeps_its_own(spark, tmp_path):
    from loglens.streaming import run_available
    from loglens.streaming.operators import STATE_TASKS_A_CORE

    write_json(str(tmp_path / "src"), "a.json", [ev(t=1, code=200)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = str(tmp_path / "out")
        run_available(start_running_success_rate(spark, str(tmp_path / "src"), out, trigger={"availableNow": True}))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        state = [d for d in os.listdir(f"{out}/_checkpoint/state/0") if d.isdigit()]
        assert 0 < len(state) <= STATE_TASKS_A_CORE * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- cost of a file ----------------------------------------------------------


def _streamed(spark, df, tmp_path):
    """The rows of a stream, run to its end."""
    out = str(tmp_path / "rows")
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "rows-ck")).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_stream_reads_plain_files_by_the_binary_reader_with_the_same_rows(spark, tmp_path):
    from loglens.streaming.source import read_raw_stream

    src = tmp_path / "src" / "batch_id=1"
    src.mkdir(parents=True)
    texts = {"plain": b'[{"service": "a"}]\n', "bom": b"\xef\xbb\xbf[]", "broken": b'["\xff\xfe"]', "accents": "[\"é中\"]\r\n".encode(),
             "nul": b"[\x00]"}
    for name, text in texts.items():
        (src / f"{name}.txt").write_bytes(text)
    (src / "none.txt").write_bytes(b"")
    raw = read_raw_stream(spark, str(tmp_path / "src"), glob="*.txt", max_files_per_trigger=2)
    assert "binaryfile" in raw._jdf.queryExecution().analyzed().toString().lower()
    cols = [F.encode("value", "utf-8").alias("bytes"), "file_path", "file_name", "file_modified"]
    got = _streamed(spark, raw, tmp_path)
    want = spark.read.text(str(tmp_path / "src"), wholetext=True, recursiveFileLookup=True).select(
        "value", *[F.col(f"_metadata.{m}").alias(c) for c, m in
                   (("file_path", "file_path"), ("file_name", "file_name"), ("file_modified", "file_modification_time"))])
    assert got.schema["value"].dataType == want.schema["value"].dataType
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert got.count() == len(texts)


def test_stream_still_unpacks_compressed_files(spark, tmp_path):
    import gzip

    from loglens.streaming.source import read_log_stream

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json.gz").write_bytes(gzip.compress(b'[{"service": "zipped"}]'))
    for i, glob in enumerate(("*.gz", "*", None, "*.{json,gz}")):
        (tmp_path / str(i)).mkdir()
        events = read_log_stream(spark, str(src), glob=glob)
        assert [r.service for r in _streamed(spark, events, tmp_path / str(i)).collect()] == ["zipped"]


def test_sliding_state_starts_no_python(spark, tmp_path):
    """The state's first version and its row of the run are made by Spark alone."""
    from loglens.streaming.operators import SLIDING_STATE, sliding_state_result, sliding_step
    from loglens.streaming.state import read_state

    out = str(tmp_path / "out")
    empty = read_state(spark, out, 0, SLIDING_STATE)
    assert empty.schema == SLIDING_STATE and empty.count() == 0
    assert "RDD" not in empty._jdf.queryExecution().executedPlan().toString()
    for epoch, events in enumerate(([ev(t=0.1, code=500), ev(t=50, code=200)], [ev(t=60.0001, code=500)])):
        assert sliding_step(spark, out, epoch, events_df(spark, [events]), 60)
    whole = read_state(spark, out, 2, SLIDING_STATE).where("service is null").first()
    assert (whole.newest, [tuple(x) for x in whole.live]) == (BASE + 60.0001, [(0, BASE + 0.1, BASE + 50), (1, BASE + 60.0001, BASE + 60.0001)])
    assert sliding_state_result(read_state(spark, out, 2, SLIDING_STATE), 60).first().value == 2.0
