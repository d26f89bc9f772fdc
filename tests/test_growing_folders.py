"""Streams and batch runs over folders that grow: replays, name order, signals, manifests."""

import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from loglens.operators.running import running_success_rate_target
from loglens.operators.sliding import sliding_failure_rate, sliding_failures
from loglens.session import SMALL_FILES_CONF, small_files
from loglens.sinks import read_results_log, write_log_epoch
from loglens.sources import manifest as sources_manifest
from loglens.sources.files import file_batches, number_files, read_logs
from loglens.sources.manifest import committed_runs, processed_files, read_runs, run_new_files
from loglens.streaming import run_until_signal
from loglens.streaming.operators import (
    SLIDING_STATE,
    late_account,
    sliding_state_result,
    sliding_step,
    start_running_by_file,
    start_sliding_failures,
    start_windowed_success_rate,
)
from loglens.streaming.state import read_results, read_state

from .conftest import ROOT, ev, events_df, write_json


def _now(q):
    q.awaitTermination()
    return q


def test_running_by_file_in_name_order_over_polls(spark, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    polls = [{"c": [ev(t=9, code=200), ev(service=None, t=40, code=500)], "a": [ev(t=3, code=404)], "b": []},
             {"aa": [ev(t=90, code=201)], "bad": None, "d": [ev(service="training", t=1, code=200)]}]
    for files in polls:
        for name, rows in files.items():  # written out of name order
            write_json(src, f"{name}.json", rows if rows is not None else "[{", raw=rows is None)
            os.utime(os.path.join(src, f"{name}.json"), (1_700_000_000 - len(name) * 100, 1_700_000_000 - ord(name[0])))
        _now(start_running_by_file(spark, src, out, log=log, trigger={"availableNow": True}))
    got = read_results(spark, out).orderBy("batch_id").collect()
    order = ["a", "b", "c", "aa", "bad", "d"]
    assert [(r.batch_id, os.path.basename(r.file_path)) for r in got] == [(i, f"{n}.json") for i, n in enumerate(order) if n not in ("b", "bad")]
    batches = [rows or [] for n in order for files in polls for m, rows in files.items() if m == n]
    want = {r.batch_id: r for r in running_success_rate_target(events_df(spark, batches)).collect()}
    for r in got:
        w = want[r.batch_id]
        assert (r.successes, r.total, r.value, r.newest_considered, r.oldest_considered) == tuple(w)[1:]
    assert [r.value_text for r in read_results_log(spark, log).collect()].count("0.5000") == 1


def test_replayed_epoch_is_logged_once(spark, tmp_path):
    """The commit of the last micro-batch is lost: Spark runs it again."""
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    for i, batch in enumerate([[ev(t=10, code=200), ev(t=20, code=500)], [ev(t=75, code=404)]]):
        write_json(src, f"b{i}.json", batch)
        _now(start_sliding_failures(spark, src, out, rate=True, log=log, trigger={"availableNow": True}))
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(out, "_checkpoint", "commits", name))
    before = os.path.getmtime(os.path.join(log, "epoch=1"))
    _now(start_sliding_failures(spark, src, out, rate=True, log=log, trigger={"availableNow": True}))
    assert os.path.getmtime(os.path.join(log, "epoch=1")) > before  # it did run again
    lines = read_results_log(spark, log).collect()
    assert [(r.epoch, r.value_text) for r in lines] == [(0, "0.5000"), (1, "1.0000")]
    assert [r.value for r in read_results(spark, out).orderBy("epoch").collect()] == [0.5, 1.0]
    assert all(r.processed_at and r.newest_text.startswith("20") and r.oldest_text for r in lines)
    write_log_epoch(read_results(spark, out).where("epoch = 0"), log, 12)
    assert [r.epoch for r in read_results_log(spark, log).collect()] == [0, 1, 12]


def _batches():
    return [[ev(t=30, code=200), ev(t=90, code=500), ev(service="training", t=95, code=404)],
            [ev(t=100, code=503), ev(service=None, t=101, code=500), ev(service="b")],
            [ev(t=50, code=500), ev(t=99, code=200)], [ev(t=155, code=504), ev(service="training", t=120, message="x")],
            [ev(service="training", t=400, code=200)], [ev(t=345, code=500), ev(t=339, code=500)], [ev(service="b", t=1000, code=201)]]


@pytest.mark.parametrize("window", [60, 250])
def test_sliding_stream_for_every_service_equals_batch(spark, tmp_path, window):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batches = _batches()
    df = events_df(spark, batches)
    for i, batch in enumerate(batches):
        write_json(src, f"b{i}.json", batch)
        _now(start_sliding_failures(spark, src, out, service=None, window_seconds=window, trigger={"availableNow": True}))
    got = {(r.epoch, r.service): r for r in read_results(spark, out).collect()}
    seen = {"monitoring": 0, "training": 0, "b": 1}
    for service, first in seen.items():
        for r in sliding_failures(df, window_seconds=window, service=service).collect():
            if r.batch_id >= first:
                g = got.pop((r.batch_id, service))
                assert (g.value, g.newest_considered, g.oldest_considered) == (r.value, r.newest_considered, r.oldest_considered)
    assert not got
    state = read_state(spark, out, 1 << 62, SLIDING_STATE)
    rates = {r.service: r.value for r in sliding_state_result(state, window, rate=True, service=None).collect()}
    for service in seen:
        want = [r.value for r in sliding_failure_rate(df, window_seconds=window, service=service).orderBy("batch_id").collect()]
        assert rates[service] == want[-1]


def test_sliding_state_follows_the_events_that_enter_and_leave(spark, tmp_path):
    """A step reads only earlier micro-batches with times between the old edge and the new one, and a step done
    again leaves the same state."""
    out = str(tmp_path / "out")
    for e in range(12):
        sliding_step(spark, out, e, events_df(spark, [[ev(t=100 * e + i, code=500) for i in range(40)]]), 450)
    for e in (2, 3, 4, 5, 6):  # far inside the window: no step may need them
        for f in os.listdir(os.path.join(out, "events", f"epoch={e}")):
            os.remove(os.path.join(out, "events", f"epoch={e}", f))
    step = events_df(spark, [[ev(t=1200 + i, code=500) for i in range(40)]])
    for _ in range(2):
        assert sliding_step(spark, out, 12, step, 450)
        state = read_state(spark, out, 13, SLIDING_STATE)
        want = sum(1239 - 450 <= 100 * e + i for e in range(13) for i in range(40))
        assert [r.failures for r in state.where("service = 'monitoring'").collect()] == [want]
        assert len(state.where("service is null").first()["live"]) <= 6


def test_late_rows_are_accounted_for(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i, t in enumerate((100, 500, 101, 600)):
        write_json(src, f"b{i}.json", [ev(service="s", t=t, code=200), ev(service="s", t=t, message="uncoded")])
        os.utime(os.path.join(src, f"b{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    q = _now(start_windowed_success_rate(spark, src, out, output_mode="update", trigger={"availableNow": True}, max_files_per_trigger=1))
    rows = [(r.epoch, r.seen, r.kept, r.dropped) for r in late_account(q, out).orderBy("epoch").collect()]
    assert rows == [(0, 1, 1, 0), (1, 1, 1, 0), (2, 1, 1, 0), (3, 1, 1, 0)] or rows == [(0, 1, 1, 0), (1, 1, 1, 0), (2, 1, 0, 1), (3, 1, 1, 0)]
    assert sum(r[1] for r in rows) == sum(r[2] + r[3] for r in rows) == 4


def test_runs_take_each_file_once(spark, tmp_path):
    src, manifest, out = (str(tmp_path / x) for x in ("src", "manifest", "out"))
    per_file = lambda events: events.groupBy("file_name").agg(F.count("*").alias("n"))
    os.makedirs(src)
    assert run_new_files(spark, src, manifest, out, per_file) is None
    write_json(src, "a.json", [ev(t=1, code=200)] * 3)
    write_json(src, "empty.json", [])
    assert run_new_files(spark, src, manifest, out, per_file) == 0
    assert run_new_files(spark, src, manifest, out, per_file) is None

    write_json(src, "b.json", [ev(t=2, code=200)] * 2)

    def broken(events):
        raise RuntimeError("no result")

    with pytest.raises(RuntimeError):
        run_new_files(spark, src, manifest, out, broken)
    write_json(src, "c.json", [ev(t=2, code=200)])
    # output without a commit, as a lost driver leaves it
    per_file(read_logs(spark, src)).write.parquet(f"{out}/run=1")
    assert run_new_files(spark, src, manifest, out, per_file, parser="multiline") == 1
    assert sorted(tuple(r) for r in read_runs(spark, manifest, out).select("file_name", "n", "run").collect()) == [
        ("a.json", 3, 0), ("b.json", 2, 1), ("c.json", 1, 1)]
    assert committed_runs(spark, manifest) == [0, 1]
    assert sorted((r.file_name, r.run) for r in processed_files(spark, manifest).collect()) == [
        ("a.json", 0), ("b.json", 1), ("c.json", 1), ("empty.json", 0)]


def _child(src, out, log, *more):
    return subprocess.Popen([sys.executable, "-m", "loglens", "--stream", "--master", "local[2]", "--task", "sliding_failures",
                             "--source", src, "--out", out, "--log", log, *more], cwd=ROOT, start_new_session=True,
                            stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)


def test_sigterm_ends_a_stream_between_micro_batches(spark, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    batches = [[ev(t=30, code=200), ev(t=90, code=500)], [ev(t=100, code=503)], [ev(t=155, code=504)]]
    write_json(src, "b0.json", batches[0])
    child = _child(src, out, log)
    try:
        deadline = time.time() + 120
        while not os.path.exists(os.path.join(out, "results", "epoch=0", "_SUCCESS")) and time.time() < deadline:
            time.sleep(0.2)
        write_json(src, "b1.json", batches[1])  # it may be taken or not when the signal comes
        os.kill(child.pid, signal.SIGTERM)
        assert child.wait(timeout=60) == 0
    finally:
        if child.poll() is None:
            child.kill()
    write_json(src, "b2.json", batches[2])
    _now(start_sliding_failures(spark, src, out, log=log, glob="*.json", max_files_per_trigger=1, trigger={"availableNow": True}))
    want = [r.value for r in sliding_failures(events_df(spark, batches)).orderBy("batch_id").collect()]
    assert [r.value for r in read_results(spark, out).orderBy("epoch").collect()] == want == [1.0, 2.0, 2.0]
    assert [r.value_text for r in read_results_log(spark, log).collect()] == ["1.0000", "2.0000", "2.0000"]


def test_run_until_signal_drains_and_restores_handlers(spark, tmp_path):
    import threading

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    old = signal.getsignal(signal.SIGUSR1)
    q = start_sliding_failures(spark, src, out, trigger={"processingTime": "2 seconds"})
    write_json(src, "a.json", [ev(t=1, code=500)])
    threading.Timer(1.0, os.kill, (os.getpid(), signal.SIGUSR1)).start()
    assert run_until_signal([q], signals=[signal.SIGUSR1], drain=True, poll_s=0.1) == signal.SIGUSR1
    assert not q.isActive and [r.value for r in read_results(spark, out).collect()] == [1.0]
    assert signal.getsignal(signal.SIGUSR1) is old
    q = start_sliding_failures(spark, src, out, trigger={"availableNow": True})
    assert run_until_signal([q], signals=[signal.SIGUSR1]) is None


def test_numbers_of_files_by_name(spark, tmp_path):
    src = str(tmp_path / "src")
    for i, name in enumerate(("c", "a", "b")):
        write_json(src, f"{name}.json", [ev(t=i, code=200)])
    numbers = number_files(spark, src, order=("file_path",))
    rows = file_batches(read_logs(spark, src), numbers=numbers).orderBy("batch_id").collect()
    assert [r.file_name for r in rows] == ["a.json", "b.json", "c.json"]


def test_running_by_file_reads_each_file_twice(spark, tmp_path):
    """Once for its path and once for its events: the ranking's samples don't read files."""
    src = str(tmp_path / "src")
    for i in range(6):
        write_json(src, f"{i}.json", [ev(t=i, code=200)])
    q = _now(start_running_by_file(spark, src, str(tmp_path / "out"), trigger={"availableNow": True}))
    assert sum(p.numInputRows for p in q.recentProgress) == 2 * 6


def test_runs_read_many_new_files_in_parts(spark, tmp_path, monkeypatch):
    """The driver holds a few paths at a time; the operator still gets all events of a run at once."""
    src, manifest, out = (str(tmp_path / x) for x in ("src", "manifest", "out"))
    reads, calls = [], []
    monkeypatch.setattr(sources_manifest, "PATHS_A_READ", 3, raising=False)
    monkeypatch.setattr(sources_manifest, "read_logs", lambda s, paths, **k: reads.append(len(paths)) or read_logs(s, paths, **k))

    def by_service(events):
        calls.append(1)
        return events.groupBy("service").agg(F.count("*").alias("n"), F.countDistinct("file_path").alias("files"), F.max("pos").alias("pos"))

    for i in range(8):
        write_json(src, f"{i}.json", [ev(service="s", t=i, code=200)] * (i + 1) + [ev(service=None, t=i)])
    write_json(src, "empty.json", [])
    assert run_new_files(spark, src, manifest, out, by_service) == 0
    assert reads == [3, 3, 3] and len(calls) == 1
    for parser in ("wholetext", "multiline"):
        for i in range(4):
            write_json(src, f"{parser}{i}.json", [ev(service=parser, t=i, code=200)] * 2)
        assert run_new_files(spark, src, manifest, out, by_service, parser=parser) == len(calls) - 1
    assert run_new_files(spark, src, manifest, out, by_service) is None
    assert reads == [3, 3, 3, 3, 1, 3, 1] and len(calls) == 3
    got = read_runs(spark, manifest, out).select("service", "n", "files", "pos", "run").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("s", 36, 8, 7, 0), (None, 8, 8, 8, 0), ("wholetext", 8, 4, 1, 1), ("multiline", 8, 4, 1, 2)], key=str)
    assert processed_files(spark, manifest).count() == 17


def test_small_files_are_dealt_out_in_few_tasks(spark, tmp_path):
    for i in range(300):
        write_json(str(tmp_path / "src"), f"{i}.json", [ev(t=i, code=200)])
    usual = read_logs(spark, str(tmp_path / "src")).rdd.getNumPartitions()
    with small_files(spark):
        assert all(spark.conf.get(k) == v for k, v in SMALL_FILES_CONF.items())
        few = read_logs(spark, str(tmp_path / "src")).rdd.getNumPartitions()
    assert few <= spark.sparkContext.defaultParallelism + 1 < usual
    own, other = SMALL_FILES_CONF
    assert spark.conf.get(own, None) is None and spark.conf.get(other, None) is None
    spark.conf.set(own, "1m")
    try:
        with small_files(spark):
            assert spark.conf.get(own) == "1m"
        assert spark.conf.get(own) == "1m"
    finally:
        spark.conf.unset(own)
