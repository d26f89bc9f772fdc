"""Operator registry, JSON options, CLI, materialisation location."""

import json
import os

import pytest

from loglens.plans.materialize import materialize
from loglens.registry import load_options, run
from loglens.session import checkpoint_root
from loglens.sources.files import file_batches, read_logs

from .conftest import ev, events_df, write_json


def test_run_ignores_unknown_options(spark, tmp_path):
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"reservoir_size": 20, "filter_file": "x", "unused": 1}))
    df = events_df(spark, [[ev(t=i, code=200) for i in range(80)] + [ev(t=99, code=500)] * 20])
    assert run("reservoir_mode", df, **load_options(str(cfg))).first().value == 200.0
    assert run("service_success_summary", df, window_duration="10s", watermark="1s").count() == 1
    with pytest.raises(ValueError):
        run("no_such_operator", df)


def test_materialize_under_checkpoint_dir(spark):
    df = spark.range(10)
    m = materialize(df, "t")
    assert m.count() == 10
    root = checkpoint_root(spark).removeprefix("file:")
    assert any(root in f.removeprefix("file:") for f in m.inputFiles())


def test_file_batches_by_mtime(spark, tmp_path):
    d = str(tmp_path / "logs")
    for i, name in enumerate(["c.json", "a.json", "b.json"]):
        write_json(d, name, [ev(t=i, code=200)])
        os.utime(os.path.join(d, name), (1_700_000_000 + i, 1_700_000_000 + i))
    got = file_batches(read_logs(spark, d)).select("file_name", "batch_id").collect()
    order = [r.file_name for r in sorted(got, key=lambda r: r.batch_id)]
    assert order == ["c.json", "a.json", "b.json"]
    by_name = file_batches(read_logs(spark, d), order=("file_path",)).collect()
    assert [r.file_name for r in sorted(by_name, key=lambda r: r.batch_id)] == ["a.json", "b.json", "c.json"]


def test_cli(spark, tmp_path, capsys):
    from loglens.__main__ import main

    d = str(tmp_path / "logs")
    write_json(d, "b1.json", [ev(t=48, code=200), ev(t=96, code=500)])
    main(["--source", d, "--task", "running_success_rate_target"])
    out = capsys.readouterr().out
    assert "0.5" in out


def test_cli_hands_out_every_result(spark, tmp_path, capsys):
    from loglens.__main__ import main

    d, out = str(tmp_path / "logs"), str(tmp_path / "out")
    for i in range(40):
        write_json(d, f"b{i:02d}.json", [ev(t=i + 1, code=200 if i % 2 else 500)])
    main(["--source", d, "--order", "name", "--out", out])
    assert spark.read.csv(out, header=True).count() == 40
    capsys.readouterr()
    main(["--source", d, "--order", "name"])
    lines = capsys.readouterr().out.strip().splitlines()
    ids = [int(x.split("\t")[0]) for x in lines[1:]]
    assert ids == list(range(40))


def test_number_files_from_metadata(spark, tmp_path):
    from loglens.operators.running import running_success_rate_target
    from loglens.sources.files import number_files

    d = str(tmp_path / "logs")
    for i, name in enumerate(["c.json", "a.json", "b.json"]):
        write_json(d, name, [ev(t=i + 1, code=200 if i else 500)])
    numbers = number_files(spark, d, order=("file_path",))
    assert [(r.file_name, r.batch_id) for r in numbers.orderBy("batch_id").collect()] == [("a.json", 0), ("b.json", 1), ("c.json", 2)]
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "content" not in plan
    logs = read_logs(spark, d)
    want = running_success_rate_target(file_batches(logs, numbers=numbers)).orderBy("batch_id").collect()
    assert running_success_rate_target(logs, numbers=numbers).orderBy("batch_id").collect() == want


def test_clean_scratch(spark):
    from loglens.session import clean_scratch

    path = materialize(spark.range(3), "to-clean").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    clean_scratch(spark, "mat-to-clean")
    assert not os.path.exists(path)


def test_checkpoint_root_when_cluster_names_none(tmp_path):
    """No spark.checkpoint.dir anywhere: a local folder is registered, nothing raises."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from loglens.plans.materialize import materialize\n"
        "from loglens.session import checkpoint_root\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "r = checkpoint_root(s)\n"
        "assert materialize(s.range(3)).count() == 3\n"
        "print('ROOT', r)\n" % root)
    empty = tmp_path / "conf"
    empty.mkdir()
    env = dict(os.environ, SPARK_CONF_DIR=str(empty))
    out = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROOT " in out.stdout


def test_cli_bloom_with_config(spark, tmp_path, capsys):
    from loglens.__main__ import main

    d = str(tmp_path / "logs")
    write_json(d, "b1.json", [ev(service="s", t=0, code=200), ev(service="s", t=0, code=500)])
    patterns = tmp_path / "known.txt"
    patterns.write_text("HTTP Status Code: 500\nSomething else\n")
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"filter_file": str(patterns), "m_bits": 8192, "k_hashes": 3}))
    main(["--source", d, "--task", "bloom_hit_ratio", "--config", str(cfg)])
    assert "0.5" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(__import__("loglens.registry", fromlist=["OPERATORS"]).OPERATORS))
def test_every_registered_operator_runs(spark, name, tmp_path):
    from loglens.sources.views import load_log_view

    v = load_log_view(spark, "/root/testdata/sf0.001", dirty=True, late=True)
    opts = {"unknown_option": 1, "window_duration": "1 hour", "slide_duration": "10 minutes"}
    if name.startswith("bloom"):
        patterns = tmp_path / "patterns.txt"
        patterns.write_text("HTTP Status Code: 500\n")
        opts |= {"filter_file": str(patterns), "m_bits": 8192, "k_hashes": 3}
    assert run(name, v, **opts).count() > 0


def test_cli_stream_available_now(spark, tmp_path):
    from loglens.__main__ import main
    from loglens.streaming.state import read_results

    d, out = str(tmp_path / "logs"), str(tmp_path / "out")
    write_json(d, "b1.json", [ev(t=48, code=200), ev(t=96, code=500)])
    main(["--stream", "--available-now", "--source", d, "--out", out, "--task", "running_success_rate_target"])
    assert [r.value for r in read_results(spark, out).collect()] == [0.5]
