"""JSON log files: shapes, quarantine, patterns, writer round trip."""

import pytest
from pyspark.sql import functions as F

from loglens.sources.files import (
    quarantine_files,
    read_logs,
    read_raw_files,
    file_batches,
    parse_log_files,
    unprocessed_files,
    write_log_files,
)
from loglens.sources.patterns import read_patterns

from .conftest import ev, events_df, write_json


def test_shapes_and_quarantine(spark, tmp_path):
    d = str(tmp_path / "logs")
    write_json(d, "a.json", [ev(t=1, code=200), ev(t=2, code=500)])
    write_json(d, "b.json", ev(t=3, code=404))                       # bare object: one row
    write_json(d, "c.json", [])                                      # empty: no rows, not bad
    write_json(d, "d.json", '[\n  {"service": "x",\n   "timestamp": 4.0}\n]', raw=True)
    write_json(d, "e.json", '[{"service": "x"', raw=True)            # malformed
    write_json(d, "f.json", '{"service": "a"}\n{"service": "b"}', raw=True)  # JSON lines: malformed
    write_json(d, "g.txt", [ev(t=9, code=200)])                      # not *.json
    logs = read_logs(spark, d)
    per_file = {r.file_name: r["count"] for r in logs.groupBy("file_name").count().collect()}
    assert per_file == {"a.json": 2, "b.json": 1, "d.json": 1}
    bad = sorted(r.file_name for r in quarantine_files(read_raw_files(spark, d)).collect())
    assert bad == ["e.json", "f.json"]
    assert [r.pos for r in logs.where("file_name = 'a.json'").orderBy("pos").collect()] == [0, 1]


def test_require_files(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    (d / "x.txt").write_text("[]")
    with pytest.raises(FileNotFoundError):
        read_logs(spark, str(d), require_files=True)


def test_round_trip_and_batches(spark, tmp_path):
    df = events_df(spark, [[ev(t=i, code=200 + i) for i in range(3)], [ev(service=None, t=5)]])
    out = str(tmp_path / "w")
    write_log_files(df, out)
    back = read_logs(spark, out, glob="*.txt")
    got = sorted((r.batch_id, r.pos, r.service, r.timestamp, r.message) for r in back.collect())
    want = sorted((r.batch_id, r.pos, r.service, r.timestamp, r.message) for r in df.collect())
    assert got == want
    numbered = file_batches(back, order=("file_path",))
    assert numbered.select("batch_id").distinct().count() == 2
    listed = read_raw_files(spark, out, glob="*.txt").select("file_path")
    processed = back.where("pos = 2").select("file_path")
    assert unprocessed_files(listed, processed).count() == 1


def test_patterns(spark, tmp_path):
    p = tmp_path / "known.txt"
    p.write_text("  HTTP Status Code: 203 \n\n\t\nSomething else\n")
    assert [r.pattern for r in read_patterns(spark, str(p)).collect()] == [
        "HTTP Status Code: 203", "Something else"]
    with pytest.raises(FileNotFoundError):
        read_patterns(spark, str(tmp_path / "missing.txt"))


def test_multiline_parser_matches_wholetext(spark, tmp_path):
    from loglens.sources.files import quarantine_files_multiline

    d = str(tmp_path / "logs")
    write_json(d, "a.json", [ev(t=i, code=200 + i) for i in range(7)])
    write_json(d, "b.json", ev(t=3, code=404))
    write_json(d, "c.json", [])
    write_json(d, "d.json", '[\n  {"service": "x",\n   "timestamp": 4.0},\n {"message": "m"}\n]', raw=True)
    write_json(d, "e.json", '[{"service": "x"', raw=True)
    cols = ["file_name", "pos", "service", "timestamp", "message"]
    whole = sorted(tuple(r) for r in read_logs(spark, d).select(*cols).collect())
    multi = sorted(tuple(r) for r in read_logs(spark, d, parser="multiline").select(*cols).collect())
    assert whole == multi and len(whole) == 10
    bad = [r.file_name for r in quarantine_files_multiline(spark, d).collect()]
    assert bad == ["e.json"]


ODD = {
    "null among": '[{"service":"x}y","timestamp":1.0,"message":"m"},null, {"service":"z","extra":{"q":[{"a":1}]}}]',
    "json lines": '{"service":"a"}\n{"service":"b"}', "numbers": "[1,2]", "empty": "[]", "bare": '{"service":"s"}',
    "number after": '[{"service":"s"},1]', "one null": "[null]", "null": "null", "blank": "  ", "trailing comma": '[{"service":"s"},]',
    "types": '[{"service":5,"timestamp":"oops"},{"service":"t"}]', "nested": '[[{"service":"s"}]]', "string": '"x"', "no keys": "[{}]",
    "no comma": '[{"service":"s"} {"service":"t"}]', "escapes": '[{"service":"a\\\\"},{"service":"\\"}"}]', "object value": '[{"service":{"a":1}},{"service":"t"}]',
    "inner comma": '[{"service":"s",}]', "single quotes": "[{'service':'s'}]", "white end": '[{"service":"s"}]\n\n  ',
    "nulls": '[null,null,{"service":"s"},null]', "null and more": '[{"service":"s"},null 3]', "unterminated": '[{"service": "x"', "open string": '[{"service": "x}',
    "two arrays": '[{"service":"s"}][{"service":"t"}]', "extra brace": '[{"service":"s"}},{"service":"t"}]', "null first": 'null,[{"service":"s"}]',
    "commas": '[{"service":"s"},,{"service":"t"}]', "lead comma": '[,{"service":"s"}]', "bare and white": ' {"service":"é}"}\n', "null null": "[null null]",
    "bare twice": '{"service":"s"} {"service":"t"}', "bare in array end": '{"service":"s"}]', "comma null": "[,null]", "null comma": "[null,]",
    "lines": '[\n  {"service": "x",\n   "timestamp": 4.0},\n {"message": "m"}\n]',
}


@pytest.mark.parametrize("split", ["128m", "9"])
def test_both_readers_agree_on_odd_files(spark, tmp_path, split):
    """One contract, also where splits of nine bytes cut events, strings and escapes."""
    from loglens.sources.files import quarantine_files_multiline

    d = str(tmp_path / "logs")
    for name, text in ODD.items():
        write_json(d, f"{name.replace(' ', '_')}.json", text, raw=True)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cols = ["file_name", "pos", "service", "timestamp", "message"]
        piece = sorted(map(str, read_logs(spark, d, parser="multiline").select(*cols).collect()))
        bad_piece = sorted(map(tuple, quarantine_files_multiline(spark, d).select("file_name", "value").collect()))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert piece == sorted(map(str, read_logs(spark, d).select(*cols).collect())) and len(piece) == 15
    assert bad_piece == sorted(map(tuple, quarantine_files(read_raw_files(spark, d)).select("file_name", "value").collect()))
    assert {n for n, _ in bad_piece}.isdisjoint(f"{n.replace(' ', '_')}.json" for n in ("null among", "bare", "empty", "nulls", "one null"))
    assert {f"{n}.json" for n in ("json_lines", "numbers", "single_quotes", "unterminated", "blank", "no_comma")} <= {n for n, _ in bad_piece}


def test_pieces_need_no_python_worker(spark, tmp_path):
    d = str(tmp_path / "logs")
    write_json(d, "a.json", [ev(t=1, code=200)])
    plan = read_logs(spark, d, parser="multiline")._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_non_finite_timestamps_are_missing(spark, tmp_path):
    d = str(tmp_path / "logs")
    write_json(d, "a.json", '[{"service": "s", "timestamp": NaN}, {"service": "s", "timestamp": Infinity},'
                            ' {"service": "s", "timestamp": 5.0}]', raw=True)
    for parser in ("wholetext", "multiline"):
        ts = sorted((r.pos, r.timestamp) for r in read_logs(spark, d, parser=parser).collect())
        assert ts == [(0, None), (1, None), (2, 5.0)]


def test_empty_files_reported(spark, tmp_path):
    from loglens.sources.files import empty_files

    d = str(tmp_path / "logs")
    write_json(d, "a.json", [ev(t=1, code=200)])
    write_json(d, "z.json", "", raw=True)
    assert [r.file_name for r in empty_files(spark, d).collect()] == ["z.json"]
    assert quarantine_files(read_raw_files(spark, d)).count() == 0


def test_paths_of_another_file_system(spark, tmp_path):
    """Readers, writers and the manifest take any Hadoop path: here one that only Spark resolves."""
    from pyspark.sql import functions as F

    from loglens.sources.files import number_files
    from loglens.sources.manifest import read_runs, run_new_files

    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.logs.link./store", f"file://{tmp_path}")
    root = "viewfs://logs/store"
    df = events_df(spark, [[ev(t=i, code=200 + i) for i in range(3)], [ev(service=None, t=5)]])
    write_log_files(df, f"{root}/w")
    for parser in ("wholetext", "multiline"):
        back = read_logs(spark, f"{root}/w", glob="*.txt", parser=parser)
        assert sorted((r.pos, r.timestamp) for r in back.collect()) == sorted((r.pos, r.timestamp) for r in df.collect())
        assert all(r.file_path.startswith("viewfs://") for r in back.select("file_path").collect())
    assert sorted(r.batch_id for r in number_files(spark, f"{root}/w", glob="*.txt").collect()) == [0, 1]
    for want in (0, None):
        assert run_new_files(spark, f"{root}/w", f"{root}/m", f"{root}/out", lambda e: e.groupBy("file_path").agg(F.count("*").alias("n")),
                             glob="*.txt") == want
    assert sorted(r.n for r in read_runs(spark, f"{root}/m", f"{root}/out").collect()) == [1, 3]


def test_listing_runs_in_few_tasks(spark, tmp_path):
    from loglens.session import LISTING_TASKS_CONF

    for i in range(40):
        write_json(str(tmp_path / f"batch_id={i}"), "a.json", [ev(code=200)])
    spark.conf.unset(LISTING_TASKS_CONF)
    try:
        assert read_logs(spark, str(tmp_path)).count() == 40
        assert int(spark.conf.get(LISTING_TASKS_CONF)) <= max(32, 4 * spark.sparkContext.defaultParallelism)
        spark.conf.set(LISTING_TASKS_CONF, "7")  # what a session has set stays
        assert read_logs(spark, str(tmp_path)).count() == 40
        assert spark.conf.get(LISTING_TASKS_CONF) == "7"
    finally:
        spark.conf.unset(LISTING_TASKS_CONF)


def test_batch_files_start_no_process_and_equal_sparks(spark, tmp_path):
    """Files that the tasks write themselves: folders and texts of Spark's writer, no permission process a file
    (whose checksum files would show Hadoop's local file system), both modes."""
    import glob
    import os

    import loglens.sources.files as files

    rows = [(b, p, f"{b}:{p} é") for b in ("a", "x y", "x/y=1%", "", None) for p in range(3)] + [("z", 0, None)]
    lines = spark.createDataFrame(rows, "day string, pos bigint, line string")

    def texts(root):
        return sorted((os.path.relpath(os.path.dirname(f), root), open(f, encoding="utf-8", newline="").read())
                      for f in glob.glob(f"{glob.escape(root)}/*/part-*"))

    want, got = str(tmp_path / "spark"), str(tmp_path / "own")
    lines.repartition("day").sortWithinPartitions("day", "pos").select("day", "line").write.partitionBy("day").text(want)
    files.write_batch_files(lines, got, "day", tasks=3)
    by_folder = [{d: sorted("".join(t for e, t in texts(root) if e == d).split("\n")) for d, _ in texts(root)} for root in (want, got)]
    assert by_folder[0] == by_folder[1] and len(by_folder[1]) == 5
    assert not glob.glob(f"{got}/*/.*") and os.path.exists(f"{got}/_SUCCESS")
    files.write_batch_files(lines.where("day = 'a'"), got, "day", mode="append")
    assert [t for d, t in texts(got) if d == "day=a"] == ["a:0 é\na:1 é\na:2 é\n"] * 2
    with pytest.raises(Exception, match="already exists"):
        files.write_batch_files(lines, got, "day")
    files.write_batch_files(lines.limit(0), str(tmp_path / "none"), "day")
    assert os.path.exists(tmp_path / "none" / "_SUCCESS")


def test_a_file_is_parsed_once(spark, tmp_path):
    write_json(str(tmp_path), "a.json", [{"service": "a"}, None])
    write_json(str(tmp_path), "b.json", [])
    events = parse_log_files(read_raw_files(spark, str(tmp_path)))
    assert events._jdf.queryExecution().executedPlan().toString().count("from_json(ArrayType(StructType") == 1
    assert [(r.file_name, r.pos, r.service) for r in events.collect()] == [("a.json", 0, "a")]


def test_files_of_a_task_in_one_folder(spark, tmp_path):
    """The same batches and texts as in a folder a batch, in fewer folders; two writes do not replace each other's files."""
    import os

    from loglens.sources.files import write_log_files

    events = events_df(spark, [[ev(service="a", t=i, code=200), ev(service="b", t=i, code=500)] for i in range(40)])
    events = events.withColumn("batch_id", F.when(F.col("batch_id") != 7, F.col("batch_id")))
    found = []
    for flat in (False, True):
        path = str(tmp_path / f"flat-{flat}")
        for wave in (0, 1):
            write_log_files(events.where(F.coalesce("batch_id", F.lit(0)) % 2 == wave), path, mode="append", tasks=3, folder_a_batch=not flat)
        files = read_raw_files(spark, path, glob="*.txt", recursive=True)
        texts = files.select(F.regexp_extract("file_path", r"/batch_id=([^/.]+)", 1).alias("batch"), "value")
        found.append(sorted(map(tuple, texts.collect())))
        if flat:
            assert len([d for d in os.listdir(path) if not d.startswith(("_", "."))]) <= 6
    assert len(found[0]) == 40 and found[0][-1][0] == "__HIVE_DEFAULT_PARTITION__"
    assert found[0] == found[1]
    assert parse_log_files(files).count() == 80
