"""Scalar functions: status flavours, outcome definitions, times, Bloom indices."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from loglens import functions as L
from loglens.operators.parse import outcome_flags


def _one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(col.alias("r")).first()["r"]


def test_strict_vs_regex(spark):
    m = "HTTP Status Code:404"
    assert _one(spark, L.status_strict("x"), m) is None
    assert _one(spark, L.status_regex("x"), m) == 404
    assert _one(spark, L.status_strict("x"), "HTTP Status Code: 503 extra") == "503"
    assert _one(spark, L.status_strict("x"), "HTTP Status Code:    ") is None
    assert _one(spark, L.status_regex("x"), "no code") is None
    assert _one(spark, L.status_last_segment("x"), "a: b: c") == "c"
    assert _one(spark, L.status_last_segment("x"), "plain") == "plain"


def test_success_definitions(spark):
    rows = spark.createDataFrame([(c,) for c in ("201", "302", "404")], "c string").select(
        F.concat(F.lit("HTTP Status Code: "), "c").alias("message"))
    got = {r["message"][-3:]: r for r in outcome_flags(rows).collect()}
    assert [got[c]["success_2xx"] for c in ("201", "302", "404")] == [True, False, False]
    assert [got[c]["success_below_400"] for c in ("201", "302", "404")] == [1, 1, 0]
    assert [got[c]["failure_not_200"] for c in ("201", "302", "404")] == [True, True, True]
    assert [got[c]["error_4xx_5xx"] for c in ("201", "302", "404")] == [False, False, True]


def test_times(spark):
    t = 1760559686.31526
    assert _one(spark, L.epoch_to_timestamp("x"), t, "double") == dt.datetime(2025, 10, 15, 20, 21, 26, 315260)
    assert _one(spark, L.epoch_to_timestamp_seconds("x"), t, "double") == dt.datetime(2025, 10, 15, 20, 21, 26)


def test_bloom_index_vectors(spark):
    expected = {
        "HTTP Status Code: 203": [1153, 2966, 5689],
        "ñandú": [2820, 509, 4265],
        "": [5842, 5245, 1735],
    }
    df = spark.createDataFrame([(k,) for k in expected], "s string")
    got = df.select("s", F.array(*L.bloom_indices("s", 3, 8192)).alias("i")).collect()
    for r in got:
        assert r["i"] == expected[r["s"]]
        py = [int.from_bytes(hashlib.sha256(i.to_bytes(2, "big") + r["s"].encode()).digest()[:4], "big") % 8192
              for i in range(3)]
        assert py == r["i"]


def test_format_value_matches_python(spark):
    vals = [0.43125, 2 / 3, 1234.56785, 0.0, 1e-5, 12345.6789]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(L.format_value("v")).collect()]
    assert got == [f"{v:.4f}" for v in vals]


def _strict_spec(message):
    """Plain statement of the strict rule: text after the first tag, first token."""
    tag = "HTTP Status Code: "
    if tag not in message:
        return None
    rest = message.split(tag, 1)[1]
    tokens = rest.split()
    return tokens[0] if tokens else None


def test_strict_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    parts = st.sampled_from(["HTTP Status Code: ", "HTTP Status Code:", " ", "\t", "\n", " ",
                             " ", "200", "5xx", "abc", ":", "é"])
    messages = st.lists(parts, max_size=8).map("".join)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(messages, min_size=1, max_size=30))
    def check(batch):
        df = spark.createDataFrame([(m,) for m in batch], "m string")
        got = [r[0] for r in df.select(L.status_strict("m")).collect()]
        assert got == [_strict_spec(m) for m in batch]

    check()


def test_format_timestamp_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1710037800.5,), (1704067207.0,)], "t double")  # 02:30:00.5 is a NY gap
        got = [tuple(r) for r in df.select(L.format_timestamp(L.epoch_to_timestamp("t")),
                                           L.format_timestamp(L.epoch_to_timestamp("t"), with_micros=False)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [("2024-03-10 02:30:00.500000", "2024-03-10 02:30:00"), ("2024-01-01 00:00:07", "2024-01-01 00:00:07")]


def test_regex_and_last_segment_property(spark):
    import re

    from hypothesis import given, settings
    from hypothesis import strategies as st

    rx = re.compile(r"HTTP Status Code:\s*(\d+)", re.ASCII)

    def regex_spec(m):
        hit = rx.search(m)
        if not hit:
            return None
        v = int(hit.group(1))
        return v if v < 2 ** 31 else None

    parts = st.sampled_from(["HTTP Status Code:", "HTTP Status Code: ", " ", "\t", "404", "5",
                             "99999999999", "x", ": ", ":"])
    messages = st.lists(parts, max_size=7).map("".join)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(messages, min_size=1, max_size=30))
    def check(batch):
        df = spark.createDataFrame([(m,) for m in batch], "m string")
        got = [tuple(r) for r in df.select(L.status_regex("m"), L.status_last_segment("m")).collect()]
        assert got == [(regex_spec(m), m.split(": ")[-1]) for m in batch]

    check()
