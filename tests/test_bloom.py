"""Bloom filter: the reference case, no false negatives, false-positive rate."""

import math

import pytest
from pyspark.sql import functions as F

from loglens.operators import bloom
from loglens.operators.bloom import bloom_build, bloom_contains, bloom_forward, bloom_hit_ratio, exact_forward
from loglens.sources.patterns import patterns_from_lines

from .conftest import ev, events_df


def test_reference_case(spark):
    pats = patterns_from_lines(spark.createDataFrame(
        [("HTTP Status Code: 500",), ("Something else",), ("   ",)], "value string"))
    filt = bloom_build(pats, m_bits=8192, k_hashes=3)
    df = events_df(spark, [[ev(service="s", t=0, code=200), ev(service="s", t=0, code=500)]])
    r = bloom_hit_ratio(df, filt, m_bits=8192, k_hashes=3).first()
    assert abs(r.value - 0.5) < 1e-9
    fwd = bloom_forward(df, filt, m_bits=8192, k_hashes=3).collect()
    assert [x.message for x in fwd] == ["HTTP Status Code: 500"]


def test_batch_without_timestamps_skipped(spark):
    filt = bloom_build(spark.createDataFrame([("x",)], "pattern string"), m_bits=1024, k_hashes=2)
    df = events_df(spark, [[{"service": "a", "message": "x"}], [ev(t=1, message="x")]])
    assert [r.batch_id for r in bloom_hit_ratio(df, filt, m_bits=1024, k_hashes=2).collect()] == [1]


def test_no_false_negatives_and_fp_rate(spark):
    m, k, n = 20000, 4, 2000
    members = spark.range(n).select(F.concat(F.lit("member-"), F.col("id").cast("string")).alias("pattern"))
    filt = bloom_build(members, m_bits=m, k_hashes=k)
    tested = bloom_contains(members, filt, "pattern", "hit", m_bits=m, k_hashes=k)
    assert tested.where(~F.col("hit")).count() == 0
    others = spark.range(20000).select(F.concat(F.lit("other-"), F.col("id").cast("string")).alias("t"))
    fp = bloom_contains(others, filt, "t", "hit", m_bits=m, k_hashes=k).where("hit").count() / 20000
    theory = (1 - math.exp(-k * n / m)) ** k
    assert abs(fp - theory) < 0.02


@pytest.fixture
def without_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_filters_take_one_exchange_of_the_events(spark, monkeypatch, without_broadcasts):
    from loglens.operators.bloom import broadcast_limit, filter_bytes

    assert broadcast_limit(spark) == -1 and filter_bytes(1_000_000) < 1_000_000
    monkeypatch.setattr(bloom, "CONSTANT_WORDS", 0)
    for k in (1, 3, 8):
        filt = bloom_build(spark.createDataFrame([("HTTP Status Code: 500",)], "pattern string"), m_bits=8192, k_hashes=k)
        df = events_df(spark, [[ev(service="s", t=0, code=200), ev(service="s", t=0, code=500), ev(service="s", t=1)]])
        fwd = bloom_forward(df, filt, m_bits=8192, k_hashes=k)
        assert [r.message for r in fwd.collect()] == ["HTTP Status Code: 500"]
        plan = fwd._jdf.queryExecution().executedPlan().toString()
        plan = plan[:plan.find("Initial Plan")] if "Initial Plan" in plan else plan
        assert "Broadcast" not in plan
        # the events with all their columns cross once, whatever k; the rest are digests and words
        crossed = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_bl_d" in x]
        assert sum("ENSURE_REQUIREMENTS" in x for x in crossed) <= 4 and len(
            [x for x in plan.split("\n") if "Exchange hashpartitioning(word" in x]) <= 3
        r = bloom_hit_ratio(df, filt, m_bits=8192, k_hashes=k)
        assert abs(r.first().value - 1 / 3) < 1e-9


def test_all_probes_agree(spark, monkeypatch, without_broadcasts):
    m, k = 512, 3
    filt = bloom_build(spark.range(60).select(F.concat(F.lit("m"), "id").alias("pattern")), m_bits=m, k_hashes=k)
    df = spark.range(400).select(F.when(F.col("id") % 50 != 7, F.concat(F.lit("m"), "id")).alias("t"), "id")
    answers = []
    for words, limit in ((1 << 16, "-1"), (0, "10m"), (0, "-1")):  # constant, broadcast, exchange
        monkeypatch.setattr(bloom, "CONSTANT_WORDS", words)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        answers.append(sorted((r.id, r.hit) for r in bloom_contains(df, filt, "t", "hit", m, k).collect()))
    assert answers[0] == answers[1] == answers[2] and sum(hit for _, hit in answers[0]) > 58
    assert not any(hit for i, hit in answers[0] if i % 50 == 7)


def test_exact_forward(spark):
    df = events_df(spark, [[ev(t=0, code=200), ev(t=1, code=500), ev(t=2, message=None), ev(t=3, code=500)]])
    pats = spark.createDataFrame([("HTTP Status Code: 500",), ("HTTP Status Code: 500",), (None,)], "pattern string")
    assert [r.message for r in exact_forward(df, pats).collect()] == ["HTTP Status Code: 500"] * 2
    plan = exact_forward(df, pats)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_probe_equals_all_bits(spark):
    """Stopping at the first unset bit gives the same answers as testing all k."""
    from loglens.functions import bloom_indices

    pats = spark.createDataFrame([("HTTP Status Code: 500",), ("HTTP Status Code: 404",)], "pattern string")
    filt = bloom_build(pats, m_bits=64, k_hashes=3)
    df = events_df(spark, [[ev(t=i, code=c) for i, c in enumerate([200, 404, 500, 201, 302, 500])] + [ev(t=9)]])
    word = filt.first()["bits"] & (2**64 - 1)
    got = bloom_contains(df, filt, F.coalesce("message", F.lit("")), "hit", 64, 3)
    rows = got.withColumn("bits", F.array(*bloom_indices(F.coalesce("message", F.lit("")), 3, 64))).collect()
    assert [r.hit for r in rows] == [all(word >> b & 1 for b in r.bits) for r in rows]


def test_ratio_probes_messages_not_events(spark):
    """No join on the message and no more shuffled rows than distinct (batch, message)."""
    filt = bloom_build(spark.createDataFrame([("HTTP Status Code: 500",)], "pattern string"), m_bits=8192, k_hashes=3)
    df = events_df(spark, [[ev(t=i, code=200 if i % 9 else 500) for i in range(200)] for _ in range(3)])
    r = bloom_hit_ratio(df, filt, m_bits=8192, k_hashes=3)
    assert [x.hits for x in r.orderBy("batch_id").collect()] == [23, 23, 23]
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "_bl_m" not in "".join(x for x in plan.split("\n") if "Join" in x)
