"""Trailing 60 s failure count anchored on the newest event."""

import random

import pytest

from loglens.operators.sliding import sliding_failure_rate, sliding_failures

from .conftest import BASE, ev, events_df


def values(df):
    return [(r.batch_id, r.value) for r in df.orderBy("batch_id").collect()]


def test_reference_case(spark):
    df = events_df(spark, [[ev(t=30, code=200), ev(t=90, code=500)], [ev(t=100, code=503)],
                           [ev(t=155, code=504)]])
    rows = sliding_failures(df).orderBy("batch_id").collect()
    assert [r.value for r in rows] == [1.0, 2.0, 2.0]
    for r in rows:
        assert (r.newest_considered - r.oldest_considered).total_seconds() == 60


def test_edge_no_advance_late_and_other_service(spark):
    df = events_df(spark, [
        [ev(t=100, code=500)],
        [ev(t=40, code=500)],                       # exactly newest - 60: counted, but no advance
        [ev(t=101, code=200)],                      # advance: 100 and 40 in [41, 101]? 40 < 41 -> out
        [ev(t=90, code=404), ev(t=160, code=200)],  # window [100, 160]: 100 in, late 90 out
        [ev(service="training", t=300, code=200)],  # other service moves newest: count 0
    ])
    assert values(sliding_failures(df)) == [(0, 1.0), (2, 1.0), (3, 1.0), (4, 0.0)]
    edge = events_df(spark, [[ev(t=100, code=500)], [ev(t=40, code=500), ev(t=101, code=200)]])
    assert values(sliding_failures(edge)) == [(0, 1.0), (1, 1.0)]
    edge2 = events_df(spark, [[ev(t=100, code=500)], [ev(t=41, code=500), ev(t=101, code=200)]])
    assert values(sliding_failures(edge2)) == [(0, 1.0), (1, 2.0)]


def test_missing_service_not_counted_missing_message_fails(spark):
    df = events_df(spark, [[ev(service=None, t=10, code=500), {"service": "monitoring", "timestamp": BASE + 20}]])
    assert values(sliding_failures(df)) == [(0, 1.0)]


def brute(batches, window, service="monitoring"):
    newest = 0.0
    fails = []
    out = []
    for b, batch in enumerate(batches):
        advanced = False
        for e in batch:
            t = e.get("timestamp", 0.0)
            if t > newest:
                newest, advanced = t, True
            if e.get("service") and "HTTP Status Code: 200" not in e.get("message", ""):
                fails.append((e["service"], t))
        if advanced and newest > 0:
            fails = [(s, t) for s, t in fails if t >= newest - window]
            out.append((b, float(sum(1 for s, _ in fails if s == service))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_bruteforce(spark, seed):
    rnd = random.Random(seed)
    batches = []
    clock = 0
    for _ in range(60):
        clock += rnd.randint(-20, 40)
        batches.append([ev(service=rnd.choice(["monitoring", "training", None]),
                           t=clock + rnd.randint(-90, 5), code=rnd.choice([200, 500, 404]))
                        for _ in range(rnd.randint(1, 5))])
    df = events_df(spark, batches)
    assert values(sliding_failures(df, window_seconds=60)) == [(b, v) for b, v in brute(batches, 60)]


def test_rate(spark):
    df = events_df(spark, [[ev(t=10, code=200), ev(t=20, code=404), ev(t=30, code=302),
                            ev(t=40, code=500)]])
    assert values(sliding_failure_rate(df)) == [(0, 0.5)]


def test_hot_batch_and_shared_timestamp_match_bruteforce(spark):
    """One batch holds most events, many sharing one timestamp."""
    rnd = random.Random(11)
    hot = [ev(service=rnd.choice(["monitoring", "training"]), t=500, code=rnd.choice([200, 500]))
           for _ in range(300)]
    batches = [[ev(t=rnd.randint(400, 600), code=rnd.choice([200, 404]))] for _ in range(20)]
    batches[7] = batches[7] + hot
    df = events_df(spark, batches)
    for w in (60, 3600):
        assert values(sliding_failures(df, window_seconds=w)) == [(b, v) for b, v in brute(batches, w)]
