"""Bottom-k reservoir: uniformity, mode, size, by-batch merge vs brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglens.operators.sample import reservoir_mode, reservoir_sample, reservoir_sample_by_batch

from .conftest import ev, events_df


def _codes(spark, codes, per_batch=10):
    batches = [[ev(t=i, code=c) for i, c in enumerate(codes[j:j + per_batch])]
               for j in range(0, len(codes), per_batch)]
    return events_df(spark, batches)


def test_majority_and_size(spark):
    df = _codes(spark, [200] * 80 + [500] * 20)
    assert reservoir_mode(df, k=20).first().value == 200.0
    assert reservoir_sample(df, k=5).count() == 5
    assert reservoir_mode(_codes(spark, [200] * 100), k=5).first().value == 200.0


def test_equal_and_many_codes(spark):
    assert reservoir_mode(_codes(spark, [200] * 50 + [500] * 50), k=10).first().value in (200.0, 500.0)
    many = _codes(spark, [200] * 10 + [500] * 10 + [404] * 10 + [503] * 10)
    assert reservoir_mode(many, k=15).first().value in (200.0, 500.0, 404.0, 503.0)


def test_empty_then_data(spark):
    empty = events_df(spark, [])
    assert reservoir_mode(empty.where(F.lit(False)), k=3).count() == 0
    assert reservoir_mode(_codes(spark, [200] * 5), k=3).first().value == 200.0


def test_uniform_inclusion(spark):
    """Each of n events is kept with probability k/n (over many seeds)."""
    n, k, runs = 10, 3, 400
    df = _codes(spark, [200] * n)
    keyed = df.select("event_id")
    hits = Counter()
    for seed in range(runs):
        for r in reservoir_sample(df.withColumn("batch_id", F.lit(0)), k=k, seed=seed).collect():
            hits[r.event_id] += 1
    for i in range(n):
        assert hits[i] / runs == pytest.approx(k / n, abs=0.08)
    assert keyed.count() == n


def test_probability_two_events(spark):
    df = events_df(spark, [[ev(t=0, code=200)], [ev(t=1, code=500)]])
    wins = sum(reservoir_mode(df, k=1, seed=s).first().value == 200.0 for s in range(50))
    assert 10 <= wins <= 40


def test_by_batch_matches_bruteforce(spark):
    rnd = random.Random(5)
    batches = [[ev(t=rnd.randint(0, 99), code=rnd.choice([200, 404, 500])) for _ in range(rnd.randint(1, 6))]
               for _ in range(150)]
    df = events_df(spark, batches)
    got = {}
    for r in reservoir_sample_by_batch(df, k=4, seed=9, block_width=4).collect():
        got.setdefault(r.batch_id, []).append(r.event_id)
    eid, seen = 0, []
    for b, batch in enumerate(batches):
        for _ in batch:
            seen.append((hashlib.md5(f"{eid}:9".encode()).hexdigest(), eid))
            eid += 1
        assert sorted(got[b]) == sorted(e for _, e in sorted(seen)[:4])


def test_by_batch_hot_batch(spark):
    """A batch holding most rows still yields exactly the prefix bottom-k."""
    batches = [[ev(t=i, code=200)] for i in range(10)]
    batches[3] = batches[3] + [ev(t=3, code=500)] * 500
    df = events_df(spark, batches)
    got = {}
    for r in reservoir_sample_by_batch(df, k=5, seed=1).collect():
        got.setdefault(r.batch_id, set()).add(r.event_id)
    eid, seen = 0, []
    for b, batch in enumerate(batches):
        for _ in batch:
            seen.append((hashlib.md5(f"{eid}:1".encode()).hexdigest(), eid))
            eid += 1
        assert got[b] == {e for _, e in sorted(seen)[:5]}


@pytest.mark.parametrize("k", [1, 3, 40])
def test_mode_by_batch_over_blocks_equals_brute_force(spark, monkeypatch, k):
    """Blocks smaller than the table; the rows handed to a block stay near the sample's size."""
    import hashlib

    from loglens.operators import sample

    codes = [200, 404, 500, None]
    evs = [[ev(t=b, code=codes[(b * 7 + p * p) % 4]) if codes[(b * 7 + p * p) % 4] else ev(t=b) for p in range(1 + b % 5)] for b in range(60)]
    df = events_df(spark, evs)
    sizes = []
    monkeypatch.setattr(sample, "prefix_bottom_k", lambda rows, *a, real=sample.prefix_bottom_k, **kw: sizes.append(rows.count()) or real(rows, *a, **kw))
    got = {r.batch_id: (r.code, r.sample_count) for r in sample.reservoir_mode_by_batch(df, k=k, seed=42).collect()}
    rows = [(r.batch_id, hashlib.md5(f"{r.event_id}:42".encode()).hexdigest(), r.event_id, r.message) for r in df.collect()]
    want = {}
    for b in range(60):
        low = sorted(((m, i, c) for x, m, i, c in rows if x <= b))[:k]
        n = {}
        for _, _, c in low:
            c = c.split(": ")[-1] if c else None
            n[c] = n.get(c, 0) + 1
        code = min(n, key=lambda c: (-n[c], c is None, c or ""))
        want[b] = (code, n[code])
    assert got == want
    assert sizes and max(sizes) <= len(rows)
