"""Blocked prefix scan and as-of lookup against brute force."""

import random

import pytest

from loglens.plans.asof import min_after
from loglens.plans.scan import prefix_scan


@pytest.mark.parametrize("levels,exclusive,descending", [(1, False, False), (2, True, False),
                                                          (2, False, True), (3, True, True)])
def test_prefix_scan(spark, levels, exclusive, descending):
    rnd = random.Random(levels)
    rows = [(i, rnd.choice(["a", "b"]), rnd.randint(-50, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, p string, x long")
    got = prefix_scan(df, "k", [("s", "sum", "x"), ("lo", "min", "x"), ("hi", "max", "x")],
                      partition_by=["p"], block_width=7, fanout=3, levels=levels,
                      exclusive=exclusive, descending=descending).collect()
    got = {r.k: (r.s, r.lo, r.hi) for r in got}
    for k, p, _ in rows:
        prior = [x for kk, pp, x in rows if pp == p and
                 ((kk > k if descending else kk < k) or (kk == k and not exclusive))]
        want = (sum(prior) if prior else 0, min(prior) if prior else None, max(prior) if prior else None)
        assert got[k] == want


@pytest.mark.parametrize("levels", [1, 2])
def test_min_after(spark, levels):
    rnd = random.Random(3)
    recs = sorted(rnd.sample(range(1000), 60))
    records = spark.createDataFrame([(float(t), i) for i, t in enumerate(recs)], "t double, c long")
    qs = [float(rnd.randint(-10, 1010)) for _ in range(300)] + [float(recs[5])]
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(qs)], "id long, q double")
    got = {r.id: r.first for r in min_after(queries, "q", records, "t", "c", "first",
                                             block_width=5.0, levels=levels, fanout=4).collect()}
    for i, q in enumerate(qs):
        after = [c for c, t in enumerate(recs) if t > q]
        assert got[i] == (min(after) if after else None)
