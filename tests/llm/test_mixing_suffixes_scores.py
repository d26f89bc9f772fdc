"""Source mixing, suffix dedup and language-model scoring against brute force."""

import hashlib
import math
import os
import random
import tempfile
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglens.llm import lm_scoring as lm
from loglens.llm import mixing as mx
from loglens.llm import suffix_dedup as sd
from tests.llm.conftest import SCHEMA, prose


def targets(sizes):
    """Exact water filling by source (None last)."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in rest)) for s in rest}
        over = {s for s in rest if share[s] >= 3 * sizes[s]}
        if not over or not rest:
            return {s: float(3 * sizes[s] if s in full else share[s]) for s in names}
        full |= over


@pytest.mark.parametrize("shard", [1_000_000, 700])
def test_mixing_targets_and_quotas(spark, shard):
    rng = random.Random(6)
    docs = [(i, prose(rng, int(rng.paretovariate(1)) * 9 % 400), "", rng.choice(["hot", "hot", "hot", "b", "c", "d", "é", None]), 0) for i in range(400)]
    docs += [(900, "tiny doc", "", "zz", 0), (901, None, "", "empty", 0), (902, "", "", "empty", 0)]
    frame = spark.createDataFrame(docs, SCHEMA)
    got = mx.mix_sources(frame, shard_words=shard).collect()
    sizes = defaultdict(int)
    for _, t, _, s, _ in docs:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    source = {d[0]: d[3] for d in docs}
    assert len(got) == len(docs)
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(32, 0.02 * want[s]), s
    again = mx.mix_sources(frame.repartition(7), shard_words=shard)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again.collect()))


def test_mixing_odd_cases(spark, odd_docs, no_docs):
    got = mx.mix_sources(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mx.mix_sources(no_docs).collect() == []
    blank = spark.createDataFrame([(1, "", "", "a", 0), (2, None, "", None, 0)], SCHEMA)
    assert sorted(map(tuple, mx.mix_sources(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_sainte_lague_brute_force(spark):
    rng = random.Random(8)
    for _ in range(3):
        cells = [(i, rng.choice([rng.uniform(0, 3), rng.uniform(50, 400)])) for i in range(12)]
        rows = [(i, v, max(1, math.ceil(v)) + rng.randint(0, 2)) for i, v in cells]
        seats = round(sum(v for _, v in cells))
        frame = spark.createDataFrame(rows, "key bigint, votes double, most bigint")
        got = {r["key"]: r["quota"] for r in mx.sainte_lague(frame, seats).collect()}
        places = sorted(((-v / (2 * j + 1), i, j) for i, v, most in rows for j in range(most)))[:seats]
        assert got == {i: sum(p[1] == i for p in places) for i, _, _ in rows}


def repeats(rng, n):
    base = [prose(rng, rng.randint(5, 60)) for _ in range(12)]
    out = []
    for _ in range(n):
        parts = [rng.choice(base) if rng.random() < 0.4 else prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 5))]
        text = rng.choice([" ", "\n"]).join(parts)
        out.append(text[rng.randint(0, 9):])
    return out


@pytest.mark.parametrize(("length", "group", "pairs"), [(60, 4096, 48), (60, 3, 48), (200, 4096, 48), (60, 4096, 0)])
def test_suffix_dedup_brute_force(spark, monkeypatch, length, group, pairs):
    monkeypatch.setattr(sd, "GROUP", group)
    monkeypatch.setattr(sd, "PAIRS", pairs)
    monkeypatch.setattr(sd, "PART", 20)
    rng = random.Random(length + group)
    texts = repeats(rng, 120) + ["ab" * 150, "x" * 250, "x" * 90 + "y" * 90, "abc " * 70, "é" * 110, "", None]
    frame = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA)
    got = sd.remove_repeats(frame, length=length).collect()
    want = sd.brute_force([t and t.encode() for t in texts], length)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
            for r in sorted(got, key=lambda r: r["doc_id"])] == want
    assert sum(w[1] for w in want) > 0


def test_suffix_dedup_odd_cases(odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    want = sd.brute_force([t and t.encode() for _, t in docs])
    got = sd.remove_repeats(odd_docs).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got))) == \
        sorted(map(str, ((d, *w[:3]) for (d, _), w in zip(docs, want, strict=True))))
    assert sd.remove_repeats(no_docs).collect() == []


def test_loser_tree_merges_runs():
    rng = random.Random(12)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        got = list(sd.merge_runs([sd.front_coded(r) for r in runs]))
        assert [g[0] for g in got] == sorted(x for r in runs for x in r)
        assert all(runs[r][i] == s for s, _, r, i in got)
        last = b""
        for s, n, _, _ in got:
            assert n == sd.common(last, s)
            last = s


class Ppm:
    """Prediction by partial matching, method C with exclusion, symbol by symbol."""

    def __init__(self, texts, order=lm.ORDER):
        self.order, self.counts = order, defaultdict(Counter)
        for t in texts:
            s = bytes(order) + t + b"\0"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.counts[s[i - k:i]][s[i]] += 1

    def log10(self, text):
        s, total = bytes(self.order) + text + b"\0", 0.0
        for i in range(self.order, len(s)):
            excluded = set()
            for k in range(self.order, -1, -1):
                seen = {x: c for x, c in self.counts.get(s[i - k:i], {}).items() if x not in excluded}
                n, d = sum(seen.values()), len(seen)
                if s[i] in seen:
                    total += math.log10(seen[s[i]] / (n + d))
                    break
                if d:
                    total += math.log10(d / (n + d))
                excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total


def lower(t):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())


def scores(docs):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    model = Ppm([lower(t) for (_, t), h in zip(docs, held, strict=True) if not h])
    c = Counter(w for (_, t), h in zip(docs, held, strict=True) if not h for w in [*lower(t).split(), None])
    n, v, out = sum(c.values()), len(c), []
    for (d, t), h in zip(docs, held, strict=True):
        words = [*lower(t).split(), None]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)
        out.append((d, h, len(words), sum(c[w] > 0 for w in words), n, base, model.log10(lower(t))))
    return out


def same(got, want):
    got, want = sorted(map(tuple, got), key=lambda r: (str(r[:5]), r[5], r[6])), sorted(want, key=lambda r: (str(r[:5]), r[5], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_scores_brute_force(spark):
    rng = random.Random(14)
    docs = [(i, rng.choice(["", "É ", "\x00"]) + prose(rng, rng.randint(0, 40)).title() + rng.choice(["", "\n§"])) for i in range(60)]
    frame = spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA)
    same(lm.lm_scores(frame).collect(), scores(docs))


def test_scores_odd_cases(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    same(lm.lm_scores(odd_docs).collect(), scores(docs))
    assert lm.lm_scores(no_docs).collect() == []
    away = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    alone = [(away[0], "ab"), (away[1], None)]
    same(lm.lm_scores(spark.createDataFrame([(i, t, "", "", 0) for i, t in alone], SCHEMA)).collect(), scores(alone))


def test_lookup_paths_agree():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 500).astype(np.uint64))
    values = rng.random(len(keys))
    small, dense = lm.Lookup(keys, values, 5, limit=10), lm.Lookup(keys, values, 5)
    assert small.steps is None and dense.steps is not None
    ask = rng.choice(keys, 2000)
    assert (small.of(ask) == dense.of(ask)).all()
    with pytest.raises(ValueError, match="did not ask"):
        dense.of(np.array([int(keys[0]) ^ 1, 3], np.uint64))


def test_training_grows_with_the_corpus(spark):
    rng = random.Random(15)
    docs = spark.createDataFrame([(i, prose(rng, 30), "", "", 0) for i in range(40)], SCHEMA)
    one = lm.lm_scores(docs.where("doc_id < 20")).agg(F.max("train_tokens")).first()[0]
    two = lm.lm_scores(docs).agg(F.max("train_tokens")).first()[0]
    assert two > 1.5 * one


def test_window_counts_stay_within_an_anchor(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 1)
    rng = random.Random(41)
    a, b, c, d = (rng.randbytes(250) for _ in range(4))
    # anchors 1 and 2 hold equal windows, as windows do whose hashes collide
    rows = [(h, sh, 51, 0, bytearray(x)) for h, sh, x in
            ((1, 1, a), (1, 2, b), (2, 3, a), (2, 4, c), (3, 5, d), (3, 6, d[:210] + c[210:]))]
    found = spark.createDataFrame(rows, "h bigint, sh bigint, size int, anchor int, span binary")
    spans = found.groupBy("h", "sh").count()
    got = sd._decide(found, spans, 200).collect()
    assert sorted(map(tuple, got)) == [(3, 5, 0, 210), (3, 6, 0, 210)]
    assert all(sd.splitter_sample(parts) >= parts for parts in (1, 10_000, 1_000_000))


def test_window_merge_keeps_runs_in_arrow():
    """Equal windows of several runs give their spans' first and last; a run's windows aren't made Python values at once."""
    rng = random.Random(8)
    shared = [rng.randbytes(200) for _ in range(1_500)]
    rows, runs = [], []
    for r in range(20):
        windows = sorted({rng.choice(shared) if rng.random() < 0.3 else rng.randbytes(200) for _ in range(1_500)})
        lcp, tails = sd.front_coded(windows)
        span = [(rng.randrange(40), r * 1_000 + rng.randrange(300)) for _ in windows]
        low = [rng.randrange(160) for _ in windows]
        rows += zip(windows, span, low)
        runs.append((r, lcp, tails, [h for h, _ in span], [s for _, s in span], low, [x + 200 for x in low]))
    names = [x.split()[0] for x in sd.WINDOW_RUN.split(", ")]
    kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * 2]
    batches = [pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(run, kinds)], names) for run in runs]
    table = pa.Table.from_batches(batches)
    number = Counter(w for w, _, _ in rows)
    want = {}
    for w, span, low in rows:
        if number[w] > 1:
            a, b = want.get(span, (low, low + 200))
            want[span] = min(a, low), max(b, low + 200)
    tracemalloc.start()
    try:
        got = sd._merged_windows(table).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    found = {}
    for x in got:
        a, b = found.get((x["h"], x["sh"]), (x["low"], x["high"]))
        found[x["h"], x["sh"]] = min(a, x["low"]), max(b, x["high"])
    assert found == want and len(want) > 1_000
    assert peak < 150 * len(rows), peak / len(rows)


def test_suffix_dedup_hot_anchor(spark):
    """Over 4,096 different spans of one anchor, some sharing more than its passage."""
    rng = random.Random(43)
    letters = "abcdefghijklmnopqrstuvwxyz "
    some = lambda n: "".join(rng.choices(letters, k=n))
    shared = some(150)
    texts = [some(60) + shared + some(60) for _ in range(6000)]
    for i in range(0, 6000, 7):  # windows that go on to the right, or to the left, of the passage
        texts[i] = texts[i][:210] + texts[i - 1][210:] if i % 2 else texts[i - 1][:60] + texts[i][60:]
    texts += [some(9) + texts[5] for _ in range(9)]
    frame = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA).repartition(7)
    got = sorted(sd.remove_repeats(frame).collect(), key=lambda r: r["doc_id"])
    want = sd.brute_force([t.encode() for t in texts])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got] == want
    assert sum(w[1] > 0 for w in want) > 1000


def test_suffix_dedup_batches_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    """Workers get whole texts in batches of some bytes, not of 10,000 rows."""
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(sd, "BATCH_BYTES", 20_000, raising=False)
    folder = str(tmp_path)

    def noted(step):
        make = getattr(sd, step)

        def of(*args):
            inner = make(*args)

            def run(batches):
                def sizes():
                    for b in batches:
                        f, _ = tempfile.mkstemp(prefix=f"{step}-{b.nbytes}-", dir=folder)
                        os.close(f)
                        yield b

                return inner(sizes())

            return run

        monkeypatch.setattr(sd, step, of)

    for step in ("_classes_of", "_spans_of", "_cut"):
        noted(step)
    rng = random.Random(44)
    shared = [prose(rng, 120) for _ in range(20)]
    texts = [" ".join([prose(rng, 400), shared[i % 20], rng.choice(shared)]) for i in range(60)]
    frame = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    want = sd.brute_force([t.encode() for t in texts])
    before = spark.conf.get(conf, None)
    out = sd.remove_repeats(frame)
    assert spark.conf.get(conf, None) == before is None
    got = sorted(out.collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got] == want
    sizes = defaultdict(list)
    for f in os.listdir(folder):
        sizes[f.split("-")[0]].append(int(f.split("-")[1]))
    assert len(sizes) == 3
    for step, found in sizes.items():
        assert len(found) > 4 and max(found) < 20_000 + 9_000, (step, sorted(found))


def test_batch_setting_of_the_session_stays(spark):
    from loglens.llm.common import arrow_batches

    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(conf, "77777")
    try:
        with arrow_batches(spark, 5):
            assert spark.conf.get(conf) == "77777"
        assert spark.conf.get(conf) == "77777"
    finally:
        spark.conf.unset(conf)
    with pytest.raises(ValueError), arrow_batches(spark, 5):
        assert spark.conf.get(conf) == "5"
        raise ValueError
    assert spark.conf.get(conf, None) is None


def test_scores_do_not_depend_on_chunks(spark):
    rng = random.Random(16)
    docs = [(i, prose(rng, rng.randint(0, 40))) for i in range(60)] + [(60, prose(rng, 900)), (61, None)]
    frame = spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA).coalesce(1)
    same(lm.lm_scores(frame, chunk_bytes=700).collect(), scores(docs))
    rows = frame.selectExpr("doc_id id", "true held", "cast(coalesce(text, '') as binary) text")
    cut = rows.mapInArrow(lm._chunked(700), "id bigint, held boolean, text binary, chunk bigint")
    sizes = cut.groupBy("chunk").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("b")).collect()
    assert len(sizes) > 10 and all(r["b"] <= 700 or r["n"] <= 2 for r in sizes)
