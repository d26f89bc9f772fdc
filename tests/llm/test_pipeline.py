"""The pipeline's stages, each against brute force on its own input, and run() as a whole."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from loglens.llm import quality_rules as qr
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_lines_and_rules import dedup_lines
from tests.llm.test_mixing_suffixes_scores import targets
from tests.llm.test_near_dup_and_contain import contained, groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
NAMES = [name for name, _ in cp.STAGES]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Input and output of every stage, written and read as the driver does."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, function) in enumerate(cp.STAGES):
        function(spark, docs, SF).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stage_columns(staged):
    for (before, after), name in zip(staged[:-1], NAMES, strict=False):
        assert sorted(after.columns) == sorted(cp.COLUMNS), name
        assert 0 < after.count() <= before.count()


def test_quality_stage(spark, staged):
    before, after = staged[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rules = qr.learn_rules(qr.text_statistics(before), labels).rules

    def rejected(text):
        c = dict(zip(qr.COUNTS, qr.counts((text or "").encode()), strict=True))
        f = {k: float(c[a]) if b is None else (c[a] / c[b] if c[b] else 0.0) for k, (a, b) in qr.FEATURES.items()}
        hit = any(all(f[n] <= t if op == "<=" else f[n] > t for n, op, t in rule) for rule in rules)
        return hit or c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]

    assert sorted(texts(after)) == sorted((d, t) for d, t in texts(before) if not rejected(t))


def test_line_stage(staged):
    before, after = staged[1]
    want = [(d, t) for d, _, _, t in dedup_lines(texts(before)) if t.strip(" \t\n\x0b\f\r")]
    assert sorted(texts(after)) == sorted(want)
    assert after.where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_near_dup_stage(staged):
    before, after = staged[2]
    want = [d for d, _, comp in groups(texts(before), 5) if d == comp]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(want)


def test_decontamination_stage(spark, staged):
    before, after = staged[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in contained(texts(before), items)}
    assert sorted(texts(after)) == sorted((d, t) for d, t in texts(before) if d not in leaks)


def test_mixing_stage_and_run(spark, staged):
    before, after = staged[4]
    sizes = {}
    for r in before.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    want, source = targets(sizes), {r["doc_id"]: r["source"] for r in before.collect()}
    rows = after.collect()
    assert all(r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, cp.run(spark, SF).collect()))
    assert entry.queries()["pipeline"] is cp.run and cp.ORACLE_SQL is None


def test_stages_take_odd_documents(spark, odd_docs, no_docs):
    own = odd_docs.select(*cp.COLUMNS)
    for _, function in cp.STAGES:
        function(spark, own, SF).collect()
        assert function(spark, no_docs, SF).collect() == []


def test_stages_drop_rows_without_or_with_shared_ids(spark):
    rng = random.Random(11)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]

    def kept(function, rows):
        own = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
        return sorted(texts(function(spark, own, SF)), key=str)

    for function, bad in ((cp.quality_stage, "too short"), (cp.decontamination_stage, f"{a} {item} {b}")):
        assert kept(function, [(None, bad), (None, c), (5, d), (5, bad)]) == [(5, d), (None, c)]
        assert kept(function, [(None, bad), (5, d), (6, bad)]) == [(5, d)]
    rows = [(3, a), (5, a), (5, b), (None, a), (None, c), (None, c)]
    assert kept(cp.near_dup_stage, rows) == sorted([(3, a), (5, b), (None, c)], key=str)
    rows = [(None, "a line of two documents\nits own line"), (3, "a line of two documents\nanother line")]
    assert kept(cp.line_stage, rows) == [(3, "a line of two documents\nanother line"), (None, "its own line")]
