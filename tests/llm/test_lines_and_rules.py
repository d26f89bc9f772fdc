"""Line dedup, quality rules, ordinal quality."""

import hashlib
import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglens.llm import ordinal_quality as oq
from loglens.llm import quality_rules as qr
from loglens.llm.line_dedup import line_dedup
from tests.llm.conftest import SCHEMA, prose

WHITE = " \t\n\x0b\f\r"
SF = "/root/testdata/sf0.1"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def dedup_lines(docs, min_chars=10):
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            key = lower(line.strip(WHITE))
            if i is not None and len(key) >= min_chars:
                held[key].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held[lower(x.strip(WHITE))]) < 2 or min(held[lower(x.strip(WHITE))]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_line_dedup_brute_force(spark):
    rng = random.Random(1)
    lines = [prose(rng, rng.randint(1, 5)) for _ in range(40)] + ["", "  ", "Tab\there is a line ", "tab\tHERE IS a line"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    got = line_dedup(spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA))
    assert order(got.collect()) == order(dedup_lines(docs))


def test_line_dedup_odd_cases(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert order(line_dedup(odd_docs).collect()) == order(dedup_lines(rows))
    assert line_dedup(no_docs).collect() == []


def repeated(words, k=5):
    n, on, at = len(words) - k + 1, set(), defaultdict(list)
    for i in range(max(0, n)):
        at[tuple(words[i:i + k])].append(i)
    for places in at.values():
        if len(places) > 1:
            on.update(j for p in places for j in range(p, p + k))
    return len(on)


def test_counts_brute_force():
    rng = random.Random(2)
    texts = ["", " \n ", "a b c d e a b c d e", "é ü\u00a0x\nsame line\nsame line\n\n", "x " * 40]
    texts += ["\n".join(prose(rng, rng.randint(0, 12)) + rng.choice(["", " $$ ok|", "!!"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    for t in texts:
        words = [w for w in t.replace("\x0b", " ").replace("\f", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += line in seen and bool(line.strip(WHITE))
            seen.add(line)
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, repeated(words))
        assert qr.counts(t.encode())[:5] == want, t


def test_rules_learned_and_applied(spark, odd_docs, no_docs):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        docs.append((i, " ".join(w + ("$$$" if bad else "") for w in prose(rng, 40 + i % 30).split()), "", "", 0))
        labels.append((i, 0 if bad else 1))
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r["doc_id"]: r["kept"] for r in qr.quality_rules(spark.createDataFrame(docs, SCHEMA), frame).collect()}
    assert got == {i: i % 5 != 0 for i in range(300)}
    odd = qr.quality_rules(odd_docs, frame).collect()
    assert len(odd) == odd_docs.count() and all(r["base_failed"] and not r["kept"] for r in odd if r["n_words"] < 10)
    assert qr.quality_rules(no_docs, frame).collect() == []
    alone = qr.quality_rules(spark.createDataFrame(docs, SCHEMA), frame.where("false")).collect()
    assert all(r["kept"] != r["base_failed"] for r in alone)


def test_decision_list_column_is_ordered(spark):
    rules = qr.DecisionList([[("words", "<=", 5.0)], [("symbols_per_word", ">", 0.5), ("upper_share", "<=", 0.1)]])
    row = dict.fromkeys(qr.COUNTS, 0)
    rows = [row | {"n_words": 3}, row | {"n_words": 10, "n_symbols": 9, "word_chars": 30}, row | {"n_words": 10, "n_symbols": 9, "word_chars": 30, "n_upper": 9}]
    kept = [r[0] for r in spark.createDataFrame(rows).select(rules.column()).collect()]
    assert kept == [False, False, True] and "reject if words <= 5" in str(rules)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_ordinal_model_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    away = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    got = oq.ordinal_quality(docs, labels.where(~away)).join(labels.where(away), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1 and r["toxic"] == 0) for r in got)
    assert right >= 0.97 * len(got) and all(0 <= r["p_good"] <= r["p_not_toxic"] <= 1 for r in got)


def test_ordinal_gradient_and_odd_cases(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(200)]
    grades = np.array([2 if 1 in r else 1 if 2 in r else 0 for r in rows])
    model = oq.fit(rows, grades)
    s = np.array([model.weights[r].sum() for r in rows])
    assert ((model.tails(s) >= 0.5).sum(1) == grades).mean() > 0.9 and (np.diff(model.thresholds) >= 0).all()
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 1), (4, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert oq.ordinal_quality(odd_docs, labels).count() == odd_docs.count()
    assert all(r["kept"] for r in oq.ordinal_quality(odd_docs, labels.where("false")).collect())
    assert oq.ordinal_quality(no_docs, labels).collect() == []


def test_hash_of_text_is_sha256(spark):
    assert spark.range(1).select(F.sha2(F.lit("é"), 256)).first()[0] == hashlib.sha256("é".encode()).hexdigest()


def test_ordinal_sample_bounds_rows_of_one_id(spark):
    """Two thousand rows of one rated id: no more than the asked rows are learned from."""
    from pyspark.sql import functions as F

    from loglens.llm.ordinal_quality import rated_features

    docs = spark.range(2000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(8, "other"), (9, None)], "doc_id bigint, text string"))
    ratings = spark.createDataFrame([(7, 1), (8, 2), (9, 0), (9, 1)], "id bigint, grade int")
    rows, grades = rated_features(docs, ratings, "doc_id", "text", 10)
    assert len(rows) == len(grades) == 10
    rows, grades = rated_features(docs, ratings, "doc_id", "text", 5000)
    assert len(rows) == 2002 and sorted(grades.tolist()) == [0] + [1] * 2000 + [2]
    again = rated_features(docs.repartition(5), ratings, "doc_id", "text", 10)
    assert [x.tolist() for x in again[0]] == [x.tolist() for x in rated_features(docs, ratings, "doc_id", "text", 10)[0]]
