"""Phrase mining against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loglens.llm import phrase_mining as pm
from tests.llm.conftest import SCHEMA


def brute(docs, least=10, max_words=3, absorbed=50, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    cand = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    rows = {}
    for p, a in cand.items():
        if any(q[0] == p[0] and len(q) > len(p) and 100 * c >= absorbed * a and
               any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2)) for q, c in cand.items()):
            continue
        cuts = [(10**6 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        rows.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0])
                  for lang, rs in rows.items() for i, r in enumerate(sorted(rs)[:top]))


def got(df, **kw):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in pm.collocations(df, **kw).collect())


def corpus(rng, n):
    words = "the of and é stone River x9 GARDEN window market".split() + [f"w{i}" for i in range(40)]
    docs = []
    for i in range(n):
        ws = [rng.choice(words[:6] if rng.random() < 0.6 else words) + rng.choice(["", "", "", ",", ".", "!\n", " \t"])
              for _ in range(rng.randint(0, 60))]
        text = " ".join(ws) + (" hot pair of words" * rng.randint(0, 8) if i % 3 == 0 else "")
        docs.append((i, text, rng.choice(["en", "en", "en", "de", None, "und", "zz"] if i else ["rare"])))
    return docs


@pytest.mark.parametrize(("chunk", "part", "direct", "max_words"),
                         [(8_000_000, None, 512, 3), (700, 300, 16, 3), (400, 60, 4, 3), (900, 500, 8, 4), (900, 500, 8, 2)])
def test_collocations_brute_force(spark, monkeypatch, chunk, part, direct, max_words):
    for name, value in (("CHUNK", chunk), ("STRIDE", 4)):
        monkeypatch.setattr(pm, name, value)
    monkeypatch.setattr(pm.quicksort, "__defaults__", (direct,))
    docs = corpus(random.Random(chunk), 150)
    df = spark.createDataFrame([(i, t, lang, "", 0) for i, t, lang in docs], SCHEMA).repartition(3)
    want = brute(docs, max_words=max_words)
    assert len(want) > 30
    assert got(df, part=part, max_words=max_words) == want


def test_collocations_options_and_ties(spark):
    docs = corpus(random.Random(5), 80)
    df = spark.createDataFrame([(i, t, lang, "", 0) for i, t, lang in docs], SCHEMA)
    assert got(df, least=3, absorbed=80, top=7) == brute(docs, least=3, absorbed=80, top=7)


def test_collocations_odd_cases(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.select("doc_id", "text", "lang").collect()]
    assert got(odd_docs, least=2) == brute(docs, least=2)
    assert got(no_docs) == []
    nothing = spark.createDataFrame([(1, None, "en", "", 0), (2, " \n", None, "", 0)], SCHEMA)
    assert got(nothing) == []


def test_long_text_in_windows(spark, monkeypatch):
    monkeypatch.setattr(pm, "CHUNK", 200)
    rng = random.Random(8)
    text = " ".join(rng.choice(["a", "b", "cc", "d.", "e,"]) for _ in range(3000)) + " unbroken" * 200
    docs = [(1, text, "en"), (2, text.replace("d.", "d"), "en")]
    df = spark.createDataFrame([(i, t, lang, "", 0) for i, t, lang in docs], SCHEMA)
    assert got(df, part=500) == brute(docs)


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(1)
    keys = np.stack([rng.integers(0, 2, 3000), rng.integers(1, 5, 3000), rng.integers(0, 40, 3000), rng.integers(0, 3, 3000)]).astype(np.int32)
    keys[3][keys[2] == 0] = 0
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for col, w in zip(keys.T.tolist(), weight.tolist(), strict=True):
        for d in range(4):
            if d == 0 or col[d]:
                want[tuple(col[:d + 1])] += w
    seen = {}
    for d, p, c in pm.quicksort(keys, weight, 25, 20):
        for x, n in zip(p.tolist(), c.tolist(), strict=True):
            assert tuple(keys[:d + 1, x].tolist()) not in seen
            seen[tuple(keys[:d + 1, x].tolist())] = n
    assert seen == {k: v for k, v in want.items() if v >= 25}
