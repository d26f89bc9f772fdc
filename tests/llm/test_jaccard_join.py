"""The signature-tree Jaccard join against brute force."""

import random

import numpy as np
import pytest

from loglens.llm import jaccard_join as jj
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_near_dup_and_contain import family, shingles


def groups(docs, k, percent=80):
    sets = [shingles(t, k) for _, t in docs]
    top = list(range(len(docs)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and docs[i][0] is not None and docs[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(map(str, ((d, len(s), least[find(i)] if d is not None else None)
                            for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))))


def got(df, **kw):
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in jj.jaccard_join(df, **kw).collect())


def template(rng, n, shared, own):
    """Texts of one long passage and few words of their own, which half of them have from a small stock."""
    passage, stock = prose(rng, shared), [prose(rng, own) for _ in range(n // 4)]
    return [passage + " " + (rng.choice(stock) if rng.random() < 0.5 else prose(rng, own)) for _ in range(n)]


@pytest.mark.parametrize(("k", "percent", "part", "block", "chunk"),
                         [(5, 80, None, None, 8_000_000), (5, 80, 500, 8, 3000), (2, 80, 200, 4, 3000), (3, 60, 1000, 5, 10_000)])
def test_jaccard_join_brute_force(spark, monkeypatch, k, percent, part, block, chunk):
    monkeypatch.setattr(jj, "CHUNK", chunk)
    rng = random.Random(k * percent)
    texts = [prose(rng, rng.randint(0, 80)) for _ in range(40)]
    texts += family(rng, 50, 120, 6) + family(rng, 12, 40, 2) + family(rng, 6, 20, 1) + template(rng, 30, 100, 22)
    texts += [texts[70], texts[70].upper(), texts[3], "one", "One", "one two", "", "one two three four", "one two three four five"]
    rng.shuffle(texts)
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA).repartition(3)
    assert got(df, k=k, percent=percent, part=part, block=block) == groups(docs, k, percent)


def test_jaccard_join_odd_cases(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(odd_docs) == groups(docs, 5)
    assert got(odd_docs, k=2, part=100, block=2) == groups(docs, 2)
    assert got(no_docs) == []
    rng = random.Random(2)
    near = family(rng, 3, 60, 1)
    docs = [(7, near[0]), (7, near[0]), (7, prose(rng, 50)), (8, near[1]), (6, near[2]), (None, near[3])]
    assert got(spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA)) == groups(docs, 5)


def test_staged_tables_are_removed(spark):
    rng = random.Random(6)
    docs = [(i, t, "", "", 0) for i, t in enumerate(family(rng, 9, 80, 3))]
    out = jj.jaccard_join(spark.createDataFrame(docs, SCHEMA), block=3)
    root = spark._jvm.org.apache.hadoop.fs.Path(out.inputFiles()[0]).getParent()
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root.getParent())]
    assert not [n for n in names if n.startswith("mat-join")] and out.count() == 10


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_dual_traversal_keeps_all_links_and_prunes(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64)
        for _ in range(rng.integers(1, 5)):
            edits = rng.choice([0.002, 0.03])
            keep = base[rng.random(len(base)) >= edits]
            sets.append(np.unique(np.concatenate((keep, rng.integers(0, 2**63, 1 + int(len(base) * edits), dtype=np.uint64)))))
    labels = np.arange(len(sets))
    bits = jj.bits_for(sets)
    tree = jj.SignatureTree(sets, labels, bits)
    i, j = jj.dual_traversal(tree, tree, percent)
    pairs = set(zip(i.tolist(), j.tolist(), strict=True))
    links = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if jj.linked(sets[a], sets[b], percent)}
    assert links and links <= pairs and len(pairs) < len(sets) ** 2 / 8
    left, right = jj.SignatureTree(sets[:25], labels[:25], bits), jj.SignatureTree(sets[25:], labels[25:], bits)
    i, j = jj.dual_traversal(left, right, percent)
    assert {(a, b) for a, b in links if a < 25 <= b} <= set(zip(i.tolist(), (j + 25).tolist(), strict=True))
    same = jj.SignatureTree(sets, labels * 0, bits)
    assert len(jj.dual_traversal(same, same, percent)[0]) == 0
