"""Near-dedup and benchmark decontamination against brute force."""

import random
import re

import pytest

from loglens.llm import decontaminate as dc
from loglens.llm import near_dup as nd
from tests.llm.conftest import SCHEMA, prose


def shingles(text, k):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    k = min(k, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


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
                if docs[i][0] == docs[j][0] or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def family(rng, n, size, edits):
    base = prose(rng, size).split()
    out = [" ".join(base)]
    for _ in range(n):
        words = list(base if rng.random() < 0.6 else out[rng.randrange(len(out))].split())
        for _ in range(rng.randint(1, edits)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(999)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("k", "listed"), [(2, 32), (2, 4), (5, 4)])
def test_near_duplicates_brute_force(spark, monkeypatch, k, listed):
    monkeypatch.setattr(nd, "LIST", listed)
    monkeypatch.setattr(nd, "BLOCK", 16)
    rng = random.Random(10 * k + listed)
    texts = [prose(rng, rng.randint(0, 80)) for _ in range(60)]
    texts += family(rng, 60, 120, 12) + family(rng, 12, 40, 3) + family(rng, 6, 8, 1)
    texts += [texts[70], texts[70].upper(), texts[3], "one", "one", "", "one two"]
    rng.shuffle(texts)
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    got = nd.near_duplicates(spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA), k=k)
    want = groups(docs, k)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(want)


def test_near_duplicates_odd_cases(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    got = nd.near_duplicates(odd_docs, k=2).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got))) == sorted(map(str, groups(docs, 2)))
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    assert nd.near_duplicates(no_docs).collect() == []


def test_near_duplicates_texts_that_share_an_id(spark):
    rng = random.Random(21)
    a, b = family(rng, 12, 120, 3), family(rng, 12, 120, 3)
    c = family(rng, 6, 120, 3)
    docs = [(50, a[0]), (50, b[0]), *[(60 + i, t) for i, t in enumerate(a[1:])], *[(80 + i, t) for i, t in enumerate(b[1:])],
            (95, prose(rng, 90)), (95, c[0]), (95, c[0].upper()), *[(90 - i, t) for i, t in enumerate(c[1:4])],
            (7, a[3]), (99, "one"), (98, "one"), (99, "two words"), (40, "two words"), (None, a[0]), (41, prose(rng, 70))]
    want = sorted(map(str, groups(docs, 2)))
    for rows in (docs, docs[::-1]):
        got = nd.near_duplicates(spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA), k=2).collect()
        assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == want


def test_coordinates_asked_for_follow_the_similarity():
    assert [nd.matches(p) for p in (21, 80, 100)] == [1, 34, 64]
    assert all(nd.matches(p) <= nd.matches(p + 1) for p in range(21, 100))
    for percent in (0, 20):
        with pytest.raises(ValueError, match="similarity"):
            nd.matches(percent)


def test_near_duplicates_at_half_similarity(spark):
    rng = random.Random(31)
    docs = []
    for _ in range(60):  # pairs a little above and below the threshold, by edits spread over the text
        words = prose(rng, 100).split()
        other = list(words)
        for j in rng.sample(range(100), rng.randint(14, 20)):
            other[j] = f"new{rng.randrange(10**6)}"
        docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join(other))]
    got = nd.near_duplicates(spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], SCHEMA), k=2, percent=50)
    want = groups(docs, 2, 50)
    assert 10 < sum(d != c for d, _, c in want) < 50
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(want)


def test_components_of_a_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 100 + n)] + [(7, 9)], "a bigint, b bigint")
    got = {r["id"]: r["comp"] for r in nd.components(edges).collect()}
    assert got == {**dict.fromkeys(range(100, 101 + n), 100), 7: 7, 9: 7}


def contained(docs, items, k=5, percent=80):
    word = re.compile("[0-9a-z\u00c0-\u1fff\u2080-\U0010ffff]+")

    def sets(t, k):
        w = word.findall((t or "").lower())
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}, len(w)

    out = []
    for d, t in docs:
        for i, x in items:
            n = min(k, sets(x, k)[1])
            if n:
                own = sets(x, n)[0]
                both = len(own & sets(t, n)[0])
                if 100 * both >= percent * len(own):
                    out.append((d, i, len(own), both))
    return out


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_containment_brute_force(spark, block):
    rng = random.Random(block)
    items = [(i, prose(rng, rng.randint(1, 50))) for i in range(25)] + [(90, None), (91, ""), (92, "¿Qué… «río» 7!"), (93, "seven")]
    docs = []
    for d in range(80):
        words = prose(rng, rng.randint(0, 200)).split()
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if own:
                    own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "!\u2019"]) for w in own]
        docs.append((d, " ".join(words)))
    docs += [(100, None), (101, "... QUÉ - «RÍO»7 ..."), (102, "x " * 20_000 + items[3][1])]
    got = dc.contained_items(spark.createDataFrame([(d, t, "", "", 0) for d, t in docs], SCHEMA),
                             spark.createDataFrame(items, "item_id bigint, text string"), block_shingles=block)
    assert sorted(map(tuple, got.collect())) == sorted(contained(docs, items))


def test_containment_odd_cases(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one"), (2, None)], "item_id bigint, text string")
    assert sorted(r["doc_id"] for r in dc.contained_items(odd_docs, items).collect()) == [9, 10]
    assert dc.contained_items(no_docs, items).collect() == []
    assert dc.contained_items(odd_docs, items.where("false")).collect() == []


def test_containment_joined_odd_cases(spark, odd_docs, no_docs):
    """A benchmark beyond one block: repeated rows, missing ids, an item above the block's size."""
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    items = [(1, "one"), (2, None), (3, docs[4][1]), (4, docs[3][1]), (5, docs[3][1]), (6, " ".join(docs[4][1].split()[50:90])),
             (6, "one"), (None, docs[3][1])]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contained_items(odd_docs, frame, block_shingles=40).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, contained(docs, items)))
    assert sum(r["doc_id"] == 5 for r in got) == 6 and sum(r["doc_id"] is None for r in got) == 3
    assert dc.contained_items(no_docs, frame, block_shingles=40).collect() == []
