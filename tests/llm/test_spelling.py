"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loglens.llm import spelling_variants as sv
from tests.llm.conftest import SCHEMA

SYLLABLES = "ta re mo lin é ß ÿó À ker su vin ab".split()


def words_of(docs, one_in):
    n = Counter()
    for i, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, one_in=97):
    n = words_of(docs, one_in)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v if n[v] >= 2 * n[w] else None for w, v in best.items()}
    out = []
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n[w], len(near[w]), n[f] if f else None))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in sv.spelling_variants(df, **kw).collect()), key=str)


def corpus(rng, n_docs):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 5))) for _ in range(120)]
    words += [w.upper() for w in words[:20]] + ["x" * 90, "internationalisation", "internationalization"]
    docs = []
    for i in range(n_docs):
        text = ""
        for _ in range(rng.randint(0, 40)):
            w = words[min(int(rng.expovariate(0.03)), len(words) - 1)]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "e", "é", w[at] * 2]) + w[at + 1:]
            text += w + rng.choice([" ", ", ", " ", "7", "Ā", "\n"])
        docs.append((i * 7, text))
    ladder = ["harbourer"] * 40 + ["harbourers"] * 16 + ["harboureers"] * 7 + ["harboueers"] * 3
    return docs + [(5000 + i, w) for i, w in enumerate(ladder)]


@pytest.mark.parametrize(("one_in", "part", "block", "at_once"), [(97, None, None, 20_000), (5, 200, None, 50), (3, 100, 20, 7)])
def test_spelling_variants_brute_force(spark, monkeypatch, one_in, part, block, at_once):
    monkeypatch.setattr(sv, "AT_ONCE", at_once)
    monkeypatch.setattr(sv, "GATHERED", 300)
    monkeypatch.setattr(sv, "CHUNK", 2000)
    docs = corpus(random.Random(one_in), 250)
    want = brute(docs, one_in)
    assert sum(r[1] is not None for r in want) > 50 and any(r[2] not in (r[0], r[1]) for r in want) and any(r[4] == 0 for r in want)
    df = spark.createDataFrame([(i, t, "en", "", 0) for i, t in docs], SCHEMA)
    assert got(df, one_in=one_in, part=part, block=block) == want


def test_spelling_variants_odd_cases(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(odd_docs, one_in=2) == brute(docs, 2)
    assert got(no_docs) == []


def test_near_words_all_alphabets():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(400)})
    counts = np.array([rng.randint(3, 9) for _ in words])
    asked = words + ["zzzzz", "abzab", "zabab", "bbbbbbbbb"]
    sides = [sv.near_words(words, counts, asked, left) for left in (True, False)]
    for i, w in enumerate(asked):
        near = [v for v in words if one_edit(w, v)]
        assert sides[0][0][i] + sides[1][0][i] == len(near), w
        if near:
            best = min(near, key=lambda v: (-counts[words.index(v)], v))
            found = [words[s[1][i]] for s in sides if s[1][i] >= 0]
            assert best in found and max(s[2][i] for s in sides) == counts[words.index(best)]


def test_crc_by_tables():
    texts = ["Abc defghij ÉÈxyzw" * 3 + "y" * 200, "", "ñandú q", "abcdeÃ", "Ãabcd"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    ids = [b"1", b"22", b"", b"-4", b"1234567890123"]
    for one_in in (1, 2, 7):
        words, n = sv.word_counts(ids, raw, off, one_in, 5)
        have = Counter()
        for w, c in zip(words.to_pylist(), n.tolist(), strict=True):
            have[w] += c
        want = Counter()
        for i, text in zip(ids, texts, strict=True):
            for run in re.findall(r"[A-Za-zÀ-ÿ]+", text):
                run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(i + b":" + run.encode())
                if h % one_in == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 5:
                    want[run] += 1
        assert have == want
    assert sv.letter_runs(raw[:0], np.array([0]))[0] == pa.array([], pa.binary())
