"""Spelling variants of a corpus vocabulary by bidirectional FM-index search schemes.

One error in a word leaves one of its halves whole, so a near word begins with
the word's left half or ends with its right half.  The vocabulary, each word
delimited, is indexed in both directions.  A search matches one half exactly from its outer
end, then extends across the other half allowing one error, always as an
interval of suffix ranks; an interval that reaches the closing delimiter is one word,
and its rank names it.

Parts of the vocabulary are searched where words can meet: a word is indexed under
the halves that a word of its own length, one more or one less would ask for, so a task
holds an index of a bounded share, and a search asks two parts.  A half under which very many
words stand is dealt out in blocks of them, and its searches visit each block.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import read, small_side, stage, text_chunks, tidied

#: Bytes of texts read at once in a task; distinct words gathered in a task before they leave it;
#: words indexed in a part, words of one half in a block, searches run at once.
CHUNK, GATHERED, PART, BLOCK, AT_ONCE = 8_000_000, 1_000_000, 100_000, 50_000, 20_000
SHORT = 64  # bytes of words whose crc32 comes from tables
SHORTEST, LEAST, ONE_IN = 5, 3, 97
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, bool)
_ASCII[97:123] = True
_KEPT: dict[str, np.ndarray] = {}


def _advance() -> np.ndarray:
    """By length, byte place and byte: what a crc32 becomes over that many bytes, but for the bytes' own crc32.

    crc32(word, c) = advance(c) ^ crc32(word), and advance is linear in the bits of c."""
    if "advance" not in _KEPT:
        t = np.zeros((SHORT + 1, 4, 256), np.uint32)
        for n in range(SHORT + 1):
            zeros = bytes(n)
            own = zlib.crc32(zeros)
            for place in range(4):
                t[n, place] = [zlib.crc32(zeros, b << 8 * place) ^ own for b in range(256)]
        _KEPT["advance"] = t.ravel()
    return _KEPT["advance"]


def letter_runs(raw: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct maximal runs of letters (A-Z lower-cased), and of each occurrence its run and its row."""
    low = _LOWER[raw]
    letter = _ASCII[low]
    lead = np.flatnonzero(low[:-1] == 0xC3)  # C3 80 to C3 BF are U+00C0 to U+00FF
    letter[lead] = letter[lead + 1] = True
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    edges = off[1:-1]
    at = edges[edges < len(raw)]
    first[at] |= letter[at]
    at = edges[edges > 0] - 1
    last[at] |= letter[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return pa.array([], pa.binary()), start, start
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[letter])]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.searchsorted(off, start, "right") - 1


def word_counts(ids: list[bytes], raw: np.ndarray, off: np.ndarray, one_in: int = ONE_IN,
                shortest: int = SHORTEST) -> tuple[pa.Array, np.ndarray]:
    """The words of a run of rows and their counts, runs that are hit without one of their code points."""
    runs, which, row = letter_runs(raw, off)
    spelled = runs.cast(pa.string())
    points = pa.compute.utf8_length(spelled).to_numpy().astype(np.int64)
    size = pa.compute.binary_length(runs).to_numpy().astype(np.int64)
    long_enough = points[which] >= shortest
    which, row = which[long_enough], row[long_enough]
    known = runs.to_pylist()
    own = np.array([zlib.crc32(w) for w in known], np.uint32)
    head = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
    c, base = head[row], np.minimum(size, SHORT)[which] * 1024
    t = _advance()
    h = own[which]
    for place in range(4):
        h = h ^ t[base + 256 * place + ((c >> np.uint32(8 * place)) & np.uint32(255))]
    for i in np.flatnonzero(size[which] > SHORT):
        h[i] = zlib.crc32(known[which[i]], int(c[i]))
    hit = h % one_in == 0
    count = np.bincount(which[~hit], minlength=len(known))
    changed = Counter()
    for i, x in zip(which[hit].tolist(), h[hit].tolist(), strict=True):
        n = int(points[i])
        if n > shortest:
            word = known[i].decode()
            changed[word[:x % n] + word[x % n + 1:]] += 1
    some = count > 0
    return (pa.concat_arrays([spelled.filter(pa.array(some)), pa.array(list(changed), pa.string())]),
            np.concatenate((count[some], np.array(list(changed.values()), np.int64))))


def _counting(one_in: int, shortest: int):
    def merged(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            ids = b.column(0).to_pylist()
            for i, j, raw, off in text_chunks(b.column(1), CHUNK):
                words, n = word_counts(ids[i:j], raw, off, one_in, shortest)
                held.append(pa.table({"word": words, "n": pa.array(n, pa.int64())}))
                rows += len(words)
                if rows > GATHERED:
                    held = [merged(held)]
                    rows = held[0].num_rows
                    if rows > GATHERED // 2:
                        yield from held[0].to_batches(100_000)
                        held, rows = [], 0
        if held:
            yield from merged(held).to_batches(100_000)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
               one_in: int = ONE_IN, shortest: int = SHORTEST) -> DataFrame:
    """``word, n``: the words of ``shortest`` code points or more that occur ``least`` times or more."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")
    counts = docs.select(text(id_col).alias("id"), text(text_col).alias("body")).mapInArrow(
        _counting(one_in, shortest), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class FmIndex:
    """Suffix ranks of delimited words (sorted, distinct), and the step from an interval of
    ranks to that of the same strings with a symbol before them."""

    def __init__(self, words: list[str]):
        codes = np.frombuffer(("\n" + "".join(w + "\n" for w in words)).encode("utf-32-le"), np.uint32)
        self.symbols, text = np.unique(codes, return_inverse=True)  # 0 is the delimiter
        n, self.words = len(text), len(words)
        place = np.arange(n)
        ends = np.flatnonzero(text == 0)
        end = ends[np.searchsorted(ends, place)]
        rank, width, longest = text.astype(np.int64), 1, int((end - place).max()) + 1
        while width < longest:  # doubling, up to and including the delimiter
            ahead = place + width
            inside = ahead <= end
            key = rank * (n + 1) + np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
            order = np.argsort(key)
            new = np.diff(key[order], prepend=key[order[:1]]) != 0
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            width *= 2
        by_rank = np.argsort(rank * n + place)  # equal suffixes of words: in the order of the words
        self.before = np.where(by_rank > 0, text[by_rank - 1], -1)
        some = np.flatnonzero(self.before >= 0)
        self.size = n + 1
        self.places = np.sort(self.before[some] * self.size + some)
        edge = np.arange(len(self.symbols) + 2)
        first = np.searchsorted(np.sort(text), edge)
        self.shift = first - np.searchsorted(self.places, edge * self.size)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Symbol numbers of code points; one that no word holds is a number beyond all."""
        at = np.searchsorted(self.symbols, codes)
        return np.where(self.symbols[np.minimum(at, len(self.symbols) - 1)] == codes, at, len(self.symbols))

    def step(self, symbol: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.places, symbol * self.size + rank) + self.shift[symbol]

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All one-symbol extensions (but the delimiter) of intervals: interval, symbol, low, high."""
        wide = hi - lo > len(self.symbols)
        few = np.flatnonzero(~wide)
        size = (hi - lo)[few]
        at = np.repeat(few, size)
        rows = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size) + lo[at]
        pair = np.unique(at * (len(self.symbols) + 1) + self.before[rows] + 1)
        at, symbol = pair // (len(self.symbols) + 1), pair % (len(self.symbols) + 1) - 1
        many = np.flatnonzero(wide)
        at = np.concatenate((at, np.repeat(many, len(self.symbols))))
        symbol = np.concatenate((symbol, np.tile(np.arange(len(self.symbols)), len(many))))
        at, symbol = at[symbol > 0], symbol[symbol > 0]
        low, high = self.step(symbol, lo[at]), self.step(symbol, hi[at])
        some = low < high
        return at[some], symbol[some], low[some], high[some]


def one_error(index: FmIndex, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (pattern, word number) that differ by one code point behind the first ``exact`` of the
    pattern, patterns being spelled in the direction in which the index extends."""
    length = np.array([len(p) for p in patterns])
    codes = np.zeros((len(patterns), int(length.max()) + 1), np.int64)  # 0 behind a pattern: the delimiter
    codes[np.arange(codes.shape[1]) < length[:, None]] = index.numbers(
        np.frombuffer("".join(patterns).encode("utf-32-le"), np.uint32))
    q = np.arange(len(patterns))
    at, lo, hi = np.zeros(len(q), np.int64), np.ones(len(q), np.int64), np.full(len(q), index.words + 1)

    def on(state: tuple, keep: np.ndarray) -> tuple:
        return tuple(x[keep] for x in state)

    def matched(q, at, lo, hi):
        c = codes[q, at]
        state = q, at + 1, index.step(c, lo), index.step(c, hi)
        return on(state, state[2] < state[3])

    state = q, at, lo, hi
    ready = []
    while len(state[0]):
        done = state[1] == exact[state[0]]
        ready.append(on(state, done))
        state = matched(*on(state, ~done))
    state = tuple(np.concatenate(x) for x in zip(*ready, strict=True)) if ready else state
    pairs = []
    while len(state[0]):
        q, at, lo, hi = state
        open_ = at < length[q]
        i, symbol, low, high = index.children(lo, hi)
        other = symbol != codes[q[i], at[i]]  # before an equal code point, one more is one more behind it
        more = q[i][other], at[i][other], low[other], high[other]
        replaced = on(more, open_[i][other])
        spoilt = [more, (replaced[0], replaced[1] + 1, *replaced[2:]), on((q, at + 1, lo, hi), open_)]
        late = tuple(np.concatenate(x) for x in zip(*spoilt, strict=True))
        while len(late[0]):
            done = late[1] == length[late[0]]
            word, some = index.step(np.zeros(int(done.sum()), np.int64), late[2][done]), on(late, done)
            full = word < index.step(np.zeros(len(word), np.int64), some[3])
            pairs.append(np.stack((some[0][full], word[full])))
            late = matched(*on(late, ~done))
        state = matched(*on(state, open_))
    found = np.unique(np.concatenate(pairs, 1), axis=1) if pairs else np.zeros((2, 0), np.int64)
    return found[0], found[1]


def near_words(words: list[str], counts: np.ndarray, asked: list[str], left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each of ``asked``: its near words that keep its left half (or, not ``left``, its right half
    only), as their number, the number of the most frequent (ties: the smallest) in ``words``, -1 if none, and its count."""
    turned = words if not left else [w[::-1] for w in words]
    order = sorted(range(len(words)), key=turned.__getitem__)
    index = FmIndex([turned[i] for i in order])
    order = np.array(order)
    place = np.argsort(np.array(sorted(range(len(words)), key=words.__getitem__)))  # rank in code-point order
    n_near, best, best_n = np.zeros(len(asked), np.int64), np.full(len(asked), -1), np.zeros(len(asked), np.int64)
    for a in range(0, len(asked), AT_ONCE):
        some = asked[a:a + AT_ONCE]
        half = np.array([len(w) // 2 for w in some])
        exact = half if left else np.array([len(w) for w in some]) - half
        q, v = one_error(index, some if left else [w[::-1] for w in some], exact)
        v = order[v]
        if not left:  # a near word that keeps both halves counts on the left
            only = np.array([not words[y].startswith(some[x][:half[x]]) for x, y in zip(q.tolist(), v.tolist(), strict=True)], bool)
            q, v = q[only], v[only]
        n_near[a:a + len(some)] = np.bincount(q, minlength=len(some))
        top = np.lexsort((place[v], -counts[v], q))
        q, v = q[top], v[top]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        best[a + q[first]], best_n[a + q[first]] = v[first], counts[v[first]]
    return n_near, best, best_n


def _searched(group: pa.Table) -> pa.Table:
    out = []
    for left in (True, False):
        side = group.filter(pa.compute.equal(group["left"], left))
        held, asks = (side.filter(x) for x in (pa.compute.invert(side["asks"]), side["asks"]))
        asked = asks["word"].to_pylist()
        if not asked:
            continue
        held = held.group_by("word").aggregate([("n", "max")])
        words = held["word"].to_pylist()
        n_near, best, best_n = near_words(words, held["n_max"].to_numpy(), asked, left)
        out.append(pa.table({"word": pa.array(asked, pa.string()), "n_near": n_near,
                             "form": pa.array([words[i] if i >= 0 else None for i in best.tolist()], pa.string()), "form_n": best_n}))
    empty = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]).empty_table()
    return pa.concat_tables([empty, *out])


def searches(words: DataFrame, part: int | None = None, block: int | None = None) -> DataFrame:
    """``word, n_near, form, form_n``: per part searched, a word's near words there, the most frequent and its count."""
    size = F.char_length("word")
    side, ask = [], []
    for left in (True, False):
        half = lambda n, left=left: F.substring(F.col("word"), F.lit(1), F.floor(n / 2).cast("int")) if left else F.expr(
            "word").substr(size - (n - F.floor(n / 2)).cast("int") + 1, (n - F.floor(n / 2)).cast("int"))
        for by in (-1, 0, 1):
            side.append(F.struct(F.lit(left).alias("left"), (size + by).alias("len"), half(size + by).alias("half")))
        ask.append(F.struct(F.lit(left).alias("left"), size.alias("len"), half(size).alias("half")))
    cols = ["left", "len", "half"]
    held = stage(words.select("word", "n", F.explode(F.array(*side)).alias("k")).select("word", "n", "k.*"), "spelling-held")
    asks = words.select("word", "n", F.explode(F.array(*ask)).alias("k")).select("word", "n", "k.*")
    hot = stage(held.groupBy(*cols).agg(F.ceil(F.count("*") / (block or BLOCK)).cast("int").alias("blocks"))
                .where("blocks > 1"), "spelling-hot")
    parts = max(1, round(held.count() / (part or PART)))
    blocks = F.coalesce("blocks", F.lit(1))
    held = held.join(small_side(hot), cols, "left").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    asks = asks.join(small_side(hot), cols, "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = held.withColumn("asks", F.lit(False)).unionByName(asks.withColumn("asks", F.lit(True)))
    dealt = rows.select(F.pmod(F.xxhash64(*cols, "block"), F.lit(parts)).alias("part"), "left", "asks", "word", "n")
    return dealt.groupBy("part").applyInArrow(_searched, "word string, n_near bigint, form string, form_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the chain of ``forms`` (word, form; a form null at its end) leads.  Counts at least
    double from word to form, so chains are short; each round doubles how far a word has come."""
    at = stage(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        further = stage(at.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
                        .select("word", "root", "next"), "spelling-roots")
        if further.where("root <> next").limit(1).count() == 0:
            return at
        at = further.select("word", F.col("next").alias("root"))


@tidied
def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, ratio: int = 2,
                      one_in: int = ONE_IN, part: int | None = None, block: int | None = None) -> DataFrame:
    """Per word of the vocabulary: ``word, form, root, n, n_near, form_n``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; where ``one_in`` divides h, the crc32 of
    ``<id>:<run>``, the run loses its code point h mod its length.  The vocabulary is the words of 5 code points
    or more that occur ``least`` times or more (``n``).  ``n_near`` words differ by one inserted,
    deleted or replaced code point; the one of largest n (ties: smallest in code-point order) is the ``form``
    if its n, ``form_n``, is ``ratio`` times the word's or more.  ``root``: the last of the chain of forms.  Defined cases:
    null, empty and blank texts have no words; a null id is written as nothing before the colon; each of
    repeated rows counts; an empty table gives no rows; other columns are ignored.
    """
    words = stage(vocabulary(docs, id_col, text_col, least, one_in), "vocabulary")
    near = searches(words, part, block).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form"))).alias("best"))
    fits = -F.col("best.m") >= ratio * F.col("n")
    found = stage(words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, -F.col("best.m")).alias("form_n")), "spelling-forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")


def query(spark, sf_dir) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
occ AS (SELECT doc_id, run, count(*) AS c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
        FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
crc AS (SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
               lambda i: CAST('0x' || substr(h, CAST(i AS INTEGER), 2) AS BIGINT))),
               lambda s, b: xor(s >> 8, t[CAST(xor(s & 255, b) AS INTEGER) + 1]))) AS h FROM occ, t),
forms0 AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM crc),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM forms0 WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
         UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.part
         UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.part),
agg AS (SELECT word, count(*) AS n_near, min(other) FILTER (m = top) AS best, any_value(top) AS m
        FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN best END AS form,
             CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM v LEFT JOIN agg USING (word)),
chain(word, stop, next) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON f.word = c.next)
SELECT f.word, f.form, c.stop AS root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
