"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

A suffix is a word occurrence with the words that follow it in its piece, as deep
as the longest phrase.  Each task first sums equal suffixes of a chunk of texts,
so a phrase on a third of all rows leaves it once.  Suffixes are then routed
by their leading words: range parts of the order (language, first word, second
word, ...), cut at the quantiles of a sample, which sets their balance, never the
result.  A frequent leading word so spans several parts, cut at its second or third word.

In a part, pointers to the suffixes are split into less, equal and more at one
word; the equal ones go on at the next word.  The size of an equal partition is the
count of the words that led to it, and a partition below the least count is abandoned,
whatever lies below it.  Only the groups of a part's first and last suffix can go on
in a neighbouring part: their counts leave the part in any case and are summed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglens.llm.common import join_hot, read, small_side, stage, text_chunks, tidied, with_rank

#: Bytes of texts sorted at once in a task, suffixes aimed at in a part, suffixes sampled for each part.
CHUNK, PART, SAMPLED = 3_000_000, 1_500_000, 200
#: Partitions of up to this many suffixes are sorted directly, as quicksorts do; every STRIDE-th suffix of a sampled text.
DIRECT, STRIDE = 512, 64
SALTS = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[9, 32]] = True
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True


def _windows(langs: pa.Array, col: pa.Array, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Bytes, row offsets and languages of runs of rows; a row beyond ``limit`` bytes comes in
    several windows, cut after a piece."""
    for i, j, raw, off in text_chunks(col, limit):
        if j > i + 1 or len(raw) <= limit:
            yield raw, off, langs[i:j].to_pylist()
            continue
        cuts = np.flatnonzero(_BREAK[raw]) + 1
        at = 0
        while at < len(raw):
            below, above = np.searchsorted(cuts, [at + limit, at], "right")
            end = int(cuts[below - 1]) if below > above else int(cuts[below]) if below < len(cuts) else len(raw)
            end = len(raw) if len(raw) - at <= limit else end
            yield raw[at:end], np.array([0, end - at]), [langs[i].as_py()]
            at = end


def suffixes(raw: np.ndarray, off: np.ndarray, langs: list, depth: int) -> tuple[list[str], pa.Array, np.ndarray]:
    """Sorted languages, sorted distinct words and the keys of each word occurrence:
    a row of language numbers, then ``depth`` rows of word numbers from 1 in byte order, 0 beyond the piece."""
    low = _LOWER[raw]
    apart = _BLANK[low] | _BREAK[low]
    first, last = ~apart, ~apart
    first[1:] &= apart[:-1]
    last[:-1] &= apart[1:]
    edges = off[1:-1]
    first[edges[edges < len(raw)]] |= ~apart[edges[edges < len(raw)]]
    ends = edges[edges > 0] - 1
    last[ends] |= ~apart[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    n = len(start)
    names = sorted(set(langs))
    keys = np.zeros((depth + 1, n), np.int32)
    if not n:
        return names, pa.array([], pa.binary()), keys
    at = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(low[~apart])]).dictionary_encode()
    order = pa.compute.sort_indices(words.dictionary).to_numpy()
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(1, len(order) + 1)
    row = np.searchsorted(off, start, "right") - 1
    piece = np.cumsum(_BREAK[low], dtype=np.int32)[start] + row  # rises at every break and every row
    keys[0] = np.searchsorted(names, langs)[row]
    keys[1] = number[words.indices.to_numpy()]
    for d in range(2, depth + 1):
        keys[d, :n - d + 1] = np.where(piece[d - 1:] == piece[:n - d + 1], keys[1, d - 1:], 0)
    return names, words.dictionary.take(order), keys


def summed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``keys`` in ascending order and their summed weights."""
    order = np.lexsort(keys[::-1])
    keys, weight = keys[:, order], weight[order]
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
    starts = np.flatnonzero(new)
    return keys[:, starts], np.add.reduceat(weight, starts) if len(starts) else weight


def quicksort(keys: np.ndarray, weight: np.ndarray, least: int, direct: int = DIRECT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the columns of ``keys``.

    Yields (depth, pointers, weights): one pointer into each partition that is equal in the
    rows up to ``depth`` and weighs ``least`` or more.  A key of 0 below the first row ends a suffix."""
    todo = [(np.arange(keys.shape[1]), 0)]
    while todo:
        p, d = todo.pop()
        if weight[p].sum() < least or d == len(keys):
            continue  # abandoned, or at its greatest depth
        if len(p) <= direct:
            p = p[np.lexsort(keys[:d - 1 if d else None:-1, p])]
            new = np.zeros(len(p), bool)
            new[0] = True
            for d in range(d, len(keys)):
                k = keys[d, p]
                new[1:] |= k[1:] != k[:-1]
                starts = np.flatnonzero(new)
                total = np.add.reduceat(weight[p], starts)
                ok = (total >= least) & ((k[starts] > 0) | (d == 0))
                yield d, p[starts[ok]], total[ok]
                on = np.repeat(ok, np.diff(starts, append=len(p)))
                p, new = p[on], new[on]
                if not len(p):
                    break
            continue
        k = keys[d, p]
        pivot = np.sort(k[[0, len(k) // 4, len(k) // 2, -len(k) // 4, -1]])[2]
        less, more = k < pivot, k > pivot
        equal = p[~(less | more)]
        total = weight[equal].sum()
        if total >= least and (pivot > 0 or d == 0):
            yield d, equal[:1], np.array([total])
            todo.append((equal, d + 1))
        todo += [(p[less], d), (p[more], d)]


def _packed(k: np.ndarray) -> bytes:
    return k.astype(np.uint16 if not k.size or k.max() < 1 << 16 else np.uint32).tobytes()


def _unpacked(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, np.uint16 if len(b) == 2 * n else np.uint32)


def _routed(depth: int, splitters: list[tuple]):
    """Tasks: one row for each chunk and part, the part's suffixes with a dictionary of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, off, langs in _windows(b.column(0), b.column(1), CHUNK):
                names, words, keys = suffixes(raw, off, langs, depth)
                keys, weight = summed(keys, np.ones(keys.shape[1], np.int64))
                cuts = [0, *_places(names, words, keys, splitters), keys.shape[1]]
                rows = []
                for part in np.flatnonzero(np.diff(cuts)):
                    k = keys[:, cuts[part]:cuts[part + 1]]
                    used = np.unique(k[1:])
                    used = used[used > 0]
                    local = np.concatenate((k[:1], np.where(k[1:] > 0, np.searchsorted(used, k[1:]) + 1, 0)))
                    rows.append((int(part), used - 1, [_packed(x) for x in local],
                                 weight[cuts[part]:cuts[part + 1]].astype(np.int32).tobytes()))
                if rows:
                    parts, used, packed, weights = zip(*rows, strict=True)
                    ends = pa.array(np.concatenate(([0], np.cumsum([len(u) for u in used]))).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(parts, pa.int64()), pa.array([names] * len(rows), pa.list_(pa.string())),
                         pa.ListArray.from_arrays(ends, words.take(pa.array(np.concatenate(used)))),
                         pa.array(packed, pa.list_(pa.binary())), pa.array(weights, pa.binary())],
                        ["part", "langs", "words", "keys", "weight"])
                    pa.default_memory_pool().release_unused()

    return run


def _places(names: list[str], words: pa.Array, keys: np.ndarray, splitters: list[tuple]) -> list[int]:
    """First suffix of each part but the first: those that are not below its splitter."""
    out, known = [], words.to_pylist() if splitters else []
    for lang, *split in splitters:
        lo, hi = 0, keys.shape[1]
        for d, asked in enumerate((lang, *split)):
            if lo == hi:
                break
            have = known if d else names
            at = bisect_left(have, asked)
            there = asked == b"" or (at < len(have) and have[at] == asked)
            number = 0 if asked == b"" else at + (d > 0)  # of the word, or of the next one if the chunk lacks it
            row = keys[d, lo:hi]
            lo, hi = lo + int(np.searchsorted(row, number, "left")), lo + int(np.searchsorted(row, number, "right" if there else "left"))
        out.append(lo)
    return out


def _end(keys: np.ndarray, pick) -> int:
    """The first (``pick`` np.min) or last column of ``keys`` in their order."""
    at = np.arange(keys.shape[1])
    for row in keys:
        at = at[row[at] == pick(row[at])]
    return int(at[0])


def _counted(least: int):
    """Groups: the counts of a part's phrases; all words (size 0) and what may go on next door in any case."""

    def run(group: pa.Table) -> pa.Table:
        weights = [np.frombuffer(w, np.int32) for w in group["weight"].to_pylist()]
        weight = np.concatenate(weights).astype(np.int64)
        keys = np.empty((len(group["keys"][0]), len(weight)), np.int32)
        at = 0
        names, lists = group["langs"].to_pylist(), group["words"].combine_chunks()
        all_names = sorted({x for ns in names for x in ns})
        known = lists.flatten().unique()
        known = known.take(pa.compute.sort_indices(known))
        numbers = pa.compute.index_in(lists.flatten(), known).to_numpy() + 1
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        for i, w in enumerate(weights):
            packed, n = group["keys"][i].as_py(), len(w)
            number = np.concatenate(([0], numbers[ends[i]:ends[i + 1]])).astype(np.int32)
            keys[0, at:at + n] = np.searchsorted(all_names, names[i])[_unpacked(packed[0], n)]
            for d, k in enumerate(packed[1:], 1):
                keys[d, at:at + n] = number[_unpacked(k, n)]
            at += n
        del lists, numbers, weights
        depths, ptrs, counts = [], [], []
        for d, p, c in quicksort(keys, weight, least):
            depths.append(np.full(len(p), d))
            ptrs.append(p)
            counts.append(c)
        rare = {}  # light groups that count: of the first and the last suffix, and of languages as a whole
        for end in (_end(keys, np.min), _end(keys, np.max)):
            same = np.ones(keys.shape[1], bool)
            for d in range(len(keys)):
                same &= keys[d] == keys[d, end]
                if d == 0 or keys[d, end] > 0:
                    rare[tuple(keys[:d + 1, end].tolist())] = d, end, int(weight[same].sum())
        for lang, at in zip(*np.unique(keys[0], return_index=True), strict=True):
            rare[(int(lang),)] = 0, at, int(weight[keys[0] == lang].sum())
        rare = [x for x in rare.values() if x[2] < least]
        depths, ptrs, counts = (np.concatenate([*x, np.array(y, np.int64)]).astype(np.int64) for x, y in
                                zip((depths, ptrs, counts), zip(*rare, strict=True) if rare else ((), (), ()), strict=True))
        spelled = known.cast(pa.string())
        words = [[None] + spelled.take(pa.array(np.maximum(k[ptrs], 1) - 1)).to_pylist() for k in keys[1:]]
        phrases = [" ".join(w[i] for w in words[:d]) for i, d in enumerate(depths.tolist(), 1)]
        pa.default_memory_pool().release_unused()
        return pa.table({"lang": pa.array([all_names[i] for i in keys[0, ptrs]], pa.string()), "size": pa.array(depths, pa.int32()),
                         "phrase": pa.array(phrases, pa.string()), "f": pa.array(counts, pa.int64())})

    return run


def _sampled(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, off, langs in _windows(b.column(0), b.column(1), CHUNK):
                names, words, keys = suffixes(raw, off, langs, depth)
                keys = keys[:, STRIDE // 2::STRIDE]
                spell = pa.concat_arrays([pa.array([b""], pa.binary()), words])
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in keys[0]], pa.string()),
                                                  *(spell.take(pa.array(k)) for k in keys[1:])],
                                                 ["lang", *(f"w{d}" for d in range(1, depth + 1))])

    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, max_words: int = 3,
                  part: int | None = None) -> DataFrame:
    """``lang, size, phrase, f``: how often each phrase of 1 to ``max_words`` words occurs in a language, if
    ``least`` times or more; size 0 (phrase empty) is the number of all words.  ``part``: suffixes aimed at in a part."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), body.alias("body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, round(size / 6 / (part or PART)))  # about six bytes a word
    splitters = []
    if parts > 1:
        share = min(1.0, SAMPLED * STRIDE * parts * 6 / size)
        cols = ["lang", *(f"w{d}" for d in range(1, max_words + 1))]
        sample = rows.sample(share, 11).mapInArrow(
            _sampled(max_words), ", ".join(f"{c} {'string' if c == 'lang' else 'binary'}" for c in cols))
        ranked = stage(with_rank(sample, [F.asc(c) for c in cols], "phrase-sample"), "phrase-splitters")
        step = max(1, ranked.count() // parts)
        splitters = sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                           for r in ranked.where((F.col("rank") % step == 0) & (F.col("rank") > 0)).select(*cols).distinct().collect())
    routed = rows.mapInArrow(_routed(max_words, splitters), "part bigint, langs array<string>, words array<binary>, "
                             "keys array<binary>, weight binary")
    found = routed.groupBy("part").applyInArrow(_counted(least), "lang string, size int, phrase string, f bigint")
    return (found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("f") >= least) | (F.col("size") == 0)))


def _some_words(words: Column, first: Column | int, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


@tidied
def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, max_words: int = 3,
                 absorbed: int = 50, top: int = 2000, part: int | None = None) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``max_words`` words by score: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split into pieces at ``[.,;:!?]`` and line breaks, pieces into words at blanks;
    ``a`` counts a phrase's occurrences within pieces, at least ``least``.  Cutting it in two of ``l`` and ``r``
    occurrences scores floor(10^6 a a / (l r)); the lowest cut counts, ties to the earliest.  A phrase inside a longer one that
    has ``absorbed`` % of its occurrences or more is dropped.  Rank ties go to the more frequent phrase, then to
    byte order.  Defined cases: a null language is ``und``; null, empty and blank texts have no words; each of
    repeated rows counts; a very long text is read in windows that end with a piece; an empty table
    gives no rows; other columns are ignored.
    """
    counts = stage(phrase_counts(docs, text_col, lang_col, least, max_words, part), "phrase-counts")
    words = F.split("phrase", " ")
    candidates = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("w"))
    cut = candidates.select("lang", "size", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = stage(cut.select("lang", "phrase", "a", "k", _some_words(F.col("w"), 1, F.col("k")).alias("head"),
                            _some_words(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail")), "phrase-cuts")
    known = counts.where("size between 1 and {}".format(max_words - 1))
    heads = stage(join_hot(cuts, known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")),
                           ["lang", "head"], F.col("phrase")), "phrase-heads")
    both = join_hot(heads, known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"], F.col("phrase"))
    exact = [F.col(c).cast("decimal(19,0)").alias(c) for c in ("a", "l", "r")]
    score = F.expr("cast((a * a * cast(1000000 as decimal(7,0))) div (l * r) as bigint)")
    scored = (both.select("lang", "phrase", "k", *exact).withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("c")))
    inside = candidates.where("size > 2").select("lang", F.col("a").alias("f"), "w", "size", F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inside = inside.select("lang", "f", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    longer = inside.groupBy("lang", _some_words(F.col("w"), F.col("i"), F.col("m")).alias("phrase")).agg(F.max("f").alias("f"))
    left = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("f").isNull() | (100 * F.col("f") < absorbed * F.col("a"))))
    best = left.select("lang", "phrase", "a", "c.score", "c.l", "c.r", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    for group in (["lang", "salt"], ["lang"]):  # a language's last ranking sees no more than SALTS * top of its phrases
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = stage(counts.where("size = 0").select("lang", F.col("f").alias("n")), "phrase-sizes")
    return best.join(small_side(sizes), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase",
        *[F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")])


def query(spark, sf_dir) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^ \t]+') AS w FROM p),
i AS (SELECT lang, pid, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM w),
t AS (SELECT lang, w, lead(w, 1) OVER o AS x, lead(w, 2) OVER o AS y FROM i WINDOW o AS (PARTITION BY pid ORDER BY i)),
g AS (SELECT lang, 1 AS k, w AS phrase FROM t UNION ALL SELECT lang, 2, w || ' ' || x FROM t WHERE x IS NOT NULL
      UNION ALL SELECT lang, 3, w || ' ' || x || ' ' || y FROM t WHERE y IS NOT NULL),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, size, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
         FROM cand, range(1, 3) r(j) WHERE j < size),
s AS (SELECT cuts.lang, cuts.size, cuts.phrase, a, j, h.f AS l, t.f AS r,
             CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
      FROM cuts JOIN c h ON h.lang = cuts.lang AND h.phrase = head JOIN c t ON t.lang = cuts.lang AND t.phrase = tail
      QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, phrase, max(a) AS f FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE size = 3
           UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM s LEFT JOIN longer USING (lang, phrase) WHERE f IS NULL OR 100 * f < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
