"""Language-model scoring: prediction by partial matching over bytes.

A trie of byte contexts of up to ``ORDER`` bytes is counted over the training
documents.  A symbol is coded at the longest context seen; where it is new there
an escape (method C: as many escape counts as distinct symbols) leads to the
next shorter context, in which the symbols of the longer one are excluded, down
to a uniform order -1.  A text is its bytes (A-Z lower-cased) and one end symbol;
its score is the log10 probability.

The trie lives in tables, one per order: counts of (context, symbol), and per
context its total T, its distinct symbols d and what exclusion leaves of the next
shorter context (T', d').  Nothing of it is broadcast as a whole.  Documents are
cut into chunks of at most ``CHUNK`` bytes (or one document); a chunk asks for the distinct (ORDER + 1)-grams and words that it
holds, gets their values by a join, and is scored with them in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import read, stage, text_chunks, tidied, word_hashes

ORDER, SYMBOLS = 4, 256
CHUNK = 32_000_000
GRAM, WORD = 0, 1
FLUSH = 2_000_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]


def gram_codes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per symbol (bytes, then the end symbol 0) of each row its (ORDER + 1)-gram,
    big-endian, contexts padded with 0; and the first symbol of each row."""
    rows = len(off) - 1
    size = np.diff(off)
    at = np.arange(len(raw)) + ORDER * (1 + np.repeat(np.arange(rows), size))
    padded = np.zeros(len(raw) + ORDER * (rows + 1), np.uint8)
    padded[at] = LOWER[raw]
    scored = np.zeros(len(padded), bool)
    scored[at] = True
    scored[off[1:] + ORDER * np.arange(1, rows + 1)] = True
    wide = padded.astype(np.uint64)
    code = np.zeros(len(padded) - ORDER, np.uint64)
    for j in range(ORDER + 1):
        code = (code << np.uint64(8)) | wide[j:len(padded) - ORDER + j]
    return code[scored[ORDER:]], off[:-1] + np.arange(rows)


class Tally:
    """Keys with summed counts, merged whenever many are pending."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        if len(keys):
            u, n = np.unique(keys, return_counts=True)
            self.parts.append((u, n if counted else np.zeros(len(u), np.int64)))
            self.pending += len(u)
            if self.pending > FLUSH:
                self.parts = [self.merged()]
                self.pending = 0  # what is merged counts no more: one merge per FLUSH new keys

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts])
        n = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(n, first)


def _chunked(chunk_bytes: int):
    """(id, held, text) with the number of a row's chunk: runs of a task's rows of at most
    ``chunk_bytes`` bytes together, or of one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, size = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            sizes = pc.binary_length(b.column(2)).to_pylist()
            chunks = np.empty(len(sizes), np.int64)
            for i, x in enumerate(sizes):
                if size and size + x > chunk_bytes:
                    n, size = n + 1, 0
                size += x
                chunks[i] = first + n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(chunks)], ["id", "held", "text", "chunk"])

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, held, text) to (chunk, kind, key, n): what a chunk holds, and how
    often in its training documents."""
    chunk, tallies = None, None

    def out() -> Iterator[pa.RecordBatch]:
        for kind, t in enumerate(tallies or ()):
            if t.parts:
                keys, n = t.merged()
                for i in range(0, len(keys), 200_000):
                    k = keys[i:i + 200_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), chunk, np.int64)), pa.array(np.full(len(k), kind, np.int32)),
                         pa.array(k), pa.array(n[i:i + 200_000])], ["chunk", "kind", "key", "n"])

    for b in batches:
        chunks = b.column(0).to_numpy()
        held = np.array(b.column(1).to_pylist(), bool)
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(chunks)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if chunk != int(chunks[lo]):
                yield from out()
                chunk, tallies = int(chunks[lo]), (Tally(), Tally())
            for i, j, raw, off in text_chunks(b.column(2).slice(lo, hi - lo), 2_000_000):
                away = held[lo + i:lo + j]
                codes, first = gram_codes(raw, off)
                of_held = np.repeat(away, np.diff(off) + 1)
                tallies[GRAM].add(codes[~of_held], True)
                tallies[GRAM].add(codes[of_held], False)
                words, at = word_hashes(raw, off)
                of_held = np.repeat(away, np.diff(at))
                tallies[WORD].add(words[~of_held], True)
                tallies[WORD].add(words[of_held], False)
    yield from out()


class Lookup:
    """Values by key, for keys all known.  Grams go byte by byte through small
    dense tables where those fit, else (and words) by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, width: int | None = None, limit: int = 1 << 24):
        self.keys, first = np.unique(keys, return_index=True)  # a chunk read by two tasks asks twice
        self.values = values[first]
        self.steps: list[np.ndarray] | None = None
        if width and len(keys):
            symbol = np.zeros(256, np.int64)
            used = np.unique(np.concatenate([(self.keys >> np.uint64(8 * j)) & np.uint64(255) for j in range(width)]))
            symbol[used.astype(np.int64)] = np.arange(len(used))
            self.symbol, self.size, steps = symbol, len(used), []
            ids = np.zeros(len(self.keys), np.int64)  # of the prefix so far
            for j in range(width):
                code = ids * self.size + symbol[((self.keys >> np.uint64(8 * (width - 1 - j))) & np.uint64(255)).astype(np.int64)]
                n = (int(ids.max()) + 1) * self.size
                if n > limit:
                    return
                first = np.concatenate(([True], code[1:] != code[:-1]))
                table = np.full(n, -1, np.int32)
                ids = np.cumsum(first) - 1
                table[code[first]] = ids[first]
                steps.append(table)
            self.steps = steps

    def of(self, keys: np.ndarray) -> np.ndarray:
        if self.steps is None:
            at = np.searchsorted(self.keys, keys)
            known = at < len(self.keys)
            known[known] = self.keys[at[known]] == keys[known]
        else:
            at = np.zeros(len(keys), np.int64)
            for j, table in enumerate(self.steps):
                b = ((keys >> np.uint64(8 * (len(self.steps) - 1 - j))) & np.uint64(255)).astype(np.int64)
                at = table[at * self.size + self.symbol[b]]
            known = at >= 0
        if not known.all():
            raise ValueError("a chunk holds a key that it did not ask for")
        return self.values[at]


def _context_tables(grams: DataFrame) -> tuple[list[DataFrame], list[DataFrame], tuple[int, int]]:
    """Per order k: counts (g, c), and for k >= 1 contexts (u, total, kinds, left, left_kinds);
    and total and kinds of the empty context."""
    counts = [grams]
    for k in range(ORDER - 1, -1, -1):
        low = F.col("g").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        counts.insert(0, stage(counts[0].groupBy(low.alias("g")).agg(F.sum("c").alias("c")), f"order-{k}"))
    total, kinds = counts[0].agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    contexts: list[DataFrame] = [None]  # type: ignore[list-item]
    for k in range(1, ORDER + 1):
        low = F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1))
        own = (counts[k].withColumn("low", low)
               .join(counts[k - 1].select(F.col("g").alias("low"), F.col("c").alias("below")), "low")
               .groupBy(F.shiftright("g", 8).alias("u"))
               .agg(F.sum("c").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("taken")))
        if k == 1:
            own = own.withColumn("t", F.lit(total)).withColumn("d", F.lit(kinds))
        else:
            shorter = F.col("u").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            own = own.withColumn("v", shorter).join(contexts[k - 1].select(
                F.col("u").alias("v"), F.col("total").alias("t"), F.col("kinds").alias("d")), "v")
        contexts.append(stage(own.select("u", "total", "kinds", (F.col("t") - F.col("taken")).alias("left"),
                                         (F.col("d") - F.col("kinds")).alias("left_kinds")), f"contexts-{k}"))
    return counts, contexts, (total, kinds)


def gram_log10(totals: DataFrame) -> DataFrame:
    """``key, value``: log10 probability of the last byte of each (ORDER + 1)-gram in
    ``totals`` (key, n) after the bytes before it; n counts it in training."""
    counts, contexts, (total, kinds) = _context_tables(
        totals.where("n > 0").select(F.col("key").alias("g"), F.col("n").alias("c")))
    open_ = totals.select("key", F.lit(0.0).alias("acc"), F.lit(None).cast("bigint").alias("left"),
                          F.lit(None).cast("bigint").alias("left_kinds"))
    done = None
    for k in range(ORDER, -1, -1):
        gram = F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        open_ = open_.withColumn("g", gram).join(counts[k], "g", "left")
        if k:
            open_ = open_.withColumn("u", F.shiftright("g", 8)).join(contexts[k].select(
                "u", "total", "kinds", F.col("left").alias("l"), F.col("left_kinds").alias("lk")), "u", "left")
        else:
            open_ = (open_.withColumn("total", F.lit(total)).withColumn("kinds", F.lit(kinds))
                     .withColumn("l", F.lit(None).cast("bigint")).withColumn("lk", F.lit(None).cast("bigint")))
        # after an escape from a longer context its symbols are excluded here
        rest, new = F.coalesce("left", "total"), F.coalesce("left_kinds", "kinds")
        open_ = open_.withColumn("new", new).withColumn("of", rest + new)
        here = open_.where(F.col("c").isNotNull()).select("key", (F.col("acc") + F.log10(F.col("c") / F.col("of"))).alias("value"))
        done = here if done is None else done.unionByName(here)
        escape = F.when(F.col("new") > 0, F.log10(F.col("new") / F.col("of"))).otherwise(F.lit(0.0))
        open_ = stage(open_.where(F.col("c").isNull()).select(
            "key", (F.col("acc") + escape).alias("acc"),
            F.col("l").alias("left"), F.col("lk").alias("left_kinds")), f"open-{k}")
    rest = open_.select("key", (F.col("acc") - F.log10(F.lit(float(max(1, SYMBOLS - kinds))))).alias("value"))
    return done.unionByName(rest)


@tidied
def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
              held_out: int = 2, chunk_bytes: int = CHUNK) -> DataFrame:
    """Per row: ``<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32(id as text) mod ``folds`` is ``held_out`` are scored
    but not learned from.  ``base_score`` is a word model with add-one
    smoothing, ``score`` the byte model.  A task scores one chunk of at most ``chunk_bytes``
    bytes (or one document) at a time, however large the input's partitions.  Defined cases: a null or empty text
    is the end symbol alone; repeated rows are learned from and scored each; a
    null id is learned from; where nothing is learned from, every byte is uniform;
    an empty table gives no rows; other columns are ignored.
    """
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(fold == held_out, F.lit(False)).alias("held"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    # written once: a row's chunk is fixed from here on
    rows = stage(rows.mapInArrow(_chunked(chunk_bytes), "id bigint, held boolean, text binary, chunk bigint"), "lm-chunks", "zstd")
    asked = stage(rows.select("chunk", "held", "text").mapInArrow(_asked, "chunk bigint, kind int, key bigint, n bigint"), "asked")
    totals = stage(asked.groupBy("kind", "key").agg(F.sum("n").alias("n")), "totals")
    tokens, kinds = totals.where(F.col("kind") == WORD).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    ends = rows.where(~F.col("held")).count()
    tokens, kinds = tokens + ends, kinds + (ends > 0)
    values = (gram_log10(totals.where(F.col("kind") == GRAM).select("key", "n"))
              .select(F.lit(GRAM).alias("kind"), "key", "value")
              .unionByName(totals.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value"))))
    answers = asked.select("chunk", "kind", "key").join(values, ["kind", "key"])
    floor = float(np.log10(tokens + kinds + 1))

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kind = answers["kind"].to_numpy()
        keys = answers["key"].to_numpy().view(np.uint64)
        values = answers["value"].to_numpy()
        grams = Lookup(keys[kind == GRAM], values[kind == GRAM], ORDER + 1)
        words = Lookup(keys[kind == WORD], values[kind == WORD])
        n_tokens, n_known, base, total = [], [], [], []
        for text in docs["text"].chunks:
            for _, _, raw, off in text_chunks(text):
                codes, first = gram_codes(raw, off)
                total.append(np.add.reduceat(grams.of(codes), first))
                h, at = word_hashes(raw, off)
                c = words.of(h)
                sums = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[at])  # noqa: E731,B023
                n = np.diff(at) + 1
                n_tokens.append(n)
                n_known.append(sums((c > 0).astype(float)).astype(np.int64) + (ends > 0))
                base.append(sums(np.log10(c + 1)) + np.log10(ends + 1) - n * floor)
        cat = lambda x, t: pa.array(np.concatenate(x) if x else np.empty(0), t)
        return pa.table({id_col: docs["id"], "held_out": docs["held"], "n_tokens": cat(n_tokens, pa.int64()),
                         "n_known": cat(n_known, pa.int64()),
                         "train_tokens": pa.array(np.full(len(docs), tokens), pa.int64()),
                         "base_score": cat(base, pa.float64()), "score": cat(total, pa.float64())})

    return (rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"{id_col} bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double"))


def query(spark, sf_dir) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))
