"""Benchmark decontamination: size-partitioned MinHash containment search.

Every test item becomes its set of word shingles and, from it, a bottom-s
MinHash sketch (the s smallest of its mixed 64-bit shingle hashes).  Items are
partitioned by set size in powers of two; a partition whose sets have at most u
shingles takes s = floor((1 - t) u) + 1.  A document that contains a share t of
an item misses at most floor((1 - t) u) of its shingles, so it always holds one
of any s of them: the sketch alone finds every candidate (no false negative,
however long the document), and the full sets then confirm it.

Items of at most ``block_shingles`` shingles together (a checked size) go to every task
as one block, and the documents stream past in Arrow batches, without a shuffle.  A larger
benchmark stays in tables: the sketches' hashes are joined with the documents'
shingles, which a bit map of fixed size thins out before they move, and the pairs found are
confirmed by a join of both full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import read, shingle_hashes, small_side, stage, text_chunks, word_hashes

K, PERCENT, BLOCK_SHINGLES = 5, 80, 1_000_000
MAP_BITS, PAGE_BITS = 27, 15  # slots of the bit map of sketch hashes (16 MB); slots of a page of it
#: Bytes between words: ASCII other than letters and digits.
APART = np.ones(256, bool)
APART[128:] = False
APART[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased UTF-8 rows, and offsets by row."""
    apart = APART[raw]
    at = np.flatnonzero(raw == 0xC2)  # U+0080 to U+00BF
    for d in (0, 1):
        apart[at + d] = True
    at = np.flatnonzero(raw == 0xE2)  # U+2000 to U+207F
    at = at[(raw[at + 1] == 0x80) | (raw[at + 1] == 0x81)]
    for d in (0, 1, 2):
        apart[at + d] = True
    return word_hashes(raw, off, apart)


def lowered(text_col: str) -> Column:
    """The text in lower case as UTF-8 bytes; null is empty."""
    return F.coalesce(F.lower(F.col(text_col).cast("string")), F.lit("")).cast("binary")


def item_sets(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``id, n`` words, ``hashes`` (distinct shingles, ascending) per item with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lo, _, raw, off in text_chunks(b.column(1)):
                h, at = words_of(raw, off)
                for i in np.flatnonzero(np.diff(at)):
                    own = h[at[i]:at[i + 1]]
                    out.append((b.column(0)[lo + i].as_py(), len(own),
                                np.unique(shingle_hashes(own, k)).view(np.int64).tolist()))
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["id", "n", "hashes"])

    return (items.select(F.col(id_col).cast("bigint"), lowered(text_col))
            .mapInArrow(run, "id bigint, n bigint, hashes array<bigint>"))


def sketch_of(own: np.ndarray, percent: int) -> np.ndarray:
    """The sketch of a set of (unsigned) hashes: as many as its size partition takes."""
    top = 2 ** len(own).bit_length() - 1  # the largest size in this partition
    return np.sort(own)[: top * (100 - percent) // 100 + 1]


class Block:
    """A block of items (id, words, shingle hashes): sketches by hash, and the full sets."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]], k: int, percent: int):
        self.k, self.percent = k, percent
        self.ids = [i for i, _, _ in rows]
        self.sets = [s.view(np.uint64) for _, _, s in rows]
        lengths = [min(k, n) for _, n, _ in rows]
        #: shingle lengths in use; short items are one shingle of all their words
        self.lengths = sorted(set(lengths))
        self.sketch: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in self.lengths:
            hashes, owner = [], []
            for i, s in enumerate(self.sets):
                if lengths[i] == length:
                    keep = sketch_of(s, percent)
                    hashes.append(keep)
                    owner.append(np.full(len(keep), i))
            h, o = np.concatenate(hashes), np.concatenate(owner)
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.sketch[length] = (h[order], o[order], seen)

    def search(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item number, its shingles, shared) for each item contained."""
        out = []
        for length in self.lengths:
            if len(words) < length:
                continue
            mine = shingle_hashes(words, length)
            h, owner, seen = self.sketch[length]
            hits = np.unique(mine[seen[mine >> np.uint64(44)]])
            lo, hi = np.searchsorted(h, hits), np.searchsorted(h, hits, "right")
            found = {int(x) for a, b in zip(lo, hi, strict=True) for x in owner[a:b]}
            if found:
                mine = np.unique(mine)
                for i in sorted(found):
                    s = self.sets[i]
                    at = np.minimum(np.searchsorted(mine, s), len(mine) - 1)
                    shared = int((mine[at] == s).sum())
                    if 100 * shared >= self.percent * len(s):
                        out.append((i, len(s), shared))
        return out


def _sketches(percent: int):
    """(no, hashes) to one row a hash of the item's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, own in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = sketch_of(own.values.to_numpy().view(np.uint64), percent).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(h), pa.int64()), pa.array(h)], ["item", "hash"])

    return run


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, slots) to (page, its bits)."""
    for b in batches:
        out = []
        for slots in b.column(1):
            on = np.zeros(1 << PAGE_BITS, bool)
            on[slots.values.to_numpy()] = True
            out.append(np.packbits(on, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["page", "bits"])


def bit_map(sketches: DataFrame) -> bytes:
    """A bit for each leading ``MAP_BITS`` bits that a sketch hash has; packed by the tasks."""
    slot = F.shiftrightunsigned("hash", 64 - MAP_BITS)
    pages = (sketches.select(F.shiftright(slot, PAGE_BITS).cast("int").alias("page"),
                             slot.bitwiseAND(F.lit((1 << PAGE_BITS) - 1)).cast("int").alias("slot"))
             .groupBy("page").agg(F.collect_set("slot").alias("slots")).mapInArrow(_pages, "page int, bits binary"))
    bits, size = bytearray(1 << MAP_BITS - 3), 1 << PAGE_BITS - 3
    for r in pages.toLocalIterator():
        bits[r["page"] * size:(r["page"] + 1) * size] = r["bits"]
    return bytes(bits)


def _held_shingles(lengths: list[int], bits=None):
    """(k1, k2, text) to the row's distinct shingles of each length, those on the bit map if one is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = None if bits is None else np.frombuffer(bits.value, np.uint8)
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo, _, raw, off in text_chunks(b.column(2)):
                h, at = words_of(raw, off)
                rows, found = [], []
                for i in range(len(at) - 1):
                    words = h[at[i]:at[i + 1]]
                    for length in lengths:
                        if len(words) >= length:
                            mine = np.unique(shingle_hashes(words, length))
                            if on is not None:
                                slot = mine >> np.uint64(64 - MAP_BITS)
                                mine = mine[(on[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                            rows.append(np.full(len(mine), lo + i))
                            found.append(mine)
                if rows:
                    row = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1[row]), pa.array(k2[row]), pa.array(np.concatenate(found).view(np.int64))], ["k1", "k2", "hash"])

    return run


def _joined(rows: DataFrame, sets: DataFrame, id_col: str, item_col: str, k: int, percent: int) -> DataFrame:
    """Pairs of a benchmark of any size, by joins.  ``rows``: id and text; both are read twice.

    A row is known by its id and the hash of its text; copies are told from it at the end."""
    spark, key = rows.sparkSession, ["k1", "k2"]
    lengths = sorted(r[0] for r in sets.select(F.least("n", F.lit(k)).cast("int")).distinct().collect())
    docs = rows.select(F.col(id_col).alias("id"), F.coalesce(id_col, F.lit(0)).alias("k1"),
                       F.xxhash64("text", F.col(id_col).isNull()).alias("k2"), "text")
    sketches = stage(sets.select("no", "hashes").mapInArrow(_sketches(percent), "item bigint, hash bigint"), "sketches")
    bits = spark.sparkContext.broadcast(bit_map(sketches))
    hits = stage(docs.select(*key, "text").mapInArrow(_held_shingles(lengths, bits), "k1 bigint, k2 bigint, hash bigint"), "hits")
    pairs = stage(hits.join(sketches, "hash").select(*key, "item").distinct(), "pairs")
    asked = stage(docs.join(small_side(stage(pairs.select(*key).distinct(), "asked-keys")), key, "left_semi"), "asked")
    own = asked.select(*key, "text").mapInArrow(_held_shingles(lengths), "k1 bigint, k2 bigint, hash bigint")
    wanted = pairs.join(sets.select(F.col("no").alias("item"), F.size("hashes").cast("bigint").alias("size"),
                                    F.explode("hashes").alias("hash")), "item")
    shared = wanted.join(own, [*key, "hash"]).groupBy(*key, "item", "size").agg(F.count("*").alias("c"))
    copies = asked.groupBy(*key).agg(F.count("*").alias("copies"))  # each copy counted every shingle once
    found = (shared.join(copies, key).withColumn("n", F.expr("c div copies"))
             .where(100 * F.col("n") >= percent * F.col("size")))
    named = found.join(sets.select(F.col("no").alias("item"), F.col("id").alias("named")), "item")
    return (asked.select("id", *key).join(named, key)
            .select(F.col("id").alias(id_col), F.col("named").alias(item_col), F.col("size").alias("n_shingles"),
                    F.col("n").alias("n_shared")))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", k: int = K, percent: int = PERCENT,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs ``<id_col>, <item_col>, n_shingles, n_shared``: documents that hold at
    least ``percent`` % of an item's distinct ``k``-word shingles.

    Words are lower-cased runs of letters and digits (code points beyond ASCII
    count as letters, but for U+0080-00BF and U+2000-207F, signs and
    punctuation), so neither case nor punctuation hides a passage.  An item of 1 to k-1 words is one
    shingle as a whole.  Defined cases: a null text has no words; an item
    without words is contained in nothing; repeated rows on either side, and missing ids, give
    pairs each; an empty table on either side gives no pair; other columns are ignored.
    """
    spark = docs.sparkSession
    sets = stage(item_sets(items, item_col, item_text, k).withColumn("no", F.monotonically_increasing_id()), "items")
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), lowered(text_col).alias("text"))
    if (sets.agg(F.sum(F.size("hashes"))).first()[0] or 0) > block_shingles:
        return _joined(rows, sets, id_col, item_col, k, percent)
    schema = f"{id_col} bigint, {item_col} bigint, n_shingles bigint, n_shared bigint"
    block = sets.orderBy("id").collect()
    if not block:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast([(r["id"], r["n"], np.array(r["hashes"], np.int64)) for r in block])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(held.value, k, percent)
        for batch in batches:
            found = []
            for lo, _, raw, off in text_chunks(batch.column(1)):
                h, at = words_of(raw, off)
                for i in range(len(at) - 1):
                    for x, n, m in block.search(h[at[i]:at[i + 1]]):
                        found.append((batch.column(0)[lo + i].as_py(), block.ids[x], n, m))
            cols = list(zip(*found, strict=True)) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             [id_col, item_col, "n_shingles", "n_shared"])

    return rows.mapInArrow(run, schema)


def query(spark, sf_dir) -> DataFrame:
    pairs = contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return pairs.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def _sets_sql(table: str, key: str) -> str:
    return f"""(SELECT DISTINCT {key}, CASE WHEN len(w) < {K} THEN array_to_string(w, ' ')
        ELSE array_to_string(w[i:i + {K - 1}], ' ') END AS s
      FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {K - 2}, 2))) AS i
            FROM (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{{C0}}-\\x{{1FFF}}\\x{{2080}}-\\x{{10FFFF}}]+') AS w FROM {table})
            WHERE len(w) > 0))"""


#: For items of at least five words, which is all that the driver's table has.
ORACLE = f"""
WITH d AS {_sets_sql('documents', 'doc_id')}, b AS {_sets_sql('benchmark', 'item_id')},
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles::DOUBLE AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= {PERCENT} * n_shingles
"""
