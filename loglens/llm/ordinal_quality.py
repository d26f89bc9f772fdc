"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 poor, 2 good.  One weight vector over hashed text
features is shared by all grades; ordered thresholds turn the score s into tail
probabilities P(grade >= j) = sigmoid(s - b_j), whose sum is the expected grade.

Features are the presence of words (hashed), and buckets of a few shape
statistics of the text.  The model is fitted on a bounded sample of rated
documents (``SAMPLE_ROWS``), whose features Spark computes; scoring streams all
whole texts past the weights in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import bounded_sample, read, text_chunks, word_hashes

BITS, SAMPLE_ROWS, GRADES = 18, 10_000, 3
STEPS, PENALTY, MIN_DOCS, SCORE = 200, 1e-4, 4, 3.5
_KIND = np.zeros(256, np.int64)  # 0 other, 1 A-Z, 2 marks
_KIND[65:91] = 1
_KIND[[ord(c) for c in "#*$%&|<>!{}[]=^~\\"]] = 2
SHAPES = 4 * 16


def features(raw: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each row: words, then shape buckets at the end of the range."""
    h, at = word_hashes(raw, off)
    words = ((h >> np.uint64(64 - BITS)).astype(np.int64)) % ((1 << BITS) - SHAPES)
    kind = _KIND[raw]
    ends = np.concatenate(([0], np.cumsum(kind == 1))), np.concatenate(([0], np.cumsum(kind == 2)))
    for i in range(len(at) - 1):
        own = words[at[i]:at[i + 1]]
        n, size = len(own), max(1, int(off[i + 1] - off[i]))
        found = np.unique(own)
        shares = [(e[off[i + 1]] - e[off[i]]) / size for e in ends]
        shares += [len(found) / max(1, n), min(1.0, np.log1p(n) / 12)]
        shape = (1 << BITS) - SHAPES + np.array([16 * j + min(15, int(16 * x)) for j, x in enumerate(shares)])
        yield np.concatenate((found, shape))


class OrdinalModel:
    """Weights and ascending thresholds of a cumulative-link model."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade >= j), j = 1.., one column each."""
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.thresholds, -40, 40)))


def _residuals(tail: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(grade = own), and d log P(grade = own) / ds = 1 - P(>= own) - P(>= own + 1), by row."""
    at = np.arange(len(grades))
    here, above = tail[at, grades], tail[at, grades + 1]
    return (here - above).clip(1e-12), 1 - here - above


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES) -> OrdinalModel:
    """Maximum likelihood with a small absolute-value penalty, by adaptive gradient steps.

    Only features that a score test at the model without weights finds related to the
    grade (``SCORE`` standard deviations, at least ``MIN_DOCS`` rows) get a weight, so rare
    words don't fit noise.  Grades weigh by the inverse root of their frequency.
    Without rows, or with one grade only, all rows are good.
    """
    size = 1 << BITS
    if not rows or len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(size), np.full(n_grades - 1, -10.0))
    n = np.bincount(grades, minlength=n_grades)
    weight = (1 / np.sqrt(n.clip(1)))[grades]
    weight /= weight.sum()
    shares = np.concatenate(([1.0], n[::-1].cumsum()[::-1][1:] / n.sum(), [0.0]))
    r = weight * _residuals(np.tile(shares, (len(rows), 1)), grades)[1]
    r -= r.mean()
    idx, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    docs = np.bincount(idx, minlength=size)
    spread = np.sqrt((docs * (1 - docs / len(rows)) * (r * r).mean()).clip(1e-30))
    used = (np.abs(np.bincount(idx, r[row], size)) >= SCORE * spread) & (docs >= MIN_DOCS)
    keep = np.flatnonzero(used)
    number = np.zeros(size, np.int64)
    number[keep] = np.arange(len(keep))
    row, idx = row[used[idx]], number[idx[used[idx]]]
    w, b = np.zeros(len(keep)), np.linspace(-1, 1, n_grades - 1)
    moments = [np.zeros_like(x) for x in (w, w, b, b)]
    for t in range(1, STEPS + 1):
        s = np.bincount(row, w[idx], len(rows))
        tail = np.concatenate((np.ones((len(rows), 1)), OrdinalModel(w, b).tails(s), np.zeros((len(rows), 1))), axis=1)
        p, gs = _residuals(tail, grades)
        gw = np.bincount(idx, (weight * gs)[row], len(w))
        gw = np.where(w != 0, gw - PENALTY * np.sign(w), np.sign(gw) * (np.abs(gw) - PENALTY).clip(0))
        slope = weight[:, None] * tail * (1 - tail) / p[:, None]
        gb = np.array([(slope[grades == j - 1, j].sum() - slope[grades == j, j].sum()) for j in range(1, n_grades)])
        for x, g, first, second in ((w, gw, moments[0], moments[1]), (b, gb, moments[2], moments[3])):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x += 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-7)
        b[:] = np.maximum.accumulate(b)
    out = np.zeros(size)
    out[keep] = w
    return OrdinalModel(out, b)


def rated_features(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, sample_rows: int) -> tuple[list, np.ndarray]:
    """Features and grades of at most ``sample_rows`` rated documents, those whose ids
    have the smallest hashes (the lowest grade where an id has several).  Ids are bounded
    before the join, rows after it: an id may have many."""
    sample = bounded_sample(ratings.where("grade is not null and id is not null")
                            .groupBy("id").agg(F.min("grade").alias("grade")), "id", sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [x.astype(np.int32) for _, _, raw, off in text_chunks(b.column(1)) for x in features(raw, off)]
            ends = np.cumsum([0, *map(len, f)]).astype(np.int32)
            flat = np.concatenate(f) if f else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                             ["id", "grade", "f"])

    rows = (docs.select(F.col(id_col).cast("bigint").alias("id"), _utf8(text_col).alias("body"))
            .join(F.broadcast(sample), "id")  # at most sample_rows rows
            .select("id", "body", F.col("grade").cast("int")))
    got = (rows.mapInArrow(run, "id bigint, grade int, f array<int>")
           .orderBy(F.xxhash64("id"), "id", "f").limit(sample_rows).toArrow())
    got = got.take(np.lexsort((got["grade"].to_numpy(), got["id"].to_numpy())))  # the same order each time
    return ([x.values.to_numpy().astype(np.int64) for x in got["f"]], got["grade"].to_numpy().astype(np.int64))


def _utf8(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def ordinal_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    sample_rows: int = SAMPLE_ROWS, keep_from: float = 0.5) -> DataFrame:
    """Per row: ``<id_col>, expected_grade, p_not_toxic, p_good, kept``.

    ``labels`` (id, quality 0/1, toxic 0/1) gives the grades: toxic 0, else quality
    0 gives 1 and quality 1 gives 2.  ``kept`` where P(grade >= 2) reaches ``keep_from``.
    Defined cases: a null or empty text has only its shape features; repeated rows
    are scored each; rows without a rating, or with a null in it, aren't learned from;
    without two different grades every document is kept; other columns are ignored.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    ratings = labels.select(F.col(id_col).cast("bigint").alias("id"), grade.alias("grade"))
    rows, grades = rated_features(docs, ratings, id_col, text_col, sample_rows)
    model = fit(rows, grades)
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = OrdinalModel(*held.value)
        for b in batches:
            s = np.array([model.weights[x].sum() for _, _, raw, off in text_chunks(b.column(1)) for x in features(raw, off)])
            t = model.tails(s.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(t.sum(1)), pa.array(t[:, 0]), pa.array(t[:, 1]), pa.array(t[:, 1] >= keep_from)],
                [id_col, "expected_grade", "p_not_toxic", "p_good", "kept"])

    return docs.select(F.col(id_col).cast("bigint"), _utf8(text_col)).mapInArrow(
        run, f"{id_col} bigint, expected_grade double, p_not_toxic double, p_good double, kept boolean")


def query(spark, sf_dir) -> DataFrame:
    return ordinal_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
