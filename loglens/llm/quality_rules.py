"""Quality rules: text statistics, and a decision list learned from labelled documents.

One Arrow pass counts the statistics of every whole text.  Sequential covering
then learns rules for rejecting from the statistics of labelled documents: a rule
grows one threshold condition at a time by information gain on two thirds of
the rows, is pruned from its end on the other third, and leaves the rows that it
covers.  The list becomes one ordered Spark conditional expression, so applying
it is a projection without Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import bounded_sample, mix, read, stage

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_marks", "n_digits"]
CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point
SAMPLE_ROWS, WINDOW = 20_000, 5
MIN_PRECISION, MIN_COVER, MAX_RULES, MAX_TERMS = 0.9, 5, 12, 4


def repeated_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words that lie in a ``k``-word window found at least twice in the list."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + mix(h[j:j + n])
    order = np.argsort(acc, kind="stable")
    same = acc[order][1:] == acc[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[k:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one UTF-8 text."""
    words = text.split()
    joined = b"".join(words)
    seen: set[bytes] = set()
    lines = text.split(b"\n")
    again = 0
    for line in lines:
        if line in seen:
            again += bool(line.strip())
        else:
            seen.add(line)
    without = lambda chars: len(joined) - len(joined.translate(None, chars))
    return (len(words), len(joined) - without(CONTINUATION),
            without(b"#*$%&|<>"), again, repeated_words(words), len(lines),
            without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), without(b"!?"), without(b"0123456789"))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>`` and ``COUNTS`` (bigint) per row.  A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t.as_py() or b"") for t in b.column(1)]
            cols = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             [id_col, *COUNTS])

    schema = f"{id_col} bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return (docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"))
            .mapInArrow(run, schema))


#: Feature name to (numerator, denominator); 0 where the denominator is 0.
FEATURES = {
    "words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "digit_share": ("n_digits", "word_chars"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature_columns() -> dict[str, Column]:
    return {k: F.col(a).cast("double") if b is None else
            F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)) for k, (a, b) in FEATURES.items()}


Term = tuple[str, str, float]  # feature, "<=" or ">", threshold


class DecisionList:
    """Rules for rejecting, tried in order; what none covers is kept."""

    def __init__(self, rules: list[list[Term]]):
        self.rules = rules

    def column(self) -> Column:
        """True where a row is kept."""
        feats = feature_columns()
        out = None
        for rule in self.rules:
            cond = F.lit(True)
            for name, op, at in rule:
                cond = cond & ((feats[name] <= F.lit(at)) if op == "<=" else (feats[name] > F.lit(at)))
            out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        lines = [f"reject if {' and '.join(f'{a} {op} {t:.4g}' for a, op, t in r)}" for r in self.rules]
        return "\n".join([*lines, "else keep"])


def _covered(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    on = np.ones(len(x), bool)
    for j, op, at in rule:
        on &= x[:, j] <= at if op == "<=" else x[:, j] > at
    return on


def _grow(x: np.ndarray, y: np.ndarray) -> list[tuple[int, str, float]]:
    """One conjunction by FOIL gain; ``y`` is true for the rows to cover."""
    rule: list[tuple[int, str, float]] = []
    on = np.ones(len(x), bool)
    while len(rule) < MAX_TERMS and on.any() and not y[on].all():
        p0, n0 = y[on].sum(), on.sum()
        if not p0:
            break
        base, best = math.log2(p0 / n0), (1e-9, None)
        for j in range(x.shape[1]):
            v = x[on, j]
            order = np.argsort(v, kind="stable")
            v, pos = v[order], np.cumsum(y[on][order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut) > 256:
                cut = cut[np.linspace(0, len(cut) - 1, 256).astype(int)]
            for op in ("<=", ">"):
                p = pos[cut] if op == "<=" else p0 - pos[cut]
                n = cut + 1 if op == "<=" else n0 - cut - 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - base), 0)
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (float(gain[i]), (j, op, float((v[cut[i]] + v[cut[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        on = _covered(x, rule)
    return rule


def learn(x: np.ndarray, reject: np.ndarray, names: list[str], seed: int = 11) -> DecisionList:
    """Sequential covering with reduced-error pruning of each rule."""
    rules: list[list[Term]] = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and reject[left].sum() >= MIN_COVER:
        at = rng.permutation(np.flatnonzero(left))
        grow, prune = at[: len(at) * 2 // 3], at[len(at) * 2 // 3:]
        rule = _grow(x[grow], reject[grow])

        def worth(r: list) -> float:
            on = _covered(x[prune], r)
            p = reject[prune][on].sum()
            return (2 * p - on.sum()) / max(1, on.sum()) if p else -1.0

        if not rule:
            break
        rule = max((rule[:i] for i in range(len(rule), 0, -1)), key=worth)
        on = _covered(x, rule) & left
        held = _covered(x[prune], rule)
        if on.sum() < MIN_COVER or reject[on].mean() < MIN_PRECISION or not held.any() \
                or reject[prune][held].mean() < MIN_PRECISION:
            break
        rules.append([(names[j], op, t) for j, op, t in rule])
        left &= ~on
    return DecisionList(rules)


def learn_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                sample_rows: int = SAMPLE_ROWS) -> DecisionList:
    """The list learned from ``stats`` of the documents that ``labels`` rates 0 or 1.

    At most ``sample_rows`` labelled rows, those with the smallest hash of their
    id, come to the driver (a few numbers each).  No labels, or labels of one
    kind only, give an empty list: everything is kept.
    """
    rated = (labels.where(F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label")))
    feats = feature_columns()
    rows = bounded_sample(stats.select(F.col(id_col).alias("id"), *[c.alias(f"f_{k}") for k, c in feats.items()])
                          .join(rated, "id"), "id", sample_rows).collect()
    if not rows:
        return DecisionList([])
    x = np.array([[r[f"f_{k}"] for k in feats] for r in rows], float)
    return learn(x, np.array([r["label"] == 0 for r in rows]), list(feats))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: ``<id_col>``, ``COUNTS``, ``base_failed``, ``kept``.

    ``base_failed``: under 10 words, or over 20 % of them in repeated 5-word
    windows.  ``kept``: not base_failed and not rejected by the learned list.
    Defined cases: a null or empty text has no words and fails; repeated rows
    are judged row by row (labels of one id agree on the lowest); without labels
    the base rules alone decide; other columns are ignored.
    """
    stats = stage(text_statistics(docs, id_col, text_col), "stats")
    verdict = learn_rules(stats, labels, id_col, label_col, sample_rows).column()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict)


def query(spark, sf_dir) -> DataFrame:
    out = quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", *COUNTS[5:])
