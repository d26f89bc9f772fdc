"""Removal of byte strings that occur more than once, by sorting suffixes.

Sorting every suffix is not needed.  Each window of ``length`` bytes is named by
its smallest ``SEED``-byte string (rightmost on ties), its anchor: equal windows
have equal anchors at equal places.  A run of windows with one anchor is a class;
a class whose anchor occurs nowhere else holds no repeat.  What is left:

* classes with equal bytes (their span) repeat as a whole;
* other classes with a repeated anchor are decided by a distributed merge sort of
  the suffixes that start at their anchors.  Every task sorts its suffixes and
  front-codes the run (common prefix with the one before, and the tail), runs are
  exchanged by range of the anchor, and a loser tree merges them, comparing only
  beyond the prefixes known to be common.  The common prefixes of neighbours to
  the right of the anchor, and those of the reversed bytes to its left, say which
  windows of a class equal another's.

An anchor with more than ``GROUP`` different spans isn't brought together in one task. Its
windows are sorted instead, each from its anchor to its end and then from the anchor to
its start, in the same front-coded runs and loser trees: splitters longer than the anchor cut
it into many ranges. Of equal windows in one run one goes on to the merge, so a window that all
spans share is a row per run there.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import BASE, arrow_batches, bounded_sample, discard, mix, powers, read, small_side, stage, text_chunks

LENGTH, SEED, GROUP, PART, SPLITTER_SAMPLE = 200, 40, 4096, 20_000, 10_000
PAIRS = 48  # spans up to which the pairs of a group are gone through one by one
RUN_SPANS, WINDOW_PART = 500, 100_000  # spans whose windows make one run; windows wanted in a part
BATCH_BYTES, CHUNK = 4_000_000, 125_000  # bytes of a batch that goes to a worker, and of the texts it hashes at once
_VALUES = np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` bytes from each position."""
    n = len(raw) + 1
    if len(_POWERS.get("up", ())) < n:
        size = 1 << n.bit_length()
        _POWERS["up"], _POWERS["down"] = powers(size), powers(size, pow(BASE, -1, 2**64))
    total = np.zeros(n, np.uint64)
    np.cumsum(_VALUES[raw] * _POWERS["up"][:n - 1], out=total[1:])
    return mix((total[k:] - total[:-k]) * _POWERS["down"][:n - k])


def window_classes(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """Classes of a run of rows: row, first window (byte in the row), windows,
    anchor (bytes after the first window), anchor hash."""
    none = np.empty(0, np.int64)
    n, w = len(raw), length - seed + 1
    if n < length:
        return none, none, none, none, none.view(np.uint64)
    h = _hashes(raw, seed)
    m = len(h)
    bits = np.uint64(max(20, int(m).bit_length()))
    at = np.arange(m, dtype=np.uint64)
    last = (np.uint64(1) << bits) - np.uint64(1)
    key = ((h >> bits) << bits) | (last - at)  # on ties the rightmost is smallest
    block = np.concatenate([key, np.full(-m % w, 2**64 - 1, np.uint64)]).reshape(-1, w)
    before = np.minimum.accumulate(block, axis=1).ravel()
    after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(after[:count], before[w - 1:w - 1 + count])
    ends = np.repeat(off[1:], np.diff(off))
    start = np.flatnonzero(np.arange(count) + length <= ends[:count])
    if not len(start):
        return none, none, none, none, none.view(np.uint64)
    own = least[start]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1))))
    size = np.diff(np.concatenate((first, [len(start)])))
    begin = start[first]
    anchor = (last - (own[first] & last)).astype(np.int64)
    row = np.searchsorted(off, begin, "right") - 1
    return row, begin - off[row], size, anchor - begin, h[anchor]


def _classes_of(length: int, chunk: int = CHUNK):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, _, raw, off in text_chunks(b.column(2), chunk):
                row, begin, size, anchor, h = window_classes(raw, off, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[row + i]), pa.array(k2[row + i]), pa.array(begin.astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(anchor.astype(np.int32)), pa.array(h.view(np.int64))],
                    ["k1", "k2", "begin", "size", "anchor", "h"])

    return run


def _spans_of(length: int, remember: int = 50_000):
    """(k1, k2, text, classes) to one row a class with its span's hash; the bytes go
    along where the task has not sent them lately."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            for r in range(b.num_rows):
                text = b.column(2)[r].as_py()
                classes = b.column(3)[r].values
                begin, size, anchor, h = (classes.field(i).to_numpy() for i in range(4))
                sh, spans = np.empty(len(begin), np.uint64), []
                for i, (x, n) in enumerate(zip(begin.tolist(), size.tolist(), strict=True)):
                    span = text[x:x + n - 1 + length]
                    s = sh[i] = xxhash.xxh3_64_intdigest(span)
                    s = int(s)
                    spans.append(None if s in sent else span)
                    sent.add(s)
                if len(sent) > remember:
                    sent.clear()
                k1, k2 = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(begin), k1, np.int64)), pa.array(np.full(len(begin), k2, np.int64)),
                     pa.array(begin), pa.array(size), pa.array(anchor), pa.array(h), pa.array(sh.view(np.int64)),
                     pa.array(spans, pa.binary())], ["k1", "k2", "begin", "size", "anchor", "h", "sh", "span"])

    return run


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Bytes that ``a`` and ``b`` have in common at the start, the first ``known`` being known."""
    m = min(len(a), len(b))
    x = int.from_bytes(a[known:m], "big") ^ int.from_bytes(b[known:m], "big")
    return m - (x.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """An ascending run as common prefixes with the one before, and tails."""
    lcp, tails, last = [], [], b""
    for s in strings:
        n = common(last, s)
        lcp.append(n)
        tails.append(s[n:])
        last = s
    return lcp, tails


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[bytes, int, int, int]]:
    """Front-coded ascending runs merged by a loser tree: string, common prefix with
    the one before, its run, its place in the run.

    A head carries its common prefix with the string put out last.  Of two heads the
    one with the longer prefix is smaller, without a look at the bytes; on equal
    prefixes they are compared from there on, and the loser keeps what was found.
    """
    k = 1
    while k < len(runs):
        k *= 2
    # state by run: string, or None at its end; place; prefix shared with the last output
    head: list[bytes | None] = [r[1][0] if r[1] else None for r in runs] + [None] * (k - len(runs))
    place, known = [0] * k, [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether the head of run a goes before that of b; the loser's prefix is then with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return x is not None
        if known[a] != known[b]:
            return known[a] > known[b]
        n = common(x, y, known[a])
        first = x[n:n + 1] <= y[n:n + 1]
        known[b if first else a] = n
        return first

    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        a, b = (a, b) if beats(a, b) else (b, a)
        losers[node] = b
        return a

    best = play(1)
    while head[best] is not None:
        s, i = head[best], place[best]
        yield s, known[best], best, i
        lcp, tails = runs[best]
        place[best] = i = i + 1
        if i < len(tails):  # the next of this run, told by its front code
            known[best] = lcp[i]
            head[best] = s[:lcp[i]] + tails[i]
        else:
            head[best] = None
        node = (best + k) // 2
        while node:
            if not beats(best, losers[node]):
                best, losers[node] = losers[node], best
            node //= 2


def repeated_windows(right: np.ndarray, left: np.ndarray, size: np.ndarray, anchor: np.ndarray,
                     length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of different spans with one anchor: first and last repeated byte offset
    windows (a, bytes before the anchor) as (largest a, smallest a); -1 if none.

    ``right``: common prefixes of neighbours in the suffix order; ``left``: an
    (order, common prefixes) table of the reversed bytes before the anchors.
    """
    g = len(right)
    most, least = np.full(g, -1), np.full(g, -1)
    order, lcp = left
    for a in range(int(anchor.max()) + 1):
        on = (anchor >= a) & (anchor - size < a)
        if on.sum() < 2:
            continue
        rights = np.cumsum(right < length - a)
        lefts = np.empty(g, np.int64)
        lefts[order] = np.cumsum(lcp < a)
        code = (rights * (g + 1) + lefts)[on]
        _, back, n = np.unique(code, return_inverse=True, return_counts=True)
        again = np.flatnonzero(on)[n[back] > 1]
        most[again] = a
        least[again] = np.where(least[again] < 0, a, least[again])
    return most, least


def repeated_windows_of_few(right: list[int], lefts: list[bytes], size: list[int], anchor: list[int],
                            length: int) -> tuple[list[int], list[int]]:
    """:func:`repeated_windows` by pairs: the common prefix of two suffixes is the
    smallest between them, and their equal windows are one range of a."""
    g = len(right)
    most, least = [-1] * g, [-1] * g
    for i in range(g):
        shared = length
        for j in range(i + 1, g):
            shared = min(shared, right[j])
            low = max(length - shared, anchor[i] - size[i] + 1)
            if low > anchor[i]:
                break  # it only gets shorter
            low = max(low, anchor[j] - size[j] + 1)
            high = min(anchor[i], anchor[j])
            if low <= high:
                high = min(high, common(lefts[i], lefts[j]))
                if low <= high:
                    for x in (i, j):
                        most[x] = max(most[x], high)
                        least[x] = low if least[x] < 0 else min(least[x], low)
    return most, least


def _sorted_runs(splitters: list[bytes]):
    """Different spans to this task's sorted, front-coded run for each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for h, sh, size, anchor, span in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows.append((span[anchor:], span[:anchor][::-1], h, sh, size, anchor))
            rows.sort()
            parts: dict[int, list] = {}
            for row in rows:
                parts.setdefault(bisect_right(splitters, row[0][:SEED]), []).append(row)
            out = []
            for part, own in parts.items():
                lcp, tails = front_coded([x[0] for x in own])
                out.append((part, lcp, tails, *([x[i] for x in own] for i in range(1, 6))))
            kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            cols = list(zip(*out, strict=True)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["part", "lcp", "tails", "lefts", "h", "sh", "size", "anchor"])

    return run


def _merged(length: int):
    """Runs of one range to (h, sh, low, high): repeated bytes of each span that has some."""

    def run(runs: pa.Table) -> pa.Table:
        cols = [c.to_pylist() for c in runs.select(["lcp", "tails", "lefts", "h", "sh", "size", "anchor"]).columns]
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple] = []

        def decide() -> None:
            if len(group) > PAIRS:
                right = np.array([x[0] for x in group])
                size, anchor = np.array([x[4] for x in group]), np.array([x[5] for x in group])
                order = sorted(range(len(group)), key=lambda i: group[i][1])
                left = np.array([0, *(common(group[i][1], group[j][1]) for i, j in zip(order[:-1], order[1:], strict=True))])
                most, least = (x.tolist() for x in repeated_windows(right, (np.array(order), left), size, anchor, length))
            else:
                right, lefts, size, anchor = ([x[i] for x in group] for i in (0, 1, 4, 5))
                most, least = repeated_windows_of_few(right, lefts, size, anchor, length)
            for x, a, b in zip(group, most, least, strict=True):
                if a >= 0:
                    out.append((x[2], x[3], x[5] - a, x[5] - b + length))
            group.clear()

        for _, lcp, r, i in merge_runs(list(zip(cols[0], cols[1], strict=True))):
            if lcp < SEED:
                decide()
            group.append((lcp, cols[2][r][i], cols[3][r][i], cols[4][r][i], cols[5][r][i], cols[6][r][i]))
        decide()
        c = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table({k: pa.array(v, t) for k, v, t in zip(
            ("h", "sh", "low", "high"), c, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)})

    return run


def window_string(h: int, span: bytes, anchor: int, at: int, length: int) -> bytes:
    """The window from ``at`` as it is sorted: anchor, bytes before the anchor, and those
    bytes from the anchor on, then those before it from right to left."""
    return (h.to_bytes(8, "big", signed=True) + (anchor - at + (1 << 31)).to_bytes(4, "big")
            + span[max(at, anchor):at + length] + span[at:anchor][::-1])


WINDOW_RUN = ("part int, lcp array<int>, tails array<binary>, h array<bigint>, sh array<bigint>, "
              "low array<int>, high array<int>")


def _window_runs(splitters: list[bytes], length: int):
    """Different spans to sorted, front-coded runs of their different windows for each range;
    part -1 holds the spans with windows that a run has twice, which need no merge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.list_(pa.int32()), pa.list_(pa.int32()))
        for b in batches:
            for lo in range(0, b.num_rows, RUN_SPANS):
                rows = sorted((window_string(h, span, anchor, at, length), sh, at, h) for h, sh, size, anchor, span in
                              zip(*(c.to_pylist() for c in b.slice(lo, RUN_SPANS).columns), strict=True) for at in range(size))
                parts: dict[int, list] = {}
                twice: dict[tuple[int, int], tuple[int, int]] = {}
                last = None
                for row in rows:
                    if last is not None and row[0] == last[0]:
                        for _, sh, at, h in (last, row):
                            low, high = twice.get((h, sh), (at, at))
                            twice[h, sh] = min(low, at), max(high, at)
                    else:
                        parts.setdefault(bisect_right(splitters, row[0]), []).append(row)
                    last = row
                out = []
                for part, own in parts.items():
                    lcp, tails = front_coded([x[0] for x in own])
                    out.append((part, lcp, tails, [x[3] for x in own], [x[1] for x in own], [x[2] for x in own],
                                [x[2] + length for x in own]))
                if twice:
                    out.append((-1, [], [], [h for h, _ in twice], [sh for _, sh in twice],
                                [x for x, _ in twice.values()], [x + length for _, x in twice.values()]))
                cols = list(zip(*out, strict=True)) if out else [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["part", "lcp", "tails", "h", "sh", "low", "high"])

    return run


class _Part:
    """Values ``lo`` to ``hi`` of a flat column, each made when it is asked for."""

    __slots__ = ("value", "lo", "n")

    def __init__(self, value, lo: int, hi: int) -> None:
        self.value, self.lo, self.n = value, lo, hi - lo

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int):
        return self.value(self.lo + i)


def _binary_values(column: pa.Array):
    """A function from place to value of a binary column without nulls, over its buffers."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:]
    data = memoryview(column.buffers()[2] or b"")
    return lambda i: data[off.item(i):off.item(i + 1)].tobytes()


def _merged_windows(runs: pa.Table) -> pa.Table:
    """Runs of one range to (h, sh, low, high): of each span the first and last of its windows that two runs hold.

    The runs stay in their Arrow columns: as Python values they take some ten times as much."""
    lists = {c: runs[c].combine_chunks() for c in ("lcp", "tails", "h", "sh", "low", "high")}
    ends = lists["tails"].offsets.to_numpy()
    value = {c: _binary_values(x.values) if c == "tails" else x.values.to_numpy().item for c, x in lists.items()}
    at = [(lo, hi) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    found: dict[tuple[int, int], tuple[int, int]] = {}

    def add(i: int) -> None:
        span, low, high = (value["h"](i), value["sh"](i)), value["low"](i), value["high"](i)
        a, b = found.get(span, (low, high))
        found[span] = min(a, low), max(b, high)

    last, again = -1, False
    for s, n, r, i in merge_runs([(_Part(value["lcp"], *x), _Part(value["tails"], *x)) for x in at]):
        place = at[r][0] + i
        same = last >= 0 and n == len(s)
        if same:
            if not again:
                add(last)
            add(place)
        last, again = place, same
    cols = [*zip(*found, strict=True), *zip(*found.values(), strict=True)] if found else [()] * 4
    return pa.table({k: pa.array(v, t) for k, v, t in zip(
        ("h", "sh", "low", "high"), cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)})


def _windows_merged(many: DataFrame, length: int) -> DataFrame:
    """``h, sh, low, high`` of the bytes repeated among the spans (h, sh, size, anchor, span; staged),
    window by window.  Splitters are windows of a sample of the spans, one of each."""
    parts = max(1, -(-(many.agg(F.sum("size")).first()[0] or 0) // WINDOW_PART))
    chosen = bounded_sample(many.select("sh", "h", "size", "anchor", "span"), "sh", splitter_sample(parts))
    sample = sorted(window_string(r.h, bytes(r.span), r.anchor, r.sh % r.size, length) for r in chosen.toLocalIterator()) \
        if parts > 1 else []
    splitters = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    runs = stage(many.select("h", "sh", "size", "anchor", "span").mapInArrow(_window_runs(splitters, length), WINDOW_RUN),
                 "window-runs")
    ranged = (runs.where("part >= 0").groupBy("part")
              .applyInArrow(_merged_windows, "h bigint, sh bigint, low int, high int"))
    own = (runs.where("part < 0").select(F.explode(F.arrays_zip("h", "sh", "low", "high")).alias("x")).select("x.*"))
    found = stage(ranged.unionByName(own).groupBy("h", "sh").agg(F.min("low").alias("low"), F.max("high").alias("high")),
                  "window-repeats")
    discard(runs)
    return found


def splitter_sample(parts: int) -> int:
    """Anchors to draw splitters from, some for each wanted part."""
    return max(SPLITTER_SAMPLE, 8 * parts)


def _decide(found: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """``h, sh, low, high`` of the bytes repeated among different spans of one anchor.

    ``spans`` has a row per span (h, sh, n), ``found`` its bytes, possibly several times."""
    kinds = spans.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    keys = stage(spans.join(kinds, "h").select("h", "sh", "kinds"), "open-spans")
    # one copy of a span leaves each task, and one goes on
    open_ = (found.where("span is not null").select("h", "sh", "size", "anchor", "span")
             .join(small_side(keys), ["h", "sh"]).groupBy("h", "sh", "kinds")
             .agg(F.first("size").alias("size"), F.first("anchor").alias("anchor"), F.max("span").alias("span")))
    few = open_.where(F.col("kinds") <= GROUP).select("h", "sh", "size", "anchor", "span")
    parts = max(1, -(-keys.where(F.col("kinds") <= GROUP).count() // PART))
    chosen = bounded_sample(keys.where(F.col("kinds") <= GROUP).select("h").distinct(), "h", splitter_sample(parts))
    seed = F.expr(f"substring(span, anchor + 1, {SEED})")
    sample = sorted(bytes(r[1]) for r in found.where("span is not null").select("h", seed.alias("s"))
                    .join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("s")).collect())
    splitters = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    merged = (few.mapInArrow(_sorted_runs(splitters), "part int, lcp array<int>, tails array<binary>, lefts array<binary>, "
                             "h array<bigint>, sh array<bigint>, size array<int>, anchor array<int>")
              .groupBy("part").applyInArrow(_merged(length), "h bigint, sh bigint, low int, high int"))
    if keys.where(F.col("kinds") > GROUP).limit(1).count() == 0:
        return merged
    many = stage(open_.where(F.col("kinds") > GROUP).select("h", "sh", "size", "anchor", "span"), "hot-spans")
    return merged.unionByName(_windows_merged(many, length))


def _cut(id_col: str):
    """(id, text, intervals) to the digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                text = b.column(1)[r].as_py()
                cuts = b.column(2)[r].values
                n = len(text)
                edge = np.zeros(n + 1, np.int32)
                np.add.at(edge, cuts.field(0).to_numpy(), 1)
                np.add.at(edge, cuts.field(1).to_numpy(), -1)
                on = np.cumsum(edge[:n]) > 0
                out.append((n, int(on.sum()), int(on[0]) + int((on[1:] & ~on[:-1]).sum()),
                            np.frombuffer(text, np.uint8)[~on].tobytes()))
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _with(rows: DataFrame, some: DataFrame, key: list[str]) -> DataFrame:
    """Rows that a staged table holds, with its columns.  Where its keys are few enough to
    broadcast, only the texts of those rows move."""
    return rows.join(small_side(some.select(*key)), key, "left_semi").join(some, key)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``<id_col>, n_bytes, n_removed, n_spans, kept`` (binary: the bytes left).

    Every byte covered by a ``length``-byte string that also starts anywhere else,
    in the same row or another, goes; strings never cross rows and are judged on
    the input.  Defined cases: a null or empty text has no bytes; texts shorter
    than ``length`` stay whole; repeated rows repeat each other and go, if
    long enough; ids may be null; other columns are ignored.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _removed(docs, id_col, text_col, length)


def _removed(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """:func:`remove_repeats`; no step that runs in workers is left to the reader of the result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = ["k1", "k2"]
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("k1"),
                       F.xxhash64(text).alias("k2"), text.cast("binary").alias("text"))
    classes = stage(rows.select(*key, "text").mapInArrow(
        _classes_of(length), "k1 bigint, k2 bigint, begin int, size int, anchor int, h bigint"), "classes")
    # staged, so that the join below reads plain exchanges, which Spark splits where an anchor is hot
    twice = stage(classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "twice")
    again = stage(classes.join(small_side(twice), "h").groupBy(*key)
                  .agg(F.collect_list(F.struct("begin", "size", "anchor", "h")).alias("classes")), "again")
    discard(classes)
    found = stage(_with(rows.select(*key, "text"), again, key).select(*key, "text", "classes").mapInArrow(
        _spans_of(length), "k1 bigint, k2 bigint, begin int, size int, anchor int, h bigint, sh bigint, span binary"), "spans")
    discard(again)
    spans = stage(found.groupBy("h", "sh").agg(F.count("*").alias("n"), F.first("size").alias("size")), "span-kinds")
    whole = spans.where("n > 1").select("h", "sh", F.lit(0).alias("low"), (F.col("size") + (length - 1)).alias("high"))
    repeats = stage(whole.unionByName(_decide(found, spans, length)), "repeats")
    cuts = stage(found.select(*key, "begin", "h", "sh").join(repeats, ["h", "sh"])
            .groupBy(*key).agg(F.collect_set(F.struct((F.col("begin") + F.col("low")).alias("low"),
                                                      (F.col("begin") + F.col("high")).alias("high"))).alias("cuts")), "cuts")
    discard(found)
    keys = small_side(cuts.select(*key))
    cut = stage(_with(rows, cuts, key).select("id", "text", "cuts").mapInArrow(
        _cut(id_col), f"{id_col} bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"), "cut-rows")
    none = F.lit(0).cast("bigint")
    whole_rows = rows.join(keys, key, "left_anti").select(
        F.col("id").alias(id_col), F.length("text").cast("bigint").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.col("text").alias("kept"))
    return cut.unionByName(whole_rows)


def query(spark, sf_dir) -> DataFrame:
    out = remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The digest of each text by counting every window; for tests."""
    seen: dict[bytes, int] = {}
    texts = [t or b"" for t in texts]
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        on = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                on[i:i + length] = True
        left = bytes(x for x, gone in zip(t, on, strict=False) if not gone)
        out.append((len(t), int(on.sum()), int((on[1:] & ~on[:-1]).sum()) + bool(on[0]), hashlib.sha256(left).hexdigest()))
    return out
