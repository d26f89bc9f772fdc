"""N-gram Jaccard join by signature trees.

Equal shingle sets are one class.  A class that another one is linked to shares most of its
shingles with it, so two exact counts come first and leave the sets that can have a partner:

* *live* classes: at least ``percent`` % of their shingles are held by another class too.  Shingles
  meet in parts of their hash; those repeated in a chunk of texts leave it once, without their classes;
* *families* of live classes: of its m repeated shingles a class that needs o in common posts the
  m - o + 1 rarest; linked classes share one of those, so they are in one family (reachable over shared posts).

Live sets are laid out by family and size and cut into blocks.  A block is a signature tree: a
leaf holds a set's token bitmap, a node the OR of its children's bitmaps, the range of their sizes
and the most tokens that share a bit in one of its sets.  A tree is joined with itself, and with
other blocks of its family, by dual traversal: a pair of nodes is followed only if the bits they have in common
allow the overlap that their smallest sets would need.  Leaf pairs are confirmed on the full
sets; pairs that other links already connect are left out.  Blocks of a family are joined with the
next one, then, if parts of the family still lie apart, wherever a traversal of the blocks' own signatures leads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import join_hot, read, shingle_sets, small_side, stage, text_chunks, tidied, with_rank
from loglens.llm.near_dup import components, linked

#: Bytes of texts read at once in a task, shingles aimed at in a part, sets in a block.
CHUNK, PART, BLOCK = 4_000_000, 1_000_000, 512
#: Classes whose counts travel together.
SPAN = 8192
#: Children of a node; leaf bitmaps have at least four bits a token up to MAX_BITS; bits of a block's signature.
FAN, MAX_BITS, BLOCK_BITS = 8, 1 << 16, 1 << 13


def _sets(col: pa.Array, k: int) -> list[np.ndarray]:
    return [s for _, _, raw, off in text_chunks(col) for s in shingle_sets(raw, off, k)]


def _sized(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h1, h2 = [], [], []
            for _, _, raw, off in text_chunks(b.column(1)):
                for s in shingle_sets(raw, off, k):
                    n.append(len(s))
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    h1.append(d >> 64)
                    h2.append(d & (2**64 - 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)),
                 pa.array(np.array(h2, np.uint64).view(np.int64)), b.column(2)], ["id", "n", "h1", "h2", "t"])

    return run


# --- live classes ------------------------------------------------------------

def _met(k: int, bits: int):
    """Tasks: per chunk and part (the first ``bits`` bits of a shingle) the next 48 bits of the shingles that one
    class of the chunk holds, with the class, and of those that several hold, without; and
    how many of the latter each class holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, _, _ in text_chunks(b.column(1), CHUNK):
                ids = b.column(0).slice(i, j - i).to_numpy()
                sets = _sets(b.column(1).slice(i, j - i), k)
                token = np.concatenate(sets)
                doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                order = np.argsort(token, kind="stable")
                token, doc = token[order], doc[order]
                start = np.flatnonzero(np.diff(token, prepend=~token[:1]))
                apart = np.minimum.reduceat(ids[doc], start) != np.maximum.reduceat(ids[doc], start) if len(start) else start > 0
                shared = np.repeat(apart, np.diff(start, append=len(token)))
                held = np.bincount(doc[shared], minlength=len(sets))
                token, one = token[start], np.where(apart, 0, doc[start] + 1)  # 0: several
                part = token >> np.uint64(64 - bits) if bits else np.zeros(len(token), np.uint64)
                rest = (token << np.uint64(bits)) >> np.uint64(16)
                cuts = np.flatnonzero(np.diff(part, prepend=~part[:1], append=~part[-1:])) if len(part) else [0]
                number = one.astype(np.uint16 if len(sets) < 1 << 16 else np.uint32)
                rows = [(int(part[x]), (rest[x:y] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                         np.diff(rest[x:y] >> np.uint64(32), prepend=np.uint64(0)).astype(np.uint16).tobytes(),
                         number[x:y].tobytes(), ids.tobytes(), None) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                if held.any():
                    rows.append((int(ids[0]) % (1 << bits), b"", b"", b"", ids[held > 0].tobytes(), held[held > 0].astype(np.int32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[c] for r in rows], pa.binary()) for c in range(1, 6))],
                    ["part", "low", "high", "one", "ids", "held"])

    return run


def _repeated(group: pa.Table) -> pa.Table:
    """Groups: how many shingles of a part each class has in common with others, packed by ``SPAN`` classes."""
    rest, ids, known, held = [], [], [], []
    for r in group.to_pylist():
        names = np.frombuffer(r["ids"], np.int64)
        if r["held"] is not None:
            known.append(names)
            held.append(np.frombuffer(r["held"], np.int32))
            continue
        low = np.frombuffer(r["low"], np.uint32).astype(np.uint64)
        high = np.cumsum(np.frombuffer(r["high"], np.uint16), dtype=np.uint64)
        one = np.frombuffer(r["one"], np.uint16 if len(r["one"]) == 2 * len(low) else np.uint32).astype(np.int64)
        rest.append(high << np.uint64(32) | low)
        ids.append(np.where(one > 0, names[one - 1], -1))  # -1: several; numbers of classes start at 0
    if rest:
        rest, ids = np.concatenate(rest), np.concatenate(ids)
        order = np.argsort(rest)
        rest, ids = rest[order], ids[order]
        start = np.flatnonzero(np.diff(rest, prepend=~rest[:1]))
        shared = np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)
        found = ids[np.repeat(shared, np.diff(start, append=len(rest))) & (ids >= 0)]
        known.append(found)
        held.append(np.ones(len(found), np.int32))
    known, at = np.unique(np.concatenate(known), return_inverse=True)
    m = np.bincount(at, np.concatenate(held)).astype(np.int32)
    span = known // SPAN
    cuts = np.flatnonzero(np.diff(span, prepend=-1, append=-1))
    return pa.table({"span": span[cuts[:-1]], "c": pa.array([(known[a:b] % SPAN).astype(np.uint16).tobytes() for a, b in zip(
        cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        "m": pa.array([m[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def _summed(group: pa.Table) -> pa.Table:
    """Groups: the sums over all parts, for ``SPAN`` classes."""
    c = np.frombuffer(b"".join(group["c"].to_pylist()), np.uint16)
    total = np.bincount(c, np.frombuffer(b"".join(group["m"].to_pylist()), np.int32), SPAN).astype(np.int64)
    some = np.flatnonzero(total)
    return pa.table({"c": some + group["span"][0].as_py() * SPAN, "m": total[some]})


def live_classes(texts: DataFrame, classes: DataFrame, k: int, percent: int, part: int | None = None) -> DataFrame:
    """Of ``classes`` (c, n) those with ``percent`` % of their shingles, or more, in another class of ``texts`` (c, body)."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, total / (part or PART))))))
    sent = texts.select("c", "body").mapInArrow(_met(k, bits), "part bigint, low binary, high binary, one binary, ids binary, held binary")
    held = (sent.groupBy("part").applyInArrow(_repeated, "span bigint, c binary, m binary")
            .groupBy("span").applyInArrow(_summed, "c bigint, m bigint"))
    return classes.join(held, "c").where(100 * F.col("m") >= percent * F.col("n")).drop("m")


def _tokens(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, _, _ in text_chunks(b.column(1), CHUNK):
                sets = _sets(b.column(1).slice(i, j - i), k)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["c", "s"])

    return run


def families(sets: DataFrame, percent: int) -> DataFrame:
    """``c, family``: live classes that share one of their rarest shingles with another, by what they reach so."""
    posts = sets.select("c", F.explode("s").alias("v"))
    often = stage(posts.groupBy("v").agg(F.count("*").alias("f")).where("f > 1"), "join-often")
    own = posts.join(often, "v").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("l"))
    need = F.ceil(F.col("n") * percent / 100).cast("int")
    lists = stage(own.join(sets.select("c", F.size("s").alias("n")), "c").where(F.size("l") >= need)
                  .select("c", F.explode(F.slice(F.col("l.v"), F.lit(1), F.size("l") - need + 1)).alias("v")), "join-posts")
    hubs = stage(lists.groupBy("v").agg(F.min("c").alias("a"), F.count("*").alias("f")).where("f > 1").select("v", "a"), "join-hubs")
    near = stage(lists.join(hubs, "v").where("c <> a").select("a", F.col("c").alias("b")).distinct(), "join-near")
    return components(near).select(F.col("id").alias("c"), F.col("comp").alias("family"))


# --- signature trees ---------------------------------------------------------

class SignatureTree:
    """Levels of nodes over ``sets`` (ascending token arrays) in their order, the leaves first: OR-combined
    bitmaps, ranges of sizes, most tokens beyond the bits they set, ranges of labels."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, bits: int):
        size = np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        bit = np.repeat(np.arange(len(sets)), size) * bits + (token & np.uint64(bits - 1)).astype(np.int64)
        bit = np.unique(bit)
        word, start = np.unique(bit >> 6, return_index=True)
        maps = np.zeros(len(sets) * bits // 64, np.uint64)
        maps[word] = np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), start)
        maps = maps.reshape(len(sets), -1)
        beyond = size - np.bitwise_count(maps).sum(1, dtype=np.int64)
        self.sets, self.levels = sets, [(maps, size, size, beyond, labels, labels)]
        while len(self.levels[-1][0]) > 1:
            at = np.arange(0, len(self.levels[-1][0]), FAN)
            self.levels.append(tuple(f.reduceat(x, at, axis=0) for f, x in zip(
                (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum), self.levels[-1], strict=True)))

    def level(self, depth: int) -> tuple:
        return self.levels[min(depth, len(self.levels) - 1)]


def bits_for(*groups: list[np.ndarray]) -> int:
    most = max(len(s) for sets in groups for s in sets)
    return min(MAX_BITS, max(64, 1 << (4 * most - 1).bit_length()))


def possible(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Node pairs that may hold a linked pair of sets of different labels."""
    out = np.zeros(len(i), bool)
    step = max(1, (1 << 19) // x[0].shape[1])
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        least_a = np.maximum(x[1][a], -(-percent * y[1][b] // 100))
        least_b = np.maximum(y[1][b], -(-percent * x[1][a] // 100))
        fits = (least_a <= x[2][a]) & (least_b <= y[2][b])
        fits &= (x[4][a] != x[5][a]) | (y[4][b] != y[5][b]) | (x[4][a] != y[4][b])
        a, b = a[fits], b[fits]
        most = np.bitwise_count(x[0][a] & y[0][b]).sum(1, dtype=np.int64) + np.minimum(x[3][a], y[3][b])
        most = np.minimum(most, np.minimum(x[2][a], y[2][b]))
        fits[fits] = (100 + percent) * most >= percent * (least_a + least_b)[fits]
        out[at:at + step] = fits
    return out


def dual_traversal(x: SignatureTree, y: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs (i, j) that pruning leaves; of a tree with itself those with i < j."""
    depth = max(len(x.levels), len(y.levels)) - 1
    i = j = np.zeros(1, np.int64)
    while True:
        a, b = x.level(depth), y.level(depth)
        ok = possible(a, i, b, j, percent)
        if x is y and depth == 0:
            ok &= i < j
        i, j = i[ok], j[ok]
        if depth == 0:
            return i, j
        depth -= 1
        for tree, side in ((x, 0), (y, 1)):
            if depth < len(tree.levels) - 1:  # a lower tree stays at its root
                of = (i, j)[side]
                child = of[:, None] * FAN + np.arange(FAN)
                there = child < len(tree.levels[depth][0])
                i, j = (np.broadcast_to(z[:, None], child.shape)[there] if s != side else child[there] for s, z in enumerate((i, j)))
        if x is y:
            ok = i <= j
            i, j = i[ok], j[ok]


def _top(labels: list[int], x: int) -> int:
    while labels[x] != x:
        labels[x] = labels[labels[x]]
        x = labels[x]
    return x


def joined(sets: list[np.ndarray], labels: np.ndarray, split: int, percent: int) -> list[tuple[int, int]]:
    """``labels`` that links between the sets bring together, each with the smallest of its group: links among
    all sets, or with ``split`` between the first ``split`` and the others."""
    names, label = np.unique(labels, return_inverse=True)
    tops = list(range(len(names)))

    def ask(i: int, j: int) -> None:
        a, b = _top(tops, int(label[i])), _top(tops, int(label[j]))
        if a != b and linked(sets[i], sets[j], percent):
            tops[max(a, b)] = min(a, b)

    # neighbours in size, and all with a middle one, connect most of a family of copies
    middle = (split or len(sets)) // 2
    for i in range(split, len(sets)):
        ask(i, middle)
        if not split and i:
            ask(i - 1, i)
    now = np.array([_top(tops, x) for x in range(len(tops))])[label]
    bits = bits_for(sets)
    if split:
        x, y = SignatureTree(sets[:split], now[:split], bits), SignatureTree(sets[split:], now[split:], bits)
    else:
        x = y = SignatureTree(sets, now, bits)
    for i, j in zip(*(z.tolist() for z in dual_traversal(x, y, percent)), strict=True):
        ask(i, j + split)
    return [(int(names[_top(tops, x)]), int(names[x])) for x in range(len(names)) if tops[x] != x]


def _linking(percent: int, sides: bool):
    """Groups of sets of one block (rows label, place, s), or of two (with side)."""

    def run(group: pa.Table) -> pa.Table:
        order = np.lexsort((group["place"].to_numpy(), group["side"].to_numpy())) if sides else np.argsort(group["place"].to_numpy())
        group = group.take(pa.array(order)).combine_chunks()
        lists = group["s"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten().to_numpy().view(np.uint64)
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        split = int((group["side"].to_numpy() == 0).sum()) if sides else 0
        links = joined(sets, group["label"].to_numpy(), split, percent) if split < len(sets) and (split or not sides) else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return run


def _signature(group: pa.Table) -> pa.Table:
    """Groups of one block: its signature, for a block's place in the tree of its family."""
    lists = group["s"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy().view(np.uint64)
    size = lists.value_lengths().to_numpy().astype(np.int64)
    bit = (flat & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
    own = np.bincount(np.unique(np.repeat(np.arange(len(size)), size) * BLOCK_BITS + bit) // BLOCK_BITS, minlength=len(size))
    maps = np.packbits(np.bincount(bit, minlength=BLOCK_BITS) > 0, bitorder="little").view(np.int64)
    label = group["label"].to_numpy()
    return pa.table({"family": group["family"][:1], "node": group["block"][:1], "bits": pa.array([maps], pa.list_(pa.int64())),
                     "lo": [size.min()], "hi": [size.max()], "beyond": [(size - own).max()], "first": [label.min()], "last": [label.max()]})


_NODE = "family bigint, node bigint, bits array<bigint>, lo bigint, hi bigint, beyond bigint, first bigint, last bigint"


def _parents(nodes: DataFrame) -> DataFrame:
    merged = F.reduce("all", F.array_repeat(F.lit(0).cast("bigint"), BLOCK_BITS // 64),
                      lambda s, x: F.zip_with(s, x, lambda a, b: a.bitwiseOR(b)))
    up = nodes.groupBy("family", F.floor(F.col("node") / FAN).cast("bigint").alias("node")).agg(
        F.collect_list("bits").alias("all"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("beyond").alias("beyond"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    return up.select("family", "node", merged.alias("bits"), "lo", "hi", "beyond", "first", "last")


def _follow(pairs: DataFrame, asks: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Of node ``pairs`` (family, i, j) those that may hold a link between different labels."""
    side = lambda nodes, name, p: nodes.select("family", F.col("node").alias(name), *[F.col(c).alias(p + c) for c in
                                                                                    ("bits", "lo", "hi", "beyond", "first", "last")])
    both = pairs.join(side(asks, "i", "x"), ["family", "i"]).join(side(held, "j", "y"), ["family", "j"])
    least = lambda p, q: F.greatest(p + "lo", F.ceil(F.col(q + "lo") * percent / 100))
    shared = F.reduce(F.zip_with("xbits", "ybits", lambda a, b: F.bit_count(a.bitwiseAND(b)).cast("bigint")), F.lit(0).cast("bigint"),
                      lambda s, x: s + x)
    most: Column = F.least(shared + F.least("xbeyond", "ybeyond"), "xhi", "yhi")
    same = (F.col("xfirst") == F.col("xlast")) & (F.col("yfirst") == F.col("ylast")) & (F.col("xfirst") == F.col("yfirst"))
    fits = (least("x", "y") <= F.col("xhi")) & (least("y", "x") <= F.col("yhi")) & ~same
    return both.where(fits & ((100 + percent) * most >= percent * (least("x", "y") + least("y", "x")))).select("family", "i", "j")


def block_pairs(asks: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """``family, i, j``: blocks of ``asks`` and ``held`` (rows family, block, label, s) that a dual traversal
    of the trees over their signatures leaves."""
    levels = [[stage(x.groupBy("family", "block").applyInArrow(_signature, _NODE), "join-nodes") for x in (asks, held)]]
    while max(x.groupBy("family").count().agg(F.max("count")).first()[0] or 0 for x in levels[-1]) > 1:
        levels.append([stage(_parents(x), "join-nodes") for x in levels[-1]])
    top = levels.pop()
    pairs = top[0].select("family", F.col("node").alias("i")).join(top[1].select("family", F.col("node").alias("j")), "family")
    pairs = stage(_follow(pairs, *top, percent), "join-pairs")
    for below in reversed(levels):
        kids = [x.select("family", F.floor(F.col("node") / FAN).cast("bigint").alias(p), F.col("node").alias(p + "k"))
                for x, p in zip(below, "ij", strict=True)]
        wider = pairs.join(kids[0], ["family", "i"]).join(kids[1], ["family", "j"]).select("family", F.col("ik").alias("i"), F.col("jk").alias("j"))
        pairs = stage(_follow(wider, *below, percent), "join-pairs")
    return pairs


def tree_links(sets: DataFrame, member: DataFrame, percent: int, block: int | None = None) -> DataFrame:
    """``a, b``: pairs of classes that connect ``sets`` (c, s) as all links within families (``member``: c, family) do."""
    sized = sets.select("c", F.size("s").alias("n")).join(member, "c")
    ranked = with_rank(sized, [F.asc("family"), F.asc("n"), F.asc("c")], "join-order", "place")
    places = stage(ranked.select("c", "family", "place", F.floor(F.col("place") / (block or BLOCK)).cast("bigint").alias("block")), "join-places")
    laid = stage(sets.join(places, "c").withColumn("label", F.col("c")), "join-laid")
    link = "a bigint, b bigint"
    links = stage(laid.select("label", "block", "place", "s").groupBy("block").applyInArrow(_linking(percent, False), link), "join-links")
    wide = stage(places.groupBy("family").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi"), "join-wide")
    if wide.limit(1).count() == 0:
        return links

    def labelled(of: DataFrame) -> DataFrame:
        comps = components(links).select(F.col("id").alias("c"), "comp")
        return stage(laid.drop("label").join(of, "family").join(comps, "c", "left").withColumn("label", F.coalesce("comp", "c"))
                     .select("c", "family", "block", "place", "label", "s"), "join-labelled")

    def ask(rows: DataFrame, *key: str) -> DataFrame:
        more = rows.select(*key, "side", "label", "place", "s").groupBy(*key).applyInArrow(_linking(percent, True), link)
        return stage(links.unionByName(stage(more, "join-more")), "join-links")

    now = labelled(wide)
    links = ask(now.withColumn("side", F.lit(0)).unionByName(
        now.withColumn("block", F.col("block") - 1).withColumn("side", F.lit(1))), "family", "block")
    # members outside a family's largest component are asked against all of the family
    now = labelled(wide)
    per = now.groupBy("family", "label").agg(F.count("*").alias("m"))
    main = stage(per.groupBy("family").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("k"))
                 .where("k > 1").select("family", "main"), "join-main")
    if main.limit(1).count() == 0:
        return links
    held = stage(now.join(main, "family"), "join-held")
    rest = held.where("label <> main")
    pairs = block_pairs(rest, held, percent)
    asks = pairs.join(rest.withColumnRenamed("block", "i"), ["family", "i"]).withColumn("side", F.lit(0))
    asked = pairs.join(held.withColumnRenamed("block", "j"), ["family", "j"]).withColumn("side", F.lit(1))
    return ask(asks.unionByName(asked), "family", "i", "j")


@tidied
def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                 part: int | None = None, block: int | None = None) -> DataFrame:
    """Per row: ``<id_col>, n_shingles, component_id``.

    Words are lower-cased (A-Z) runs without ASCII white space; a document's set is its distinct
    ``k``-word shingles, or the whole sequence if shorter.  Documents are linked at a Jaccard
    similarity of ``percent`` % or more, exactly; ``component_id`` is the smallest id reachable over links.
    Defined cases: null, empty and blank texts have no set and are linked with nothing; every row is a
    document of its own, also where ids or texts repeat (rows that share an id are linked by
    their texts only); a row without an id has a set, but is linked with nothing and has the component null;
    an empty table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), body.alias("body")).withColumn("t", F.xxhash64("body"))
    signed = stage(rows.mapInArrow(_sized(k), "id bigint, n bigint, h1 bigint, h2 bigint, t bigint"), "join-signed")
    named, key = signed.where((F.col("n") > 0) & F.col("id").isNotNull()), ["h1", "h2"]
    first = named.groupBy(*key).agg(F.min(F.struct("id", "t")).alias("row"), F.first("n").alias("n"))
    classes = stage(with_rank(first.select(*key, F.col("row.id").alias("id"), F.col("row.t").alias("t"), "n"),
                              [F.asc("id"), *map(F.asc, key)], "join-numbers", "c"), "join-classes")
    # rows that repeat an id and a text come as often; only a set's first copy is kept below
    texts = rows.join(small_side(classes.select("c", "id", "t")), ["id", "t"]).select("c", "body")
    live = stage(live_classes(texts, classes.select("c", "n", "id", "t"), k, percent, part), "join-live")
    few = rows.join(small_side(live.select("c", "id", "t")), ["id", "t"]).select("c", "body")
    sets = stage(few.mapInArrow(_tokens(k), "c bigint, s array<bigint>").groupBy("c").agg(F.first("s").alias("s")), "join-sets")
    links = tree_links(sets, families(sets, percent), percent, block)
    comps = components(links).select(F.col("id").alias("c"), "comp")
    own = classes.select(F.col("c").alias("comp"), F.col("id").alias("component_id"))
    found = stage(classes.select(*key, "c").join(comps, "c", "left").select(*key, F.coalesce("comp", "c").alias("comp")), "join-found")
    found = join_hot(found, own, ["comp"], F.col("h1")).select(*key, "component_id")
    grouped = join_hot(named.select("id", "n", *key), found, key, F.col("id")).select("id", "n", "component_id")
    alone = signed.where((F.col("n") == 0) | F.col("id").isNull()).select("id", "n", F.col("id").alias("component_id"))
    return grouped.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def query(spark, sf_dir) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\f\r]+') AS w FROM documents),
i AS (SELECT doc_id, len(w) AS m, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM w),
l AS (SELECT doc_id, m, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
      FROM i WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, concat_ws(' ', w, w1, w2, w3, w4) AS s FROM l WHERE w4 IS NOT NULL OR (m < 5 AND i = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s
      JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
      WHERE x.doc_id <> y.doc_id AND least(p.n, q.n) * 100 >= 80 * greatest(p.n, q.n)
      GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
g(id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.a, g.near FROM g JOIN e ON e.b = g.id),
c AS (SELECT id, min(near) AS comp FROM g GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.comp AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
"""
