"""MinHash near-dedup by a signature-coordinate inverted join.

Equal shingle sets are one class.  Each class posts itself under its
``COORDS`` coordinate-value pairs; classes whose sets have the asked Jaccard
similarity agree in a binomial number of coordinates, in at least ``matches``
of them (34 at a similarity of 0.8) but for one link in three million (``MISS``).  Hence:

* pairs found only once are dropped, and with them every class that has fewer
  than ``matches`` pairs left (it can have no partner);
* of the m pairs left, a class posts only its m - matches + 1 rarest (prefix);
  two classes that agree often enough share one of those, and the most
  frequent, longest lists are skipped;
* candidates are compared coordinate by coordinate, and those that agree often
  enough are confirmed on the full sets.

Lists of up to ``LIST`` classes give all their pairs.  A longer list pairs its
members with one hub, the member whose values are most frequent (the middle of
a group of copies).  Links make components; what still lies apart in a long
list is then compared in blocks, without a row per pair: its members outside
the largest component with that component and among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import join_hot, mix, read, shingle_sets, small_side, stage, text_chunks, with_rank

COORDS, LIST, BLOCK, MISS = 64, 32, 128, 1 / 3_000_000
_SEEDS = np.random.default_rng(6).integers(0, 2**62, (2, COORDS), dtype=np.uint64)


def matches(percent: int) -> int:
    """Coordinates in which sets of a similarity of ``percent`` % agree, but for a share of at most ``MISS``."""
    p, below = percent / 100, 0.0
    for m in range(COORDS + 1):
        below += comb(COORDS, m) * p ** m * (1 - p) ** (COORDS - m)
        if below > MISS:
            break
    if not m:
        raise ValueError(f"{COORDS} coordinates don't find all links at a similarity of {percent} %: ask for 21 or more")
    return m


def signature(s: np.ndarray) -> np.ndarray:
    """Per coordinate the smallest permuted shingle, marked with the coordinate."""
    out = np.full(COORDS, 2**64 - 1, np.uint64)
    for at in range(0, len(s), 2048):
        out = np.minimum(out, ((s[at:at + 2048, None] ^ _SEEDS[0]) * (_SEEDS[1] * np.uint64(2) + np.uint64(1))).min(0))
    return mix(out ^ np.arange(COORDS, dtype=np.uint64))


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h1, h2, sigs = [], [], [], []
            for _, _, raw, off in text_chunks(b.column(1)):
                for s in shingle_sets(raw, off, k):
                    n.append(len(s))
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    h1.append(d >> 64)
                    h2.append(d & (2**64 - 1))
                    sigs.append(signature(s) if len(s) else np.empty(0, np.uint64))
            flat = np.concatenate(sigs).view(np.int64) if sigs else np.empty(0, np.int64)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in sigs]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)),
                 pa.array(np.array(h2, np.uint64).view(np.int64)), b.column(2),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "n", "h1", "h2", "t", "sig"])

    return run


def _utf8(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Jaccard similarity of two ascending sets of at least ``percent`` %."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(col: pa.Array, k: int) -> list[np.ndarray]:
    return [s for _, _, raw, off in text_chunks(col) for s in shingle_sets(raw, off, k)]


def agreeing(pairs: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """Of candidate ``pairs`` (a, b) those that agree in ``least`` coordinates."""
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return (pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
            .where(agree >= least).select("a", "b"))


def confirm(near: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(x, y, percent) for x, y in zip(_sets(batch.column(2), k), _sets(batch.column(3), k), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = (near.join(texts.select(F.col("id").alias("a"), F.col("body").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("body").alias("tb")), "b"))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id reachable over ``edges`` (a, b), for ids with an edge.

    Labels fall to the smallest among the neighbours, then to the label's own
    label, until none changes; each round is staged, so its lineage is short.
    """
    both = stage(edges.select(F.col("a").alias("id"), F.col("b").alias("to"))
                 .unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to"))).distinct(), "edges")
    labels = stage(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        lower = (both.join(labels.select(F.col("id").alias("to"), "comp"), "to")
                 .groupBy("id").agg(F.min("comp").alias("near")))
        stepped = labels.join(lower, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        new = stage(stepped.join(jump, "comp", "left")
                    .select("id", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp")), "labels")
        labels = new.select("id", "comp")
        if new.where("comp <> old").limit(1).count() == 0:
            return labels


def _dealt(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (of, kind, id) dealt by hash into parts of about ``BLOCK`` ids each."""
    parts = rows.groupBy("of", "kind").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    return rows.join(parts, ["of", "kind"]).select("of", "kind", "id", F.pmod(F.xxhash64("id"), "parts").alias(name))


def _apart(long_lists: DataFrame, comps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Links across components among members of one long list, or None if no list
    holds two components.

    A list's members outside its largest component are asked against all members
    of that component (kind 0), and against all such members of its lists (kind 1),
    in blocks of ids: rows grow with the blocks, not with the pairs.
    """
    member = long_lists.join(comps, "id", "left").select("v", "id", F.coalesce("comp", "id").alias("comp"))
    per = member.groupBy("v", "comp").agg(F.count("*").alias("c"))
    main = (per.groupBy("v").agg(F.max_by("comp", F.struct("c", "comp")).alias("of"), F.count("*").alias("nc"))
            .where("nc > 1").select("v", "of"))
    rest = stage(member.join(main, "v").where("comp <> of").select("of", "id").distinct(), "apart")
    if rest.limit(1).count() == 0:
        return None
    kinds = F.explode(F.array(F.lit(0), F.lit(1))).alias("kind")
    asks = _dealt(rest.select("of", kinds, "id"), "turn")
    owners = rest.select("of").distinct()
    members = (texts.select("id").join(comps, "id", "left").select(F.coalesce("comp", "id").alias("of"), "id")
               .join(owners, "of").select("of", F.lit(0).alias("kind"), "id"))
    held = stage(_dealt(members.unionByName(rest.select("of", F.lit(1).alias("kind"), "id")), "block"), "held")
    asks = stage(asks, "asks")
    side = ["of", "kind"]
    held_rows = held.join(asks.select(*side, "turn").distinct(), side).withColumn("asks", F.lit(False))
    asking = asks.join(held.select(*side, "block").distinct(), side).withColumn("asks", F.lit(True))
    rows = held_rows.unionByName(asking).join(texts, "id")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = np.array(group["asks"].to_pylist(), bool)
        ids = group["id"].to_numpy()
        sets = _sets(group["body"].chunk(0), k) if len(ids) else []
        rows = np.flatnonzero(~asks)
        a, b = [], []
        if len(rows):
            flat = np.concatenate([sets[i] for i in rows])
            size = np.array([len(sets[i]) for i in rows])
            first = np.concatenate(([0], np.cumsum(size)[:-1]))
            for i in np.flatnonzero(asks):
                s = sets[i]
                at = np.minimum(np.searchsorted(s, flat), len(s) - 1)
                both = np.add.reduceat((s[at] == flat).astype(np.int64), first)
                on = 100 * both >= percent * (len(s) + size - both)
                a += [int(ids[i])] * int(on.sum())
                b += ids[rows[on]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (rows.groupBy("of", "kind", "block", "turn")
            .applyInArrow(run, "a bigint, b bigint").where("a <> b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: ``<id_col>, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z) runs without ASCII white space; a document's set
    is its distinct ``k``-word shingles, or the whole sequence if shorter.
    Documents are linked at a Jaccard similarity of ``percent`` % or more;
    ``component_id`` is the smallest id reachable.  A ``percent`` under 21, which
    the signatures cannot serve, is refused.  Defined cases: null, empty
    and blank texts have no set and are linked with nothing; rows that share an
    id are linked, whatever their texts (each is returned, kept or not by
    its component); a null id has the component null and is kept; other columns are ignored.
    """
    least = matches(percent)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), _utf8(text_col).alias("body"))
    rows = rows.withColumn("t", F.xxhash64("body"))  # rows may share an id but not the text
    signed = stage(rows.mapInArrow(_signed(k), "id bigint, n bigint, h1 bigint, h2 bigint, t bigint, sig array<bigint>"), "signed")
    named = signed.where((F.col("n") > 0) & F.col("id").isNotNull())
    key = ["h1", "h2"]
    # own, t: the row with the class's smallest id, which stands for it
    classes = stage(named.groupBy(*key).agg(F.min(F.struct("id", "t")).alias("row"), F.first("sig").alias("sig"))
                    .select(*key, F.col("row.id").alias("own"), F.col("row.t").alias("t"), "sig"), "classes")
    shared = stage(named.groupBy("id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in key for f in (F.min, F.max)])
                   .where("min_h1 <> max_h1 or min_h2 <> max_h2").select("id"), "shared-ids")
    some_shared = shared.limit(1).count() > 0
    if some_shared:  # an id doesn't name one class: classes are numbered in the order of their ids
        numbers = with_rank(classes.select(*key, "own"), [F.asc("own"), *map(F.asc, key)], "class-numbers", "id")
        classes = stage(classes.join(numbers.select(*key, "id"), key), "classes")
    else:
        classes = classes.withColumn("id", F.col("own"))
    posts = classes.select("id", F.explode("sig").alias("v"))
    # staged, so that the join below reads plain exchanges, which Spark splits where a value is hot
    often = stage(posts.groupBy("v").agg(F.count("*").alias("f")).where("f > 1"), "often")
    own = posts.join(often, "v").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("l"))
    live = stage(own.where(F.size("l") >= least).select(
        "id", F.aggregate("l", F.lit(0).cast("bigint"), lambda s, x: s + x["f"]).alias("middle"),
        F.slice(F.col("l.v"), F.lit(1), F.size("l") - (least - 1)).alias("prefix")), "live")
    lists = live.select("id", "middle", F.explode("prefix").alias("v"))
    sizes = stage(lists.groupBy("v").agg(F.count("*").alias("c")).where("c > 1"), "list-sizes")
    lists = stage(lists.join(small_side(sizes), "v"), "lists")
    short = (lists.where(F.col("c") <= LIST).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("m"))
             .select(F.explode(F.flatten(F.transform("m", lambda x: F.transform(
                 F.filter("m", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
             .select("p.a", "p.b"))
    long_ = lists.where(F.col("c") > LIST).select("v", "id", "middle")
    hubs = long_.groupBy("v").agg(F.max_by("id", F.struct("middle", -F.col("id"))).alias("hub"))
    spokes = (long_.join(hubs, "v").where("id <> hub")
              .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")))
    pairs = stage(short.unionByName(spokes).distinct(), "pairs")
    ids = lambda p: p.select(F.col("a").alias("id")).unionByName(p.select(F.col("b").alias("id")))
    # 15 bits of each coordinate do for counting agreements; the sets confirm
    short_sig = F.transform("sig", lambda x: x.bitwiseAND(F.lit(0x7FFF)).cast("smallint"))
    paired = stage(ids(pairs).distinct(), "paired")
    sigs = stage(classes.join(small_side(paired), "id").select("id", short_sig.alias("sig")), "sigs")
    near = stage(agreeing(pairs, sigs, least), "near-pairs")
    # texts are fetched only now: chance collisions are gone
    in_play = stage(ids(near).unionByName(long_.select("id")).distinct(), "in-play")
    wanted = stage(classes.join(small_side(in_play), "id").select("id", "own", "t"), "wanted")
    texts = stage(rows.withColumnRenamed("id", "own").join(small_side(wanted), ["own", "t"])
                  .groupBy("id").agg(F.first("body").alias("body")), "texts")
    edges = confirm(near, texts, k, percent)
    if some_shared:
        holds = stage(named.join(small_side(shared), "id").select(F.col("id").alias("doc"), *key).distinct()
                      .join(classes.select(*key, "id"), key).select("doc", "id"), "holds")
        first = holds.groupBy("doc").agg(F.min("id").alias("a"))
        edges = edges.unionByName(holds.join(first, "doc").where("a <> id").select("a", F.col("id").alias("b")))
    edges = stage(edges, "links")
    comps = components(edges)
    more = _apart(long_.select("v", "id"), comps, texts, k, percent)
    if more is not None:
        more = stage(more, "more-links")
        if more.limit(1).count():
            joined = edges.unionByName(more).unionByName(
                comps.where("id <> comp").select(F.col("comp").alias("a"), F.col("id").alias("b")))
            comps = components(joined)
    found = (classes.select(*key, "id").join(comps, "id", "left")
             .select(*key, F.coalesce("comp", "id").alias("component_id")))
    if some_shared:  # from the smallest number to the smallest id
        found = (join_hot(stage(found, "found"), classes.select(F.col("id").alias("component_id"), "own"), ["component_id"],
                          F.col("h1")).select(*key, F.col("own").alias("component_id")))
    grouped = join_hot(named.select("id", "n", *key), found, key, F.col("id")).select("id", "n", "component_id")
    alone = signed.where((F.col("n") == 0) | F.col("id").isNull()).select("id", "n", F.col("id").alias("component_id"))
    return grouped.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), k=2)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\f\r]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s
      JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
      WHERE x.doc_id <> y.doc_id AND least(p.n, q.n) * 100 >= 80 * greatest(p.n, q.n)
      GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*)))
, g(id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.a, g.near FROM g JOIN e ON e.b = g.id)
, c AS (SELECT id, min(near) AS comp FROM g GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.comp AS component_id, d.doc_id = c.comp AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
"""
