"""Large JSON log files, read in pieces by many tasks.

A file is read as text records that end at ``}``, so one file of any size is dealt out over
its splits, whatever its line breaks.  Whether a record starts inside a string, and how
deep its brackets are nested, follows from the records before it: running sums
inside a split (for both cases of its start), then a carry over the few splits of a file.  A record
whose ``}`` returns to the depth of the file's elements ends an event; the events before it
number it.  An event is parsed alone, by the expressions of the whole-file parser.

The contract is the whole-file parser's: a file is one JSON array of objects (``null`` elements
count as positions and give no event) or one object.  Anything else (a second value, an element of another
kind, a missing bracket or comma, a malformed event) sets the whole file aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglens.plans.materialize import materialize, tidied
from loglens.session import few_listing_tasks

_WS = "[ \\t\\r\\n]*"
_FILE = ["file_path", "file_name", "file_modified"]


def _records(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool) -> DataFrame:
    """One row per piece of text up to a ``}``, which is left out."""
    few_listing_tasks(spark)
    opts = {"lineSep": "}"}
    if glob:
        opts["pathGlobFilter"] = glob
    if recursive:
        opts["recursiveFileLookup"] = True
    meta = {"file_path": "file_path", "file_name": "file_name", "file_modified": "file_modification_time",
            "file_size": "file_size", "block": "file_block_start"}
    return spark.read.text(path, **opts).select(
        *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()], F.monotonically_increasing_id().alias("id"), "value")


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _change(text: Column, outside: Column) -> Column:
    """Change of depth over a record without escapes whose strings are closed, or open at its end;
    ``outside``: its ``}`` is not in a string."""
    bare = F.regexp_replace(F.regexp_replace(text, r'"[^"]*"', ""), r'"[^"]*$', "")
    return _count(bare, "[{") - _count(bare, "]}") - F.when(outside, 1).otherwise(0)


def _located(records: DataFrame) -> DataFrame:
    """Records with running sums over their split: ``ql`` quotes before (mod 2) and, for a split that starts
    outside (0) or inside (1) a string, the change of depth before (``r``) and in it (``f``)."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    odd = _count(plain, '"') % 2
    before = Window.partitionBy("file_path", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    run = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    d = (records.withColumn("odd", odd).withColumn("e0", _change(plain, F.col("odd") == 0))
         .withColumn("e1", _change(F.regexp_replace(plain, r'^[^"]*("|\z)', ""), F.col("odd") == 1))
         .withColumn("ql", run("odd") % 2))
    for start in (0, 1):
        d = d.withColumn(f"f{start}", F.when(F.col("ql") == start, F.col("e0")).otherwise(F.col("e1")))
        d = d.withColumn(f"r{start}", run(f"f{start}"))
    return d.withColumn("number", F.row_number().over(Window.partitionBy("file_path", "block").orderBy("id"))).drop("e0", "e1")


def _carried(located: DataFrame) -> DataFrame:
    """Per split: string state and depth at its start, and what holds for its file."""
    splits = materialize(located.groupBy("file_path", "block").agg(
        F.sum("odd").alias("odd"), F.sum("f0").alias("d0"), F.sum("f1").alias("d1"), F.max("number").alias("last"),
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.first("file_size").alias("file_size"),
        F.min_by(F.col("value").rlike(f"^{_WS}\\["), "number").alias("array")), "json-splits")
    of_file, order = Window.partitionBy("file_path"), Window.partitionBy("file_path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    run = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return (splits.withColumn("qs", run("odd") % 2)
            .withColumn("ds", run(F.when(F.col("qs") == 0, F.col("d0")).otherwise(F.col("d1"))))
            .withColumn("base", F.max(F.when((F.col("block") == 0) & F.col("array"), 1).otherwise(0)).over(of_file))
            # the file ends behind a }, or its last record lacks one
            .withColumn("open", F.sum("bytes").over(of_file) == F.col("file_size") + 1)
            .withColumn("last", F.when(F.col("block") == F.max("block").over(of_file), F.col("last")).otherwise(-1))
            .select("file_path", "block", "qs", "ds", "base", "open", "last"))


def _cut(located: DataFrame, carried: DataFrame) -> DataFrame:
    """Records with the number of their event in the file, its position, and whether they start and end it."""
    order = Window.partitionBy("file_path", "block").orderBy("id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here = lambda c: F.when(F.col("qs") == 0, F.col(c + "0")).otherwise(F.col(c + "1"))
    lead = F.regexp_extract("value", r"^([^{\"]*)", 1)
    rows = located.join(carried, ["file_path", "block"])
    rows = (rows.withColumn("depth", F.col("ds") + here("r")).withColumn("quoted", (F.col("ql") + F.col("qs")) % 2)
            .withColumn("tail", F.col("open") & (F.col("number") == F.col("last"))))
    rows = (rows.withColumn("ends", ~F.col("tail") & ((F.col("quoted") + F.col("odd")) % 2 == 0)
                            & (F.col("depth") + here("f") == F.col("base")))
            .withColumn("starts", ((F.col("block") == 0) & (F.col("number") == 1))
                        | ((F.col("quoted") == 0) & (F.col("depth") == F.col("base"))))
            .withColumn("nulls", F.when(F.col("starts"), F.regexp_count(lead, F.lit("null"))).otherwise(0)))
    rows = (rows.withColumn("event", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
            .withColumn("skipped", F.sum("nulls").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    rows = materialize(rows.select(*_FILE, "block", "number", "value", "base", "open", "tail", "starts", "ends", "event", "skipped", "nulls"),
                       "json-records")
    by_split = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("file_path", "block").agg(F.sum(F.col("ends").cast("int")).alias("e"), F.sum("nulls").alias("s"))
               .withColumn("e0", F.coalesce(F.sum("e").over(by_split), F.lit(0)))
               .withColumn("s0", F.coalesce(F.sum("s").over(by_split), F.lit(0))).select("file_path", "block", "e0", "s0"))
    return (rows.join(offsets, ["file_path", "block"]).withColumn("event", F.col("event") + F.col("e0"))
            .withColumn("skipped", F.col("skipped") + F.col("s0")).drop("e0", "s0", "nulls"))


def _fits(value: Column, base: Column, event: Column) -> Column:
    """What stands before the ``{`` of an event: the array's bracket or a comma, then only nulls."""
    lead = F.regexp_extract(value, r"^([^{\"]*)\{", 1)
    rest = F.regexp_replace(lead, f"null{_WS},", "")
    first = F.when(base == 1, lead.rlike(f"^{_WS}\\[") & rest.rlike(f"^{_WS}\\[{_WS}\\z")).otherwise(lead.rlike(f"^{_WS}\\z"))
    later = (base == 1) & lead.rlike(f"^{_WS},") & rest.rlike(f"^{_WS},{_WS}\\z")
    return value.rlike(r"^[^{\"]*\{") & F.when(event == 0, first).otherwise(later)


def _closes(value: Column, base: Column, events: Column) -> Column:
    """What stands behind the last event, or is all of a file without one."""
    rest = F.regexp_replace(value, f",{_WS}null", "")
    tail = rest.rlike(f"^{_WS}\\]{_WS}\\z") & value.rlike(f"\\]{_WS}\\z")
    alone = rest.rlike(f"^{_WS}\\[{_WS}(null{_WS})?\\]{_WS}\\z") & ~value.rlike(f"^{_WS}\\[{_WS},")
    blank = (events == 1) & value.rlike(f"^{_WS}\\z")
    return F.when(base == 0, blank).when(events == 0, alone).otherwise(tail)


def split_files(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool, parsed) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, parsed events and good files (``file_path``).  ``parsed`` gives the events of a
    text, null if it is not what it must be."""
    located = _located(_records(spark, path, glob, recursive))
    records = _cut(located, _carried(located))
    per_event = ["file_path", "event"]
    alone = F.col("starts") & F.col("ends")
    body = F.regexp_replace("value", r"^[^{\"]*", "")
    whole = records.where(alone).select(*_FILE, "event", "skipped", _fits(F.col("value"), F.col("base"), F.col("event")).alias("fits"),
                                        F.lit(True).alias("complete"), F.concat(body, F.lit("}")).alias("text"))
    # only events of several records move: a } in a string, or a nested object
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("block", "number", F.when(F.col("starts"), body).otherwise(F.col("value")).alias("v")))),
                         lambda x: x["v"])
    broken = (records.where(~alone).groupBy(*per_event).agg(
        *[F.first(c).alias(c) for c in _FILE[1:]], F.max("skipped").alias("skipped"),
        F.coalesce(F.bool_and(F.when(F.col("starts"), _fits(F.col("value"), F.col("base"), F.col("event")))), F.lit(False)).alias("fits"),
        F.bool_or("ends").alias("complete"), F.concat(F.array_join(pieces, "}"), F.lit("}")).alias("text"))
        .where("complete").select(*whole.columns))
    events = materialize(whole.unionByName(broken).select(
        *_FILE, (F.col("event") + F.col("skipped")).cast("bigint").alias("pos"), "fits", parsed(F.col("text")).alias("e")), "json-events")
    counts = events.groupBy("file_path").agg(F.count("*").alias("n"), F.bool_and(F.col("fits") & F.col("e").isNotNull()).alias("ok"))
    ended = records.groupBy("file_path").agg(F.max("base").alias("base"), F.sum(F.col("ends").cast("int")).alias("events"),
                                             F.max_by(F.struct("value", "tail", "event"), F.struct("block", "number")).alias("end"),
                                             F.sum(F.when(F.col("ends"), 0).otherwise(1)).alias("others"))
    rest = (records.join(ended.select("file_path", "events"), "file_path").where("event = events").groupBy("file_path")
            .agg(F.count("*").alias("left")))
    closed = (F.when(F.col("left").isNull(), (F.col("base") == 0) & (F.col("events") == 1))
              .otherwise((F.col("left") == 1) & F.col("end.tail") & _closes(F.col("end.value"), F.col("base"), F.col("events"))))
    good = (ended.join(rest, "file_path", "left").join(counts, "file_path", "left")
            .where(closed & F.coalesce("ok", F.lit(True)) & (F.coalesce("n", F.lit(0)) == F.col("events"))).select("file_path"))
    return records, events, materialize(good, "json-good")


@tidied
def read_events(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool, parsed) -> DataFrame:
    """``file_path, file_name, file_modified, pos, e`` (a struct) of the well-formed files' events."""
    _, events, good = split_files(spark, path, glob, recursive, parsed)
    return events.join(good, "file_path", "left_semi").select(*_FILE, "pos", F.col("e")[0].alias("e"))


@tidied
def malformed_files(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool, parsed) -> DataFrame:
    """``file_path, file_name, file_modified, value``: the other files, with their text."""
    records, _, good = split_files(spark, path, glob, recursive, parsed)
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("block", "number", "value"))), lambda x: x["value"])
    return (records.join(good, "file_path", "left_anti").groupBy(*_FILE)
            .agg(F.array_join(pieces, "}").alias("text"), F.first("open").alias("open"))
            .select(*_FILE, F.when(F.col("open"), F.col("text")).otherwise(F.concat("text", F.lit("}"))).alias("value")))
