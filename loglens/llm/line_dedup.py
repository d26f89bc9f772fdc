"""Line dedup with DataFrame functions only.

Normalised lines are exploded and hashed, distinct documents are counted per
hash, and the lines of hashes found in enough documents go, except in the
smallest document id that holds them.  What is left is put together by position.
Only hashes, ids and positions are shuffled for that; the text moves once, in
the join with its dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import LOWER, UPPER, WHITE, lower_ascii, read, small_side, stage

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10, min_docs: int = 2, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: ``<id_col>, n_lines, n_dropped, kept`` (the text left)
    and the columns named in ``extra``.

    A line takes part if its key has at least ``min_chars`` code points; a key
    in at least ``min_docs`` documents loses all its lines except those in the
    smallest id.  Keys are told apart by 128 bits of hash.  Defined cases: a
    null or empty text is one empty line; rows that share an id are one
    document (each row is returned); a row without an id is returned as it is
    and counts for nothing; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       *[F.col(c).alias(f"extra_{c}") for c in extra])
    rows = rows.withColumn("body", F.xxhash64("text"))  # rows may share an id but not the text
    lines = (rows.select("id", "body", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .select("id", "body", "pos", line_key(F.col("line")).alias("key"))
             .where(F.col("id").isNotNull() & (F.char_length("key") >= min_chars))
             .select("id", "body", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(1), "key").alias("h2")))
    # (key, document) first: a line that a third of all documents hold is
    # dealt out by document, and counted per task before it meets
    found = (lines.groupBy(*KEY, "id").agg(F.lit(1).alias("one"))
             .groupBy(*KEY).agg(F.count("one").alias("n_docs"), F.min("id").alias("keeper"))
             .where(F.col("n_docs") >= min_docs).select(*KEY, "keeper"))
    # staged, so that the join below reads plain exchanges, which Spark splits where a line is hot
    found = small_side(stage(found, "found-lines"))
    dropped = (lines.join(found, KEY).where(F.col("id") != F.col("keeper"))
               .groupBy("id", "body").agg(F.collect_set("pos").alias("gone")))
    joined = rows.join(dropped, ["id", "body"], "left")
    # the outer one-element transform binds the split lines once per row
    kept = F.transform(
        F.array(F.split("text", "\n")),
        lambda ls: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")),
            lambda p: F.get(ls, p)), "\n"))
    return joined.select(
        F.col("id").alias(id_col),
        (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.get(kept, F.lit(0))).alias("kept"),
        *[F.col(f"extra_{c}").alias(c) for c in extra])


def query(spark, sf_dir) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{LOWER}') AS key FROM l),
f AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
  FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
