"""URL filters with DataFrame functions only: host rules, and a character
language-model ratio for the URLs that no rule fits.

URLs that the rules allow or block teach two variable-order Markov models over
``SYMBOLS`` folded characters.  A symbol's probability mixes the orders 0 to 2 by
Witten-Bell weights (a context counts by its occurrences against its kinds of
successors) down to a uniform floor.  A URL's score is the mean over its
symbols of log P(allowed) - log P(blocked), in millionths; it is allowed if the
score reaches the cut that gives the training URLs the best balanced accuracy.

The log ratios are one table of (SYMBOLS + 1) ** 3 numbers however many URLs there
are.  It enters the plan as an array constant, so scoring is a projection: URLs
are neither exploded nor shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglens.llm.common import LOWER, lower_ascii, read, stage

#: Host, path and verdict of the contract's rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Symbols 1 to 40: letters, any digit as 0, marks, anything else as !; 0 stands before the URL.
ALPHABET = LOWER + "0./-_:?=&#%~+!"
SYMBOLS = len(ALPHABET)
BASE, BINS, UNIT = SYMBOLS + 1, 1000, 1_000_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null.

    A rule's text is its host and path; of equal lengths the first in ``rules`` wins."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def symbols(url: Column) -> Column:
    """The URL as an array of symbol numbers."""
    low = F.translate(lower_ascii(F.coalesce(url, F.lit(""))), "123456789", "0" * 9)
    chars = F.filter(F.split(low, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c))
                       .otherwise(F.lit(SYMBOLS)))


def gram_counts(urls: DataFrame) -> DataFrame:
    """``gram, allow, block``: training counts of each context and symbol found in ``urls``
    (s: symbols, verdict: null where no rule fits)."""
    first, second = F.concat(F.array(F.lit(0), F.lit(0)), "s"), F.concat(F.array(F.lit(0)), "s")
    pairs = F.zip_with(F.slice(first, F.lit(1), F.size("s")), F.slice(second, F.lit(1), F.size("s")),
                       lambda a, b: a * BASE + b)
    grams = F.zip_with(pairs, F.col("s"), lambda ab, c: ab * BASE + c)
    return (urls.select("verdict", F.explode(grams).alias("gram")).groupBy("gram")
            .agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("allow"),
                 F.count(F.when(F.col("verdict") == "block", 1)).alias("block")))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram, ratio``: log P(allow) - log P(block) of a gram's last symbol, in units."""
    prob = {}
    for kind in ("allow", "block"):
        p = F.lit(1.0 / SYMBOLS)
        for k in range(3):
            suffix = F.col("gram") % BASE ** (k + 1)
            context = Window.partitionBy(F.floor(suffix / BASE)) if k else Window.partitionBy(F.lit(0))
            c = F.sum(kind).over(Window.partitionBy(suffix))
            t = F.sum(kind).over(context)
            d = F.size(F.collect_set(F.when(F.col(kind) > 0, suffix)).over(context))
            p = F.when(t > 0, (c + d * p) / (t + d)).otherwise(p)
        prob[kind] = p
    return counts.select("gram", F.round((F.log(prob["allow"]) - F.log(prob["block"])) * UNIT).cast("bigint").alias("ratio"))


def score(ratios: Column, s: Column) -> Column:
    """Mean ratio of the symbols ``s``; 0 for an empty URL."""
    start = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).cast("bigint").alias("sum"))
    total = F.aggregate(s, start, lambda st, x: F.struct(
        st["b"].alias("a"), x.alias("b"),
        (st["sum"] + F.get(ratios, (st["a"] * BASE + st["b"]) * BASE + x)).alias("sum")))["sum"]
    return F.when(F.size(s) > 0, F.floor(total / F.size(s))).otherwise(F.lit(0)).cast("bigint")


def calibrated_cut(scored: DataFrame) -> int:
    """The score from which a URL is allowed: the edge, of ``BINS`` between the lowest and
    the highest training score, with the best balanced accuracy (the lowest on ties).
    Without URLs of both verdicts it is 0."""
    known = scored.where(F.col("verdict").isNotNull())
    low, high, allow, block = known.agg(F.min("score"), F.max("score"), F.count(F.when(F.col("verdict") == "allow", 1)),
                                        F.count(F.when(F.col("verdict") == "block", 1))).first()
    if not allow or not block:
        return 0
    width = max(1, -(-(high - low + 1) // BINS))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (known.groupBy(F.floor((F.col("score") - low) / width).alias("bin"))
            .agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"),
                 F.count(F.when(F.col("verdict") == "block", 1)).alias("b"))
            .select("bin", F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a"),
                    F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b")))
    best = bins.orderBy(F.desc(F.col("b") / block - F.col("a") / allow), "bin").first()
    return low + best["bin"] * width


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Per row: ``<id_col>, host, path, rule, verdict, score``.

    ``verdict`` is the longest fitting rule's, else allow or block by the model.
    Defined cases: a null URL or one without ``://`` has an empty host and path
    (and is judged by its characters; an empty one scores 0); repeated URLs weigh by their
    rows in training; rules that allow nothing or block nothing leave a cut of 0;
    an empty table gives no rows; other columns are ignored.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = (rows.withColumn("by", rule_column(F.col("host"), F.col("path"), rules))
            .select("id", "host", "path", F.col("by.rule").alias("rule"), F.col("by.verdict").alias("verdict"),
                    symbols(F.col("url")).alias("s")))
    rows = stage(rows, "urls")
    table = [0] * BASE ** 3
    for gram, ratio in log_ratios(stage(gram_counts(rows), "grams")).collect():  # at most BASE ** 3 rows
        table[gram] = ratio
    ratios = F.from_json(F.lit(json.dumps(table)), "array<bigint>")  # folded to a constant
    scored = stage(rows.select("id", "host", "path", "rule", "verdict", score(ratios, F.col("s")).alias("score")), "scored")
    cut = calibrated_cut(scored)
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("verdict", by_model).alias("verdict"), "score")


def query(spark, sf_dir) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))
