"""Quality rules with a verdict per host.

Rules are counted inside every document; whether a host is fit follows from how many of its
documents fail. Small hosts say little, so rates are shrunk: failures are taken as binomial
with a beta prior fitted to the rates of all hosts, and the verdict goes by the posterior mean.
Only DataFrame functions are used; a document never leaves its row, and a host may hold any
share of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import BLANK, WORD, look_up
from zonal.operators.staging import stage

SYMBOL = r"[#*$%&|<>]"

MIN_WORDS = 50
REPEAT_PERCENT = 50

# A host whose shrunk failure rate is above this is not kept.
HOST_RATE = 0.5


def repeated_words(hashes: Column) -> Column:
    """Number of words that lie in a window of three words found twice or more, the first time
    included. `hashes` holds one 64-bit number per word. Most texts repeat no window, which a
    hash set tells; else windows are sorted with their places, and each place of a repeated
    window covers up to three words, fewer if the next such place is nearer."""

    def windows(h: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(h) - F.lit(3))
        return F.transform(first, lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        nothing = F.lit(None).cast("struct<w:bigint,i:int>")
        before = F.concat(F.array(nothing), F.slice(placed, 1, F.size(placed) - 1))
        after = F.concat(F.slice(placed, 2, F.size(placed) - 1), F.array(nothing))
        # the window before or after in sorted order is equal: the window is repeated
        marked = F.zip_with(
            F.zip_with(placed, before, lambda x, y: F.when(x["w"] == y["w"], x["i"])),
            F.zip_with(placed, after, lambda x, y: F.when(x["w"] == y["w"], x["i"])),
            lambda x, y: F.coalesce(x, y),
        )
        places = F.sort_array(F.filter(marked, lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        walk = F.aggregate(
            places,
            start,
            lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        )
        return walk["n"]

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))

    # a one-element transform names the windows once, so that they are not computed again per use
    once = F.transform(F.array(windows(hashes)), count)
    return F.when(F.size(hashes) < 3, F.lit(0)).otherwise(F.get(once, F.lit(0)))


def base_metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Per row of `docs` the columns `keep` and, as bigint: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words. NULL text has no words."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    rows = docs.select(
        *keep,
        F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
        lines.alias("lines"),
        (F.length(text) - F.regexp_count(text, F.lit(BLANK))).alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).alias("n_symbols"),
    )
    return rows.select(
        *keep,
        F.size("hashes").cast("bigint").alias("n_words"),
        F.col("word_chars").cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("hashes")).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def host_rates(hosts: DataFrame) -> DataFrame:
    """Hosts (host, n, failures) with `rate`, the posterior mean of the failure rate.

    The prior Beta(a, b) has the mean of all documents and, by moments, the spread that hosts'
    rates have beyond what their sizes explain; a prior weighs at most 1,000 documents, which is
    also its weight when hosts differ no more than chance allows."""
    n, failures = F.col("n").cast("double"), F.col("failures").cast("double")
    sums = hosts.agg(
        F.sum(n).alias("docs"),
        F.sum(failures).alias("failed"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n * n).alias("n2"),
        F.sum(failures * failures / n).alias("f2"),
    )
    mean = F.try_divide("failed", F.col("docs"))
    # one-way analysis of variance for proportions: between-host variance beyond the binomial
    between = F.try_divide(F.col("f2") - F.col("docs") * mean * mean, F.col("hosts") - 1)
    within = F.try_divide(F.col("failed") - F.col("f2"), F.col("docs") - F.col("hosts"))
    size = F.try_divide(F.col("docs") - F.try_divide("n2", F.col("docs")), F.col("hosts") - 1)
    extra = F.greatest(F.lit(0.0), F.try_divide(between - within, size))
    weight = F.least(F.lit(1000.0), F.coalesce(F.try_divide(mean * (1 - mean), extra) - 1, F.lit(1000.0)))
    prior = sums.select(mean.alias("mean"), F.greatest(F.lit(1.0), weight).alias("weight"))
    # one row
    rated = hosts.join(F.broadcast(prior), how="left")
    rate = (failures + F.col("mean") * F.col("weight")) / (n + F.col("weight"))
    return rated.withColumn("rate", rate).drop("mean", "weight")


def judge(docs: DataFrame, host: Column, limit: float = HOST_RATE) -> DataFrame:
    """One row per document row: doc_id, the five counts, base_failed, host_rate, kept.

    A document is kept when it passes the base rules and its host's shrunk failure rate is not
    above `limit`. `host` is any expression; documents with a NULL host stand on their own: their
    host_rate is NULL and only the base rules count. NULL or empty text fails for want of words.
    Repeated rows count each time. No documents: no rows. Other columns are ignored."""
    counts = base_metrics(docs.withColumn("judged_host", host), ["doc_id", "judged_host"])
    rows = stage(counts.withColumn("base_failed", base_failed()))
    hosts = rows.where(F.col("judged_host").isNotNull()).groupBy("judged_host")
    hosts = stage(hosts.agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failures")))
    total = hosts.agg(F.sum("n")).first()[0] or 0
    rated = host_rates(hosts).select("judged_host", F.col("rate").alias("host_rate"), "n")
    judged = look_up(rows, stage(rated), "judged_host", total)
    kept = ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= F.lit(limit))
    return judged.withColumn("kept", kept).drop("judged_host")
