"""Quality by importance resampling.

Two generative models of hashed n-grams, one of texts labelled good and one of all texts, give
every document an importance weight: the ratio of its probabilities under the two. A sample
without replacement in proportion to the weights is the top k of log weight plus Gumbel noise.
How many are drawn, k, is the number of good documents to be expected, read off the labelled
ones among documents of like weight.

n-grams are of two kinds: words (one and two in a row) and shapes (one to three in a row): a
word's shape is its use of capitals and digits, a mark's shape is the mark itself. Two equal
words in a row are one and the same bigram, whatever the word.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import in_order, pieces, released, ship, small_batches
from zonal.llm.words import Tokens, mixed
from zonal.operators.staging import stage

BUCKETS = 1 << 15

# Most labelled rows that the model is fitted on; the table of all texts has no such limit.
MAX_LABELS = 50_000

# Weight of the model of all texts inside that of the good ones, in n-grams per bucket: where
# little is known about a bucket, the ratio is near 1.
PRIOR = 20.0


def features(tokens: Tokens):
    """Bucket and text number of every n-gram."""
    word, doc = tokens.hash, tokens.doc
    shape = np.where(
        tokens.mark,
        word,
        np.where(
            tokens.digit,
            np.uint64(5),
            np.where(
                (tokens.upper == tokens.length) & (tokens.length > 1),
                np.uint64(4),
                np.where(tokens.upper > tokens.first_upper, np.uint64(3), np.where(tokens.first_upper, np.uint64(2), np.uint64(1))),
            ),
        ),
    )
    shape = mixed(shape, 1)
    second = doc[1:] == doc[:-1]
    third = second[1:] & second[:-1]
    three = np.uint64(3)
    pair = np.where(word[1:] == word[:-1], np.uint64(7), word[:-1] * three + word[1:])
    shapes2 = shape[:-1] * three + shape[1:]
    shapes3 = shapes2[:-1] * three + shape[2:]
    grams = [mixed(word, 2), mixed(pair[second], 3), shape, mixed(shapes2[second], 4), mixed(shapes3[third], 5)]
    docs = [doc, doc[1:][second], doc, doc[1:][second], doc[2:][third]]
    return (np.concatenate(grams) % np.uint64(BUCKETS)).astype("i8"), np.concatenate(docs)


def gumbel(ids, texts, seed: int):
    """Standard Gumbel noise fixed by seed, doc_id and text."""
    import xxhash

    def one(i, t):
        return xxhash.xxh3_64_intdigest(t or b"", seed=seed) ^ (0 if i is None else int(i) & 0xFFFFFFFFFFFFFFFF)

    import pyarrow as pa

    raw = np.array([one(i, t) for i, t in zip(ids.to_pylist(), texts.cast(pa.large_binary()).to_pylist())], dtype="u8")
    u = ((mixed(raw, seed) >> np.uint64(11)).astype("f8") + 0.5) / float(1 << 53)
    return -np.log(-np.log(u))


@dataclass
class Importance:
    """A fitted model: n-grams per bucket in all texts and in the good ones, and the sample of
    labelled rows. A text is scored against the counts of all other texts: its own n-grams are in
    the model of all texts, and in that of the good ones only if it is labelled, and would else
    speak for labelled texts and against others."""

    every: np.ndarray
    target: np.ndarray
    ids: np.ndarray
    good: np.ndarray
    seed: int = 1
    temperature: float = 1.0
    threshold: float = field(default=float("-inf"))

    def score(self, batch, at: int, text: int):
        """log weight, key (with noise), n-grams and label (1, 0, -1 for none) per row."""
        texts, ids = batch.column(text), batch.column(at)
        held = ids.fill_null(0).to_numpy(zero_copy_only=False)
        place = np.searchsorted(self.ids, held)
        known = (place < len(self.ids)) & ids.is_valid().to_numpy(zero_copy_only=False)
        known[known] &= self.ids[place[known]] == held[known]
        label = np.full(len(texts), -1, dtype="i4")
        label[known] = self.good[place[known]]
        weight, count = np.zeros(len(texts)), np.zeros(len(texts), dtype="i8")
        for first, last in pieces(texts, 1 << 19):
            bucket, doc = features(Tokens(texts.slice(first, last - first)))
            count[first:last] = np.bincount(doc, minlength=last - first)
            weight[first:last] = self.log_ratio(bucket, doc, count[first:last], label[first:last] == 1)
        key = np.round(weight + self.temperature * gumbel(ids, texts, self.seed), 6)
        # a text without any n-gram says nothing good about itself
        key[count == 0] = -np.inf
        return weight, key, count, label


    def log_ratio(self, bucket, doc, count, fine):
        """Sum over a text's n-grams of the log ratio of the two models without that text."""
        pairs, own = np.unique(doc * BUCKETS + bucket, return_counts=True)
        doc, bucket = pairs // BUCKETS, pairs % BUCKETS
        rest = (self.every[bucket] - own + 0.5) / (self.every.sum() - count[doc] + 0.5 * BUCKETS)
        mine = fine[doc]
        prior = PRIOR * BUCKETS
        among = self.target[bucket] - own * mine + prior * rest
        good = among / (self.target.sum() - count[doc] * mine + prior)
        return np.bincount(doc, own * (np.log(good) - np.log(rest)), len(count))


def label_sample(labels: DataFrame, seed: int, most: int = MAX_LABELS):
    """At most `most` labelled ids in a seeded order, as sorted arrays (ids, good). An id with
    several labels is good when most of them are."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    one = one.agg((F.avg("quality") > 0.5).cast("int").alias("good"))
    rows = one.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most).collect()
    rows.sort()
    return np.array([r[0] for r in rows], dtype="i8"), np.array([r[1] for r in rows], dtype="i4")


def fit(docs: DataFrame, labels: DataFrame, seed: int = 1) -> Importance:
    """Count n-grams of all texts and of those labelled good, in one pass over the corpus. What
    leaves a task is one row per bucket, and what reaches the driver is BUCKETS rows."""
    ship(docs.sparkSession)
    ids, good = label_sample(labels, seed)
    fine = ids[good == 1]

    def count(batches):
        import pyarrow as pa

        every, target = np.zeros(BUCKETS, dtype="i8"), np.zeros(BUCKETS, dtype="i8")
        for batch in batches:
            held = batch.column(0)
            chosen = np.isin(held.fill_null(0).to_numpy(zero_copy_only=False), fine)
            chosen &= held.is_valid().to_numpy(zero_copy_only=False)
            texts = batch.column(1)
            for first, last in pieces(texts, 1 << 19):
                bucket, doc = features(Tokens(texts.slice(first, last - first)))
                every += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[chosen[first:last][doc]], minlength=BUCKETS)
        seen = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(every[seen]), pa.array(target[seen])], ["bucket", "n", "t"])

    counts = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(released(count), "bucket bigint, n bigint, t bigint")
    with small_batches(docs.sparkSession):
        rows = counts.groupBy("bucket").agg(F.sum("n"), F.sum("t")).collect()  # at most BUCKETS rows
    every, target = np.zeros(BUCKETS, dtype="i8"), np.zeros(BUCKETS, dtype="i8")
    for bucket, n, t in rows:
        every[bucket], target[bucket] = n, t
    return Importance(every, target, ids, good, seed)


def score(docs: DataFrame, model: Importance) -> DataFrame:
    """doc_id, log_weight, key, n_grams, label for every row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            weight, key, count, label = model.score(batch, 0, 1)
            columns = [batch.column(0), *[pa.array(x) for x in (weight, key, count, label)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "log_weight", "key", "n_grams", "label"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(released(run), "doc_id bigint, log_weight double, key double, n_grams bigint, label int")


def sample_size(scores: DataFrame) -> int:
    """Number of good documents to be expected: documents are grouped by the size of their key
    (on a logarithmic scale, some hundred groups at most), and each group counts with the part
    of its labelled rows that is good. A group without labels takes the part of the nearest
    groups that have some."""
    level = F.round(F.asinh("key") * 6).cast("int")
    groups = scores.where(F.col("n_grams") > 0).groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") >= 0).alias("known"), F.count_if(F.col("label") == 1).alias("good")
    )
    rows = sorted(groups.collect())
    labelled = [r for r in rows if r["known"]]
    if not labelled:
        return sum(r["n"] for r in rows)
    expected = 0.0
    for row in rows:
        near = min(abs(r["level"] - row["level"]) for r in labelled)
        close = [r for r in labelled if abs(r["level"] - row["level"]) == near]
        expected += row["n"] * sum(r["good"] for r in close) / sum(r["known"] for r in close)
    return round(expected)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 1) -> tuple[DataFrame, Importance]:
    """Gumbel top-k: the chosen rows (doc_id, log_weight, key, n_grams, position from 0), and the
    model with its `threshold` set so that exactly they reach it.

    `labels` has doc_id and quality (1 good, 0 not). `k` is by default the expected number of good
    documents. Texts without any n-gram (NULL, empty, blank) are never chosen. Equal rows (id and
    text) have equal keys and are taken or left together with the last place. Without labels
    every other text is kept. Other columns are ignored."""
    model = fit(docs, labels, seed)
    with small_batches(docs.sparkSession):
        scores = stage(score(docs, model))
    k = sample_size(scores) if k is None else k
    ranked = in_order(scores.where(F.col("n_grams") > 0), F.desc("key"), "doc_id")
    last = ranked.where(F.col("position") == F.lit(k - 1)).select("key").collect() if k > 0 else []
    model.threshold = last[0][0] if last else (float("inf") if k <= 0 else float("-inf"))
    chosen = ranked.where(F.col("key") >= F.lit(model.threshold)) if last else ranked.where(F.lit(k > 0))
    return chosen.select("doc_id", "log_weight", "key", "n_grams", "position"), model


def select(docs: DataFrame, model: Importance) -> DataFrame:
    """The rows of `docs` that the model's threshold lets through, all columns as they are."""
    at, text = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            _, key, count, _ = model.score(batch, at, text)
            yield batch.filter(pa.array((key >= model.threshold) & (count > 0)))

    return docs.mapInArrow(released(run), docs.schema)
