"""Importance resampling towards a target distribution, on CRC buckets of n-grams.

A text is normalised to its words, joined by one space, and scanned once: what is kept is the
running CRC-32 at the end of each word. The CRC of any run of words follows from the two running
values at its borders. Appending n bytes to a text moves its CRC by a linear map over GF(2) (n zero
bytes) before those bytes come in, so the part that the prefix leaves is cancelled by the prefix's
CRC, moved as far. The maps for 1, 2, 4, ... zero bytes are tables; a length is a sum of those.

Bucket counts of all texts and of the target give every bucket a gain, the log ratio of the two
smoothed models; a text's weight is the sum of the gains of its n-grams, and a sample without
replacement in proportion to the weights is the top of weight plus Gumbel noise.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import free_name, in_order, pieces, ship, with_row_id
from zonal.operators.staging import stage

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

# Words are runs of digits, letters and whatever lies above ASCII; A to Z count as lower case.
_WORDLIKE = [*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORDLIKE else 32 for b in range(256))


@dataclass(frozen=True)
class Sampling:
    """n-grams of 1 to `most` words in `buckets` buckets; `percent` of the texts with at least
    `least` words are drawn. Logs are counted in `steps` to the unit and rounded down."""

    most: int = 1
    buckets: int = 10_000
    least: int = 20
    percent: int = 10
    steps: int = 1000
    seed: int = 2024

    @property
    def width(self) -> str:
        return "<u2" if self.buckets <= 1 << 16 else "<u4"


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, in lower case."""
    return text.translate(_NORMAL).split()


@cache
def _one_byte():
    """What a byte in the register's low end becomes when it is shifted out."""
    c = np.arange(256, dtype="u4")
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


def _moved(tables, crc):
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


@cache
def _zeros(k: int):
    """The map that 2**k zero bytes apply to a CRC, as a table for each of its four bytes."""
    if k == 0:
        bytes_ = np.arange(256, dtype="u4")
        single = [bytes_ << np.uint32(8 * p) for p in range(4)]
        return np.array([_one_byte()[c & 255] ^ (c >> 8) for c in single])
    half = _zeros(k - 1)
    return np.array([_moved(half, t) for t in half])


def shifted(crc, lengths):
    """CRCs after as many zero bytes as `lengths` says."""
    out = crc.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        chosen = np.flatnonzero(lengths >> k & 1)
        out[chosen] = _moved(_zeros(k), out[chosen])
    return out


def _after_space(crc):
    """Running CRCs with one space more."""
    register = ~crc
    return ~(_one_byte()[(register ^ 32) & 255] ^ (register >> 8))


def run_crcs(texts: list[list[bytes]], most: int):
    """CRC-32 and text number of every run of 1 to `most` words, given the words of each text."""
    counts = np.array([len(w) for w in texts], dtype="i8")
    total = int(counts.sum())
    ends, lengths = np.empty(total, dtype="u4"), np.empty(total, dtype="i8")
    at = 0
    for words in texts:
        if not words:
            continue
        # every word but the first with the space before it; NUL separates words and is in none
        steps = b" ".join(words).replace(b" ", b"\0 ").split(b"\0")
        running = accumulate(steps, lambda crc, step: crc32(step, crc), initial=0)
        next(running)
        ends[at : at + len(words)] = np.fromiter(running, dtype="u4", count=len(words))
        lengths[at : at + len(words)] = np.fromiter(map(len, words), dtype="i8", count=len(words))
        at += len(words)
    doc = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.zeros(total, dtype="u4")  # the CRC of nothing is 0
    later = place > 0
    starts[later] = _after_space(ends[np.flatnonzero(later) - 1])
    borders = np.cumsum(lengths + 1)  # a space after each word; what spans two texts is left out
    crcs, docs = [], []
    for n in range(1, most + 1):
        first = np.flatnonzero(place[: total - n + 1] + n <= counts[doc[: total - n + 1]]) if total >= n else np.zeros(0, "i8")
        last = first + n - 1
        bytes_ = borders[last] - borders[first] + lengths[first]
        crcs.append(ends[last] ^ shifted(starts[first], bytes_))
        docs.append(doc[first])
    return np.concatenate(crcs), np.concatenate(docs), counts


def features(texts: DataFrame, sampling: Sampling, keep: list[str] | None = None) -> DataFrame:
    """One written row per text: the columns `keep`, n_words, n_features and the buckets of its
    n-grams, `sampling.width` each. The text is read and scanned this once."""
    ship(texts.sparkSession)
    keep = keep or []

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for first, last in pieces(batch.column(0), 1 << 19):
                part = batch.slice(first, last - first)
                held = part.column(0).cast(pa.large_binary()).to_pylist()
                crcs, doc, counts = run_crcs([words_of(t or b"") for t in held], sampling.most)
                order = np.argsort(doc, kind="stable") if sampling.most > 1 else slice(None)
                buckets = (crcs[order] % np.uint32(sampling.buckets)).astype(sampling.width)
                sizes = np.bincount(doc, minlength=len(held))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                bytes_ = (ends * buckets.itemsize).astype("i4")
                packed = pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(bytes_), pa.py_buffer(buckets)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(counts), pa.array(sizes.astype("i8")), packed],
                    [*keep, "n_words", "n_features", "buckets"],
                )

    schema = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in keep)
    return stage(texts.select("text", *keep).mapInArrow(run, schema + "n_words bigint, n_features bigint, buckets binary"))


def bucket_counts(found: DataFrame, sampling: Sampling):
    """Number of n-grams per bucket over all texts. A task sends one row per bucket it has seen,
    and what reaches the driver is a row per bucket."""
    n, width = sampling.buckets, sampling.width

    def run(batches):
        import pyarrow as pa

        seen = np.zeros(n, dtype="i8")
        for batch in batches:
            for first, last in pieces(batch.column(0)):
                part = b"".join(batch.column(0).slice(first, last - first).to_pylist())
                seen += np.bincount(np.frombuffer(part, dtype=width), minlength=n)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(n, dtype="i8")
    for bucket, total in rows.groupBy("bucket").agg(F.sum("n")).collect():  # at most a row per bucket
        counts[bucket] = total
    return counts


def gains(every, target, sampling: Sampling):
    """Per bucket the log ratio of the target's model to that of all texts, one n-gram added to
    each bucket of both, in steps and rounded down."""
    smooth = float(sampling.buckets)
    of_all, of_target = float(every.sum()) + smooth, float(target.sum()) + smooth
    ratios = ((t + 1.0) * of_all / ((s + 1.0) * of_target) for s, t in zip(every.tolist(), target.tolist()))
    return np.array([math.floor(sampling.steps * math.log(r)) for r in ratios], dtype="i8")


def noise(doc_id, sampling: Sampling) -> int:
    """Gumbel noise in steps, fixed by seed and doc_id; a NULL id has that of the empty text."""
    named = f"{sampling.seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-sampling.steps * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain, sampling: Sampling, keep: list[str]) -> DataFrame:
    """The columns `keep`, doc_id first, with n_words, n_features, weight and score of each text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            k = len(keep)
            packed = batch.column(k + 2).to_pylist()
            weight = [int(gain[np.frombuffer(b, dtype=sampling.width)].sum()) for b in packed]
            score = [w + noise(i, sampling) for i, w in zip(batch.column(0).to_pylist(), weight)]
            columns = [*batch.columns[: k + 2], pa.array(weight, pa.int64()), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_words", "n_features", "weight", "score"])

    schema = "".join(f"`{c}` bigint, " for c in keep) + "n_words bigint, n_features bigint, weight bigint, score bigint"
    return found.select(*keep, "n_words", "n_features", "buckets").mapInArrow(run, schema)


def _ranked(docs: DataFrame, target: DataFrame, sampling: Sampling, keep: list[str]) -> DataFrame:
    found = features(docs, sampling, keep)
    every = bucket_counts(found, sampling)
    wanted = bucket_counts(features(target.select("text"), sampling), sampling)
    scored = scores(found, gains(every, wanted, sampling), sampling, keep)
    enough = F.col("n_words") >= sampling.least
    ordered = in_order(scored, F.desc(enough), F.desc("score"), F.asc_nulls_last(keep[0]), *keep[1:], "weight", "n_features")
    drawn = ordered.where(enough).count() * sampling.percent // 100
    position = F.col("position")
    return ordered.withColumn("rank", F.when(enough & (position < drawn), position + 1)).drop("position")


def rank_documents(docs: DataFrame, target: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """One row per row of `docs`: doc_id, n_features, weight, score, and the rank of those drawn.

    `docs` has doc_id and text, `target` text; other columns are not read. NULL, empty and
    wordless texts have no features, weigh 0 and are not drawn. Equal scores go by the smaller
    doc_id, NULL ids last; rows that repeat an id have the same noise and are documents each. No
    target texts: the target is even over the buckets. No documents: no rows."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _ranked(rows, target, sampling, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """The drawn rows of `docs`, all columns, with their `rank` (underscores after it if `docs` has
    a column of that name)."""
    numbered, row = with_row_id(docs)
    rows = numbered.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(row).alias("row_number"), "text")
    ranks = _ranked(rows, target, sampling, ["doc_id", "row_number"]).where("rank is not null")
    name = free_name(docs, "rank")
    chosen = ranks.select(F.col("row_number").alias(row), F.col("rank").alias(name))
    return numbered.join(chosen, row).drop(row)
