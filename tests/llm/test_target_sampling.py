"""Prefix CRCs and the resampling on them, against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonal.llm import target_sampling
from zonal.llm.target_sampling import Sampling

DOCS = "doc_id bigint, text string, source string"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return WORD.findall(low)


def grams(text, most):
    w = words(text)
    return [b" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, s):
    of_all, of_target = collections.Counter(), collections.Counter()
    for _, t, _ in rows:
        of_all.update(zlib.crc32(g) % s.buckets for g in grams(t, s.most))
    for t in target:
        of_target.update(zlib.crc32(g) % s.buckets for g in grams(t, s.most))
    n_all, n_target = sum(of_all.values()), sum(of_target.values())

    def gain(b):
        return math.floor(1000 * math.log((of_target[b] + 1) * (n_all + s.buckets) / ((of_all[b] + 1) * (n_target + s.buckets))))

    out = []
    for i, t, _ in rows:
        found = [zlib.crc32(g) % s.buckets for g in grams(t, s.most)]
        weight = sum(gain(b) for b in found)
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(t))])
    enough = sorted((r for r in out if r[4] >= s.least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(enough) * s.percent // 100
    ranks = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(enough)]
    return sorted(ranks + [(*r[:4], None) for r in out if r[4] < s.least], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcXYZ01é🙂") for _ in range(rng.randint(1, 9))) for _ in range(80)]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "-", "\x00", "?! "]) for _ in range(n))

    out = [(i, text(rng.randint(1, 60)), "hot") for i in range(150)]
    out += [(200, None, None), (201, "", "a"), (202, " \x00\t- ", "a"), (None, text(30), "a"), (None, None, None), (203, text(30_000), "a")]
    return out + [(204, out[0][1] * 9, "b")] * 3 + [(205, "x" * 70_000 + " y", "b"), (-5, text(25), "b")]


def test_running_crcs_give_every_run_of_words(rows):
    texts = [words(t) for _, t, _ in rows]
    crcs, doc, counts = target_sampling.run_crcs(texts, 3)
    assert counts.tolist() == [len(t) for t in texts]
    found = collections.Counter(zip(doc.tolist(), crcs.tolist()))
    assert found == collections.Counter((k, zlib.crc32(g)) for k, (_, t, _) in enumerate(rows) for g in grams(t, 3))


def test_shift_cancels_any_prefix():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.randbytes(rng.randint(0, 50)), rng.randbytes(rng.randint(0, 5000))
        moved = target_sampling.shifted(np.array([zlib.crc32(a)], dtype="u4"), np.array([len(b)]))
        assert int(moved[0]) ^ zlib.crc32(a + b) == zlib.crc32(b)


@pytest.mark.parametrize("sampling", [Sampling(percent=30), Sampling(most=3, buckets=97, least=0, percent=100), Sampling(most=2, buckets=100_000, seed=5)])
def test_ranks_are_brute_force(spark, rows, sampling):
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("rank", "score", "n_words", "buckets", "row_number", "position", "row_id")})
    target = ["abc abc X01 " * 30, None, "", "Z é é"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    found = target_sampling.rank_documents(docs, table, sampling)
    want = brute(rows, target, sampling)
    assert sorted([tuple(r) for r in found.collect()], key=str) == want
    drawn = target_sampling.resample(docs, table, sampling)
    assert drawn.columns == [*docs.columns, "rank_"]
    assert sorted(r[0] for r in drawn.select("rank_").collect()) == sorted(r[4] for r in want if r[4])
    by_rank = {r[4]: r[0] for r in want if r[4]}
    assert all(by_rank[r[0]] == r[1] for r in drawn.select("rank_", "doc_id").collect())


def test_ranks_of_nothing(spark):
    none, text = spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string")
    assert target_sampling.rank_documents(none, text).collect() == []
    assert target_sampling.resample(none, text).collect() == []
    one = spark.createDataFrame([(1, "a " * 40, "s")] * 20, DOCS)
    assert sum(r[0] is not None for r in target_sampling.rank_documents(one, text).select("rank").collect()) == 2
