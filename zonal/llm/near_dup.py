"""Near-duplicates by SuperMinHash.

A text is the set of its five-word shingles. SuperMinHash gives every shingle a random order of
the signature's slots and offers each slot the shingle's rank there plus a random fraction; the
smallest offer wins. Ranks of one shingle are a permutation, hence correlated, which lowers the
variance; and offers of rank j only matter while some slot has none below, so it stops early.

Equal sets are one class, of which only one member goes on. Slots are cut into bands; sets that
agree on a band are a bucket. A bucket of n sets offers not n * n pairs but each set with at most
four pivots. Of all its pairs a set first gets the one with most bands in common, and after links
are confirmed on the full sets and grouped by union-find, the others where that left the two in
different groups. So most texts move once or twice, however many bands and copies they have.
Buckets that still hold several groups are then compared block against block, across groups only,
and of those links one for a set and a group is kept. A signature never decides on a link: it only says which sets are worth confirming.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import look_up, pieces, released, ship, sift, small_batches, spread_join, without
from zonal.llm.words import mixed
from zonal.operators.staging import stage

WORDS = 5
PERCENT = 75

# Slots and bands of four: two sets at 0.75 miss each other in all bands once in 190,000 pairs.
SLOTS = 128
BANDS = 32

# Sets of one bucket are confirmed when this part of their slots agrees: 3.9 standard deviations
# below 0.75 at 128 slots, so that of pairs right at the limit about one in 20,000 is passed over. A
# parameter: 0 confirms every pair that a band proposes.
LIKELY = 0.6

# Sets of one bucket that a block holds.
BLOCK = 512

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ORDER = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(text: bytes):
    """The set of a text as sorted distinct 64-bit hashes. Words are runs without ASCII white
    space, A to Z in lower case; fewer than five words are one shingle together."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype="u8")
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype="u8")
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype="u8", count=len(words))
    n = len(w) - WORDS + 1
    rolled = w[:n] * _ORDER[0]
    for k in range(1, WORDS):
        rolled += w[k : n + k] * _ORDER[k]
    return np.unique(mixed(rolled, 9))


@cache
def _codecs():
    import zstandard

    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def packed(text: bytes) -> bytes:
    """A text as it travels to where its links are confirmed: whole, but compressed. It takes a
    third of the room of its set, whose hashes do not compress."""
    return _codecs()[0].compress(text)


@lru_cache(maxsize=2)
def unpacked(data: bytes):
    """The set of a packed text. Sorted pairs ask for one of their two texts again and again."""
    return shingles(_codecs()[1].decompress(data))


def signatures(elements, doc, docs: int):
    """SuperMinHash of several sets at once: `elements` with the number of their set. All sets go
    up the ranks together; a set drops out when all its slots have an offer."""
    best = np.full(docs * SLOTS, _EMPTY, dtype="u8")
    swaps: list = []
    base = doc.astype("i8") * SLOTS
    for rank in range(SLOTS):
        if not len(elements):
            break
        x = mixed(elements, 100 + rank)
        place = rank + (((x & np.uint64(0xFFFFFF)) * np.uint64(SLOTS - rank)) >> np.uint64(24)).astype("u1")
        # what a Fisher-Yates shuffle has at this place after the swaps before: follow them back
        slot = place.copy()
        for earlier in range(rank - 1, -1, -1):
            slot[swaps[earlier] == slot] = earlier
        offer = (np.uint64(rank) << np.uint64(40)) | (x >> np.uint64(24))
        np.minimum.at(best, base + slot, offer)
        swaps.append(place)
        held = np.unique(base) // SLOTS
        full = np.zeros(docs, dtype=bool)
        full[held] = (best.reshape(docs, SLOTS)[held] != _EMPTY).all(axis=1)
        going = ~full[base // SLOTS]
        if not going.all():
            elements, base = elements[going], base[going]
            swaps = [s[going] for s in swaps]
    return best.reshape(docs, SLOTS)


def _sketches(batch, at: int, text: int):
    import pyarrow as pa
    import xxhash

    texts = batch.column(text)
    for first, last in pieces(texts, 1 << 21):
        held = texts.slice(first, last - first).cast(pa.large_binary()).to_pylist()
        sets = [shingles(t or b"") for t in held]
        sizes = np.array([len(s) for s in sets], dtype="i8")
        slots = signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
        rows = slots.reshape(len(sets), BANDS, SLOTS // BANDS)
        key = np.broadcast_to(np.arange(BANDS, dtype="u8"), (len(sets), BANDS)).copy()
        for k in range(SLOTS // BANDS):
            key = mixed(key * _ORDER[0] + rows[:, :, k], 50)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(at).slice(first, last - first),
                pa.array(sizes),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype="i4") * BANDS, pa.array(key.view("i8").ravel())),
                pa.array([p.tobytes() for p in (slots & np.uint64(255)).astype("u1")], pa.binary()),
                pa.array([packed(t or b"") for t in held], pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_key", "bands", "prints", "packed"],
        )


def sketch(docs: DataFrame) -> DataFrame:
    """One written row per document: doc_id, row_id, n_shingles, set_key (128 bits over the set),
    bands, prints (a byte per slot) and the whole text, packed."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield from _sketches(batch, 0, 1)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        released(run), "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, prints binary, packed binary"
    )
    with small_batches(docs.sparkSession):
        return stage(rows.withColumn("row_id", F.monotonically_increasing_id()))


def tested(pairs: DataFrame, values: DataFrame, test: Callable[[bytes, bytes], bool]) -> DataFrame:
    """Pairs (a, b) whose binary values (row, value) pass a test, written. Only values that some
    pair asks for are moved."""
    pairs = stage(pairs)
    total = pairs.count()
    both = pairs
    for end, other in (("a", "b"), ("b", "a")):
        wanted = sift(values.select(F.col("row").alias(end), F.col("value").alias(f"of_{end}")), end, pairs, total)
        both = spread_join(both, wanted, end, other, total, counted=pairs)

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            passed = [test(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(passed, pa.bool_()))

    with small_batches(pairs.sparkSession):
        return stage(both.select("a", "b", "of_a", "of_b").mapInArrow(released(check), "a bigint, b bigint"))


def alike(likely: float) -> Callable[[bytes, bytes], bool]:
    """Whether enough slots agree for a confirmation to be worth while."""

    def test(x: bytes, y: bytes) -> bool:
        same = np.frombuffer(x, dtype="u1") == np.frombuffer(y, dtype="u1")
        return int(same.sum()) >= likely * SLOTS

    return test


def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are not yet in one group of `known` (node, group)."""
    pairs = stage(pairs)
    total, named = pairs.count(), pairs
    for end in ("a", "b"):
        sizes = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
        table = sizes.join(known.select(F.col("node").alias(end), "group"), end, "left")
        table = stage(table.select(end, "n", F.coalesce("group", end).alias(f"group_{end}")))
        named = stage(look_up(named, table, end, total, written=True))
    return named.where("group_a <> group_b").select("a", "b")


def linked(x: bytes, y: bytes) -> bool:
    """Whether the sets of two packed texts are linked."""
    x, y = unpacked(x), unpacked(y)
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _forest(batches):
    """Union-find over the edges of one task: a link from every node to its root."""
    import pyarrow as pa

    root: dict[int, int] = {}

    def find(x):
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            root.setdefault(a, a)
            root.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
    nodes = [x for x in root if root[x] != x]
    tops = [find(x) for x in nodes]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(tops, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, group), one row per node of an edge. Each round shrinks every task's
    edges to a forest by union-find, lets every node follow the neighbour that comes first in a
    random order, and goes on between those; the rounds are logarithmic in the number of nodes.
    Every round is written, and only its number of edges reaches the driver."""
    steps, salt = [], 0
    edges = stage(edges.select("a", "b").mapInArrow(_forest, "a bigint, b bigint"))
    while n := edges.count():
        salt += 1
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("next"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("next")))
        rank = F.xxhash64(F.lit(salt), "next")
        near = ends.groupBy("node").agg(F.min(F.struct(rank.alias("rank"), "next")).alias("near"), F.count(F.lit(1)).alias("n"))
        own = F.struct(F.xxhash64(F.lit(salt), "node").alias("rank"), F.col("node").alias("next"))
        step = stage(near.select("node", F.least("near", own)["next"].alias("to"), "n"))
        steps.append(step)
        for end in ("a", "b"):
            table = step.select(F.col("node").alias(end), "to", "n")
            edges = look_up(edges, table, end, n, written=True).drop(end).withColumnRenamed("to", end)
            edges = stage(edges) if end == "a" else edges
        left = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = stage(left.mapInArrow(_forest, "a bigint, b bigint"))
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
    groups = steps[0].select("node", F.col("to").alias("group"))
    for step in steps[1:]:
        groups = stage(groups)
        sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        table = step.select(F.col("node").alias("group"), "to").join(sizes, "group")
        groups = look_up(groups, stage(table), "group", groups.count(), written=True)
        groups = groups.select("node", F.coalesce("to", "group").alias("group"))
    return stage(groups)


def _block_pairs(batches):
    """Batches of rows sorted by (band, i, j) to one batch per block pair."""
    import pyarrow as pa

    rest = None
    for batch in _ended(batches):
        if batch is not None:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
        if rest is None or not rest.num_rows:
            continue
        names = [rest.column(k).to_numpy() for k in range(3)]
        turns = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
        edges = [0, *turns.tolist()] + ([] if batch is not None else [rest.num_rows])
        for first, last in zip(edges[:-1], edges[1:]):
            yield rest.slice(first, last - first)
        rest = rest.slice(edges[-1])


def _minor(group, block, crossed):
    """Members outside the largest group, each with whom it is to be compared to: members of
    another group, in the other block if there are two. That covers every pair of two groups."""
    names, counts = np.unique(group, return_counts=True)
    for k in np.flatnonzero(group != names[counts.argmax()]):
        yield k, (group != group[k]) & ((block != block[k]) | (not crossed))


def _likely(likely: float):
    """Members of a block pair that look linked to a member of another group. Two sets that share
    several bands are looked at in the first of them only: there they meet in a bucket that is open
    too, or were compared as a set and its pivot."""

    def run(batches):
        import pyarrow as pa

        for rows in _block_pairs(batches):
            band, i, j, group, block = (rows.column(k).to_numpy() for k in (0, 1, 2, 4, 5))
            marks = rows.column(6)
            prints = np.frombuffer(b"".join(marks.field("prints").to_pylist()), dtype="u1").reshape(-1, SLOTS)
            bands = marks.field("bands").flatten().to_numpy().reshape(-1, BANDS)
            sizes = marks.field("n_shingles").to_numpy()
            found = np.zeros(len(group), dtype=bool)
            for k, others in _minor(group, block, i[0] != j[0]):
                others &= 100 * np.minimum(sizes, sizes[k]) >= PERCENT * np.maximum(sizes, sizes[k])
                others &= (prints == prints[k]).sum(axis=1) >= likely * SLOTS
                others[others] = bands[k, (bands[others] == bands[k]).argmax(axis=1)] == band[0]
                found[k] |= others.any()
                found |= others
            yield pa.RecordBatch.from_arrays(rows.columns[:6], rows.schema.names[:6]).filter(pa.array(found))

    return run


def _links(batches):
    """Links across groups in a block pair, at most one for a member and a group. Shared shingles
    are counted through an inverted index of the block pair."""
    import pyarrow as pa

    for rows in _block_pairs(batches):
        i, j, group, block = (rows.column(k).to_numpy() for k in (1, 2, 4, 5))
        sets = [unpacked(x) for x in rows.column(6).to_pylist()]
        sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        member, flat = np.repeat(np.arange(len(sets)), sizes)[order], flat[order]
        ends = []
        for k, others in _minor(group, block, i[0] != j[0]):
            first, last = np.searchsorted(flat, sets[k], "left"), np.searchsorted(flat, sets[k], "right")
            held = np.concatenate([member[a:b] for a, b in zip(first, last)])
            common = np.bincount(held, minlength=len(sets))
            others &= 100 * common >= PERCENT * (sizes + sizes[k] - common)
            ends += [(int(group[k]), int(g)) for g in np.unique(group[others])]
        yield pa.RecordBatch.from_arrays([pa.array([e[x] for e in ends], pa.int64()) for x in (0, 1)], ["a", "b"])


def _ended(batches):
    yield from batches
    yield None


def group(sketches: DataFrame, likely: float = LIKELY) -> DataFrame:
    """Sketches to one row per distinct set: set_key, component_id, n (documents)."""
    filled = sketches.where("n_shingles > 0")
    classes = filled.groupBy("set_key").agg(
        F.min("row_id").alias("row"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    classes = stage(classes)
    # all members of a class but the first drop out; what is no copy is not moved to find that out
    repeated = classes.where("n > 1").select("set_key", F.col("row").alias("first"), "n")
    times, copies = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    members = stage(sift(filled.select(F.col("row_id").alias("row"), "set_key"), "set_key", repeated, times))
    gone = stage(look_up(members, repeated, "set_key", copies, written=True).where("row <> first").select("row"))
    sized = filled.select(F.col("row_id").alias("row"), F.col("n_shingles").alias("size"), "bands")
    bands = stage(without(sized, "row", gone, copies))
    entries = bands.select("row", "size", F.explode("bands").alias("band"))
    # most bands belong to one set alone: count them with nothing else in the shuffle, and go on
    # with entries of the others
    often = stage(entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared, total = often.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    entries = sift(entries, "band", often, shared)
    odd = F.xxhash64("row") % 2 != 0
    sized = F.struct("row", "size")
    left, right = F.when(odd, sized), F.when(~odd, sized)
    buckets = entries.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min(left).alias("p0"), F.max(left).alias("p1"), F.min(right).alias("p2"), F.max(right).alias("p3")
    )
    buckets = stage(buckets.where("n > 1"))
    pivots = buckets.select("band", "n", F.col("n").alias("members"), F.array_compact(F.array_distinct(F.array("p0", "p1", "p2", "p3"))).alias("pivots"))
    held = stage(look_up(entries, pivots, "band", total, written=True).where("pivots is not null"))
    stars = held.select("row", "size", F.explode("pivots").alias("pivot")).where("row <> pivot.row")
    # sets whose sizes alone are too far apart share too little
    stars = stars.where(F.least("size", "pivot.size") * 100 >= F.greatest("size", "pivot.size") * PERCENT)
    ends = [F.least("row", "pivot.row").alias("a"), F.greatest("row", "pivot.row").alias("b")]
    stars = stage(stars.groupBy(*ends).agg(F.count(F.lit(1)).alias("bands")))
    # first every set with the one it shares most bands with; ties to the smaller row
    closest = stars.groupBy("b").agg(F.max(F.struct("bands", (-F.col("a")).alias("back"))).alias("best"))
    closest = stage(closest.select((-F.col("best.back")).alias("a"), "b"))
    sets = sketches.select(F.col("row_id").alias("row"), F.col("packed").alias("value"))
    prints = sketches.select(F.col("row_id").alias("row"), F.col("prints").alias("value"))
    marks = sketches.select(F.col("row_id").alias("row"), F.struct("prints", "bands", "n_shingles").alias("value"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return tested(tested(pairs, prints, alike(likely)), sets, linked)

    known = components(confirmed(closest))
    more = confirmed(apart(stars.select("a", "b").join(closest, ["a", "b"], "left_anti"), known))
    known = components(known.select(F.col("node").alias("a"), F.col("group").alias("b")).unionByName(more))

    # what stars leave open: buckets with more than one group, among sets that are no pivots
    large = held.where("members > 3").select("band", "row", "members")
    large = large.join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("group", F.coalesce("group", "row"))
    large = stage(large)
    mixed_up = large.groupBy("band").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("n"))
    mixed_up = stage(mixed_up.where("low <> high").select("band", F.lit(True).alias("open"), "n"))
    open_rows = look_up(large, mixed_up, "band", large.count(), written=True).where("open")
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    open_rows = open_rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    open_rows = stage(open_rows.select("band", "row", "group", "blocks", "block"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["band", "i", "j", "row", "group", "block"]

    def together(rows: DataFrame, values: DataFrame) -> DataFrame:
        total = rows.count()
        found = spread_join(rows, sift(values, "row", rows, total), "row", "band", total)
        if "blocks" in rows.columns:
            pairs = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
            found = found.withColumn("other", other).select("band", *pairs, *columns[3:], "value")
        return found.select(*columns, "value").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    schema = "band bigint, i int, j int, row bigint, group bigint, block int"
    with small_batches(sketches.sparkSession):
        near = stage(together(open_rows, marks).mapInArrow(released(_likely(likely)), schema))
        links = stage(together(near, sets).mapInArrow(released(_links), "a bigint, b bigint").distinct())
    joined = components(links)

    named = stage(classes.join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("group", F.coalesce("group", "row")))
    sizes = named.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    final = joined.select(F.col("node").alias("group"), F.col("group").alias("final")).join(sizes, "group")
    named = look_up(named, stage(final), "group", named.count(), count="members", written=True)
    named = stage(named.withColumn("group", F.coalesce("final", "group")).drop("final"))
    firsts = named.groupBy("group").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    whole = look_up(named, stage(firsts), "group", named.count(), count="members", written=True)
    return stage(whole.select("set_key", "component_id", "n"))


def near_duplicates(docs: DataFrame, likely: float = LIKELY) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets share 75 % of their union; component_id is the
    smallest doc_id that links lead to, itself included, and kept says doc_id = component_id. Texts
    without words (NULL, empty, blank) are linked with nothing and kept. NULL doc_ids are linked
    like others, never name a component unless all its ids are NULL, and are not kept then
    either. Rows that repeat an id are documents each, and kept together. No documents: no rows.
    Other columns are not read."""
    sketches = sketch(docs)
    classes = group(sketches, likely)
    rows = sketches.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key"))
    found = look_up(rows, classes, "set_key", sketches.count(), written=True)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    named = found.select("doc_id", "n_shingles", component.alias("component_id"))
    alone = F.col("n_shingles") == 0
    return named.withColumn("kept", alone | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
