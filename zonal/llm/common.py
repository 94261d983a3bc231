"""Helpers shared by the operators: skew-safe look-ups, exact ranks, seeded draws, files."""

from __future__ import annotations

import io
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.operators.staging import stage, staging_dir

# A key with at least 1 / HOT_SHARE of all rows counts as hot: by construction there are at
# most HOT_SHARE of them, which is the proof that broadcasting their rows is safe.
HOT_SHARE = 1000

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def draw(seed: int, *columns) -> Column:
    """A number in (0, 1) fixed by the seed and the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def look_up(rows: DataFrame, table: DataFrame, key: str, total: int, count: str = "n", written: bool = False) -> DataFrame:
    """Left join of `rows` to a table of one row per key that also says how many rows each
    key has (`count`, dropped). Hot keys are answered from a broadcast of at most HOT_SHARE
    rows and never shuffled, so the shuffled rest holds no key with more than its share; rows
    without a key take no part in either. `rows` is read up to three times: stage it first. Where the
    table is `written`, it is asked first whether it has hot keys at all, and without any this is a
    plain join: a broadcast takes up memory on every executor, however few rows it has."""
    values = [c for c in table.columns if c not in (key, count)]
    hot = F.col(count) * F.lit(HOT_SHARE) >= F.lit(total)
    few = table.where(hot).select(key, *values)
    known = rows.where(F.col(key).isNotNull())
    order = [*rows.columns, *values]
    types = dict(table.dtypes)
    if written and few.isEmpty():
        parts = [known.join(table.select(key, *values), key, "left").select(*order)]
    else:
        cold = known.join(F.broadcast(few.select(key)), key, "left_anti")
        parts = [
            known.join(F.broadcast(few), key).select(*order),
            cold.join(table.where(~hot).select(key, *values), key, "left").select(*order),
        ]
    if rows.schema[key].nullable:
        nothing = [F.lit(None).cast(types[c]).alias(c) for c in values]
        parts.append(rows.where(F.col(key).isNull()).select(*rows.columns, *nothing))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def spread_join(
    rows: DataFrame, table: DataFrame, key: str, spread_by: str, total: int, counted: DataFrame | None = None
) -> DataFrame:
    """Inner join of `rows` (`total` of them) to a table of one wide row per key. A key with more
    than its share of the rows is dealt out, with copies of its table row: shares add up to one, so
    there are at most 2 * HOT_SHARE copies in all. `counted` is a narrow written table with the
    same keys to count them on, by default `rows` itself, which is then read twice."""
    sizes = (rows if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * F.lit(HOT_SHARE) > F.lit(total))
    salts = F.ceil(F.col("n") * F.lit(HOT_SHARE) / F.lit(max(1, total))).cast("int")
    hot = F.broadcast(sizes.select(key, salts.alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")).drop("salts")
    copies = table.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt.join(copies, [key, "salt"]).drop("salt")


def sift(table: DataFrame, key: str, wanted: DataFrame, total: int) -> DataFrame:
    """Rows of `table` whose key is, or by a chance of 1 in 16 seems to be, among the `total` keys
    of `wanted`: tested in place against a bitmap of hashed keys before anything is shuffled. The
    bitmap has at most 16 MB, whatever the number of keys; it lets more through when it fills up,
    and never drops a key that is wanted."""
    met, hit = _met(table, key, wanted, total, "inner")
    return met.where(hit).select(*table.columns)


def without(table: DataFrame, key: str, gone: DataFrame, total: int) -> DataFrame:
    """Rows of `table` whose key is not among the `total` keys of `gone`. Only what the bitmap of
    `sift` takes for gone is shuffled and looked up; all other rows stay where they are. `table` is
    read twice; rows without a key are kept."""
    met, hit = _met(table, key, gone, total, "left")
    hit = F.coalesce(hit, F.lit(False))
    maybe = met.where(hit).select(*table.columns).join(gone.select(key), key, "left_anti")
    return met.where(~hit).select(*table.columns).unionByName(maybe.select(*table.columns))


def _met(table: DataFrame, key: str, wanted: DataFrame, total: int, how: str) -> tuple[DataFrame, Column]:
    """`table` joined to the bitmap of the keys of `wanted`, and whether a row's bit is set."""
    bits = 1 << min(27, max(15, (16 * total).bit_length()))
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    slots = wanted.select(slot.alias("slot"))
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )
    placed = table.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn("bit", F.bitmap_bit_position(slot).cast("int"))
    byte = F.expr("cast(conv(hex(substring(bitmap, bit div 8 + 1, 1)), 16, 10) as int)")
    mask = F.expr("1 << (bit % 8)").cast("int")
    return placed.join(F.broadcast(maps), "bucket", how), byte.bitwiseAND(mask) != 0


def in_order(df: DataFrame, *order) -> DataFrame:
    """Written copy of `df` in global order with `position`, gapless from 0. Rows of one task
    are numbered as they are written; what lies before them is a sum over tasks."""
    numbered = stage(df.orderBy(*order).withColumn("seq", F.monotonically_increasing_id()))
    part = F.shiftright("seq", 33)
    sizes = numbered.groupBy(part.alias("part")).count().collect()  # one row per task
    before, bases = 0, []
    for row in sorted(sizes):
        bases.append((row["part"], before))
        before += row["count"]
    known = F.broadcast(df.sparkSession.createDataFrame(bases, "part bigint, base bigint"))
    placed = numbered.withColumn("part", part).join(known, "part")
    inside = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("position", F.col("base") + inside).drop("part", "base", "seq")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores after it while a column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame) -> tuple[DataFrame, str]:
    """Written copy of `df` with a number for every row, and that column's name. Written first,
    so that the numbers stay the same whoever reads them, however often."""
    name = free_name(df, "row_id")
    return stage(df.withColumn(name, F.monotonically_increasing_id())), name


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{staging_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Hand this library to the executors, once per session, so that functions run there can
    import it. The archive lies in the shared folder and Spark passes it on."""
    import zipfile
    from pathlib import Path

    import zonal

    context = spark.sparkContext
    if getattr(context, "_zonal_shipped", False):
        return
    top = Path(zonal.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent).as_posix())
    folder = new_folder(spark, "code")
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    out = Finished(store, f"{path}/zonal_code.zip")
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(f"{folder}/zonal_code.zip")
    context._zonal_shipped = True


def store_of(uri: str):
    """File system and path of a folder; local files are opened memory-mapped."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        store = fs.LocalFileSystem(use_mmap=True)
    return store, path


class Finished:
    """A file that appears under its name only when complete, so that a repeated or lost
    attempt of a task leaves either nothing or the same bytes."""

    def __init__(self, store, path: str):
        self.store, self.path = store, path
        self.hidden = f"{path}.{uuid.uuid4().hex}.tmp"
        self.out = io.BufferedWriter(_Sink(store.open_output_stream(self.hidden)), 1 << 20)
        self.size = 0

    def write(self, data) -> None:
        self.size += len(data)
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.store.move(self.hidden, self.path)


class _Sink(io.RawIOBase):
    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self.stream.close()
        super().close()


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Bound the Arrow batches of what is run inside by bytes: both sides of the pipe hold some of
    them per task, outside the heap. The session's own bound comes back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def released(run):
    """`run` over batches, handing back to the system what it no longer needs when it ends. Workers
    stay for later tasks, and would keep at hand as much as their largest batch ever took."""

    def all_of(batches):
        import ctypes
        import gc

        import pyarrow as pa

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return all_of


def pieces(texts, most: int = 1 << 20):
    """Slices (first, last) of an Arrow string column with about `most` bytes each; a longer
    text is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype="int64")
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, last
        first = last
