"""Written intermediate tables and spreading of hot keys."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with more than 1 / HOT_KEYS of all rows may be hot; there are at most HOT_KEYS of those.
HOT_KEYS = 1000

# Compression of what is staged: texts take two thirds of the room that the default leaves them.
STAGED_AS = "zstd"

# Rows whose keys one task counts.
COUNTED_PER_TASK = 1 << 20


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`. Only a local session without one
    gets a temporary folder: on a cluster executors could not read each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="zonal-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for what is run inside; the session's own comes back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is written inside go when it is written: nobody reads them again, and
    otherwise they lie on the executors' disks until the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stage(df: DataFrame) -> DataFrame:
    """Write a table once and read it back: the lineage is cut, a lost executor costs a
    re-read, and each consumer prunes to its own columns. What was shuffled for it is dropped."""
    path = f"{staging_dir(df.sparkSession)}/zonal-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", STAGED_AS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def more_tasks(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """The tasks that `rows` of work take, `rows_per_task` each; 0 where the session has as many."""
    wanted = -(-rows // rows_per_task)
    usual = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return wanted if wanted > usual else 0


def spread(df: DataFrame, keys: list[str], rows: int, rows_per_task: int) -> DataFrame:
    """`df` sent to the tasks of its keys: as many as the session has it, or, where these would hold
    more of the `rows` of work than `rows_per_task`, as many as that takes."""
    wanted = more_tasks(df.sparkSession, rows, rows_per_task)
    return df.repartition(wanted, *keys) if wanted else df.repartition(*keys)


def sent(df: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """`df` sent to `tasks` tasks by its keys; left as it is, to be sent by Spark, without a number."""
    return df.repartition(tasks, *keys) if tasks else df


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Written table of rows per key of a written table. Partial counts run before the shuffle, unless
    the session's tasks would hold too many keys."""
    tasks = more_tasks(df.sparkSession, df.count(), COUNTED_PER_TASK)
    return stage(sent(df.select(*keys), keys, tasks).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def hot_keys(sizes: DataFrame, keys: list[str], rows_per_task: int) -> list[Row]:
    """Keys with more rows than `rows_per_task` and than their share of all rows, with the number of
    `salts` each needs. Shares add up to one, so there are at most HOT_KEYS of them and twice as
    many salts in all, whatever the data: few enough for the driver and for a broadcast."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    share = max(rows_per_task, -(-total // HOT_KEYS))
    salts = F.ceil(F.col("n") / F.lit(share)).cast("int")
    return sizes.where(F.col("n") > share).select(*keys, salts.alias("salts")).collect()


def spread_join(
    rows: DataFrame,
    once: DataFrame,
    sizes: DataFrame,
    keys: list[str],
    spread_by: list[str],
    rows_per_task: int,
    hint: str = "merge",
    tasks: int = 0,
    within: str | None = None,
) -> DataFrame:
    """Inner join of `rows` to a side with few rows per key; `sizes` has the rows per key. Keys that
    are not hot are joined where they lie, by the hinted join, and their side is neither copied nor
    salted. Hot keys are a branch of their own: their rows are dealt out, and each share meets its
    own copy of the other side. Both branches are joined by `tasks` tasks, if a number is given. Rows
    meet those of the same integer `within`, if it is named, which has no part in where they lie."""
    spark = rows.sparkSession
    rows, once = sent(rows, keys, tasks), sent(once, keys, tasks)
    crowded = hot_keys(sizes, keys, rows_per_task)
    if not crowded:
        return _hinted(rows, once, keys, hint, within)
    schema = T.StructType([*[sizes.schema[k] for k in keys], T.StructField("salts", T.IntegerType())])
    hot = F.broadcast(spark.createDataFrame(crowded, schema))
    cold = _hinted(rows.join(hot.select(*keys), keys, "left_anti"), once, keys, hint, within)
    salt = F.pmod(F.xxhash64(*spread_by), F.col("salts").cast("bigint")).cast("int")
    dealt = rows.join(hot, keys).withColumn("salt", salt).drop("salts")
    # ranges of the hot keys are literals, which reach the scan of a sorted table
    for k in keys:
        values = [row[k] for row in crowded]
        once = once.where(F.col(k).between(min(values), max(values)))
    copies = once.join(hot, keys).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    dealt, copies = [sent(side, [*keys, "salt"], tasks) for side in (dealt, copies)]
    on = [*keys, "salt", *([within] if within else [])]
    return cold.unionByName(dealt.join(copies.hint("merge"), on).drop("salt"))


def _hinted(rows: DataFrame, once: DataFrame, keys: list[str], hint: str, within: str | None) -> DataFrame:
    if within:
        # told apart once the keys have met: as a key it would call for both sides to be sent by it as well
        other = f"other {within}"
        met = _hinted(rows, once.withColumnRenamed(within, other), keys, hint, None)
        return met.where(F.col(within) - F.col(other) == 0).drop(other)
    # a hash join is built from the rows and streams past them the side that must not be sorted
    return rows.hint("shuffle_hash").join(once, keys) if hint == "shuffle_hash" else rows.join(once.hint("merge"), keys)
