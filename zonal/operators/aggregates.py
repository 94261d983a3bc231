"""Year-bucketed sums and their dense 32-slot maps.

All of them are ordinary grouped sums, so partial aggregation shrinks the rows to at
most 32 per group and task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonal.functions.grid import Grid
from zonal.operators.layers import explode_tiles
from zonal.operators.staging import more_tasks, sent, setting, stage

# Fixed value: slots of a year histogram; slot 0 is "no loss", slot 1 the first year.
BUCKETS = 32

# Rows of sums that one task holds: with a double for each of four analyses some 100 MB of them.
SUMS_PER_TASK = 1 << 20


def year_bucket(code: Column, strict: bool = False) -> Column:
    """The slot of a year code. NULL has none; a code outside 0..31 has none either,
    or fails the query when `strict`."""
    bucket = F.when(code.between(0, BUCKETS - 1), code.cast("int"))
    if strict:
        message = F.format_string("year code %s is outside 0..31", code.cast("string"))
        bucket = bucket.when(code.isNotNull(), F.raise_error(message))
    return bucket


def sums_by_bucket(df: DataFrame, by: list[str], bucket: Column, measures: Mapping[str, Column]) -> DataFrame:
    """Long form: one row per group and bucket. Rows without a bucket keep their group alive."""
    named = df.select(*by, bucket.alias("bucket"), *[m.alias(name) for name, m in measures.items()])
    return named.groupBy(*by, "bucket").agg(*[F.sum(name).alias(name) for name in measures])


def sums_written(sums: DataFrame, groups: int) -> DataFrame:
    """`sums` as they are, or, where the session's tasks would hold too many of the `groups`, written
    by as many tasks as that takes. The rows of a task are summed before they are sent, so the
    number is given to the whole job and not to an exchange before it."""
    spark = sums.sparkSession
    tasks = more_tasks(spark, groups, SUMS_PER_TASK)
    if not tasks:
        return sums
    with setting(spark, "spark.sql.shuffle.partitions", str(tasks)):
        return stage(sums)


def _slots(expression: str) -> str:
    """The SQL of an array holding an expression for every slot number."""
    return "array(" + ", ".join(expression.format(slot=i) for i in range(BUCKETS)) + ")"


def _slot_map(expression: str) -> Column:
    return F.expr(f"map_from_arrays(sequence(0, {BUCKETS - 1}), {_slots(expression)})")


def dense_maps(
    long: DataFrame, by: list[str], names: list[str], totals: list[str] | None = None, rows: int = 0
) -> DataFrame:
    """Long form to one MAP<INT, DOUBLE> per measure with every slot present. Measures in
    `totals` are summed over all rows instead, those without a bucket included. `rows` of the long
    form, if they are given, say how many tasks there are."""
    totals = totals or []
    long = sent(long, by, more_tasks(long.sparkSession, rows, SUMS_PER_TASK))
    sums = [F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in totals]
    entries = F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", F.struct(*names)))) if names else None
    maps = [F.map_from_entries(entries).alias("held")] if names else []
    held = long.groupBy(*by).agg(*maps, *sums)

    def dense(name: str) -> Column:
        # written out per slot: a lambda over the slots would leave generated code
        return _slot_map(f"coalesce(try_element_at(held, {{slot}}).`{name}`, 0e0)").alias(name)

    return held.select(*by, *[dense(name) for name in names], *totals)


def loss_year_agg(
    df: DataFrame, by: list[str], year: Column, areas: Mapping[str, Column], strict: bool = False
) -> DataFrame:
    """Area per year slot as dense maps; a NULL year or area adds nothing."""
    long = sums_by_bucket(df, by, year_bucket(year, strict), areas)
    return dense_maps(long, by, list(areas))


def histogram_agg(df: DataFrame, by: list[str], histograms: list[str]) -> DataFrame:
    """Slot-wise sum of ARRAY<DOUBLE> histograms as dense maps; missing slots add 0."""
    slot_sums = [
        F.expr(f"coalesce(sum(get(`{h}`, {i})), 0e0)").alias(f"{h}_{i}") for h in histograms for i in range(BUCKETS)
    ]
    summed = df.groupBy(*by).agg(*slot_sums)
    return summed.select(*by, *[_slot_map(f"`{h}_{{slot}}`").alias(h) for h in histograms])


def scale_histogram(histogram: Column, factor: Column) -> Column:
    """Every slot times a factor."""
    return F.transform(histogram, lambda v: v * factor)


def zonal_histogram(
    pixels: DataFrame, by: list[str], year: Column, criteria: Mapping[str, Column], strict: bool = False
) -> DataFrame:
    """Number of pixels per group and year slot meeting each criterion, in long form.
    A NULL criterion counts nothing."""
    counts = {name: F.coalesce(c.cast("int"), F.lit(0)).cast("bigint") for name, c in criteria.items()}
    return sums_by_bucket(pixels, by, year_bucket(year, strict), counts)


def tile_histograms(
    tiles: DataFrame, by: list[str], value: str, weight: str | None, grid: Grid, name: str = "histogram"
) -> DataFrame:
    """The 32-slot histogram of each tile as ARRAY<DOUBLE>: cells per value, or the sum of
    another tile's cells per value. One pass over the cells, one row per tile shuffled."""
    layers = [value] if weight is None else [value, weight]
    amount = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    cell_rows = explode_tiles(tiles.select(*by, *layers), layers, grid)
    numbered = cell_rows.select(*by, year_bucket(F.col(value)).alias("bucket"), amount.alias("amount"))
    slots = [F.expr(f"sum(amount) filter (where bucket = {i})").alias(f"slot_{i}") for i in range(BUCKETS)]
    filled = F.expr(_slots("coalesce(slot_{slot}, 0e0)"))
    return numbered.groupBy(*by).agg(*slots).select(*by, filled.alias(name))


def map_rows(df: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Dense maps back to rows: bucket and one value column per map."""
    slots = df.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))))
    return slots.select(*by, "bucket", *[F.element_at(name, F.col("bucket")).alias(name) for name in names])
