"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight schedule, piecewise linear over training time 0..1. Its integral
says how much of the mix the source gets, and its cumulative demand says when: a document
that starts `c` words into its source's stream is met at the time by which the source has
been asked for `c` words. Documents sorted by that time are the training order.

Only DataFrame functions are used. A source may hold any share of the rows: running sums go
by (source, slice of a seeded order), so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonal.llm.common import WORD, draw, free_name, look_up, with_row_id
from zonal.operators.staging import stage

# Documents per slice of a source's running sum.
SLICE_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A source name that NULL has too, sorting last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def integrated(schedule: DataFrame) -> DataFrame:
    """Schedules (key, at, weight; times from 0 to 1) to one row per key with `weight`, the
    integral, and `legs`: per piece of the schedule the part of the integral before it and
    after it, where it starts, its weight there and its slope."""
    along = Window.partitionBy("key").orderBy("at")
    legs = schedule.select(
        "key",
        "at",
        F.col("weight").cast("double").alias("w"),
        F.lead("at").over(along).alias("end"),
        F.lead(F.col("weight").cast("double")).over(along).alias("w_end"),
    ).where("end > at")
    legs = legs.withColumn("area", (F.col("w") + F.col("w_end")) / 2 * (F.col("end") - F.col("at")))
    upto = F.sum("area").over(along)
    leg = F.struct(
        (upto - F.col("area")).alias("a0"),
        upto.alias("a1"),
        F.col("at"),
        F.col("w"),
        ((F.col("w_end") - F.col("w")) / (F.col("end") - F.col("at"))).alias("slope"),
    )
    legs = legs.select("key", "area", leg.alias("leg"))
    return legs.groupBy("key").agg(F.sum("area").alias("weight"), F.sort_array(F.collect_list("leg")).alias("legs"))


def share_targets(sources: DataFrame, share: float, repeats: float) -> DataFrame:
    """Add `target`: `share` of all sizes, split by weight, no source above `repeats` times its
    size; what is over goes to the others by weight until none is above.

    That is the water level L with sum(min(repeats * size, L * weight)) = total: with sources
    in the order in which they fill up, the first that L does not fill fixes L. Sources are a
    dimension of one row each; documents never pass through these windows."""
    cap = F.lit(float(repeats)) * F.col("source_size")
    fills = sources.withColumn("cap", cap).withColumn(
        "fills_at", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    )
    order = Window.partitionBy("all").orderBy("fills_at", "key")
    everything = Window.partitionBy("all")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = fills.withColumn("all", F.lit(1)).withColumn("level", F.try_divide(total - before, rest))
    free = F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "key", "level"))
    level = level.withColumn("level", F.coalesce(F.min(free).over(everything)["level"], F.lit(float("inf"))))
    target = F.when(F.col("weight") > 0, F.least("cap", F.col("level") * F.col("weight"))).otherwise(F.lit(0.0))
    return level.withColumn("target", target).drop("all", "level", "fills_at", "cap")


def met_at(progress: Column, legs: Column, weight: Column) -> Column:
    """The time by which a schedule has given out the part `progress` (0..1) of its integral."""
    wanted = progress * weight
    inside = F.element_at(F.filter(legs, lambda leg: leg["a1"] >= wanted), 1)
    leg = F.coalesce(inside, F.element_at(legs, -1))
    area = F.greatest(F.lit(0.0), wanted - leg["a0"])
    # w * x + slope * x * x / 2 = area, solved in the form that also holds for slope 0
    root = F.sqrt(F.greatest(F.lit(0.0), leg["w"] * leg["w"] + 2 * leg["slope"] * area))
    return F.when(area > 0, leg["at"] + 2 * area / (leg["w"] + root)).otherwise(leg["at"])


def plan_mix(
    docs: DataFrame,
    schedule: DataFrame | None,
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 1,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix does with every document (doc_id, text, source): `size` in words,
    `source_size`, its source's `target`, `taken` words, and `positions`, the times in 0..1 at
    which it is met, one per repetition.

    A source's documents run in a seeded order, as often as the target needs, `repeats` times
    at most; the last document is in when at least half of it lies below the target. So taken
    words miss the target by half a document at most.

    `schedule` is a table (source, at, weight); None takes `default_schedule`. Documents of a
    source without schedule get nothing. NULL source: a source of its own, last. NULL or empty
    text: size 0, never taken. Rows with the same doc_id are separate documents. No documents: no
    rows. Other columns are ignored but for those named in `carry`."""
    key = source_key(F.col("source"))
    sized = stage(docs.select("doc_id", *carry, key.alias("key"), word_count(F.col("text")).alias("size")))
    stats = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    stats = stage(stats)
    total = stats.agg(F.sum("n")).first()[0] or 0
    schedules = default_schedule(stats) if schedule is None else schedule.withColumn("key", source_key(F.col("source")))
    known = stats.join(integrated(schedules), "key", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    slices = F.ceil(F.col("n") / F.lit(SLICE_ROWS)).cast("int")
    sources = stage(share_targets(known, share, repeats).withColumn("slices", slices))

    u = draw(seed, "doc_id", "size")
    rows = stage(look_up(sized, sources.select("key", "source_size", "target", "slices", "n"), "key", total))
    rows = rows.withColumn("u", u).withColumn("slice", F.floor(F.col("u") * F.col("slices")).cast("int"))
    # before a slice: a running sum over the slices of its source, one row per SLICE_ROWS documents
    per_slice = rows.groupBy("key", "slice").agg(F.sum("size").alias("slice_size"))
    running = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select("key", "slice", F.coalesce(F.sum("slice_size").over(running), F.lit(0)).alias("base"))
    inside = Window.partitionBy("key", "slice").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(per_slice, ["key", "slice"]).withColumn("before", F.col("before") + F.col("base"))

    rounds = F.sequence(F.lit(0), F.lit(repeats - 1))
    starts = F.transform(rounds, lambda r: r * F.col("source_size") + F.col("before"))
    size, target = F.col("size"), F.col("target")
    starts = F.when(size > 0, F.filter(starts, lambda s: s + size / 2 <= target)).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("doc_id", *carry, "key", "size", "source_size", "target", starts.alias("starts"))
    curves = sources.select("key", "weight", "legs", "n")
    placed = look_up(stage(rows), curves, "key", total)
    times = F.transform("starts", lambda s: met_at(s / F.col("target"), F.col("legs"), F.col("weight")))
    return placed.select(
        "doc_id",
        *carry,
        "size",
        "source_size",
        "target",
        (size * F.size("starts")).alias("taken"),
        times.alias("positions"),
    )


def default_schedule(sources: DataFrame) -> DataFrame:
    """Weights 5, 2, 1, repeating over the sources in order of their names. Every other source
    starts at half as much again and fades to half, the rest the other way round: the integral
    stays the weight. `sources` has one row per key."""
    order = Window.partitionBy("all").orderBy("key")
    ranked = sources.select("key").withColumn("all", F.lit(1))
    ranked = ranked.select("key", (F.row_number().over(order) - 1).alias("rank"))
    weight = F.element_at(F.array(F.lit(5.0), F.lit(2.0), F.lit(1.0)), (F.col("rank") % 3 + 1).cast("int"))
    lean = F.when(F.col("rank") % 2 == 0, F.lit(0.5)).otherwise(F.lit(-0.5))
    knots = F.array(
        F.struct(F.lit(0.0).alias("at"), (weight * (1 + lean)).alias("weight")),
        F.struct(F.lit(0.5).alias("at"), weight.alias("weight")),
        F.struct(F.lit(1.0).alias("at"), (weight * (1 - lean)).alias("weight")),
    )
    return ranked.select("key", F.inline(knots))


def mix(docs: DataFrame, schedule: DataFrame | None = None, share: float = 1.5, repeats: int = 2, seed: int = 1) -> DataFrame:
    """The training order itself: every document row as often as the mix takes it, with all its
    columns, sorted by a last column `position` (`position_` if that name is taken). The plan is
    made on narrow rows; texts are moved once to their plan and once into order."""
    held, row = with_row_id(docs)
    narrow = held.select("doc_id", "source", "text", F.col(row).alias("held_row"))
    plan = plan_mix(narrow, schedule, share, repeats, seed, carry=("held_row",))
    position = free_name(docs, "position")
    wanted = plan.where("taken > 0").select(F.col("held_row").alias(row), F.col("positions").alias(position))
    rows = held.join(wanted, row).withColumn(position, F.explode(position))
    return rows.orderBy(position, "doc_id", row).drop(row)
