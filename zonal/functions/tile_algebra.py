"""Cell-wise algebra on tiles held as arrays. NULL is the only NoData value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_multiply(a: Column, b: Column) -> Column:
    """Cell-wise product; NoData in either tile stays NoData."""
    return F.zip_with(a, b, lambda x, y: x * y)


def local_greater(tile: Column, threshold: float) -> Column:
    """1 where the cell is above the threshold, 0 where it is not, NoData kept."""
    return F.transform(tile, lambda x: (x > F.lit(threshold)).cast("int"))


def mask(tile: Column, by: Column) -> Column:
    """Keep a cell where the other tile has data."""
    return F.zip_with(tile, by, lambda x, m: F.when(m.isNotNull(), x))


def mask_by_value(tile: Column, by: Column, value: int) -> Column:
    """Drop a cell where the other tile equals `value`."""
    return F.zip_with(tile, by, lambda x, m: F.when(~m.eqNullSafe(F.lit(value)), x))


def tile_max(tile: Column) -> Column:
    """Largest cell of a tile."""
    return F.array_max(tile)


def criterion_tile(value: Column, criterion: Column, threshold: float) -> Column:
    """1 where `value` > 0 and `criterion` > threshold, else 0; NoData if either is. One pass over
    the cells, with no tile in between."""
    return F.zip_with(value, criterion, lambda v, c: ((v > 0).cast("int") * (c > F.lit(threshold)).cast("int")))


def clean_nan(value: Column) -> Column:
    """NaN to NULL: in Spark NaN > 0 is true, so a NaN NoData must not reach a predicate."""
    return F.nanvl(value, F.lit(None).cast("double"))


def calendar_year(code: Column) -> Column:
    """Exploded loss code (NaN or NULL for NoData) to a calendar year."""
    return (clean_nan(code) + F.lit(2000)).try_cast("int")
