"""Tile tables: key_col, key_row, layer, cells (row-major, NULL for NoData)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.functions.grid import KEY, Grid

SCHEMA = "key_col int, key_row int, layer string, cells array<int>"

# Rows of segments written by one task; a file of the default grid then spans four tasks.
BAND = 25


def read_tiles(spark: SparkSession, path: str, layers: list[str] | None = None) -> DataFrame:
    """A tile table; asking for layers prunes partitions, `cells` stays unread until used."""
    tiles = spark.read.schema(SCHEMA + ", file_row int, file_col int").parquet(path)
    return tiles if layers is None else tiles.where(F.col("layer").isin(layers))


def write_tiles(tiles: DataFrame, path: str, grid: Grid, mode: str = "errorifexists") -> None:
    """Write tiles partitioned by layer and file, sorted by key inside each part, so that
    a job over few places opens few files and skips row groups by key."""
    placed = tiles.select(
        *[F.col(k).cast("int").alias(k) for k in KEY],
        F.col("cells").cast("array<int>").alias("cells"),
        "layer",
        grid.file_of_key(F.col("key_row")).alias("file_row"),
        grid.file_of_key(F.col("key_col")).alias("file_col"),
    )
    spread = placed.repartition("layer", "file_row", "file_col", F.floor(F.col("key_row") / F.lit(BAND)))
    ordered = spread.sortWithinPartitions("layer", "file_row", "file_col", "key_row", "key_col")
    ordered.write.mode(mode).partitionBy("layer", "file_row", "file_col").parquet(path)


def tile_summary(tiles: DataFrame) -> DataFrame:
    """Cells with data per layer and key."""
    valid = F.size(F.filter("cells", lambda x: x.isNotNull()))
    return tiles.select("layer", *KEY, valid.cast("bigint").alias("n_valid"))
