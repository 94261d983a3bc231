"""The global block grid and the column expressions over it.

Pixels, segments (blocks) and files are counted from the north-west corner
(180 W, 90 N). Everything that can be an integer is one: a degree holds a whole
number of pixels, so coordinates are multiplied and never divided by a pixel size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY = ("key_col", "key_row")


@dataclass(frozen=True)
class Grid:
    """`px_per_deg` pixels per degree, files of `file_deg` degrees, blocks of `block` pixels."""

    px_per_deg: int = 4000
    file_deg: int = 10
    block: int = 400

    def __post_init__(self) -> None:
        if 180 % self.file_deg or self.file_px % self.block:
            raise ValueError("files must tile the world and blocks must tile a file")

    @property
    def width(self) -> int:
        return 360 * self.px_per_deg

    @property
    def height(self) -> int:
        return 180 * self.px_per_deg

    @property
    def file_px(self) -> int:
        return self.file_deg * self.px_per_deg

    @property
    def cols(self) -> int:
        return self.width // self.block

    @property
    def rows(self) -> int:
        return self.height // self.block

    @property
    def file_count(self) -> int:
        return (360 // self.file_deg) * (180 // self.file_deg)

    @property
    def cells(self) -> int:
        return self.block * self.block

    @property
    def pixel_deg(self) -> float:
        return 1.0 / self.px_per_deg

    # -- coordinates -------------------------------------------------------

    def x_to_px(self, lon: Column) -> Column:
        """Longitude to a fractional pixel column."""
        return (lon + F.lit(180.0)) * F.lit(float(self.px_per_deg))

    def y_to_px(self, lat: Column) -> Column:
        """Latitude to a fractional pixel row, growing southwards."""
        return (F.lit(90.0) - lat) * F.lit(float(self.px_per_deg))

    def point_key(self, lon: Column, lat: Column) -> Column:
        """Segment key of a point. The east and south edge of the world belong to its last column
        and row; a point outside the world, or with a NaN coordinate, has NULL there."""
        x, y = self.x_to_px(lon), self.y_to_px(lat)
        col = F.least(_floor_div(x, self.block), F.lit(self.cols - 1))
        row = F.least(_floor_div(y, self.block), F.lit(self.rows - 1))
        return F.struct(
            F.when(x.between(0, self.width), col.cast("int")).alias("col"),
            F.when(y.between(0, self.height), row.cast("int")).alias("row"),
        )

    def extent_key(self, extent: Column) -> Column:
        """Segment key holding the centre of an extent struct."""
        return self.point_key(
            (extent["xmin"] + extent["xmax"]) / F.lit(2.0),
            (extent["ymin"] + extent["ymax"]) / F.lit(2.0),
        )

    def segment(self, col: Column, row: Column) -> Column:
        """Number of a segment, row by row: one long for a key."""
        return row.cast("bigint") * F.lit(self.cols) + col

    def key_extent(self, col: Column, row: Column) -> Column:
        """Extent struct of a segment key."""
        return self._extent(col, row, self.block)

    def file_extent(self, file_col: Column, file_row: Column) -> Column:
        """Extent struct of a file key."""
        return self._extent(file_col, file_row, self.file_px)

    def _extent(self, col: Column, row: Column, size: int) -> Column:
        def lon(c: Column) -> Column:
            return c * F.lit(size) / F.lit(float(self.px_per_deg)) - F.lit(180.0)

        def lat(r: Column) -> Column:
            return F.lit(90.0) - r * F.lit(size) / F.lit(float(self.px_per_deg))

        return F.struct(
            lon(col).alias("xmin"),
            lat(row + 1).alias("ymin"),
            lon(col + 1).alias("xmax"),
            lat(row).alias("ymax"),
        )

    def key_lat(self, row: Column) -> Column:
        """Latitude of the centre of a segment row."""
        half = (row * F.lit(2) + F.lit(1)) * F.lit(self.block)
        return F.lit(90.0) - half / F.lit(2.0 * self.px_per_deg)

    # -- files -------------------------------------------------------------

    def file_of_key(self, key: Column) -> Column:
        """File column (or row) of a segment column (or row)."""
        return F.floor(key / F.lit(self.file_px // self.block)).cast("int")

    def tile_id(self, file_col: Column, file_row: Column) -> Column:
        """Name of a file from its north-west corner, e.g. `10N_010E`."""
        return corner_name(
            file_col * F.lit(self.file_deg) - F.lit(180),
            F.lit(90) - file_row * F.lit(self.file_deg),
        )

    def fill_template(self, template: Column, tile_id: Column) -> Column:
        """Put grid size, row count and tile id into a layer's URI template."""
        filled = F.replace(template, F.lit("{grid_size}"), F.lit(str(self.file_deg)))
        filled = F.replace(filled, F.lit("{row_count}"), F.lit(str(self.file_px)))
        return F.replace(filled, F.lit("{tile_id}"), tile_id)


def extent_ring(extent: Column) -> Column:
    """The closed five-vertex ring around an extent struct."""
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    return F.array(*[F.struct(extent[x].alias("x"), extent[y].alias("y")) for x, y in corners])


def corner_name(lon: Column, lat: Column) -> Column:
    """`NN[NS]_NNN[EW]` of whole-degree coordinates; zero counts as N and E."""
    return F.concat(_lat_name(lat), F.lit("_"), _lon_name(lon))


def point_grid_id(lon: Column, lat: Column, size: int) -> Column:
    """Name of the `size`-degree cell holding a point: north and west edges
    belong to the cell, south and east edges do not."""
    return corner_name(
        F.floor(lon / F.lit(float(size))).cast("int") * F.lit(size),
        F.ceil(lat / F.lit(float(size))).cast("int") * F.lit(size),
    )


def grid_id_to_bounds(grid_id: Column, size: int = 10) -> Column:
    """Turn `10N_010E` into the west_south_east_north form `010E_00N_020E_10N`."""
    part = r"^(\d+)([NS])_(\d+)([EW])$"
    top, ns = F.regexp_extract(grid_id, part, 1).cast("int"), F.regexp_extract(grid_id, part, 2)
    left, ew = F.regexp_extract(grid_id, part, 3).cast("int"), F.regexp_extract(grid_id, part, 4)
    bottom = F.when(ns == "N", top).otherwise(-top) - F.lit(size)
    right = F.when(ew == "E", left).otherwise(-left) + F.lit(size)
    west = F.concat(F.format_string("%03d", left), ew)
    north = F.concat(F.format_string("%02d", top), ns)
    return F.concat_ws("_", west, _lat_name(bottom), _lon_name(right), north)


def _lon_name(lon: Column) -> Column:
    return F.concat(F.format_string("%03d", F.abs(lon)), F.when(lon >= 0, "E").otherwise("W"))


def _lat_name(lat: Column) -> Column:
    return F.concat(F.format_string("%02d", F.abs(lat)), F.when(lat >= 0, "N").otherwise("S"))


def _floor_div(px: Column, size: int) -> Column:
    # floor to the pixel first: the pixel is an exact integer, the quotient need not be
    return F.floor(F.floor(px) / F.lit(size))
