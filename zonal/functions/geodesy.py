"""Pixel area on the WGS 84 ellipsoid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonal.functions.grid import Grid

# WGS 84 semi-major and semi-minor axis in metres.
SEMI_MAJOR = 6378137.0
SEMI_MINOR = 6356752.314245179

ECCENTRICITY = math.sqrt(1.0 - (SEMI_MINOR / SEMI_MAJOR) ** 2)


def area_to_pole_band(lat: Column) -> Column:
    """Ellipsoid area (m2) between the equator and a latitude, signed."""
    sin_lat = F.sin(F.radians(lat))
    e_sin = F.lit(ECCENTRICITY) * sin_lat
    band = F.atanh(e_sin) / F.lit(ECCENTRICITY) + sin_lat / ((F.lit(1.0) + e_sin) * (F.lit(1.0) - e_sin))
    return F.lit(math.pi * SEMI_MINOR**2) * band


def cell_area_m2(lat: Column, height_deg: float, width_deg: float) -> Column:
    """Area of a cell whose lower edge is at `lat`."""
    strip = area_to_pole_band(lat + F.lit(height_deg)) - area_to_pole_band(lat)
    return F.abs(strip) * F.lit(width_deg / 360.0)


def pixel_area_ha(grid: Grid, key_row: Column) -> Column:
    """Hectares of one pixel, taken at the centre latitude of its segment row,
    so it is one value per segment row."""
    return cell_area_m2(grid.key_lat(key_row), grid.pixel_deg, grid.pixel_deg) / F.lit(10000.0)
