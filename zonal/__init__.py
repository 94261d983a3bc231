"""Zonal raster statistics on Spark: area by year and by class inside polygons.

Polygons become run-length coverage per grid key, tiles are joined to it by that
key, and every statistic is a plain grouped sum over the covered cells.
"""

from zonal.functions.grid import Grid
from zonal.operators.coverage import coverage_cells, coverage_runs, coverage_spans, segment_cover
from zonal.plans.analyses import Analysis, Layers, extended_analyses, standard_analyses
from zonal.plans.jobs import loss_by_year_histogram, loss_by_year_pixelwise, run_report

__all__ = [
    "Analysis",
    "Grid",
    "Layers",
    "coverage_cells",
    "coverage_runs",
    "coverage_spans",
    "extended_analyses",
    "loss_by_year_histogram",
    "loss_by_year_pixelwise",
    "run_report",
    "segment_cover",
    "standard_analyses",
]
