"""What to measure: named criteria over layer columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonal.operators.aggregates import BUCKETS


@dataclass(frozen=True)
class Layers:
    """Names of the layers in the tile table. Every field can be set to the user's own names."""

    loss: str = "umd_tree_cover_loss"
    density: str = "umd_tree_cover_density_2000"
    primary: str = "umd_regional_primary_forest_2001"
    peat: str = "peatlands"
    intact: str = "ifl_intact_forest_landscapes"
    protected: str = "wdpa_protected_areas"
    soy: str = "umd_soy_planted_area"


@dataclass(frozen=True)
class Analysis:
    """Area where all `above` conditions (layer, threshold) hold, strictly. A yearly analysis
    is split by the loss year; the others are one number per location. A NULL layer value
    fails the condition. Subclass and override `criterion` for anything richer."""

    name: str
    above: tuple[tuple[str, float], ...]
    yearly: bool = True

    @property
    def layers(self) -> tuple[str, ...]:
        return tuple(layer for layer, _ in self.above)

    def criterion(self) -> Column:
        condition = F.lit(True)
        for layer, threshold in self.above:
            condition = condition & (F.col(layer) > F.lit(threshold))
        return condition

    def content(self, area: Column) -> Column:
        """The area a pixel adds, NULL where the criterion fails."""
        return F.when(self.criterion(), area)


def standard_analyses(layers: Layers = Layers()) -> list[Analysis]:
    """The four analyses of the standard report."""
    loss = (layers.loss, 0)
    return [
        Analysis("tree_cover_loss_total_yearly", (loss, (layers.density, 30))),
        Analysis("tree_cover_loss_tcd90_yearly", (loss, (layers.density, 90))),
        Analysis("tree_cover_loss_primary_forest_yearly", (loss, (layers.primary, 0))),
        Analysis("tree_cover_loss_peat_yearly", (loss, (layers.peat, 0))),
    ]


def extended_analyses(layers: Layers = Layers()) -> list[Analysis]:
    """Three more yearly analyses, five extents, two habitats and the total area."""
    loss, cover = (layers.loss, 0), (layers.density, 30)
    return [
        Analysis("tree_cover_loss_intact_forest_yearly", (loss, (layers.intact, 0))),
        Analysis("tree_cover_loss_protected_areas_yearly", (loss, (layers.protected, 0))),
        Analysis("tree_cover_loss_soy_yearly", (loss, (layers.soy, 0))),
        Analysis("tree_cover_extent_total", (cover,), yearly=False),
        Analysis("tree_cover_extent_primary_forest", (cover, (layers.primary, 0)), yearly=False),
        Analysis("tree_cover_extent_protected_areas", (cover, (layers.protected, 0)), yearly=False),
        Analysis("tree_cover_extent_peat", (cover, (layers.peat, 0)), yearly=False),
        Analysis("tree_cover_extent_intact_forest", (cover, (layers.intact, 0)), yearly=False),
        Analysis("natural_habitat_primary", ((layers.primary, 0),), yearly=False),
        Analysis("natural_habitat_intact_forest", ((layers.intact, 0),), yearly=False),
        Analysis("total_area", (), yearly=False),
    ]


def needed_layers(analyses: list[Analysis], loss: str) -> list[str]:
    """Layers the analyses read, the loss layer first; all others stay unread."""
    wanted = [loss] + [layer for a in analyses for layer in a.layers]
    return list(dict.fromkeys(wanted))


def contributing(analyses: list[Analysis], loss: str, strict: bool = False) -> Column:
    """Pixels that add to some analysis. Loss is rare, so most pixels stop here and never
    reach the aggregation; `strict` also keeps codes it has to complain about. A pixel without
    a loss code still adds to the analyses that are not split by year."""
    lost = F.col(loss).isNotNull()
    # a NULL layer fails its criterion; it must not turn the whole condition to NULL
    wanted = [F.coalesce(a.criterion() & lost if a.yearly else a.criterion(), F.lit(False)) for a in analyses]
    if strict:
        wanted.append(lost & ~F.col(loss).between(0, BUCKETS - 1))
    return reduce(or_, wanted)


def add_columns(pixels: DataFrame, analyses: list[Analysis], area: str = "area") -> DataFrame:
    """One content column per analysis beside the pixel columns."""
    return pixels.withColumns({a.name: a.content(F.col(area)) for a in analyses})


def agg_columns(analyses: list[Analysis]) -> list[Column]:
    """The sums of the content columns; a group without any is 0."""
    return [F.coalesce(F.sum(a.name), F.lit(0.0)).alias(a.name) for a in analyses]
