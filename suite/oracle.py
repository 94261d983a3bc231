"""The same questions in plain SQL for DuckDB, answered by brute force: every pixel near a
polygon is tested against its shape, tiles are unnested cell by cell, codes go through CASE."""

from __future__ import annotations

from suite.inputs import LAND_COVER_CODES, LAYERS, STACK
from zonal.operators.legends import LEGENDS, REGION_BITS

# Fixed values, written out apart from the library's: WGS 84 axes in metres, and the upper end and
# label of density classes.
SEMI_MAJOR, SEMI_MINOR = 6378137.0, 6356752.314245179
ECCENTRICITY = (1.0 - (SEMI_MINOR / SEMI_MAJOR) ** 2) ** 0.5
DENSITY_CLASSES = {10: 0, 15: 10, 20: 15, 25: 20, 30: 25, 50: 30, 75: 50}
DENSITY_TOP = 75

ORACLE: dict[str, str] = {}
NAMES = [
    "tree_cover_loss_total_yearly",
    "tree_cover_loss_tcd90_yearly",
    "tree_cover_loss_primary_forest_yearly",
    "tree_cover_loss_peat_yearly",
]


def area_ha(lat: str) -> str:
    """Hectares of a 0.00025 degree pixel at a latitude expression."""

    def band(at: str) -> str:
        s = f"{ECCENTRICITY!r}*sin(radians({at}))"
        return f"(atanh({s})/{ECCENTRICITY!r} + sin(radians({at}))/((1e0+{s})*(1e0-{s})))"

    scale = f"pi()*{SEMI_MINOR!r}*{SEMI_MINOR!r}"
    return f"abs({scale}*({band(f'({lat})+0.00025e0')} - {band(f'({lat})')}))*(0.00025e0/360e0)/1e4"


def case(code: str, table: dict[int, str], default: str) -> str:
    arms = " ".join(f"when {k} then '{v}'" for k, v in table.items())
    return f"case when {code} is null then null else case {code} {arms} else '{default}' end end"


# -- shared tables ---------------------------------------------------------------

POLY = """
base as (
  select c_custkey % 25 as list_id, case when c_custkey < 25 then -1 else c_custkey end::bigint as location_id,
    760000 + c_custkey*97 % 4000 as cx, 180005 + (c_custkey // 40)*10 as cy,
    case when c_custkey < 25 then 60 else 6 + c_custkey % 13 end as w,
    case when c_nationkey % 5 = 0 then 3 else 0 end as hole, c_mktsegment as seg
  from customer),
poly as (
  select list_id, location_id, cx, cy, w, hole from base
  union all select list_id, location_id, cx + 5, cy + 2, w, 0 from base where seg = 'BUILDING')"""

# A pixel is covered if its centre is inside a diamond and not inside its hole.
PIX = (
    POLY
    + """,
cand as (select *, unnest(range(cx - w - 1, cx + w + 2)) as c from poly),
cand2 as (select *, unnest(range(cy - w - 1, cy + w + 2)) as r from cand),
pix as (
  select distinct list_id, location_id, r, c,
    c // 10 as key_col, r // 10 as key_row, (r % 10)*10 + c % 10 as i
  from cand2
  where abs(c - cx + 0.25e0) + abs(r - cy + 0.375e0) < w
    and not abs(c - cx + 0.25e0) + abs(r - cy + 0.375e0) < hole)"""
)


def touched(size: int) -> str:
    """Cells of `size` pixels that share a point with a diamond outside its hole."""
    return (
        POLY
        + f""",
cand as (select *, unnest(range((cx - w - 1)//{size}, (cx + w + 1)//{size} + 1)) as c from poly),
cand2 as (select *, unnest(range((cy - w - 1)//{size}, (cy + w + 1)//{size} + 1)) as r from cand),
rel as (
  select *, c*{size} - cx - 0.25e0 as x0, (c + 1)*{size} - cx - 0.25e0 as x1,
    r*{size} - cy - 0.125e0 as y0, (r + 1)*{size} - cy - 0.125e0 as y1 from cand2),
touch as (
  select distinct list_id, location_id, r, c from rel
  where greatest(x0, -x1, 0) + greatest(y0, -y1, 0) < w
    and greatest(abs(x0), abs(x1)) + greatest(abs(y0), abs(y1)) > hole)"""
    )


TOUCHED_PIX = touched(1) + ",\npix as (select *, c // 10 as key_col, r // 10 as key_row, (r % 10)*10 + c % 10 as i from touch)"

TILE = """
lines as (select l_orderkey as k, sum(l_suppkey)::bigint as m from lineitem group by 1),
tile as (
  select o_orderkey as k, o_custkey as ck, l.m, 76000 + o_orderkey % 400 as key_col,
    18000 + o_orderkey // 400 as key_row
  from orders left join lines l on l.k = o_orderkey)"""

VALUES = {
    LAYERS.loss: "case when (k + i) % 17 = 0 then null else (k*7 + i*13) % 24 end",
    LAYERS.density: "(ck + i*31) % 101",
    LAYERS.primary: "case when (k + i) % 3 = 0 then 1 else 0 end",
    LAYERS.peat: "case when (m + i) % 5 = 0 then 1 when m is not null then 0 end",
}
LOSS, DENSITY, PRIMARY, PEAT = (VALUES[name] for name in STACK)

CELL = (
    TILE
    + f""",
cell0 as (select *, unnest(range(0, 100)) as i from tile),
cell as (
  select k, key_col, key_row, i, m is not null as has_peat, ({LOSS})::bigint as loss, ({DENSITY})::bigint as density,
    ({PRIMARY})::bigint as prim, ({PEAT})::bigint as peat
  from cell0)"""
)

# Covered pixels with the values of their tile; NULL where there is no tile.
VALUED = (
    TILE
    + f""",
valued0 as (
  select p.*, t.k, t.ck, t.m from pix p left join tile t on t.key_col = p.key_col and t.key_row = p.key_row),
valued as (
  select list_id, location_id, key_col, key_row, i, ({LOSS})::bigint as loss, ({DENSITY})::bigint as density,
    ({PRIMARY})::bigint as prim, ({PEAT})::bigint as peat, {area_ha("90e0 - (key_row*2 + 1)*10/8000e0")} as area
  from valued0)"""
)

PX = f"""
px as (
  select l_suppkey % 4 as list_id, case when l_partkey % 10 = 0 then -1 else l_partkey % 10 end as location_id,
    l_suppkey*37 % 3600 as key_col, l_partkey*17 % 1800 as key_row,
    case when l_discount = 0 then null else floor(l_quantity)::bigint % 24 end as loss,
    floor(l_extendedprice)::bigint % 101 as density,
    case when l_returnflag = 'R' then 1 else 0 end as prim, case when l_linestatus = 'O' then 1 else 0 end as peat,
    l_partkey % 4 as intact, l_partkey % 3 as protected, l_suppkey % 2 as soy, l_partkey as code,
    {area_ha("90e0 - ((l_partkey*17 % 1800)*2 + 1)*400/8000e0")} as area
  from lineitem)"""


def pt(name: str = "customer", key: str = "c_custkey", out: str = "pt") -> str:
    return (
        f"{out} as (select ({key}*7919 % 36000)/100.0e0 - 180e0 as x, "
        f"({key}*104729 % 18000)/100.0e0 - 90e0 as y from {name})"
    )


KEYED = """
keyed as (
  select x, y, least(floor(floor((x + 180e0)*4000e0)/400e0), 3599)::bigint as key_col,
    least(floor(floor((90e0 - y)*4000e0)/400e0), 1799)::bigint as key_row from pt)"""

GRID_ID = """
gid0 as (select (floor(x/10e0)*10)::bigint as lon, (ceil(y/10e0)*10)::bigint as lat from pt),
gid as (
  select lon, lat, printf('%02d', abs(lat)) || case when lat >= 0 then 'N' else 'S' end || '_'
    || printf('%03d', abs(lon)) || case when lon >= 0 then 'E' else 'W' end as grid_id from gid0)"""


def file_uri(source: str, out: str) -> str:
    """Tile URIs of the files holding points."""
    return f"""
{out}0 as (
  select (least(floor((x + 180e0)*4000e0), 1439999)::bigint // 40000)*10 - 180 as lon,
    90 - (least(floor((90e0 - y)*4000e0), 719999)::bigint // 40000)*10 as lat from {source}),
{out} as (
  select 's3://tiles/loss/v1/10/40000/year/' || printf('%02d', abs(lat)) || case when lat >= 0 then 'N' else 'S' end
    || '_' || printf('%03d', abs(lon)) || case when lon >= 0 then 'E' else 'W' end || '.tif' as uri from {out}0)"""


CATALOG = """
cat0 as (select page_id, url, regexp_extract(url, '//([^/]+)/', 1) as name from pages),
cat as (
  select case when url like 'https%' then 'pro' else 'default' end as flavor, page_id as pos, name,
    's3://tiles/' || name || '/' || case when page_id % 4 = 0 then 'latest' else 'v' || (page_id % 9) end
    || '/{grid_size}/{row_count}/{tile_id}.tif' || case when page_id % 10 = 3 then '"' else '' end as source_uri
  from cat0)"""

CRITERIA = ["loss > 0 and density > 30", "loss > 0 and density > 90", "loss > 0 and prim > 0", "loss > 0 and peat > 0"]


def yearly(ctes: str, source: str, groups: str, names: list[str], criteria: list[str], digits: int = 5) -> str:
    """Dense 32-bucket conditional area sums for every group."""
    sums = ", ".join(
        f"round(coalesce(sum(case when {c} then area end), 0e0), {digits}) as {n}" for n, c in zip(names, criteria)
    )
    return f"""with {ctes},
slots as (select list_id, location_id, b from (select distinct list_id, location_id from {groups}) cross join range(32) t(b))
select s.list_id, s.location_id, s.b as bucket, {sums}
from slots s left join {source} v on v.list_id = s.list_id and v.location_id = s.location_id and v.loss = s.b
group by 1, 2, 3"""


# -- jobs -------------------------------------------------------------------------

ORACLE["fcd_pixelwise"] = yearly(PX, "px", "px", NAMES, CRITERIA)
ORACLE["fcd_histogram"] = yearly(f"{PIX}, {VALUED}", "valued", "poly", NAMES, CRITERIA)
ORACLE["fcd_polygons_pixelwise"] = ORACLE["fcd_histogram"]
ORACLE["fcd_histogram_all_touched"] = yearly(f"{TOUCHED_PIX}, {VALUED}", "valued", "poly", NAMES, CRITERIA)

for same in ("fcd_stacked", "fcd_two_level", "fcd_prefix", "results_json"):
    ORACLE[same] = ORACLE["fcd_histogram"]

CROWD = """
poly as (
  select c_custkey % 25 as list_id, c_custkey as location_id, 760008 + c_custkey % 7 as cx, 180008 + c_custkey % 5 as cy,
    3 + c_custkey % 3 as w, 0 as hole from customer)"""
ORACLE["fcd_crowded"] = f"""with {PIX.replace(POLY, CROWD)}, {VALUED},
slots as (select list_id, b from (select distinct list_id from poly) cross join range(32) t(b))
select s.list_id, s.b as bucket, {", ".join(
    f"round(coalesce(sum(case when {c} then area end), 0e0), 4) as {n}" for n, c in zip(NAMES, CRITERIA)
)}
from slots s left join valued v on v.list_id = s.list_id and v.loss = s.b group by 1, 2"""

LAND_CODE = f"[{', '.join(map(str, LAND_COVER_CODES))}][1 + (o_orderkey + i) % {len(LAND_COVER_CODES)}]"
LANDED = f"""{PIX},
landed as (
  select list_id, location_id, {LAND_CODE}::bigint as code, {area_ha("90e0 - (key_row*2 + 1)*10/8000e0")} as area
  from pix join orders on 76000 + o_orderkey % 400 = key_col and 18000 + o_orderkey // 400 = key_row)"""
ORACLE["area_by_class_polygons"] = f"""with {LANDED}
select list_id, location_id, {case("code", LEGENDS["idn_land_cover_2017"][0]["pro"], "")} as label, round(sum(area), 5) as area
from landed group by 1, 2, 3"""
ORACLE["area_by_class_lists"] = f"with {LANDED} select list_id, code, round(sum(area), 4) as area from landed group by 1, 2"

EXTENTS = {
    "tree_cover_extent_total": "density > 30",
    "tree_cover_extent_primary_forest": "density > 30 and prim > 0",
    "tree_cover_extent_protected_areas": "density > 30 and protected > 0",
    "tree_cover_extent_peat": "density > 30 and peat > 0",
    "tree_cover_extent_intact_forest": "density > 30 and intact > 0",
    "natural_habitat_primary": "prim > 0",
    "natural_habitat_intact_forest": "intact > 0",
    "total_area": "true",
}
EXTENDED_YEARLY = {
    "tree_cover_loss_intact_forest_yearly": "loss > 0 and intact > 0",
    "tree_cover_loss_protected_areas_yearly": "loss > 0 and protected > 0",
    "tree_cover_loss_soy_yearly": "loss > 0 and soy > 0",
}


def area_sums(criteria: dict[str, str]) -> str:
    return ", ".join(f"round(coalesce(sum(case when {c} then area end), 0e0), 5) as {n}" for n, c in criteria.items())


ORACLE["extended_analyses"] = f"with {PX} select list_id, location_id, {area_sums(EXTENTS)} from px group by 1, 2"
ORACLE["extended_yearly"] = yearly(PX, "px", "px", list(EXTENDED_YEARLY), list(EXTENDED_YEARLY.values()))
STANDING_IN = f"{PIX}, {VALUED}, ext as (select *, prim as intact, peat as protected, prim as soy from valued)"
ORACLE["fcd_extended"] = f"""select y.*, {", ".join(f"a.{name}" for name in EXTENTS)}
from ({yearly(STANDING_IN, "ext", "poly", list(EXTENDED_YEARLY), list(EXTENDED_YEARLY.values()))}) y
join (with {STANDING_IN} select list_id, location_id, {area_sums(EXTENTS)} from ext group by 1, 2) a
  on a.list_id = y.list_id and a.location_id = y.location_id"""
ORACLE["analysis_columns"] = (
    f"with {PX} select list_id, location_id, {area_sums(dict(zip(NAMES, CRITERIA)))} from px group by 1, 2"
)

# -- aggregates ---------------------------------------------------------------------

ORACLE["loss_year_agg"] = yearly(PX, "px", "px", ["area"], ["true"])

ORACLE["pixel_agg_test"] = f"""with {PX}
select list_id as id, (case when loss <> 0 then loss + 2000 end)::bigint as loss_year,
  round(sum(case when density > 90 then area end), 5) as area_gt90,
  round(sum(case when density < 30 then area end), 5) as area_lt30
from px group by 1, 2"""

ORACLE["histogram_agg"] = f"""with {CELL}
select g.list_id, b as bucket, count(c.loss)::double as total
from (select distinct key_col % 4 as list_id from tile) g cross join range(32) t(b)
left join cell c on c.key_col % 4 = g.list_id and c.loss = b group by 1, 2"""

ORACLE["histogram_scale"] = f"""with {CELL},
tot as (select key_col, key_row, loss, sum(prim) as v from cell group by 1, 2, 3)
select t.key_col, t.key_row, b as bucket,
  round(coalesce(v, 0)::double*{area_ha("90e0 - (t.key_row*2 + 1)*10/8000e0")}, 6) as area
from tile t cross join range(32) s(b)
left join tot on tot.key_col = t.key_col and tot.key_row = t.key_row and tot.loss = b"""

ORACLE["zonal_histogram"] = f"""with {PIX}, {VALUED}
select list_id, location_id, key_col, key_row, loss as bucket, count(*) as n,
  count(*) filter (where density > 30) as n_dense
from valued where loss is not null group by 1, 2, 3, 4, 5"""

ORACLE["zonal_prefix"] = ORACLE["zonal_histogram"]

# -- grid -----------------------------------------------------------------------------

ORACLE["pixel_area"] = f"""with {pt()}, {KEYED}
select key_row, count(*) as n, round({area_ha("90e0 - (key_row*2 + 1)*400/8000e0")}, 8) as area_ha from keyed group by key_row"""

ORACLE["points_per_tile"] = f"with {pt()}, {GRID_ID} select grid_id, count(*) as n from gid group by 1"

ORACLE["glad_ids"] = f"""with {pt()}, {GRID_ID}
select distinct grid_id, printf('%03d', abs(lon)) || case when lon >= 0 then 'E' else 'W' end || '_'
  || printf('%02d', abs(lat - 10)) || case when lat - 10 >= 0 then 'N' else 'S' end || '_'
  || printf('%03d', abs(lon + 10)) || case when lon + 10 >= 0 then 'E' else 'W' end || '_'
  || printf('%02d', abs(lat)) || case when lat >= 0 then 'N' else 'S' end as glad_id from gid"""

ORACLE["tile_keys"] = f"with {pt()}, {KEYED} select key_col, key_row, count(*) as n from keyed group by 1, 2"

ORACLE["tile_extents"] = f"""with {TILE},
e as (
  select key_col, key_row, key_col*10/4000e0 - 180e0 as xmin, 90e0 - (key_row + 1)*10/4000e0 as ymin,
    (key_col + 1)*10/4000e0 - 180e0 as xmax, 90e0 - key_row*10/4000e0 as ymax from tile)
select key_col, key_row, round(xmin, 7) as xmin, round(ymin, 7) as ymin, round(xmax, 7) as xmax, round(ymax, 7) as ymax,
  5::bigint as vertices, round(3*xmin + 2*xmax, 6) as sum_x, round(3*ymin + 2*ymax, 6) as sum_y from e"""

ORACLE["pixel_years"] = f"""with {PX}
select loss + 2000 as loss_year, count(*) as n from px where loss is not null group by 1"""

# -- locations and coverage ---------------------------------------------------------------

ORACLE["locations_scan"] = f"""with {POLY}
select list_id, location_id, count(*) as n_parts, sum(case when hole > 0 then 2 else 1 end)::bigint as n_rings
from poly group by 1, 2"""

ORACLE["locations_geojson"] = ORACLE["locations_scan"]

ORACLE["vertex_counts"] = f"""with {POLY}
select list_id, location_id, sum(case when hole > 0 then 10 else 5 end)::bigint as n from poly group by 1, 2"""

ORACLE["crowded_locations"] = f"select * from ({ORACLE['vertex_counts']}) where n > 10"

ORACLE["aoi_per_list"] = f"""with {POLY}
select list_id, round(min(cx + 0.25e0 - w)/4000e0 - 180e0, 7) as xmin, round(90e0 - max(cy + 0.125e0 + w)/4000e0, 7) as ymin,
  round(max(cx + 0.25e0 + w)/4000e0 - 180e0, 7) as xmax, round(90e0 - min(cy + 0.125e0 - w)/4000e0, 7) as ymax
from poly where location_id = -1 group by 1"""

ORACLE["segment_cover"] = f"with {touched(10)} select list_id, location_id, c as key_col, r as key_row from touch"

ORACLE["area_files"] = f"with {touched(40000)} select distinct c as file_col, r as file_row from touch"

ORACLE["coverage_runs"] = f"""with {PIX}
select list_id, location_id, key_col, key_row, count(*) as n_pixels, sum(r % 10)::bigint as sum_r
from pix group by 1, 2, 3, 4"""

ORACLE["coverage_crossing_rings"] = f"""with {POLY},
cand as (select *, unnest(range(cx - w - 1, cx + w + 2)) as c from poly),
cand2 as (select *, unnest(range(cy - w - 1, cy + w + 2)) as r from cand),
pix as (
  select distinct list_id, location_id, r, c from cand2
  where abs(c - cx + 0.25e0) < abs(r - cy + 0.375e0) and abs(r - cy + 0.375e0) < w)
select list_id, location_id, c // 10 as key_col, r // 10 as key_row, count(*) as n_pixels, sum(r % 10)::bigint as sum_r
from pix group by 1, 2, 3, 4"""

ORACLE["coverage_all_touched"] = f"""with {TOUCHED_PIX}
select list_id, location_id, key_col, key_row, count(*) as n_pixels from pix group by 1, 2, 3, 4"""

def spiked(size: int) -> str:
    """Cells of `size` pixels that share a point with a square or its spike: the square as a box,
    the spike as a line that has corners of the cell on both sides."""
    return (
        POLY
        + f""",
lines as (
  select *, cx % 3 = 0 as bare, cx + 0.25e0 + w as x0, cy + 0.125e0 + w as y0, cx + 0.25e0 + 3*w + 1.5e0 as x1, cy + 0.125e0 + w + 7 as y1
  from poly),
cand as (select *, unnest(range((cx - w - 1)//{size}, (cx + 3*w + 3)//{size} + 1)) as c from lines),
cand2 as (select *, unnest(range((cy - w - 1)//{size}, (cy + w + 8)//{size} + 1)) as r from cand),
sides as (
  select *, (x1 - x0)*(r*{size} - y0) - (y1 - y0)*(c*{size} - x0) as a, (x1 - x0)*(r*{size} - y0) - (y1 - y0)*((c + 1)*{size} - x0) as b,
    (x1 - x0)*((r + 1)*{size} - y0) - (y1 - y0)*(c*{size} - x0) as d, (x1 - x0)*((r + 1)*{size} - y0) - (y1 - y0)*((c + 1)*{size} - x0) as e
  from cand2),
touch as (
  select distinct list_id, location_id, r, c from sides
  where (not bare and (c + 1)*{size} >= cx + 0.25e0 - w and c*{size} <= x0 and (r + 1)*{size} >= cy + 0.125e0 - w and r*{size} <= y0)
    or ((c + 1)*{size} >= x0 and c*{size} <= x1 and (r + 1)*{size} >= y0 and r*{size} <= y1
      and least(a, b, d, e) <= 0 and greatest(a, b, d, e) >= 0))"""
    )


ORACLE["coverage_spikes"] = f"""with {spiked(1)}
select list_id, location_id, c // 10 as key_col, r // 10 as key_row, count(*) as n_pixels from touch group by 1, 2, 3, 4"""

ORACLE["spikes_cover"] = f"with {spiked(10)} select list_id, location_id, c as key_col, r as key_row from touch"

ORACLE["two_level_cover"] = f"""with {PIX}
select list_id, location_id, key_col, key_row, count(*) as n_pixels from pix group by 1, 2, 3, 4"""

ORACLE["coverage_pixels"] = f"""with {PIX}
select list_id, location_id, r, count(*) as n, sum(c)::bigint as sum_c from pix group by 1, 2, 3"""

ORACLE["coverage_mask"] = f"""with {PIX}
select list_id, location_id, key_col, key_row, 100::bigint as cells, count(*) as n, sum(i)::bigint as sum_i
from pix group by 1, 2, 3, 4"""

ORACLE["covered_pixels"] = f"with {PIX} select list_id, count(*) as n from pix group by 1"

ORACLE["cell_map_explode"] = f"""with {PIX}
select list_id, key_col, key_row, location_id, count(*) as n from pix group by 1, 2, 3, 4"""

ORACLE["cell_map_masks"] = ORACLE["cell_map_geojson"] = ORACLE["cell_map_explode"]

# -- tiles -------------------------------------------------------------------------------

LONG = (
    CELL
    + f""",
long as (
  select '{LAYERS.loss}' as layer, key_col, key_row, loss as v from cell
  union all select '{LAYERS.density}', key_col, key_row, density from cell
  union all select '{LAYERS.primary}', key_col, key_row, prim from cell
  union all select '{LAYERS.peat}', key_col, key_row, peat from cell where has_peat)"""
)

ORACLE["tile_scan"] = f"with {LONG} select layer, key_col, key_row, count(v) as n_valid from long group by 1, 2, 3"

ORACLE["stored_tile_scan"] = ORACLE["tile_scan"]

ORACLE["stacked_tile_scan"] = f"""with {CELL}
select key_col, key_row, count(loss) as n_0, count(density) as n_1, count(prim) as n_2, count(peat) as n_3 from cell group by 1, 2"""

ORACLE["tile_coverage_mask"] = f"""with {PIX}, {VALUED}
select list_id, location_id, key_col, key_row, sum(loss)::bigint as total, count(loss) as n
from valued where loss is not null group by 1, 2, 3, 4"""

ORACLE["tile_runs_max"] = f"""with {CELL}
select key_col, key_row, max(loss) as max_0, max(density) as max_1, max(prim) as max_2, max(peat) as max_3 from cell group by 1, 2"""

ORACLE["tile_max"] = f"with {LONG} select layer, key_col, key_row, max(v) as max_cell from long group by 1, 2, 3"


def per_tile(value: str) -> str:
    return f"""with {CELL}
select key_col, key_row, coalesce(sum({value}), 0)::bigint as total, count({value}) as n from cell group by 1, 2"""


ORACLE["tile_local_multiply"] = per_tile("loss*density")
ORACLE["tile_local_greater"] = per_tile("case when loss > 12 then 1 when loss is not null then 0 end")
ORACLE["tile_mask"] = per_tile("case when loss is not null then density end")
ORACLE["tile_mask_by_value"] = per_tile("case when prim <> 0 then density end")

for name in ("multiply", "greater"):
    ORACLE[f"tile_runs_{name}"] = ORACLE[f"tile_local_{name}"]
for name in ("mask", "mask_by_value"):
    ORACLE[f"tile_runs_{name}"] = ORACLE[f"tile_{name}"]
ORACLE["tile_runs_criterion"] = per_tile("case when loss > 0 and peat > 0 then 1 when loss is not null and peat is not null then 0 end")

ORACLE["criterion_tiles"] = f"""with {CELL}
select key_col, key_row, count(*) filter (where loss > 0 and density > 30) as dense30,
  count(*) filter (where loss > 0 and density > 90) as dense90, count(*) filter (where loss > 0 and prim > 0) as in_primary
from cell group by 1, 2"""

ORACLE["tile_explode"] = f"""with {CELL}
select key_row, i as cell, count(*) as n, sum(loss)::bigint as sum_0, sum(density)::bigint as sum_1, sum(peat)::bigint as sum_2
from cell group by 1, 2"""

ORACLE["layer_join"] = f"""with {CELL}
select key_col, key_row, sum(loss)::bigint as sum_0, sum(density)::bigint as sum_1, sum(prim)::bigint as sum_2,
  sum(peat)::bigint as sum_3 from cell group by 1, 2"""

ORACLE["layer_join_missing"] = f"""with {touched(10)}, {CELL},
sums as (
  select key_col, key_row, sum(density)::bigint as sum_0, sum(peat)::bigint as sum_1 from cell group by 1, 2)
select k.key_col, k.key_row, sum_0, sum_1
from (select distinct c as key_col, r as key_row from touch) k
left join sums s on s.key_col = k.key_col and s.key_row = k.key_row"""

ORACLE["spatial_join"] = f"""with {touched(10)}, {TILE}
select list_id, location_id, key_col, key_row, case when m is null then 3 else 4 end::bigint as n_layers
from touch join tile on key_col = c and key_row = r"""

ORACLE["locations_with_tiles"] = f"""with {PIX}, {CELL},
sums as (select key_col, key_row, sum(peat)::bigint as tile_sum from cell where has_peat group by 1, 2)
select list_id, location_id, p.key_col, p.key_row, count(*) as n_pixels, max(tile_sum) as tile_sum
from pix p join sums s on s.key_col = p.key_col and s.key_row = p.key_row group by 1, 2, 3, 4"""

ORACLE["locations_with_tiles_left"] = f"""with {PIX}, {CELL},
sums as (select key_col, key_row, sum(peat)::bigint as tile_sum from cell where has_peat group by 1, 2)
select list_id, location_id, p.key_col, p.key_row, count(*) as n_pixels, max(tile_sum) as tile_sum
from pix p left join sums s on s.key_col = p.key_col and s.key_row = p.key_row group by 1, 2, 3, 4"""

ORACLE["aoi_tile_filter"] = f"""with {touched(10)}, {LONG}
select layer, key_col, key_row, coalesce(sum(v), 0)::bigint as total from long
where exists (select 1 from touch where location_id = -1 and c = key_col and r = key_row) group by 1, 2, 3"""

# -- catalogue ----------------------------------------------------------------------------

ORACLE["catalog_resolve"] = f"""with {CATALOG},
ranked as (select *, row_number() over (partition by name order by pos) as rn from cat where flavor = 'pro')
select name, source_uri from ranked where rn = 1"""

ORACLE["catalog_file"] = ORACLE["catalog_resolve"].replace("flavor = 'pro'", "flavor = 'default'")

ORACLE["catalog_latest"] = f"""with {CATALOG},
newest as (select name, 'v' || max(page_id) as version from cat0 group by 1)
select flavor, pos, cat.name, replace(source_uri, 'latest', version) as source_uri from cat join newest n on n.name = cat.name"""

ORACLE["catalog_malformed"] = f"with {CATALOG} select * from cat where source_uri not like '%.tif'"

ORACLE["tile_uris"] = f"with {pt()}, {file_uri('pt', 'f')} select uri, count(*) as n from f group by 1"

ORACLE["tile_listing"] = f"""with {pt()}, {pt('supplier', 's_suppkey', 'st')}, {file_uri('pt', 'f')}, {file_uri('st', 's')}
select distinct uri from f where uri in (select uri from s)"""

# -- legends ------------------------------------------------------------------------------

LAND = f"[{', '.join(map(str, LAND_COVER_CODES))}][1 + code % {len(LAND_COVER_CODES)}]"
CLASS_CODES = [
    ("ibge_bra_biomes", None, "code % 8"),
    ("idn_forest_area", None, "code % 9"),
    ("idn_land_cover_2017", "flagship", LAND),
    ("idn_land_cover_2017", "pro", LAND),
    ("plantations", None, "code % 13"),
    ("wdpa_protected_areas", None, "code % 4"),
    ("rspo_southeast_asia_land_cover_2010", None, "code % 24"),
]

ORACLE["decode_classes"] = f"with {PX} " + " union all ".join(
    f"""select '{layer}' as layer, '{variant or ""}' as variant,
  {case(code, LEGENDS[layer][0][variant], LEGENDS[layer][1])} as label, round(sum(area), 5) as area, count(*) as n
from px group by 3"""
    for layer, variant, code in CLASS_CODES
)

ORACLE["area_by_class"] = f"""with {PX}
select list_id, {case(LAND, LEGENDS["idn_land_cover_2017"][0]["pro"], "")} as label, round(sum(area), 5) as area
from px group by 1, 2"""

ORACLE["decode_years"] = f"""with {PX},
y as (
  select area, case when loss <> 0 then loss + 2000 end as loss_year,
    case code % 3 when 0 then 0 when 1 then 2013 else 2016 end as ifl from px)
select loss_year, case when ifl = 0 then '' else ifl::varchar end as intact_year, ifl <> 0 as intact_2000,
  ifl in (2013, 2016) as intact_2013, ifl = 2016 as intact_2016, round(sum(area), 5) as area
from y group by 1, 2, 3, 4, 5"""

DENSITY_CASE = " ".join(f"when density <= {upper} then {label}" for upper, label in DENSITY_CLASSES.items())
ORACLE["decode_density"] = f"""with {PX}
select (case {DENSITY_CASE} else {DENSITY_TOP} end)::bigint as density, density > 60 as above_60,
  round(sum(area), 5) as area, count(*) as n from px group by 1, 2"""

FLAGS = ", ".join(
    f"((code % 256) // {2**bit}) % 2 = 1 as {name.lower().replace(' ', '_')}" for name, bit in REGION_BITS.items()
)
ORACLE["decode_region_flags"] = f"""with {PX}
select {FLAGS}, round(sum(area), 5) as area, count(*) as n from px group by 1, 2, 3, 4, 5, 6"""
