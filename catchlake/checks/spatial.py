"""Extents as boxes and grid cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake.checks.registry import check
from catchlake.functions.columns import ring_area
from catchlake.operators import grid as G
from catchlake.plans import extents
from catchlake.session import materialize

MEET = "b.xmin <= g.xmax and g.xmin <= b.xmax and b.ymin <= g.ymax and g.ymin <= b.ymax"
CLIP = f"""
select b.gid, b.taxon_key, b.is_extended, g.id as cell_id, greatest(b.xmin, g.xmin) as xmin, greatest(b.ymin, g.ymin) as ymin,
  least(b.xmax, g.xmax) as xmax, least(b.ymax, g.ymax) as ymax,
  (least(b.xmax, g.xmax) - greatest(b.xmin, g.xmin)) * (least(b.ymax, g.ymax) - greatest(b.ymin, g.ymin)) as area
from {{taxon_extent_box}} b join {{grid}} g on {MEET}"""


@check("g01_intersecting", f"select gid, taxon_key, cell_id from ({CLIP}) x")
def g01(t):
    return G.intersecting(t.taxon_extent_box, t.grid).select("gid", "taxon_key", "cell_id")


@check("g02_clip", f"select gid, cell_id, xmin, ymin, xmax, ymax, round(area, 8) as area from ({CLIP}) x")
def g02(t):
    clipped = G.clip(G.intersecting(t.taxon_extent_box, t.grid))
    return clipped.select("gid", "cell_id", *G.CORNERS, F.round("area", 8).alias("area"))


def _union_sql(key: str) -> str:
    return f"""
select {key}, count(*) as pieces, round(sum(area), 6) as area, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax
from ({CLIP}) x group by 1"""


@check("g03_union_by_extent", _union_sql("gid"))
def g03(t):
    return G.union_by(G.clip(G.intersecting(t.taxon_extent_box, t.grid)), "gid").withColumn("area", F.round("area", 6))


@check("g03_union_by_cell", _union_sql("cell_id"))
def g03_cell(t):
    return G.union_by(G.clip(G.intersecting(t.taxon_extent_box, t.grid)), "cell_id").withColumn("area", F.round("area", 6))


@check("g04_merge_extents", f"select distinct taxon_key, cell_id from ({CLIP}) x where taxon_key in (select taxon_key from {{taxon_name}})")
def g04(t):
    cells = G.extent_cells(t.taxon_extent_box, t.grid, ["taxon_key"])
    return G.merge_extents(cells, t.taxon_name)


@check("g05_extent_from_distribution", """
select distinct d.taxon_key, b.id as cell_id from {taxon_distribution} d join {grid} a on a.id = d.cell_id
join {grid} b on b.gx between a.gx - 1 and a.gx + 1 and b.gy between a.gy - 1 and a.gy + 1
where d.is_backfilled and d.taxon_key in (select taxon_key from {taxon_name})""")
def g05(t):
    return G.extent_from_distribution(t.taxon_distribution, t.grid, t.taxon_name)


OUTSIDE = """
select e.taxon_key, e.is_extended, c.cell_id from (select distinct taxon_key, is_extended from {taxon_extent_box}) e
join (select distinct taxon_key, cell_id from {taxon_distribution} where taxon_key in (
  select taxon_key from {taxon_distribution} where not is_backfilled)) c on c.taxon_key = e.taxon_key
join {grid} g on g.id = c.cell_id
left join (
  select b.taxon_key, b.is_extended, h.id as cell_id from (select distinct taxon_key, is_extended, xmin, ymin, xmax, ymax
    from {taxon_extent_box}) b
  join {grid} h on sqrt(pow(greatest(b.xmin - h.xmax, h.xmin - b.xmax, 0), 2) + pow(greatest(b.ymin - h.ymax, h.ymin - b.ymax, 0), 2)) <= 0.1
  group by all) n on n.taxon_key = e.taxon_key and n.is_extended = e.is_extended and n.cell_id = c.cell_id
where n.cell_id is null"""


@check("g06_outside_extent", OUTSIDE)
def g06(t):
    return G.outside_extent(t.taxon_distribution, t.grid, t.taxon_extent_box, keep=materialize)


CHILDREN = """
targets as (select taxon_key, lineage from {taxon_lineage} where level = 2
  and taxon_key not in (select taxon_key from {lineage_box})),
children as (select t.taxon_key, c.taxon_key as child from targets t join {taxon_lineage} c on c.parent = t.lineage
  where c.taxon_key in (select taxon_key from {lineage_box})),
counts as (select taxon_key, count(*) as n from children group by 1)"""


@check("g07_rollup_extents", f"""
with {CHILDREN}
select distinct k.taxon_key, n.n = 1 and b.is_extended as is_extended, true as is_rolled_up, g.id as cell_id
from children k join counts n on n.taxon_key = k.taxon_key join {{lineage_box}} b on b.taxon_key = k.child
join {{grid}} g on {MEET}""")
def g07(t):
    return extents.rollup_extents(t.taxon_lineage, t.lineage_box, t.grid, 2)


@check("g07_rollup_log", f"""
with {CHILDREN}
select k.taxon_key, cast(floor(child / 1000) as bigint) as block, array_to_string(list_sort(list(child)), ',') as children_taxon_keys,
  max(n) as children_distributions_found from children k join counts n on n.taxon_key = k.taxon_key group by 1, 2""")
def g07_log(t):
    log = extents.rollup_log(extents.rollup_children(t.taxon_lineage, t.lineage_box, 2))
    return log.withColumn("children_taxon_keys", F.array_join("children_taxon_keys", ","))


@check("g08_purge_contained", """
with unique_boxes as (select taxon_key % 25 as taxon_key, xmin, ymin, xmax, ymax, min(gid) as gid from {lineage_box} group by 1, 2, 3, 4, 5)
select gid, taxon_key, xmin, ymin, xmax, ymax from unique_boxes a where not exists (select 1 from unique_boxes b
  where b.taxon_key = a.taxon_key and b.gid <> a.gid and b.xmin <= a.xmin and b.ymin <= a.ymin and b.xmax >= a.xmax and b.ymax >= a.ymax)""")
def g08(t):
    pieces = t.lineage_box.withColumn("taxon_key", F.col("taxon_key") % 25)
    return G.purge_contained(pieces, "taxon_key", "gid")


def ring():
    points = F.array(*[F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in range(1, 6)])
    return F.slice(points, F.lit(1), F.col("points"))


SHOELACE = "abs(x1*y2 - x2*y1 + x2*y3 - x3*y2 + case when points = 5 then x3*y4 - x4*y3 + x4*y5 - x5*y4 else 0 end) / 2"


@check("g09_invalid_extents", f"""
select gid, taxon_key from {{extent_corner}} where points < 4 or x1 <> case points when 3 then x3 else x5 end
  or y1 <> case points when 3 then y3 else y5 end or {SHOELACE} <= 0""")
def g09(t):
    return extents.invalid_extents(t.extent_corner.withColumn("ring", ring()))


@check("g10_load_extents", rf"""
with files as (select file_name, count(*) as n, max(round({SHOELACE}, 8)) as area from {{extent_feature}} group by 1),
keyed as (select *, cast(regexp_extract(file_name, '^(\d+)\-?(\d+)?.shp', 1) as int) as taxon_key,
  regexp_extract(file_name, '^(\d+)\-?(\d+)?.shp', 2) <> '' as is_extended from files)
select taxon_key, is_extended, round({SHOELACE}, 8) as area from (select b.is_extended, c.* from {{extent_corner}} c
  join {{taxon_extent_box}} b on b.gid = c.gid) e
where not exists (select 1 from keyed k where k.taxon_key = e.taxon_key and k.is_extended = e.is_extended)
union all
select taxon_key, is_extended, area from keyed where n = 1 and area > 0 and taxon_key in (select taxon_key from {{taxon_name}})""")
def g10(t):
    existing = t.extent_corner.join(t.taxon_extent_box.select("gid", "is_extended"), "gid").withColumn("ring", ring())
    loaded = extents.load_extents(t.extent_feature.withColumn("ring", ring()), t.taxon_name, existing)
    return loaded.select("taxon_key", "is_extended", F.round(ring_area(F.col("ring")), 8).alias("area"))


@check("g11_check_manifest", r"""
select path, f.taxon_key, f.taxon_name, folder from (
  select path, string_split(path, '/')[-2] as folder, cast(regexp_extract(string_split(path, '/')[-1], '^(\d+)\-?(\d+)?.shp', 1) as int) as key
  from {extent_path}) p
join (select taxon_key, common_name as taxon_name from {taxon_lineage}) f on f.taxon_key = p.key
where taxon_name <> replace(folder, '_', ' ')""")
def g11(t):
    taxa = t.taxon_lineage.select("taxon_key", F.col("common_name").alias("taxon_name"))
    return extents.check_manifest(t.extent_path, taxa)
