"""Quality checks and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake.checks.registry import check, in_order, spark_of
from catchlake.operators.sizing import measured
from catchlake.plans import documents, quality
from catchlake.session import materialize, shared_path
from catchlake.sources import readers


@check("q07_catch_fluctuation", """
with annual as (select area_key, year, sum(catch_sum) as catch from {stock_fact} group by all),
spread as (select area_key, sqrt(var_samp(cast(catch as double))) / avg(catch) as coevar from annual group by all)
select name, a.main_area_id as area_id, layer_name, round(coevar, 8) as coevar,
  cast(row_number() over (order by coevar desc nulls first, a.main_area_id, layer_name) as int) as position from spread s
join {area} a on a.area_key = s.area_key join {entity_name} n on n.marine_layer_id = a.marine_layer_id and n.id = a.main_area_id""")
def q07(t):
    d = measured(area=t.area, names=t.entity_name)
    report = in_order(quality.catch_fluctuation(t.stock_fact, d["area"], d["names"]), "fluctuation")
    return report.withColumn("coevar", F.round("coevar", 8))


@check("q08_compare_distribution", """
with compared as (
  select coalesce(o.taxon_key, v.taxon_key) as taxon_key, o.cell_id is not null as was, v.cell_id is not null as is_now,
    o.relative_abundance as old_share, v.relative_abundance as new_share, c.cell_id is not null as wet
  from {taxon_distribution} o full join {new_distribution} v on v.taxon_key = o.taxon_key and v.cell_id = o.cell_id
  left join (select cell_id from {cell} where water_area > 0) c on c.cell_id = coalesce(o.cell_id, v.cell_id))
select common_name, taxon_key, count(*) filter (where was and wet and new_share is null) as cells_now_missing,
  count(*) filter (where wet and old_share > 0) as old_cells, nullif(count(*) filter (where wet and new_share > 0), 0) as new_cells,
  cast(row_number() over (order by count(*) filter (where was and wet and new_share is null) desc, taxon_key) as int) as position
from compared join {taxon_name} using (taxon_key) group by common_name, taxon_key
having cells_now_missing > 0 and old_cells > 0 and count(*) filter (where is_now) > 0""")
def q08(t):
    return in_order(quality.compare_distribution(t.taxon_distribution, t.new_distribution, t.cell, t.taxon_name), "comparison")


RULES = {
    1: "amount <= 2",
    2: "taxon_key is null or taxon_key = 0",
    3: "year > 2000 and catch_type_id = 2",
    4: "eez_id = 0 and fao_area_id > 2",
    5: "amount < 0",
}


@check("q11_run_rules", """
select 1 as rule_id, id from {raw_catch} where amount <= 2 and year <> 1996
union all select 2, id from {raw_catch} where taxon_key is null or taxon_key = 0
union all select 4, id from {raw_catch} where eez_id = 0 and fao_area_id > 2""")
def q11(t):
    """Violations of all rules, then those of two rules again in mended data, of which one finds nothing any more."""
    path = shared_path(spark_of(t), "rules")
    quality.write_rule_results(quality.run_rules(t.raw_catch, RULES, "id"), path, RULES)
    mended = t.raw_catch.filter("year <> 1996").withColumn("catch_type_id", F.lit(1))
    again = {r: RULES[r] for r in (1, 3)}
    quality.write_rule_results(quality.run_rules(mended, again, "id"), path, again)
    return readers.read_current(spark_of(t), path).select("rule_id", "id")


NODE = """json_object('key', taxon_key, 'name', common_name, 'level', level, 'lineage', lineage, 'parent', parent,
  'is_dist', is_distribution_available, 'is_extent', is_extent_available,
  'total_catch', lpad(format('{:,.2f}', total_catch), 22, ' '), 'total_value', lpad(format('{:,.2f}', total_value), 22, ' '))"""


# A walk from the roots, level by level; a step is the last part of a lineage and the taxon's key.
TREE_SQL = f"""
with recursive taxa as (
  select *, concat(string_split(lineage, '.')[-1], chr(1), lpad(cast(taxon_key as varchar), 20, '0')) as step, {NODE} as node from {{taxon_lineage}}),
walk as (
  select taxon_key, lineage, node, common_name as root_order, [step] as path from taxa where level = 1 and cast(taxon_key as varchar) like '19%'
  union all
  select t.taxon_key, t.lineage, t.node, w.root_order, list_append(w.path, t.step) from taxa t join walk w on t.parent = w.lineage),
placed as (select *, path[:-2] as above, row_number() over (partition by path[:-2] order by root_order, path) = 1 as first_child from walk),
shown as (select *, path in (select above from placed) as is_parent from placed)
select root_order, array_to_string(path, '/') as path,
  concat(case when first_child then '' else ',' end, left(node, length(node) - 1), case when is_parent then ',"children":[' else '}}' end) as text from shown
union all
select root_order, concat(array_to_string(path, '/'), '/', chr(65535)), ']}}' from shown where is_parent
union all select '', '', '{{"name":"Non-Fishes","key":"N/A","lineage":"root","children":['
union all select chr(65535), chr(65535), ']}}'""".replace("{{taxon_lineage}}", "{taxon_lineage}").replace("}}", "}").replace("'{{", "'{")


@check("q09_taxon_tree", TREE_SQL)
def q09(t):
    tree = documents.taxon_tree(t.taxon_lineage, "19", "Non-Fishes")
    return tree.withColumn("path", F.array_join("path", "/"))


TOTALS = """
sums as (select fishing_entity_id, sum(catch_sum) as catch, sum(real_value) as value from {stock_fact} where marine_layer_id in (1, 2) group by 1),
ends as (select cast(min(catch) as double) as c0, cast(max(catch) as double) as c1, cast(min(value) as double) as v0,
  cast(max(value) as double) as v1 from sums),
totals as (select s.fishing_entity_id as id, f.name, cast(s.catch as decimal(30,2)) as catch,
  cast(least(floor((cast(s.catch as double) - c0) * 20 / (c1 - c0)), 20) as bigint) as catch_bucket,
  cast(s.value as decimal(30,2)) as value,
  cast(least(floor((cast(s.value as double) - v0) * 20 / (v1 - v0)), 20) as bigint) as value_bucket
  from sums s join {fishing_entity} f on f.fishing_entity_id = s.fishing_entity_id, ends)"""


def _entity_sums(t):
    return materialize(documents.entity_sums(t.stock_fact), "entity-sums")


@check("q10_entity_totals", f"with {TOTALS} select * from totals")
def q10(t):
    return documents.entity_totals(_entity_sums(t), t.fishing_entity)


@check("q10_entity_treemap", f"""
with {TOTALS}
select 1 as section, id, concat(case when id = (select min(id) from totals) then '' else ',' end, json_object('id', id, 'name', name,
  'catch', catch, 'catch_bucket', catch_bucket, 'value', value, 'value_bucket', value_bucket)) as text from totals
union all select 0, null, '{{"id":0,"name":"All Fishing Entities","children":['
union all select 2, null, ']}}'""".replace("'{{", "'{").replace("}}'", "}'"))
def q10_treemap(t):
    return documents.entity_treemap(_entity_sums(t), t.fishing_entity)


@check("q12_taxon_list", """
select 1 as section, common_name as name, taxon_key, concat(case when row_number() over (order by common_name, taxon_key) = 1 then '' else ',' end,
  json_object('taxon_key', taxon_key, 'name', common_name, 'taxon_level_id', level, 'lineage', lineage)) as text from {taxon_lineage}
union all select 0, null, null, '{"name":"taxon","children":['
union all select 2, null, null, ']}'""")
def q12(t):
    return documents.taxon_list(t.taxon_lineage)
