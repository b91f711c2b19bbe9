"""The catch tables, derived from the Parquet tables of a test folder by SQL that Spark and DuckDB both read.

Every view reads its tables whole. {name} stands for a Parquet table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

_AREA_PARTS = [(1, sub) for sub in range(1, 6)] + [(layer, 1) for layer in (2, 3, 4, 19)]

# A supplier's box on the grid; sizes differ, so that some boxes lie in others.
_BOX = """
  cast((s_suppkey * 7 % 40) * 0.5 + 0.1 as double) as xmin, cast((s_suppkey * 3 % 30) * 0.5 + 0.1 as double) as ymin,
  cast((s_suppkey * 7 % 40) * 0.5 + 1.6 + (s_suppkey % 3) * 0.5 as double) as xmax,
  cast((s_suppkey * 3 % 30) * 0.5 + 1.1 + (s_suppkey % 3) * 0.5 as double) as ymax"""


def _literals(name: str, values, **more) -> str:
    """A handful of literal rows, with a column of ones to join them on."""
    columns = {name: values, **more}
    rows = zip(*columns.values(), strict=True)
    return "(" + " union all ".join(
        "select 1 as one, " + ", ".join(f"{v} as {c}" for c, v in zip(columns, row, strict=True)) for row in rows) + ")"


VIEWS = {
    "allocation_data": """
select o_orderkey as universal_data_id, cast(case when o_custkey % 97 = 5 then 223 else o_custkey % 25 end as int) as fishing_entity_id, year(o_orderdate) as year,
  cast(o_custkey % 40 as int) as taxon_key, cast(o_custkey % 4 + 1 as int) as sector_type_id,
  case o_orderstatus when 'F' then 2 else 1 end as catch_type_id,
  case o_orderstatus when 'P' then 2 else 1 end as reporting_status_id,
  cast(o_orderkey % 73 as int) as gear_type_id, cast(o_orderkey % 3 + 1 as int) as data_layer_id,
  case when o_orderkey % 10 = 0 then null else cast(o_totalprice as decimal(18,2)) end as unit_price
from {orders}""",
    "allocation_result": """
select l_orderkey as universal_data_id, l_partkey as cell_id, l_suppkey as allocation_simple_area_id,
  cast(case when l_quantity < 2 then 0 when l_partkey % 50 = 7 then 0.0001 else l_quantity end as decimal(18,4)) as allocated_catch
from {lineitem}""",
    "allocation_simple_area": """
select s_suppkey as allocation_simple_area_id, case when s_suppkey % 5 = 0 then 0 else s_nationkey + 1 end as eez_id,
  s_nationkey % 5 + 1 as fao_area_id
from {supplier}""",
    "cell": "select p_partkey as cell_id, cast((p_size + 10) * 21 as decimal(18,4)) as water_area from {part}",
    "simple_area_cell_assignment_raw": """
select case p_partkey % 4 when 0 then 3 when 1 then 4 when 2 then 14 else 19 end as marine_layer_id,
  cast(p_size % 12 + 1 as int) as area_id, p_partkey as cell_id, cast(p_size % 5 + 1 as int) as fao_area_id,
  cast((p_size + 10) * case p_partkey % 3 when 0 then 7 when 1 then 3 else 0.007 end as decimal(18,4)) as water_area
from {part}
union all
select case p_partkey % 4 when 0 then 3 when 1 then 4 when 2 then 14 else 19 end, cast(p_size % 12 + 2 as int), p_partkey,
  cast(p_size % 5 + 1 as int), cast((p_size + 10) * 5.25 as decimal(18,4))
from {part}""",
    "area_fao": """
select distinct cast(p_size % 12 + 1 as int) as area_id, cast(p_size % 5 + 1 as int) as fao_area_id from {part}""",
    "end_use": f"""
select fishing_entity_id, year, case when taxon_key % 2 = 0 then taxon_key else taxon_key + 100 end as taxon_key,
  sector_type_id, reporting_status_id, gear_type_id, catch_type_id, end_use_type_id, end_use_percentage
from (select distinct 1 as one, fishing_entity_id, year, taxon_key, sector_type_id, reporting_status_id, gear_type_id, catch_type_id
  from {{allocation_data}}) d
join {_literals("end_use_type_id", (1, 2), end_use_percentage=("cast(0.7 as decimal(6,4))", "cast(0.3 as decimal(6,4))"))} u
  on u.one = d.one""",
    "price": f"""
select year, fishing_entity_id, case when taxon_key % 3 = 0 then taxon_key + 100 else taxon_key end as taxon_key,
  end_use_type_id, cast(case when taxon_key % 11 = 4 then null else 100 + taxon_key * 10 + end_use_type_id end as decimal(18,2)) as price
from (select distinct 1 as one, year, fishing_entity_id, taxon_key from {{allocation_data}}) d
join {_literals("end_use_type_id", (1, 2, 4))} u on u.one = d.one""",
    "uncertainty_eez": f"""
select case when n_nationkey % 5 = 4 then n_nationkey + 101 else n_nationkey + 1 end as eez_id, sector_type_id,
  period_id, (n_nationkey + sector_type_id + period_id) % 4 + 1 as score, layer
from (select 1 as one, n_nationkey from {{nation}}) n
join {_literals("sector_type_id", (1, 2, 3))} s on s.one = n.one join {_literals("period_id", (1, 2))} p on p.one = n.one
join {_literals("layer", (1, 2))} l on l.one = n.one""",
    "uncertainty_time_period": """
select 1 as period_id, 1950 as year_from, 1998 as year_to union all select 2, 1998, 2100""",
    "cube_dim_taxon": """
select distinct cast(c_custkey % 40 as int) as taxon_key, cast(2.0 + (c_custkey % 40) * 0.05 as decimal(6,3)) as tl,
  cast(10 + c_custkey % 40 as decimal(9,2)) as sl_max, cast(c_custkey % 40 % 6 + 1 as int) as commercial_group_id,
  cast(c_custkey % 40 % 8 + 1 as int) as functional_group_id
from {customer}""",
    "area": f"""
select 1000 * marine_layer_id + 10 * n_nationkey + sub_area_id as area_key, marine_layer_id, n_nationkey + 1 as main_area_id,
  sub_area_id, n_nationkey * 4 as number_of_cells
from (select 1 as one, n_nationkey from {{nation}}) n
join {_literals("marine_layer_id", [p[0] for p in _AREA_PARTS], sub_area_id=[p[1] for p in _AREA_PARTS])} p on p.one = n.one
union all select 6001, 6, 1, 1, 0 union all select 6002, 6, 1, 2, 0""",
    "time_dim": """
select distinct year(o_orderdate) - 1900 as time_key, year(o_orderdate) as time_business_key from {orders}""",
    "catch_type": "select 1 as catch_type_id, 'R' as abbreviation union all select 2, 'D'",
    "reporting_status": "select 1 as reporting_status_id, 'R' as abbreviation union all select 2, 'U'",
    "gear": "select distinct cast(least(o_orderkey % 73, 69) as int) as gear_id from {orders}",
    "fao_area": "select distinct n_nationkey % 4 + 1 as fao_area_id from {nation}",
    "lme": "select distinct n_nationkey % 11 + 1 as lme_id from {nation}",
    "rfmo": "select distinct n_nationkey % 11 + 1 as rfmo_id from {nation}",
    "meow": "select distinct n_nationkey % 11 + 1 as meow_id from {nation}",
    "entity_name": f"""
select marine_layer_id, n_nationkey + 1 as id, n_name as name, layer_name from (select 1 as one, n_nationkey, n_name from {{nation}}) n
join {_literals("marine_layer_id", (1, 2), layer_name=("'eez'", "'high seas'"))} l on l.one = n.one""",
    "fishing_entity": "select n_nationkey as fishing_entity_id, n_name as name from {nation}",
    "stock_fact": """
select main_area_id, marine_layer_id, 1000 * marine_layer_id + 10 * (main_area_id - 1) + 1 as area_key,
  cast(taxon_key % 25 as int) as fishing_entity_id, taxon_key, year, catch_sum,
  cast(catch_sum * (taxon_key % 7 + 1) as decimal(24,4)) as real_value
from (
  select cast(user_id % 5 + 1 as int) as main_area_id, cast(event_id % 2 + 1 as int) as marine_layer_id,
    case user_id % 41 when 7 then 100000 when 19 then 100339 else user_id end as taxon_key, day(ts) as year,
    cast(round(value * case when (day(ts) + user_id) % 29 = 0 then null
      when user_id % 11 = 0 then cast(0.01 as double)
      when day(ts) <= user_id % 30 then cast(1 as double) + day(ts) * cast(0.3 as double)
      else cast(8 as double) / (1 + day(ts) - user_id % 30) end, 4) as decimal(18,4)) as catch_sum
  from {events}) e""",
    "stock_years": "select distinct day(ts) as time_business_key from {events}",
    "grid": """
select p_partkey as id, cast(p_partkey % 50 as int) as gx, cast(floor(p_partkey / 50) as int) as gy,
  cast(p_partkey % 50 as double) / 2 as xmin, cast(floor(p_partkey / 50) as double) / 2 as ymin,
  cast(p_partkey % 50 as double) / 2 + 0.5 as xmax, cast(floor(p_partkey / 50) as double) / 2 + 0.5 as ymax
from {part}""",
    "taxon_extent_box": f"""
select s_suppkey as gid, cast(case when s_suppkey % 4 = 3 then s_suppkey % 40 - 3 else s_suppkey % 40 end as int) as taxon_key,
  s_suppkey % 2 = 1 as is_extended, {_BOX}
from {{supplier}}""",
    "taxon_distribution": """
select distinct cast(l_suppkey % 40 as int) as taxon_key, l_partkey as cell_id,
  l_suppkey % 40 > 30 or l_partkey % 3 = 0 as is_backfilled, cast(l_partkey % 7 as double) / 10 as relative_abundance
from {lineitem}""",
    "new_distribution": """
select taxon_key, case when cell_id % 6 = 0 then cell_id + 1000000000 else cell_id end as cell_id, relative_abundance
from {taxon_distribution}""",
    "taxon_name": """
select distinct cast(c_custkey % 40 as int) as taxon_key, concat('Taxon ', cast(c_custkey % 40 as varchar(10))) as common_name
from {customer}""",
    "raw_catch": """
select l_orderkey as id, cast(l_suppkey % 25 as int) as fishing_entity_id, cast(null as int) as original_country_fishing_id,
  cast(l_suppkey % 7 as int) as eez_id, l_returnflag as eez_sub_area, cast(l_partkey % 5 as int) as fao_area_id,
  l_linestatus as subregional_area, cast(null as varchar(10)) as province_state, cast(l_partkey % 3 as int) as ices_area_id,
  cast(null as int) as nafo_division_id, l_returnflag as ccamlr_area, cast(l_linenumber % 3 as int) as layer,
  cast(l_suppkey % 4 as int) as sector_type_id, l_linestatus as original_sector, cast(l_linenumber % 2 + 1 as int) as catch_type_id,
  cast(l_linenumber % 2 + 1 as int) as reporting_status_id, year(l_shipdate) as year, cast(l_partkey % 50 as int) as taxon_key,
  cast(l_partkey % 9 as int) as original_taxon_name_id, cast(l_partkey % 8 as int) as original_fao_name_id,
  cast(l_quantity as decimal(18,4)) as amount, cast(l_discount as decimal(6,4)) as adjustment_factor,
  cast(l_orderkey % 73 as int) as gear_type_id, cast(l_orderkey % 4 as int) as input_type_id,
  cast(null as int) as forward_carry_rule_id, cast(null as int) as disaggregation_rule_id, cast(null as int) as layer_rule_id,
  cast(l_partkey % 6 as int) as reference_id, l_returnflag as notes
from {lineitem}""",
    "taxon_substitute": """
select distinct cast(p_size * 2 as int) as original_taxon_key, cast(p_size * 2 + 100 as int) as use_this_taxon_key_instead
from {part}""",
    "taxon_lineage": """
select cast(1900 + r_regionkey as bigint) as taxon_key, r_name as common_name, 1 as level, r_name as lineage, cast(null as varchar(80)) as parent,
  r_regionkey % 2 = 0 as is_distribution_available, r_regionkey % 3 = 0 as is_extent_available,
  cast(r_regionkey * 1234567.5 as decimal(17,2)) as total_catch, cast(null as decimal(17,2)) as total_value
from {region}
union all
select cast(100000 + n_nationkey as bigint), n_name, 2, concat(r_name, '.', n_name), r_name, n_nationkey % 2 = 0, n_nationkey % 3 = 0,
  cast(n_nationkey * 1234.5 as decimal(17,2)), cast(n_nationkey * 7654321.25 as decimal(17,2))
from {nation} join {region} on n_regionkey = r_regionkey
union all
select 1000000 + s_suppkey, s_name, 3, concat(r_name, '.', n_name, '.', s_name), concat(r_name, '.', n_name),
  s_suppkey % 2 = 0, s_suppkey % 3 = 0, cast(s_suppkey * 10.75 as decimal(17,2)), cast(s_suppkey * 1000.5 as decimal(17,2))
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
union all
select 5000000 + s_suppkey, s_name, 4, concat(r_name, '.', n_name, '.', s_name, '.', cast(case when s_suppkey % 3 = 0 then 1 else s_suppkey end as varchar(20))),
  case when s_suppkey % 5 = 0 then concat(r_name, '.', n_name, '.lost') else concat(r_name, '.', n_name, '.', s_name) end,
  false, false, cast(s_suppkey * 2.5 as decimal(17,2)), cast(null as decimal(17,2))
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
union all
select 6000000 + s_suppkey, concat(s_name, ' twin'), 3, concat(r_name, '.', n_name, '.', s_name), concat(r_name, '.', n_name),
  false, false, cast(1 as decimal(17,2)), cast(1 as decimal(17,2))
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey where s_suppkey % 4 = 1""",
    "lineage_box": f"""
select s_suppkey as gid, 1000000 + s_suppkey as taxon_key, s_suppkey % 2 = 1 as is_extended, {_BOX} from {{supplier}}
union all
select cast(1000000000 + n_nationkey as bigint), cast(100000 + n_nationkey % 5 as bigint), false,
  cast(0.1 as double), cast(0.1 as double), cast(1.6 as double), cast(1.1 as double)
from {{nation}}""",
    "extent_corner": """
select gid, taxon_key, xmin as x1, ymin as y1, xmax as x2, ymin as y2, xmax as x3,
  case when gid % 7 = 0 then ymin else ymax end as y3, xmin as x4, case when gid % 7 = 0 then ymin else ymax end as y4,
  case when gid % 5 = 0 then xmin + 1 else xmin end as x5, ymin as y5, cast(case when gid % 11 = 0 then 3 else 5 end as int) as points
from {taxon_extent_box}""",
    "extent_feature": """
select gid, concat(cast(gid % 60 as varchar(10)), case when gid % 2 = 1 then '-1' else '' end, '.shp') as file_name,
  x1, y1, x2, y2, x3, y3, x4, y4, x5, y5, points
from {extent_corner}""",
    "extent_path": """
select concat('/extents/', replace(r_name, ' ', '_'), case when s_suppkey % 3 = 0 then '_x' else '' end, '/',
  cast(1900 + r_regionkey as varchar(10)), case when s_suppkey % 2 = 0 then '' else '-1' end, '.shp') as path, s_suppkey as file_id
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
}

_NAME = re.compile(r"\{(\w+)\}")


def needs(sql: str) -> list[str]:
    """Views and tables a text names, each after those it reads itself."""
    found: list[str] = []
    for name in _NAME.findall(sql):
        for inner in (needs(VIEWS[name]) if name in VIEWS else []) + [name]:
            if inner not in found:
                found.append(inner)
    return found


def with_views(sql: str) -> str:
    """The text for DuckDB: views become common table expressions, tables are used by name."""
    views = [n for n in needs(sql) if n in VIEWS]
    parts = ",\n".join(f"{n} as ({_NAME.sub(r'\1', VIEWS[n]).strip()})" for n in views)
    body = _NAME.sub(r"\1", sql).strip()
    if not views:
        return body
    if body.lower().startswith("with recursive"):
        return f"with recursive {parts},\n{body[14:].lstrip()}"
    return f"with {parts},\n{body[4:].lstrip()}" if body.lower().startswith("with") else f"with {parts}\n{body}"


class Tables:
    """The views of one test folder as DataFrames: tables.cell, tables.orders, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self.folder, self._made = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name not in VIEWS:
            if name not in BASE_TABLES:
                raise AttributeError(name)
            return self._spark.read.parquet(f"{self.folder}/{name}.parquet")
        sources = {n: getattr(self, n) for n in _NAME.findall(VIEWS[name])}
        return self._spark.sql(VIEWS[name], **sources)
