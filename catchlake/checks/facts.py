"""Facts of the seven layers, and cell catch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks.registry import check, spark_of
from catchlake.checks.summaries import SQL as SUMMARY_SQL
from catchlake.checks.summaries import lookup_frames, lookups
from catchlake.functions.columns import ppr
from catchlake.layers import LAYERS, Layer
from catchlake.operators.joins import uncertainty_periods
from catchlake.operators.sizing import measured
from catchlake.plans import cells as cell_plans
from catchlake.plans import facts as fact_plans
from catchlake.plans import summaries as S
from catchlake.session import materialize, shared_path
from catchlake.sources import layout, readers, writers

DIMS = ("end_use", "price", "cube_dim_taxon", "area", "time_dim", "catch_type",
        "reporting_status", "gear")

ALLOWED = {"high_seas": "fao_area", "lme": "lme", "rfmo": "rfmo", "meow": "meow"}


def dim_frames(t) -> dict[str, DataFrame]:
    lists = fact_plans.allowed_areas({layer: (getattr(t, name), f"{name}_id")
                                      for layer, name in ALLOWED.items()})
    scores = uncertainty_periods(t.uncertainty_eez, t.uncertainty_time_period)
    return {**{name: getattr(t, name) for name in DIMS}, "allowed_area": lists, "scores": scores}


def dims_of(t) -> dict[str, DataFrame]:
    return measured(keep=materialize, **dim_frames(t))


LOOKUPS = {"eez": ("simple_area",), "high_seas": ("simple_area",), "global": ("simple_area",), "ifa": ("weights",),
           "rfmo": ("weights", "simple_area"), "lme": ("weights", "simple_area", "pairs"), "meow": ("weights", "simple_area", "pairs"),
           "all": ("weights", "simple_area", "layer_pairs")}


def dims_and_lookups(t, *layers: str) -> dict[str, DataFrame]:
    """Everything the result and the facts of the layers (all of them by default) are joined to, and nothing else, measured in one job."""
    own = [LAYERS[n] for n in layers or LAYERS]
    used = {"price": any(x.end_use_price for x in own), "scores": any(x.score == "lookup" for x in own),
            "gear": any(x.gear_join for x in own), "allowed_area": any(x.allowed for x in own)}
    dims = {n: df for n, df in dim_frames(t).items() if used.get(n, True)}
    lookups_ = dict.fromkeys(x for n in layers or ("all",) for x in LOOKUPS[n])
    return measured(keep=materialize, **dims, **lookup_frames(t, *lookups_))


def published(fact: DataFrame) -> DataFrame:
    """Fixed digits, so that both engines print the same numbers."""
    decimal = {c: F.col(c).cast("decimal(28,6)") for c in ("catch_sum", "catch_trophic_level", "catch_max_length")}
    return fact.withColumns({**decimal, "real_value": F.col("real_value").cast("decimal(30,8)"), "primary_production_required": F.round("primary_production_required", 2)})


def fact_sql(layer: Layer, summary: str | None = None) -> str:
    """The fact row by row: every join on the unsummed rows, one sum at the end."""
    place = {n: c if isinstance(c, int) else f"c.{c}" for n, c in (("main_area_id", layer.main), ("sub_area_id", layer.sub))}
    use = "coalesce(e.end_use_type_id, 1)"
    share = "coalesce(e.end_use_percentage, 1)"
    if layer.discard_rule:
        use = f"case when d.catch_type_id = 2 then 4 else {use} end"
        share = f"case when d.catch_type_id = 2 then 1 else {share} end"
    price, price_join = "cast(c.unit_price as decimal(10,2))", ""
    if layer.end_use_price:
        price = "cast(coalesce(p.price, 1466) as decimal(10,2))"
        price_join = """left join {price} p on p.fishing_entity_id = c.fishing_entity_id and p.year = c.year
  and p.taxon_key = c.taxon_key and p.end_use_type_id = c.end_use_type_id"""
    score, raw, score_join = {"one": "1", "null": "cast(null as int)", "lookup": "coalesce(u.score, 1)"}[layer.score], "0", ""
    if layer.score == "lookup":
        raw, score_join = "u.score", """left join (select ue.*, year_from, year_to from {uncertainty_eez} ue
    left join {uncertainty_time_period} up on up.period_id = ue.period_id) u
  on u.eez_id = c.eez_id and u.sector_type_id = c.sector_type_id and u.layer = c.data_layer_id
  and c.year >= u.year_from and c.year < u.year_to"""
    areas = " and ".join(f"a.{key} = {place[key]}" for key in layer.area_keys)
    allowed = f"where s.{layer.main} in (select {layer.main} from {{{ALLOWED[layer.name]}}})" if layer.allowed else ""
    gear = "join {gear} g on g.gear_id = c.gear_type_id" if layer.gear_join else ""
    return f"""
select {place['main_area_id']} as main_area_id, {place['sub_area_id']} as sub_area_id, {layer.layer_id} as marine_layer_id,
  c.data_layer_id, c.fishing_entity_id, c.gear_type_id as gear_id, tm.time_key, c.year, c.taxon_key, a.area_key, c.catch_type_id,
  max(ct.abbreviation) as catch_status, c.reporting_status_id, max(rs.abbreviation) as reporting_status, c.sector_type_id,
  c.end_use_type_id, {score} as score, cast(sum(c.catch) as decimal(28,6)) as catch_sum,
  cast(sum({price} * c.catch) as decimal(30,8)) as real_value,
  round(cast(sum(c.catch) as double) / 9 * pow(10, cast(max(t.tl) as double) - 1), 2) as primary_production_required,
  cast(sum(c.catch * t.tl) as decimal(28,6)) as catch_trophic_level,
  cast(sum(c.catch * t.sl_max) as decimal(28,6)) as catch_max_length
from (
  select s.* exclude (universal_data_id, total_catch), d.* exclude (universal_data_id), {use} as end_use_type_id,
    cast(s.total_catch * cast({share} as decimal(6,4)) as decimal(28,{12 if layer.end_use_price else 16})) as catch
  from ({summary or SUMMARY_SQL[layer.name]}) s join {{allocation_data}} d on d.universal_data_id = s.universal_data_id
  left join {{end_use}} e on e.fishing_entity_id = d.fishing_entity_id and e.year = d.year and e.taxon_key = d.taxon_key
    and e.sector_type_id = d.sector_type_id and e.reporting_status_id = d.reporting_status_id
    and e.gear_type_id = d.gear_type_id and e.catch_type_id = d.catch_type_id
  {allowed}) c
join {{cube_dim_taxon}} t on t.taxon_key = c.taxon_key
join {{area}} a on a.marine_layer_id = {layer.area_layer} and {areas}
join {{catch_type}} ct on ct.catch_type_id = c.catch_type_id
join {{reporting_status}} rs on rs.reporting_status_id = c.reporting_status_id
join {{time_dim}} tm on tm.time_business_key = c.year {gear}
{price_join} {score_join}
group by {place['main_area_id'] if isinstance(layer.main, str) else 'a.main_area_id'}, {place['sub_area_id'] if isinstance(layer.sub, str) else 'a.sub_area_id'},
  c.data_layer_id, c.fishing_entity_id, c.gear_type_id, tm.time_key, c.year, c.taxon_key, a.area_key, c.sector_type_id,
  c.catch_type_id, c.reporting_status_id, c.end_use_type_id, {raw if layer.score == 'lookup' else 'a.marine_layer_id'}"""


def summary_of(t, name: str, d: dict[str, DataFrame] | None = None) -> DataFrame:
    d = d or lookups(t, *LOOKUPS[name])
    result = t.allocation_result
    makers = {
        "eez": lambda: S.summarize_eez(result, d["simple_area"]),
        "high_seas": lambda: S.summarize_high_seas(result, d["simple_area"]),
        "lme": lambda: S.summarize_lme(result, d["weights"], d["simple_area"], d["pairs"]),
        "meow": lambda: S.summarize_meow(result, d["weights"], d["simple_area"], d["pairs"]),
        "rfmo": lambda: S.summarize_rfmo(result, d["weights"], d["simple_area"]),
        "ifa": lambda: S.summarize_ifa(result, d["weights"]),
        "global": lambda: S.summarize_global(S.simple_base(result, d["simple_area"])),
    }
    return makers[name]()


def layer_fact(t, name: str) -> DataFrame:
    d = dims_and_lookups(t, name)
    return fact_plans.build_fact(summary_of(t, name, d), t.allocation_data, d, LAYERS[name])


def layer_facts(t, *names: str) -> DataFrame:
    """The facts of several layers, each from its summary; what all are joined to is measured once and joined once."""
    d = dims_and_lookups(t, *names)
    return fact_plans.build_layer_facts({n: summary_of(t, n, d) for n in names}, t.allocation_data, d)


def _register(key: str, name: str) -> None:
    check(key, fact_sql(LAYERS[name]))(lambda t: published(layer_fact(t, name)))


for _key, _name in (("b10_eez_fact", "eez"), ("b11_high_seas_fact", "high_seas"), ("b12_lme_fact", "lme"),
                    ("b13_meow_fact", "meow"), ("b14_rfmo_fact", "rfmo"), ("b15_ifa_fact", "ifa"), ("b16_global_fact", "global")):
    _register(_key, _name)


@check("p14_write_fact", f"select * from ({fact_sql(LAYERS['eez'])}) e union all select * from ({fact_sql(LAYERS['high_seas'])}) h")
def p14(t):
    """Three layers written, then one again and one that has become empty: no row is doubled, none is left over."""
    path = shared_path(spark_of(t), "fact")
    writers.write_fact(layer_facts(t, "eez", "high_seas", "global"), path)
    eez = readers.read_current(spark_of(t), path).filter(F.col("marine_layer_id") == C.EEZ)
    writers.write_fact(eez, path, [C.EEZ, C.GLOBAL])
    return published(readers.read_current(spark_of(t), path))


@check("b04_unit_price_value", """
select d.year, d.taxon_key, cast(sum(d.unit_price * r.allocated_catch) as decimal(28,6)) as real_value
from {allocation_data} d join {allocation_result} r on r.universal_data_id = d.universal_data_id group by 1, 2""")
def b04(t):
    rows = t.allocation_data.join(t.allocation_result, "universal_data_id").groupBy("year", "taxon_key")
    return rows.agg(F.sum(F.col("unit_price") * F.col("allocated_catch")).cast("decimal(28,6)").alias("real_value"))


@check("b06_b07_production_and_weights", """
select d.taxon_key, d.year, round(cast(sum(r.allocated_catch) as double) / 9 * pow(10, cast(max(t.tl) as double) - 1), 2) as ppr,
  cast(sum(r.allocated_catch * t.tl) as decimal(28,6)) as catch_trophic_level,
  cast(sum(r.allocated_catch * t.sl_max) as decimal(28,6)) as catch_max_length
from {allocation_data} d join {allocation_result} r on r.universal_data_id = d.universal_data_id
join {cube_dim_taxon} t on t.taxon_key = d.taxon_key group by 1, 2""")
def b06(t):
    rows = t.allocation_data.join(t.allocation_result, "universal_data_id").join(measured(t=t.cube_dim_taxon)["t"], "taxon_key")
    catch = F.col("allocated_catch")
    return rows.groupBy("taxon_key", "year").agg(
        F.round(ppr(F.sum(catch), F.max("tl")), 2).alias("ppr"),
        F.sum(catch * F.col("tl")).cast("decimal(28,6)").alias("catch_trophic_level"),
        F.sum(catch * F.col("sl_max")).cast("decimal(28,6)").alias("catch_max_length"))


AUDITED_AREA = 3


@check("b17_area_audit", fact_sql(LAYERS["meow"], "select * from (" + SUMMARY_SQL["meow"] + f") m where meow_id = {AUDITED_AREA}"))
def b17(t):
    d = dims_and_lookups(t, "meow")
    fact = fact_plans.audit_area(t.allocation_result, d["weights"], d["simple_area"], d["pairs"], t.allocation_data,
                                 d, LAYERS["meow"], AUDITED_AREA, S.summarize_meow)
    return published(fact)


@check("b18_all_facts", "select * replace (case fishing_entity_id when 223 then 213 else fishing_entity_id end as fishing_entity_id) from ("
       + " union all ".join(f"select * from ({fact_sql(LAYERS[n])}) {n}_fact" for n in LAYERS) + ") all_facts")
def b18(t):
    """Two passes over the result and one over everything else give the facts of all seven layers."""
    d = dims_and_lookups(t)
    simple = S.simple_base(t.allocation_result, d["simple_area"])
    weighted = S.weighted_base(t.allocation_result, d["weights"], d["simple_area"], d["layer_pairs"])
    return published(fact_plans.build_all_facts(simple, weighted, t.allocation_data, d))


def laid_out(t):
    """The result and the allocation data in a layout by their common key, as pairs to be joined."""
    by_id, root = layout.layout_for(t.allocation_result, "universal_data_id"), shared_path(spark_of(t), "laid-out")
    result = layout.lay_out(t.allocation_result, f"{root}/result", by_id)
    return layout.pairs_of(result, layout.lay_out_side(t.allocation_data, f"{root}/data", by_id))


def bucketed_fact(t) -> DataFrame:
    d = dims_and_lookups(t, "eez")
    parts = [(S.summarize_eez(result, d["simple_area"]), data) for result, data in laid_out(t)]
    return fact_plans.build_fact_of_parts(parts, d, LAYERS["eez"])


def bucketed_cells(t) -> DataFrame:
    areas = measured(a=t.allocation_simple_area)["a"]
    parts = [(result, cell_plans.caught_data(data, S.summarize_eez(result, areas))) for result, data in laid_out(t)]
    return cell_plans.cell_sums_of_parts(parts)


@check("j01_bucketed_fact", fact_sql(LAYERS["eez"]))
def j01_fact(t):
    return published(bucketed_fact(t))


CELL_SQL = """
select d.year, d.taxon_key, d.fishing_entity_id, r.cell_id, t.commercial_group_id, t.functional_group_id, d.sector_type_id,
  ct.abbreviation as catch_status, rs.abbreviation as reporting_status, cast(sum(r.allocated_catch) as decimal(28,4)) as catch_sum,
  d.gear_type_id
from {allocation_data} d join {allocation_result} r on r.universal_data_id = d.universal_data_id
join {cube_dim_taxon} t on t.taxon_key = d.taxon_key join {catch_type} ct on ct.catch_type_id = d.catch_type_id
join {reporting_status} rs on rs.reporting_status_id = d.reporting_status_id
where d.universal_data_id in (select universal_data_id from {allocation_result} x join {allocation_simple_area} s
  on s.allocation_simple_area_id = x.allocation_simple_area_id where s.eez_id > 0)
  and d.year in (select time_business_key from {time_dim}) and d.taxon_key in (select taxon_key from {taxon_name}) %s
group by all"""


def _eez_ids(t) -> DataFrame:
    return materialize(cell_plans.eez_ids(t.allocation_result, measured(a=t.allocation_simple_area)["a"]), "eez-ids")


def cells_of(t, year: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    d = measured(taxon=t.cube_dim_taxon, catch_type=t.catch_type, status=t.reporting_status, years=t.time_dim, names=t.taxon_name)
    return cell_plans.cell_catch(t.allocation_data, t.allocation_result, ids or _eez_ids(t), d["taxon"], d["catch_type"], d["status"],
                                 d["years"], d["names"], year, materialize)


def _four(df: DataFrame) -> DataFrame:
    return df.withColumn("catch_sum", F.col("catch_sum").cast("decimal(28,4)"))


C01_SQL = """
select d.year, d.taxon_key, d.fishing_entity_id, r.cell_id, d.sector_type_id, d.catch_type_id, d.reporting_status_id, d.gear_type_id,
  cast(sum(r.allocated_catch) as decimal(28,4)) as catch_sum
from {allocation_data} d join {allocation_result} r on r.universal_data_id = d.universal_data_id
where d.universal_data_id in (select universal_data_id from {allocation_result} x join {allocation_simple_area} s
  on s.allocation_simple_area_id = x.allocation_simple_area_id where s.eez_id > 0) group by all"""


@check("c01_cell_sums", C01_SQL)
def c01(t):
    return _four(cell_plans.cell_sums(materialize(cell_plans.caught_data(t.allocation_data, _eez_ids(t)), "caught-data"),
                                      t.allocation_result))


@check("j01_bucketed_cells", C01_SQL)
def j01_cells(t):
    return _four(bucketed_cells(t))


@check("c02_c03_cell_catch", CELL_SQL % "")
def c02(t):
    return _four(cells_of(t))


@check("c04_refresh_year", "select * from (" + CELL_SQL % "" + ") c where year <> 1996")
def c04(t):
    """All years written, then two years again, of which one has no rows any more: every other row is there once."""
    path = shared_path(spark_of(t), "cell-catch")
    ids = _eez_ids(t)
    cell_plans.refresh_year(cells_of(t, ids=ids), path)
    cell_plans.refresh_year(cells_of(t, 1997, ids), path, [1996, 1997])
    return _four(readers.read_current(spark_of(t), path))
