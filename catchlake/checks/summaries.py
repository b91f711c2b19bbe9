"""Area summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks.registry import check
from catchlake.operators.joins import cell_weights
from catchlake.operators.sizing import measured
from catchlake.plans import summaries as S
from catchlake.session import materialize

WEIGHTED = """
from {allocation_result} r join {simple_area_cell_assignment_raw} a on a.cell_id = r.cell_id and a.marine_layer_id = %d
join {cell} c on c.cell_id = r.cell_id"""
SIMPLE = " join {allocation_simple_area} s on s.allocation_simple_area_id = r.allocation_simple_area_id"
SHARE = "sum(r.allocated_catch * cast(a.water_area / c.water_area as decimal(18,12)))"


def sixth(summary: str) -> str:
    """The summary as it is shown: rounded once, after the sum."""
    return f"select * replace (cast(total_catch as decimal(28,6)) as total_catch) from ({summary}) s"


def _paired(layer: int, name: str) -> str:
    return f"""
select universal_data_id, area_id as {name}, eez_id, cast(sum(total_catch) as decimal(26,12)) as total_catch from (
  select r.universal_data_id, a.area_id, s.fao_area_id, s.eez_id, {SHARE} as total_catch {WEIGHTED % layer} {SIMPLE} group by 1, 2, 3, 4) b
join {{area_fao}} f using (area_id, fao_area_id) group by 1, 2, 3"""


SQL = {
    "eez": """
select universal_data_id, eez_id, fao_area_id, cast(sum(allocated_catch) as decimal(26,12)) as total_catch
from {allocation_result} r""" + SIMPLE + " where eez_id > 0 group by 1, 2, 3",
    "high_seas": """
select universal_data_id, fao_area_id, cast(sum(allocated_catch) as decimal(26,12)) as total_catch
from {allocation_result} r""" + SIMPLE + " where eez_id = 0 group by 1, 2",
    "lme": _paired(C.LME, "lme_id"),
    "meow": _paired(C.MEOW, "meow_id"),
    "rfmo": f"select r.universal_data_id, a.area_id as rfmo_id, s.eez_id, cast({SHARE} as decimal(26,12)) as total_catch {WEIGHTED % C.RFMO} {SIMPLE} group by 1, 2, 3",
    "ifa": f"select r.universal_data_id, a.area_id as eez_id, a.fao_area_id, cast({SHARE} as decimal(26,12)) as total_catch {WEIGHTED % C.IFA} group by 1, 2, 3",
}
SQL["global"] = f"""
select universal_data_id, 1 as area_id, cast(sum(total_catch) as decimal(26,12)) as total_catch from ({SQL['eez']}) e group by 1
union all
select universal_data_id, 2, cast(sum(total_catch) as decimal(26,12)) from ({SQL['high_seas']}) h group by 1"""


def lookup_frames(t, *names: str) -> dict[str, DataFrame]:
    """Those asked for, all by default."""
    makers = {"weights": lambda: cell_weights(t.simple_area_cell_assignment_raw, t.cell), "simple_area": lambda: t.allocation_simple_area,
              "pairs": lambda: t.area_fao, "layer_pairs": lambda: S.pairs_by_layer({C.LME: t.area_fao, C.MEOW: t.area_fao})}
    return {n: makers[n]() for n in names or makers}


def lookups(t, *names: str) -> dict[str, DataFrame]:
    return measured(keep=materialize, **lookup_frames(t, *names))


def all_summaries(t, keep=lambda df, name: df) -> dict[str, DataFrame]:
    d = lookups(t, "weights", "simple_area", "layer_pairs")
    return S.summarize_all(t.allocation_result, d["weights"], d["simple_area"], d["layer_pairs"], keep)


def _six(df: DataFrame) -> DataFrame:
    return df.withColumn("total_catch", F.col("total_catch").cast("decimal(28,6)"))


@check("s01_summarize_eez", sixth(SQL["eez"]))
def s01(t):
    return _six(S.summarize_eez(t.allocation_result, measured(a=t.allocation_simple_area)["a"]))


@check("s02_summarize_high_seas", sixth(SQL["high_seas"]))
def s02(t):
    return _six(S.summarize_high_seas(t.allocation_result, measured(a=t.allocation_simple_area)["a"]))


@check("s03_summarize_lme", sixth(SQL["lme"]))
def s03(t):
    d = lookups(t, "weights", "simple_area", "pairs")
    return _six(S.summarize_lme(t.allocation_result, d["weights"], d["simple_area"], d["pairs"]))


@check("s04_summarize_meow", sixth(SQL["meow"]))
def s04(t):
    d = lookups(t, "weights", "simple_area", "pairs")
    return _six(S.summarize_meow(t.allocation_result, d["weights"], d["simple_area"], d["pairs"]))


@check("s05_summarize_rfmo", sixth(SQL["rfmo"]))
def s05(t):
    d = lookups(t, "weights", "simple_area")
    return _six(S.summarize_rfmo(t.allocation_result, d["weights"], d["simple_area"]))


@check("s06_summarize_ifa", sixth(SQL["ifa"]))
def s06(t):
    d = lookups(t, "weights")
    return _six(S.summarize_ifa(t.allocation_result, d["weights"]))


@check("s07_summarize_global", sixth(SQL["global"]))
def s07(t):
    areas = measured(a=t.allocation_simple_area)["a"]
    return _six(S.summarize_global(S.simple_base(t.allocation_result, areas)))


@check("s08_two_step_lme", sixth(SQL["lme"]))
def s08_lme(t):
    d = lookups(t, "weights", "simple_area", "pairs")
    return _six(S.two_step_summary(t.allocation_result, d["weights"], d["simple_area"], C.LME, "lme_id", d["pairs"]))


@check("s08_reconcile_rfmo", """
select rfmo_id, count(*) as keys_compared, 0 as keys_different from (""" + SQL["rfmo"] + ") x group by 1")
def s08_rfmo(t):
    d = lookups(t, "weights", "simple_area")
    args = (t.allocation_result, d["weights"], d["simple_area"])
    one = materialize(S.summarize_rfmo(*args), "one-step")
    two = S.two_step_summary(*args, C.RFMO, "rfmo_id")
    keys = ["universal_data_id", "rfmo_id", "eez_id"]
    wrong = S.reconcile(one, two, keys, "total_catch").groupBy("rfmo_id").agg(F.count(F.lit(1)).cast("int").alias("wrong"))
    compared = one.groupBy("rfmo_id").agg(F.count(F.lit(1)).alias("keys_compared"))
    report = compared.join(wrong, "rfmo_id", "left")
    return report.select("rfmo_id", "keys_compared", F.coalesce("wrong", F.lit(0)).alias("keys_different"))


AREA_OF = {"eez": ("eez_id", "fao_area_id"), "high_seas": ("fao_area_id", "null"), "lme": ("lme_id", "eez_id"), "meow": ("meow_id", "eez_id"),
           "rfmo": ("rfmo_id", "eez_id"), "ifa": ("eez_id", "fao_area_id"), "global": ("area_id", "null")}


@check("s09_summarize_all", " union all ".join(
    f"select '{n}' as area_type, universal_data_id, {AREA_OF[n][0]} as area, {AREA_OF[n][1]} as other, cast(total_catch as decimal(28,6)) as total_catch from ({q}) {n}_rows"
    for n, q in SQL.items()))
def s09(t):
    """All rows of all seven from two passes, by way of written bases."""
    parts = [df.select(F.lit(n).alias("area_type"), "universal_data_id", F.expr(AREA_OF[n][0]).alias("area"),
                       F.expr(AREA_OF[n][1]).cast("int").alias("other"), "total_catch")
             for n, df in all_summaries(t, materialize).items()]
    return _six(reduce(DataFrame.unionByName, parts))
