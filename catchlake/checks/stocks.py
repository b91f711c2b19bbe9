"""Series windows and stock status."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks.registry import check
from catchlake.functions.columns import percent2
from catchlake.operators.aggregates import with_bounds
from catchlake.operators.partitions import key_distribution, running_total
from catchlake.operators.windows import centred_mean, with_peak, with_post_peak_min
from catchlake.plans import stocks as Q
from catchlake.session import materialize

# The SQL states the definitions over sets: ordered aggregates joined back, self joins on places, and a table of rules.
SERIES = """
yearly as (select main_area_id, taxon_key, year, cast(sum(catch_sum) as decimal(20,0)) as tonnes from {stock_fact}
  where marine_layer_id in (1, 2)
    and taxon_key not in (100000, 100011, 100025, 100039, 100047, 100058, 100077, 100139, 100239, 100339) group by all),
calendar as (select time_business_key as year, row_number() over (order by time_business_key) as place from {stock_years}),
cells_of_years as (select s.main_area_id, s.taxon_key, c.year, c.place, y.tonnes
  from (select distinct main_area_id, taxon_key from yearly) s cross join calendar c left join yearly y using (main_area_id, taxon_key, year)),
peaks as (select main_area_id, taxon_key, arg_max(year, {'size': coalesce(tonnes, 0), 'early': -year}) as peak_year from cells_of_years group by all),
tops as (select p.*, c.tonnes as peak_catch_sum from peaks p join cells_of_years c on c.main_area_id = p.main_area_id and c.taxon_key = p.taxon_key
  and c.year = p.peak_year),
caught as (select * from cells_of_years where tonnes > 0),
large as (select main_area_id, taxon_key, max(year) as final_year from caught group by all
  having sum(tonnes) >= 1000 and max(year) - min(year) >= 9),
steady as (select distinct a.main_area_id, a.taxon_key from caught a join caught b on b.main_area_id = a.main_area_id and b.taxon_key = a.taxon_key
  and b.place - a.place between 0 and 4 group by a.main_area_id, a.taxon_key, a.place having count(*) = 5),
stocks as (select t.*, l.final_year from tops t join large l using (main_area_id, taxon_key) semi join steady using (main_area_id, taxon_key)),
troughs as (select s.main_area_id, s.taxon_key, arg_min(c.year, {'size': c.tonnes, 'early': c.year}) as year
  from stocks s join caught c on c.main_area_id = s.main_area_id and c.taxon_key = s.taxon_key and c.year > s.peak_year group by all),
lowest as (select s.main_area_id, s.taxon_key, coalesce(any_value(t.year), min(c.year)) as year from stocks s
  join caught c using (main_area_id, taxon_key) left join troughs t using (main_area_id, taxon_key) group by all),
collated as (select c.main_area_id, c.taxon_key, c.year, c.tonnes as catch_sum, s.peak_year, s.peak_catch_sum, s.final_year,
  w.year as post_peak_min_year, v.tonnes as post_peak_min_catch_sum
  from caught c join stocks s using (main_area_id, taxon_key) join lowest w on w.main_area_id = c.main_area_id and w.taxon_key = c.taxon_key
  join caught v on v.main_area_id = w.main_area_id and v.taxon_key = w.taxon_key and v.year = w.year)"""

#: When a row lies against the peak, its share of the peak (up to a tenth, below half, half, above), and whether it is back
#: from below a tenth; null: no matter.
CATEGORIES = SERIES + """,
rules(era, part, back, category_id) as (values ('open', null, null, 4), ('before', 'tenth', null, 4), ('before', 'less', null, 4),
  ('before', 'half', null, 4), ('before', 'more', null, 3), ('after', 'more', null, 3), ('after', 'half', null, 6),
  ('after', 'less', true, 5), ('after', 'less', false, 2), ('after', 'tenth', null, 1)),
described as (select *, case when peak_year = final_year then 'open' when year > peak_year then 'after' else 'before' end as era,
  case sign(2 * catch_sum - peak_catch_sum) when 1 then 'more' when 0 then 'half'
    else case when 10 * catch_sum > peak_catch_sum then 'less' else 'tenth' end end as part,
  10 * post_peak_min_catch_sum < peak_catch_sum and year > post_peak_min_year as back from collated),
categorized as (select d.* exclude (era, part, back), r.category_id from described d join rules r on r.era = d.era
  and coalesce(r.part, d.part) = d.part and coalesce(r.back, d.back) = d.back)"""

SHARES = CATEGORIES + """,
tally as (select main_area_id, category_id, year, sum(catch_sum) as catch, count(*) as stocks from categorized
  where category_id < 6 group by all),
numbered as (select *, row_number() over (partition by main_area_id, category_id order by year) as place from tally),
areas as (select main_area_id, min(year) as b, max(year) as e from tally group by all),
means as (select a.main_area_id, a.category_id, a.year, cast(sum(b.catch) as double) / count(*) as mean from numbered a
  join numbered b on b.main_area_id = a.main_area_id and b.category_id = a.category_id and abs(b.place - a.place) <= 1 group by all),
counted as (select main_area_id, year, sum(stocks) as stocks from tally group by all),
valued as (select main_area_id, category_id, year, if(year = r.b or year = r.e, cast(t.catch as double), m.mean) as catch,
  t.stocks * 100.0 / c.stocks as nss from tally t join means m using (main_area_id, category_id, year)
  join counted c using (main_area_id, year) join areas r using (main_area_id)),
filled as (select k.main_area_id, k.category_id, y.time_business_key as year, coalesce(v.catch, 0.0) as catch, coalesce(v.nss, 0.0) as nss
  from (select distinct main_area_id, category_id from tally) k cross join {stock_years} y
  left join valued v on v.main_area_id = k.main_area_id and v.category_id = k.category_id and v.year = y.time_business_key),
totals as (select main_area_id, year, sum(catch) as total from filled group by all),
shares as (select main_area_id, category_id, year, nss, if(total = 0, 0.0, catch * 100.0 / total) as css from filled join totals using (main_area_id, year))"""


def two_digits(value: str) -> str:
    """Halves up at two decimals, spelled out."""
    return f"cast(cast(floor(round({value} * 100, 6) + 0.5) as bigint) as decimal(10,0)) * cast(0.01 as decimal(3,2))"


def categorized(t):
    return Q.stock_category(Q.stock_collate(t.stock_fact, t.stock_years))


@check("w01_peak", f"with {SERIES} select main_area_id, taxon_key, year, tonnes as catch_sum, peak_year, peak_catch_sum from cells_of_years join tops using (main_area_id, taxon_key)")
def w01(t):
    return with_peak(Q.annual_series(t.stock_fact, t.stock_years), Q.STOCK, "year", "catch_sum")


@check("w03_post_peak_minimum", f"""
with {SERIES} select main_area_id, taxon_key, year, catch_sum, post_peak_min_year, post_peak_min_catch_sum from collated""")
def w03(t):
    base = Q.stock_collate(t.stock_fact, t.stock_years).drop("post_peak_min_year", "post_peak_min_catch_sum")
    rows = with_post_peak_min(base, Q.STOCK, "year", "catch_sum")
    return rows.select(*Q.STOCK, "year", "catch_sum", "post_peak_min_year", "post_peak_min_catch_sum")


@check("w04_centred_mean", """
with annual as (select taxon_key, year, cast(sum(catch_sum) as decimal(20,0)) as catch from {stock_fact} group by all),
numbered as (select *, row_number() over (partition by taxon_key order by year) as place from annual),
span as (select min(year) as b, max(year) as e from annual)
select a.taxon_key, a.year, round(if(a.year = any_value(s.b) or a.year = any_value(s.e), cast(any_value(a.catch) as double),
  cast(sum(b.catch) as double) / count(b.catch)), 6) as smooth
from numbered a join numbered b on b.taxon_key = a.taxon_key and abs(b.place - a.place) <= 1 cross join span s group by a.taxon_key, a.year""")
def w04(t):
    annual = t.stock_fact.groupBy("taxon_key", "year").agg(F.sum("catch_sum").cast("decimal(20,0)").alias("catch"))
    rows = with_bounds(annual, "year").withColumnsRenamed({"min_year": "begin_year", "max_year": "end_year"})
    smooth = centred_mean(rows, ["taxon_key"], "year", "catch", "begin_year", "end_year", "smooth")
    return smooth.select("taxon_key", "year", F.round("smooth", 6).alias("smooth"))


@check("w05_running_total", """
select universal_data_id, n as record_count, cast(sum(n) over (order by universal_data_id) as bigint) as through from (
  select universal_data_id, count(*) as n from {allocation_result} group by 1) x""")
def w05(t):
    dist = materialize(key_distribution(t.allocation_result, "universal_data_id"), "result-distribution")
    return running_total(dist, "universal_data_id", "record_count", "through")


@check("q01_stock_collate", f"with {SERIES} select * from collated")
def q01(t):
    return Q.stock_collate(t.stock_fact, t.stock_years)


@check("q02_stock_category", f"with {CATEGORIES} select * from categorized")
def q02(t):
    return categorized(t)


@check("q03_catch_by_status", f"with {SHARES} select main_area_id, category_id, year, {two_digits('css')} as value from shares")
def q03(t):
    return Q.stock_css(categorized(t), t.stock_years).withColumn("value", percent2(F.col("value")).cast("decimal(13,2)"))


@check("q04_stocks_by_status", f"with {SHARES} select main_area_id, category_id, year, {two_digits('nss')} as value from shares")
def q04(t):
    return Q.stock_nss(categorized(t), t.stock_years).withColumn("value", percent2(F.col("value")).cast("decimal(13,2)"))


GATE = """
select c.main_area_id, c.taxa_count, a.cell_count from (
  select main_area_id, count(distinct taxon_key) as taxa_count from categorized group by 1) c
join (select main_area_id, cast(sum(number_of_cells) as bigint) as cell_count from {area} where marine_layer_id = 1 group by 1) a
  on a.main_area_id = c.main_area_id
where a.cell_count > 30 and c.taxa_count > 10"""


@check("q05_display_gate", f"with {CATEGORIES} {GATE}")
def q05(t):
    return Q.stock_gate(categorized(t), t.area)


REPORT = ", ".join(f"max(value) filter (where category_id = {i}) as \"{name}\"" for i, name in enumerate(C.STOCK_HEADINGS, 1))


@check("q06_stock_status", f"""
with {SHARES},
rows_of as (select main_area_id, 'css' as data_set, year, category_id, {two_digits('css')} as value from shares
  union all select main_area_id, 'nss', year, category_id, {two_digits('nss')} from shares)
select main_area_id, data_set, year, {REPORT} from rows_of where main_area_id in (select main_area_id from ({GATE}) g)
group by 1, 2, 3""")
def q06(t):
    report = Q.stock_status(t.stock_fact, t.stock_years, t.area)
    return report.withColumns({n: F.col(n).cast("decimal(13,2)") for n in C.STOCK_HEADINGS})
