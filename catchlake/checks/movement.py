"""Sources, sinks and table movement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.checks.registry import check, spark_of
from catchlake.checks.summaries import lookups
from catchlake.operators.partitions import key_distribution, partition_map
from catchlake.plans import documents
from catchlake.plans.summaries import summarize_eez, summarize_rfmo
from catchlake.session import materialize, shared_path
from catchlake.sources import readers, writers

MANIFEST_ROWS = [
    (2, "Catch", "orders", "o_orderkey", "o_orderkey, o_custkey, o_totalprice", "where o_orderstatus = 'F'", "allocation",
     "orders_done", ["o_totalprice"], 8),
    (1, "CATCH", "supplier", "s_suppkey", None, None, "master", "supplier", None, 2),
    (3, "other", "part", None, None, "", "master", "part", [], 1),
    (4, "Catch", "lineitem", "l_orderkey", "l_orderkey, count(*) as parts", "GROUP BY l_orderkey", "allocation", "order_parts", None, 150),
    (5, "Catch", "customer", None, "c_custkey, c_nationkey", "c_nationkey between 3 and 9", "master", "customer", ["c_nationkey"], 1),
]


@check("p01_read_source", """
select 'allocation' as part, 'orders_done' as name, o_orderkey as a, cast(o_custkey as bigint) as b from {orders} where o_orderstatus = 'F'
union all select 'master', 'supplier', s_suppkey, cast(s_nationkey as bigint) from {supplier}
union all select 'master', 'part', p_partkey, cast(p_size as bigint) from {part}
union all select 'allocation', 'order_parts', l_orderkey, count(*) from {lineitem} group by l_orderkey
union all select 'master', 'customer', c_custkey, null from {customer} where c_nationkey between 3 and 9""")
def p01(t):
    """Every row of the manifest, in id order, into its target table."""
    spark, root = spark_of(t), shared_path(spark_of(t), "pulled")
    readers.pull_all(spark, spark.createDataFrame(MANIFEST_ROWS, readers.MANIFEST_SCHEMA), readers.ParquetReader(t.folder), root)
    columns = {"allocation/orders_done": ("o_orderkey", "o_custkey"), "master/supplier": ("s_suppkey", "s_nationkey"),
               "master/part": ("p_partkey", "p_size"), "allocation/order_parts": ("l_orderkey", "parts"), "master/customer": ("c_custkey", None)}
    return reduce(DataFrame.unionByName, [readers.read_current(spark, f"{root}/{table}").select(
        F.lit(table.split("/")[0]).alias("part"), F.lit(table.split("/")[1]).alias("name"), F.col(a).alias("a"),
        (F.col(b) if b else F.lit(None)).cast("bigint").alias("b")) for table, (a, b) in columns.items()])


@check("p03_full_refresh", """
select universal_data_id, cell_id, allocated_catch from {allocation_result}""")
def p03(t):
    path = shared_path(spark_of(t), "full-refresh")
    writers.full_refresh(t.allocation_result, path, exclude=["allocation_simple_area_id"])
    return readers.read_current(spark_of(t), path)


MAP_SQL = """
with dist as (select universal_data_id as k, count(*) as n from {allocation_result} group by 1),
ran as (select k, n, sum(n) over (order by k) as through, sum(n) over () as total from dist),
map as (select cast(floor((through - n) * 150 / total) as int) as bucket, min(k) as lo, max(k) as hi,
  cast(sum(n) as bigint) as n from ran group by 1),
ranges as (select cast(row_number() over (order by bucket) as int) as partition_id, lo, hi, n from map)
"""


def ranges_of(t):
    """The map, made from a written distribution: the map reads it several times and the result only once."""
    dist = materialize(key_distribution(t.allocation_result, "universal_data_id"), "result-distribution")
    return materialize(partition_map(dist, "universal_data_id"), "partition-map")


@check("p04_pull_by_partition", MAP_SQL + """
select universal_data_id, cell_id, allocation_simple_area_id, allocated_catch, partition_id
from {allocation_result} join ranges on universal_data_id between lo and hi where allocated_catch > 0""")
def p04(t):
    return readers.pull_by_partition(t.allocation_result, ranges_of(t))


@check("p05_key_distribution", """
select universal_data_id, count(*) as record_count from {allocation_result} group by 1""")
def p05(t):
    return key_distribution(t.allocation_result, "universal_data_id")


@check("p06_partition_map", MAP_SQL + """
select partition_id, lo as begin_universal_data_id, hi as end_universal_data_id, n as record_count from ranges""")
def p06(t):
    return ranges_of(t)


#: Texts with tabs, line ends, quotes, backslashes, the mark of NULL, blanks at the ends and none at all.
HARD_TEXTS = """select doc_id, case doc_id % 9 when 0 then text when 1 then null when 2 then '' when 3 then concat(chr(92), 'N')
  when 4 then concat('  ', text, ' ') when 5 then concat(chr(9), text, chr(9), chr(92)) when 6 then concat('a', chr(13), chr(10), chr(92), 'n', chr(34), text)
  when 7 then concat(chr(92), chr(92), 't', chr(10)) else concat('"', text, ', "') end as hard from {documents}"""


def hard_texts(t):
    return spark_of(t).sql(HARD_TEXTS, documents=t.documents)


@check("p08_text_interchange", f"select universal_data_id, unit_price, taxon_key, hard from {{allocation_data}} left join ({HARD_TEXTS}) h on doc_id = universal_data_id")
def p08(t):
    data = t.allocation_data.select("universal_data_id", "unit_price", "taxon_key")
    data = data.join(hard_texts(t), F.col("doc_id") == F.col("universal_data_id"), "left").drop("doc_id")
    path = shared_path(spark_of(t), "text")
    writers.write_text(data, path)
    return readers.read_text(spark_of(t), path, data.schema)


@check("p09_csv_per_entity", f"""
select main_area_id, taxon_key, year, catch_sum, null as hard from {{stock_fact}}
union all select cast(doc_id % 7 as int), doc_id, null, null, hard from ({HARD_TEXTS}) h""")
def p09(t):
    columns = ["taxon_key", "year", "catch_sum", "hard"]
    path = shared_path(spark_of(t), "csv-per-entity")
    texts = hard_texts(t).select((F.col("doc_id") % 7).cast("int").alias("main_area_id"), F.col("doc_id").alias("taxon_key"), "hard")
    rows = t.stock_fact.select("main_area_id", *columns[:-1]).unionByName(texts, allowMissingColumns=True)
    writers.write_csv_per_entity(rows, "main_area_id", path)
    schema = T.StructType([rows.schema[c] for c in columns] + [rows.schema["main_area_id"]])
    return readers.read_csv(spark_of(t), path, schema)


@check("p10_csv_texts", f"""
select 4 as entity_layer_id, doc_id as entity_id, concat(doc_id, ',', case when hard is null then '' when hard = '' then '""'
  when hard like '%"%' or hard like '%,%' or hard like concat('%', chr(10), '%') or hard like concat('%', chr(13), '%')
  then concat('"', replace(hard, '"', '""'), '"') else hard end) as csv_data from ({HARD_TEXTS}) h""")
def p10_texts(t):
    rows = hard_texts(t).withColumns({"marine_layer_id": F.lit(4), "main_area_id": F.col("doc_id")})
    return documents.csv_cache(rows, ["doc_id", "hard"], exclude=(-1,))


@check("p10_csv_cache", """
select 4 as entity_layer_id, rfmo_id as entity_id,
  concat(universal_data_id, ',', coalesce(cast(eez_id as varchar), ''), ',', total_catch) as csv_data
from (
  select universal_data_id, area_id as rfmo_id, eez_id,
    cast(sum(allocated_catch * cast(a.water_area / c.water_area as decimal(18,12))) as decimal(28,6)) as total_catch
  from {allocation_result} r join {simple_area_cell_assignment_raw} a on a.cell_id = r.cell_id and a.marine_layer_id = 4
  join {cell} c on c.cell_id = r.cell_id
  join {allocation_simple_area} s on s.allocation_simple_area_id = r.allocation_simple_area_id
  group by 1, 2, 3) x
where rfmo_id <> 9""")
def p10(t):
    d = lookups(t, "weights", "simple_area")
    rows = summarize_rfmo(t.allocation_result, d["weights"], d["simple_area"])
    rows = rows.select("universal_data_id", F.col("rfmo_id").alias("main_area_id"), "eez_id",
                       F.col("total_catch").cast("decimal(28,6)").alias("total_catch"), F.lit(4).alias("marine_layer_id"))
    return documents.csv_cache(rows, ["universal_data_id", "eez_id", "total_catch"])


@check("p11_cell_catch_json", """
select year, block, concat('[', string_agg(concat('{"cell_id":', cell_id, ',"catch":', catch, '}'), ',' order by cell_id), ']')
  as result
from (
  select d.year, r.cell_id, cast(floor(r.cell_id / 1000) as bigint) as block, sum(r.allocated_catch) as catch
  from {allocation_data} d join {allocation_result} r on r.universal_data_id = d.universal_data_id
  group by 1, 2, 3) x
group by year, block""")
def p11(t):
    rows = t.allocation_data.join(t.allocation_result, "universal_data_id")
    return documents.cell_catch_json(rows.withColumnRenamed("allocated_catch", "catch_sum"))


@check("p12_write_by_year", """
select universal_data_id, fishing_entity_id, taxon_key, sector_type_id, catch_type_id, reporting_status_id, gear_type_id, year
from {allocation_data}""")
def p12(t):
    path = shared_path(spark_of(t), "data-by-year")
    writers.write_by_year(t.allocation_data, path)
    return spark_of(t).read.parquet(path)


@check("p13_json_document", """
with listed as (select row_number() over (order by common_name, taxon_key) as place, json_object('taxon_key', taxon_key, 'name', common_name,
  'taxon_level_id', level, 'lineage', lineage) as line from {taxon_lineage})
select place, concat(case when place = 1 then '' else ',' end, line) as text from listed
union all select 0, '{"name":"taxon","children":['
union all select (select count(*) + 1 from listed), ']}'""")
def p13(t):
    """Every line of the written document, numbered as the part files read one after the other have them."""
    path = shared_path(spark_of(t), "document")
    writers.write_json_doc(documents.taxon_list(t.taxon_lineage), ["section", "name", "taxon_key"], path)
    lines = readers.read_in_order(spark_of(t), path, "place", "text", lineSep="\n")
    return lines.select((F.col("place") - 1).alias("place"), F.col("value").alias("text"))


@check("p15_write_summary", """
select universal_data_id, eez_id, fao_area_id, cast(sum(allocated_catch) as decimal(28,4)) as total_catch
from {allocation_result} r join {allocation_simple_area} s on s.allocation_simple_area_id = r.allocation_simple_area_id
where eez_id > 0 group by 1, 2, 3""")
def p15(t):
    root = shared_path(spark_of(t), "summaries")
    for _ in range(2):
        writers.write_summary(summarize_eez(t.allocation_result, t.allocation_simple_area), root, "eez")
    rows = readers.read_current(spark_of(t), f"{root}/eez")
    return rows.withColumn("total_catch", F.col("total_catch").cast("decimal(28,4)"))
