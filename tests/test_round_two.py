"""Exact shares, balanced ranges, a tree with gaps, and the number of passes."""

import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks import CHECKS
from catchlake.operators import joins
from catchlake.operators.partitions import key_distribution, partition_map, ranged, running_total
from catchlake.plans import documents, summaries
from catchlake.session import intermediates, materialize, shared_path


def test_thirds_keep_the_catch(spark):
    """3000 rows of 0.01 t in a cell that three areas share, and 1000 rows of 0.0001 t at a weight of 1/3000."""
    result = spark.range(4000).selectExpr("id % 7 AS universal_data_id", "CAST(IF(id < 3000, 1, 2) AS BIGINT) AS cell_id",
                                          "CAST(IF(id < 3000, 0.01, 0.0001) AS DECIMAL(18,4)) AS allocated_catch")
    cell = spark.createDataFrame([(1, Decimal(21)), (2, Decimal(3000))], "cell_id long, water_area decimal(18,4)")
    assigned = spark.createDataFrame([(14, a, 1, 9, Decimal(7)) for a in (1, 2, 3)] + [(14, 4, 2, 9, Decimal(1))],
                                     "marine_layer_id int, area_id int, cell_id long, fao_area_id int, water_area decimal(18,4)")
    rows = joins.area_weighted(result, joins.cell_weights(assigned, cell))
    sums = {r["area_id"]: r["s"] for r in rows.groupBy("area_id").agg(F.sum("allocated_catch").alias("s")).collect()}
    assert abs(sums[1] + sums[2] + sums[3] - 30) < Decimal("1e-9")
    assert abs(sums[4] - Decimal("0.0001") / 3) < Decimal("1e-9")
    total = summaries.summarize_ifa(result, joins.cell_weights(assigned, cell)).agg(F.sum("total_catch")).first()[0]
    assert round(total, 6) == Decimal("30.000033")


def test_a_far_key_does_not_fill_one_range(spark):
    keys = spark.range(20_000).unionByName(spark.range(9 * 10**15, 9 * 10**15 + 1)).select("id", F.lit(1).alias("n"))
    counts = [r["count"] for r in ranged(keys, "id", 10).groupBy("_stretch").count().collect()]
    assert len(counts) == 10 and max(counts) < 2 * 20_000 / 10
    through = running_total(keys, "id", "n", "through")
    assert through.filter("id < 20000 and through <> id + 1").count() == 0
    assert through.filter("id > 20000").first()["through"] == 20_001
    ranges = partition_map(key_distribution(keys, "id"), "id", 4).collect()
    assert [r["record_count"] for r in ranges] == [5001, 5000, 5000, 5000] or sum(r["record_count"] for r in ranges) == 20_001


TAXA = "taxon_key long, common_name string, level int, lineage string, parent string, is_distribution_available boolean, is_extent_available boolean, total_catch decimal(17,2), total_value decimal(17,2)"


def test_tree_with_gaps_and_twins(spark):
    rows = [(1901, "B", 1, "b", None), (1900, "A", 1, "a", None), (2, "a2", 2, "a.2", "a"), (3, "a1", 2, "a.1", "a"), (4, "twin", 2, "a.1", "a"),
            (5, "low", 3, "a.1.x", "a.1"), (6, "lost", 4, "a.3.x.y", "a.3.x"), (7, "below lost", 5, "a.3.x.y.z", "a.3.x.y"), (1000, "other", 1, "o", None)]
    taxa = spark.createDataFrame([(*r, True, False, Decimal(1), None) for r in rows], TAXA)
    pieces = documents.taxon_tree(taxa, "19", "Non-Fishes").orderBy("root_order", "path").collect()
    tree = json.loads("".join(p["text"] for p in pieces))

    def shape(node):
        return node["key"], [shape(c) for c in node.get("children", [])]

    assert [shape(c) for c in tree["children"]] == [(1900, [(3, [(5, [])]), (4, [(5, [])]), (2, [])]), (1901, [])]
    path = shared_path(spark, "tree")
    documents.taxon_tree(taxa.limit(0), "19", "Non-Fishes").write.parquet(path)
    assert json.loads("".join(r["text"] for r in spark.read.parquet(path).orderBy("root_order", "path").collect()))["children"] == []


def scans(df, name):
    return len(re.findall(rf"Location: InMemoryFileIndex.*{name}[.]parquet", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))))


@pytest.mark.parametrize("name,table,most", [("s07_summarize_global", "lineitem", 1), ("b16_global_fact", "lineitem", 1), ("g06_outside_extent", "lineitem", 0)])
def test_large_tables_are_scanned_once(tables, name, table, most):
    """g06 reads its distribution once, into a written table, before the plan it gives back."""
    assert scans(CHECKS[name].run(tables), table) == most


def test_listed_keys_are_distinct_before_they_travel(tables):
    plan = CHECKS["j15_array_membership"].run(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftSemi[\s\S]*Aggregate \[id", plan)


def test_intermediates_go(spark):
    with intermediates(spark):
        kept = materialize(spark.range(5).toDF("x"), "short")
        place = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 5
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_fixed_values_are_what_they_should_be():
    assert C.AGGREGATE_TAXA == (100000, 100011, 100025, 100039, 100047, 100058, 100077, 100139, 100239, 100339)
    assert C.MERGED_ENTITIES == {223: 213}
    assert C.STOCK_HEADINGS == ("Collapsed", "Over-exploited", "Exploited", "Developing", "Rebuilding")
    assert (C.EEZ, C.HIGH_SEAS, C.LME, C.RFMO, C.GLOBAL, C.IFA, C.MEOW) == (1, 2, 3, 4, 6, 14, 19)
    assert C.DEFAULT_UNIT_PRICE == 1466 and len(C.GEAR_CODES) == 71


def test_the_cases_occur_in_the_fixture(tables):
    assert tables.allocation_data.filter("fishing_entity_id = 223").count() > 0
    assert tables.price.filter("price IS NULL").count() > 0
    shares = joins.cell_weights(tables.simple_area_cell_assignment_raw, tables.cell).select("share").distinct().collect()
    assert {round(float(r["share"]), 6) for r in shares} >= {0.333333, 0.142857, 0.000333}
    assert tables.allocation_result.filter("allocated_catch = 0.0001").count() > 0
