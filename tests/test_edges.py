"""Small literal cases that the test tables do not hold."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.functions import columns as X
from catchlake.layers import LAYERS
from catchlake.operators import aggregates, clean, grid, joins, partitions, windows
from catchlake.plans import documents, extents, facts, quality, stocks, summaries


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_peak_tie_takes_earliest_year(spark):
    df = spark.createDataFrame([(7, 2, 10), (7, 1, 10), (7, 3, 4)], "t int, year int, v int")
    assert rows(windows.with_peak(df, ["t"], "year", "v"), "peak_year", "peak_catch_sum") == [(1, 10)] * 3


def test_run_counts_positive_years_ahead(spark):
    df = spark.createDataFrame([(1, y, v) for y, v in enumerate([3, 0, 2, None, 5, 1, 1])], "t int, year int, v int")
    assert [r[1] for r in rows(windows.with_run(df, ["t"], "year", "v"), "year", "positive_catch_count")] == [3, 0, 4 - 0, 0, 3, 2, 1]


def test_post_peak_minimum(spark):
    df = spark.createDataFrame([(1, 1, 9, 1), (1, 2, 3, 1), (1, 3, 3, 1), (1, 4, 5, 1)], "t int, year int, v int, peak_year int")
    out = windows.with_post_peak_min(df, ["t"], "year", "v")
    assert rows(out, "post_peak_min_year", "post_peak_min_catch_sum") == [(2, 3)] * 4


def test_smoothing_keeps_both_ends(spark):
    df = spark.createDataFrame([(1, y, v, 1, 3) for y, v in ((1, 1), (2, 2), (3, 6))], "t int, year int, v int, b int, e int")
    assert rows(windows.centred_mean(df, ["t"], "year", "v", "b", "e", "m"), "m") == [(1.0,), (3.0,), (6.0,)]


COLLATED = ("main_area_id int, taxon_key int, year int, catch_sum decimal(20,0), peak_year int, peak_catch_sum decimal(20,0), "
            "final_year int, post_peak_min_year int, post_peak_min_catch_sum decimal(20,0)")


@pytest.mark.parametrize("year, catch, peak_year, final, low_year, low, category", [
    (5, 50, 1, 9, 8, 40, 6),     # exactly half, after the peak
    (1, 50, 3, 9, 8, 40, 4),     # half, before the peak
    (9, 100, 9, 9, 9, 100, 4),   # peak in the last year
    (5, 51, 1, 9, 8, 40, 3),
    (5, 30, 1, 9, 8, 40, 2),
    (5, 30, 1, 9, 4, 9, 5),      # recovered from below a tenth
    (4, 30, 1, 9, 4, 9, 2),      # not after the minimum
    (5, 10, 1, 9, 8, 9, 1),      # exactly a tenth
])
def test_stock_category(spark, year, catch, peak_year, final, low_year, low, category):
    row = (1, 1, year, Decimal(catch), peak_year, Decimal(100), final, low_year, Decimal(low))
    df = spark.createDataFrame([row], COLLATED)
    assert rows(stocks.stock_category(df), "category_id") == [(category,)]


def _stock(spark, values, area=1, taxon=1):
    return [(area, 1, taxon, y, Decimal(v)) for y, v in values.items()]


FACT = "main_area_id int, marine_layer_id int, taxon_key int, year int, catch_sum decimal(18,4)"


def test_collate_thresholds(spark):
    long = {y: 200 for y in range(1, 11)}
    short_run = {y: 500 for y in (1, 2, 3, 4, 6, 7, 8, 9, 11)}
    little = {y: 50 for y in range(1, 11)}
    data = (_stock(spark, long, taxon=1) + _stock(spark, short_run, taxon=2) + _stock(spark, little, taxon=3)
            + _stock(spark, long, taxon=100000) + [(1, 3, 4, y, Decimal(500)) for y in range(1, 12)])
    years = spark.createDataFrame([(y,) for y in range(1, 12)], "time_business_key int")
    out = stocks.stock_collate(spark.createDataFrame(data, FACT), years)
    assert rows(out.select("taxon_key").distinct()) == [(1,)]


def test_null_score_and_score_one_stay_apart(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 1, 7)], "k int, score int, v int")
    out = aggregates.sum_then_default(df, ["k"], "score", 1, v=F.sum("v"))
    assert rows(out, "k", "score", "v") == [(1, 1, 5), (1, 1, 7)]


def test_overlapping_periods_repeat_rows_and_range_end_is_open(spark):
    df = spark.createDataFrame([(1, 1, 1, 2000), (1, 1, 1, 2010)], "eez_id int, sector_type_id int, data_layer_id int, year int")
    scores = spark.createDataFrame([(1, 1, p, 10 * p, 1) for p in (1, 2, 3)], "eez_id int, sector_type_id int, period_id int, score int, layer int")
    periods = spark.createDataFrame([(1, 1990, 2010), (2, 1995, 2005)], "period_id int, year_from int, year_to int")
    out = joins.with_score(df, joins.uncertainty_periods(scores, periods))
    assert sorted(out.select("year", "score").collect(), key=str) == [(2000, 10), (2000, 20), (2010, None)]


def test_zero_goes_and_null_stays(spark):
    df = spark.createDataFrame([(0,), (None,), (2,)], "v int")
    assert {r[0] for r in clean.drop_zero(df, "v").collect()} == {None, 2}


def test_variation_of_one_sample_and_zero_mean(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 0.0), (2, 0.0), (3, 1.0), (3, 3.0)], "k int, v double")
    assert {r[0]: r[1] for r in aggregates.variation(df, ["k"], "v").collect()} == {1: None, 2: None, 3: pytest.approx(2 ** 0.5 / 2)}


def test_cell_without_water_adds_nothing(spark):
    result = spark.createDataFrame([(1, 1, 1, Decimal(8)), (1, 2, 1, Decimal(4))],
                                   "universal_data_id int, cell_id int, allocation_simple_area_id int, allocated_catch decimal(18,4)")
    water = "cell_id int, water_area decimal(18,4)"
    cell = spark.createDataFrame([(1, Decimal(0)), (2, Decimal(4))], water)
    assigned = spark.createDataFrame([(14, 5, c, 9, Decimal(2)) for c in (1, 2)],
                                     "marine_layer_id int, area_id int, cell_id int, fao_area_id int, water_area decimal(18,4)")
    assert rows(summaries.summarize_ifa(result, joins.cell_weights(assigned, cell))) == [(1, 5, 9, Decimal(2))]


def test_bucket_ends(spark):
    df = aggregates.with_bounds(spark.createDataFrame([(1.0,), (11.0,), (21.0,)], "v double"), "v")
    assert rows(df.select(X.tally_bucket(F.col("v"), F.col("min_v"), F.col("max_v")))) == [(0,), (10,), (20,)]
    flat = aggregates.with_bounds(spark.createDataFrame([(1.0,)], "v double"), "v")
    assert rows(flat.select(X.tally_bucket(F.col("v"), F.col("min_v"), F.col("max_v")))) == [(None,)]


def test_extent_file_names(spark):
    df = spark.createDataFrame([("600123.shp",), ("600123-1.shp",), ("notes.txt",)], "f string")
    out = {r[0]: (r[1], r[2]) for r in df.select("f", X.extent_file_key(F.col("f")), X.extent_file_is_extended(F.col("f"))).collect()}
    assert out["600123.shp"] == (600123, False) and out["600123-1.shp"] == (600123, True) and out["notes.txt"][0] is None


def test_money_text(spark):
    df = spark.createDataFrame([(Decimal("1234567.5"),)], "v decimal(17,2)")
    assert df.select(X.money_text(F.col("v"))).first()[0] == "          1,234,567.50"


def test_end_use_rules(spark):
    keys = ["fishing_entity_id", "year", "taxon_key", "sector_type_id", "reporting_status_id", "gear_type_id"]
    schema = ", ".join(f"{k} int" for k in keys) + ", catch_type_id int, "
    df = spark.createDataFrame([(1, 1, 1, 1, 1, 1, t, 10.0) for t in (1, 2)] + [(None, 1, 1, 1, 1, 1, 1, 10.0)], schema + "v double")
    uses = spark.createDataFrame([(1, 1, 1, 1, 1, 1, t, u, p) for t in (1, 2) for u, p in ((1, 0.7), (2, 0.3))]
                                 + [(None, 1, 1, 1, 1, 1, 1, 9, 1.0)], schema + "end_use_type_id int, end_use_percentage double")
    out = rows(joins.split_end_use(df, uses, ["v"], True), "catch_type_id", "end_use_type_id", "v")
    assert out == [(1, 1, 7.0), (1, 1, 10.0), (1, 2, 3.0), (2, 4, 10.0), (2, 4, 10.0)]
    out = rows(joins.split_end_use(df, uses, ["v"], False), "catch_type_id", "end_use_type_id", "v")
    assert out == [(1, 1, 7.0), (1, 1, 10.0), (1, 2, 3.0), (2, 1, 7.0), (2, 2, 3.0)]


def test_price_update_with_null_price(spark):
    data = spark.createDataFrame([(1, 1, 1, 1, Decimal(5)), (2, 1, 1, 2, Decimal(5)), (3, 1, 1, 3, None)],
                                 "universal_data_id int, year int, fishing_entity_id int, taxon_key int, unit_price decimal(18,2)")
    price = spark.createDataFrame([(1, 1, 1, 2, Decimal(9)), (1, 1, 1, 1, Decimal(8)), (1, 1, 2, 1, None)],
                                  "year int, fishing_entity_id int, taxon_key int, end_use_type_id int, price decimal(18,2)")
    assert {r[0]: r[4] for r in clean.update_price(data, price).collect()} == {1: Decimal(8), 2: None, 3: None}
    assert rows(clean.changed_prices(data, price), "universal_data_id") == [(1,), (2,)]


def test_near_and_far_cells(spark):
    cells = spark.createDataFrame([(1, 1.05, 0.0, 1.5, 1.0), (2, 1.15, 0.0, 1.6, 1.0), (3, 1.08, 1.08, 2.0, 2.0), (4, 0.2, 0.2, 0.4, 0.4)],
                                  "id int, xmin double, ymin double, xmax double, ymax double")
    boxes = spark.createDataFrame([(9, False, 0.0, 0.0, 1.0, 1.0)], "taxon_key int, is_extended boolean, xmin double, ymin double, xmax double, ymax double")
    dist = spark.createDataFrame([(9, i, i == 2) for i in (1, 2, 3, 4)] + [(8, 1, False)], "taxon_key int, cell_id int, is_backfilled boolean")
    assert rows(grid.outside_extent(dist, cells, boxes)) == [(9, False, 2), (9, False, 3)]
    filled = dist.withColumn("is_backfilled", F.lit(True))
    assert rows(grid.outside_extent(filled, cells, boxes)) == []


def test_touching_cells(spark):
    cells = spark.createDataFrame([(10 * y + x, x, y) for x in range(5) for y in range(5)], "id int, gx int, gy int")
    dist = spark.createDataFrame([(1, 22, True), (1, 0, False), (2, 33, True)], "taxon_key int, cell_id int, is_backfilled boolean")
    taxa = spark.createDataFrame([(1,)], "taxon_key int")
    assert rows(grid.extent_from_distribution(dist, cells, taxa), "cell_id") == [(i,) for i in (11, 12, 13, 21, 22, 23, 31, 32, 33)]


def test_boxes_that_touch_meet_once(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "gid int, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame([(1, 1.0, 1.0, 2.0, 2.0), (2, 1.1, 0.0, 2.0, 1.0), (3, -5.0, -5.0, 5.0, 5.0)],
                              "id int, xmin double, ymin double, xmax double, ymax double")
    assert rows(grid.intersecting(a, b), "gid", "cell_id") == [(1, 1), (1, 3)]


def test_contained_boxes_go(spark):
    boxes = spark.createDataFrame([(1, 1, 0.0, 0.0, 4.0, 4.0), (2, 1, 1.0, 1.0, 2.0, 2.0), (3, 1, 0.0, 0.0, 4.0, 4.0),
                                   (4, 2, 1.0, 1.0, 2.0, 2.0), (5, 1, 3.0, 3.0, 5.0, 5.0)],
                                  "gid int, taxon_key int, xmin double, ymin double, xmax double, ymax double")
    assert rows(grid.purge_contained(boxes, "taxon_key", "gid"), "gid") == [(1,), (4,), (5,)]


def _ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


RING = "array<struct<x:double,y:double>>"
SQUARE = _ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))


def test_invalid_rings(spark):
    cases = [SQUARE, SQUARE[:4], SQUARE[:2] + SQUARE[:1], _ring((0, 0), (1, 0), (2, 0), (0, 0)),
             _ring((0, 0), (float("inf"), 0), (1, 1), (0, 0)), [], None]
    df = spark.createDataFrame([(i, i, r) for i, r in enumerate(cases)], f"gid int, taxon_key int, ring {RING}")
    assert rows(extents.invalid_extents(df), "gid") == [(i,) for i in range(1, 7)]


def test_load_extents_replaces_even_when_nothing_new_comes(spark):
    big = _ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    existing = spark.createDataFrame([(1, False, SQUARE), (2, False, SQUARE), (3, True, SQUARE), (4, False, SQUARE)],
                                     f"taxon_key int, is_extended boolean, ring {RING}")
    features = spark.createDataFrame([("1.shp", big), ("2.shp", big), ("2.shp", SQUARE), ("3.shp", big), ("9.shp", big)],
                                     f"file_name string, ring {RING}")
    taxa = spark.createDataFrame([(1,), (2,), (3,), (4,)], "taxon_key int")
    out = extents.load_extents(features, taxa, existing)
    areas = out.select("taxon_key", "is_extended", X.ring_area(F.col("ring")).alias("a"))
    assert rows(areas) == [(1, False, 4.0), (3, False, 4.0), (3, True, 1.0), (4, False, 1.0)]


def test_partition_map_is_balanced_and_whole(spark):
    dist = spark.createDataFrame([(i * i, 1 + i % 7) for i in range(1, 400)], "k bigint, record_count bigint")
    ranges = [tuple(r) for r in partitions.partition_map(dist, "k", 10).orderBy("partition_id").collect()]
    assert sum(r[3] for r in ranges) == sum(1 + i % 7 for i in range(1, 400))
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))
    assert max(r[3] for r in ranges) <= min(r[3] for r in ranges) + 14


def test_running_total_over_sparse_keys(spark):
    keys = [-5, 0, 3, 1000, 10 ** 12]
    out = partitions.running_total(spark.createDataFrame([(k, 2) for k in keys], "k bigint, n bigint"), "k", "n", "s")
    assert rows(out, "k", "s") == [(k, 2 * i) for i, k in enumerate(keys, 1)]


def test_comparison_counts_unknown_abundance_as_missing(spark):
    schema = "taxon_key int, cell_id int, relative_abundance double"
    old = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.0), (1, 3, 0.5), (1, 4, 0.5), (2, 1, 0.5)], schema)
    new = spark.createDataFrame([(1, 1, 0.5), (1, 3, None), (1, 9, 0.1)], schema)
    cells = spark.createDataFrame([(c, 0.0 if c == 4 else 1.0) for c in (1, 2, 3, 4)], "cell_id int, water_area double")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "taxon_key int, common_name string")
    assert rows(quality.compare_distribution(old, new, cells, names)) == [("a", 1, 2, 2, 1)]


def test_taxon_tree_reads_as_json(spark):
    import json
    nodes = [(1901, "B", 1, "x", None), (1900, "A", 1, "y", None), (5, "c", 2, "x.c", "x"), (6, "b", 2, "x.b", "x"),
             (7, "d", 3, "x.b.d", "x.b"), (2000, "other", 1, "z", None), (8, "e", 2, "z.e", "z")]
    taxa = spark.createDataFrame([(*n, True, False, Decimal("1.5"), None) for n in nodes],
                                 "taxon_key int, common_name string, level int, lineage string, parent string, is_distribution_available "
                                 "boolean, is_extent_available boolean, total_catch decimal(17,2), total_value decimal(17,2)")
    pieces = documents.taxon_tree(taxa, "19", "All").orderBy("root_order", "path").collect()
    tree = json.loads("".join(p["text"] for p in pieces))
    assert tree["name"] == "All" and [c["name"] for c in tree["children"]] == ["A", "B"]
    assert [c["lineage"] for c in tree["children"][1]["children"]] == ["x.b", "x.c"]
    assert tree["children"][1]["children"][0]["children"][0]["key"] == 7
    assert "children" not in tree["children"][0]


def test_document_lines_read_as_json(spark, tables):
    import json
    lines = documents.taxon_list(tables.taxon_lineage).orderBy("section", "name", "taxon_key").collect()
    document = json.loads("".join(r["text"] for r in lines))
    assert len(document["children"]) == tables.taxon_lineage.count()


def test_merged_entities_are_not_summed(spark):
    df = spark.createDataFrame([(223, 1), (213, 2), (1, 3)], "fishing_entity_id int, v int")
    assert rows(clean.merge_entity(df, "fishing_entity_id", C.MERGED_ENTITIES)) == [(1, 3), (213, 1), (213, 2)]


def test_unknown_gear_drops_only_where_gear_is_joined():
    assert {n for n, layer in LAYERS.items() if layer.gear_join} == {"lme", "global"}
    assert {n for n, layer in LAYERS.items() if not layer.discard_rule} == {"lme", "global"}
    assert LAYERS["ifa"].layer_id == 14 and LAYERS["ifa"].area_layer == 1


def test_allowed_area_table(spark):
    table = facts.allowed_areas({"lme": (spark.createDataFrame([(1,), (1,), (2,)], "lme_id int"), "lme_id")})
    assert rows(table) == [(3, 1), (3, 2)]
