"""What must hold on any data, on the test tables and on tables where one key holds a third of all rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.checks.facts import dims_of, summary_of
from catchlake.checks.summaries import all_summaries, lookups
from catchlake.layers import LAYERS
from catchlake.operators import joins
from catchlake.operators.sizing import measured
from catchlake.plans import cells, facts, stocks, summaries
from catchlake.session import materialize


def total(df, column="total_catch"):
    return df.agg(F.sum(column)).first()[0]


def test_global_is_eez_and_high_seas(tables):
    parts = {n: summary_of(tables, n) for n in ("eez", "high_seas", "global")}
    assert total(parts["global"]) == total(parts["eez"]) + total(parts["high_seas"])


def test_one_pass_summaries_equal_single_ones(tables):
    together = all_summaries(tables)
    for name, layer in LAYERS.items():
        alone = summary_of(tables, name)
        keys = [c for c in alone.columns if c != "total_catch"]
        assert summaries.reconcile(alone, together[name].select(alone.columns), keys, "total_catch").count() == 0, name


def test_reconcile_finds_a_difference(spark):
    a = spark.createDataFrame([(1, None, Decimal(2)), (2, 3, Decimal(2))], "id int, k int, total_catch decimal(9,2)")
    b = spark.createDataFrame([(1, None, Decimal(2)), (2, 3, Decimal(5)), (4, 4, Decimal(1))], "id int, k int, total_catch decimal(9,2)")
    assert {r["id"] for r in summaries.reconcile(a, b, ["id", "k"], "total_catch").collect()} == {2, 4}


def test_shares_that_sum_to_one_keep_the_catch(tables):
    data = tables.allocation_data.filter("catch_type_id <> 2").withColumn("v", F.col("unit_price"))
    split = joins.split_end_use(data, tables.end_use, ["v"], True)
    assert total(split, "v") == total(data, "v")


def test_status_shares_sum_to_a_hundred_or_nothing(tables):
    categories = stocks.stock_category(stocks.stock_collate(tables.stock_fact, tables.stock_years))
    for shares in (stocks.stock_css(categories, tables.stock_years), stocks.stock_nss(categories, tables.stock_years)):
        for row in shares.groupBy("main_area_id", "year").agg(F.sum("value").alias("v")).collect():
            assert row["v"] == 0 or abs(row["v"] - 100) < 1e-6


def test_report_needs_enough_taxa_and_cells(tables):
    shown = stocks.stock_status(tables.stock_fact, tables.stock_years, tables.area, min_cells=0, min_taxa=0)
    assert shown.count() > 0
    assert stocks.stock_status(tables.stock_fact, tables.stock_years, tables.area, min_cells=10 ** 6, min_taxa=0).count() == 0


def test_fact_rows_are_unique_by_key_and_raw_score(tables):
    fact = facts.build_fact(summary_of(tables, "eez"), tables.allocation_data, dims_of(tables), LAYERS["eez"])
    assert fact.columns == list(C.FACT_COLUMNS)
    keys = [c for c in C.FACT_COLUMNS[:16]]
    assert fact.groupBy(*keys).count().filter("count > 2").count() == 0


@pytest.fixture(scope="module")
def hot(tables):
    """The result with a third of all its rows on one id, one cell and one simple area."""
    result = tables.allocation_result
    one = result.orderBy("universal_data_id", "cell_id").first()
    amount = (F.col("l_orderkey") % 9 + 1).cast("decimal(18,4)").alias("allocated_catch")
    same = [F.lit(one[c]).cast("bigint").alias(c) for c in result.columns[:3]]
    return result.unionByName(tables.lineitem.filter("l_linenumber % 2 = 0").select(*same, amount))


def test_hot_keys_lose_nothing(spark, tables, hot):
    d = lookups(tables)
    weights = joins.cell_weights(tables.simple_area_cell_assignment_raw, tables.cell)
    shuffled = (materialize(weights, "weights"), tables.allocation_simple_area, tables.area_fao)
    hinted = (d["weights"], d["simple_area"], d["pairs"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_shuffle = summaries.summarize_lme(hot, *shuffled)
        by_hint = summaries.summarize_lme(hot, *hinted)
        keys = ["universal_data_id", "lme_id", "eez_id"]
        assert summaries.reconcile(by_shuffle, by_hint, keys, "total_catch").count() == 0
        eez = summaries.summarize_eez(hot, tables.allocation_simple_area)
        kept = hot.join(tables.allocation_simple_area.filter("eez_id > 0"), "allocation_simple_area_id")
        assert total(eez) == total(kept, "allocated_catch")
        ids = kept.select("universal_data_id")
        in_cells = cells.cell_sums(cells.caught_data(tables.allocation_data, ids), hot)
        same = hot.join(ids.distinct(), "universal_data_id", "left_semi").join(
            tables.allocation_data.select("universal_data_id"), "universal_data_id")
        assert total(in_cells, "catch_sum") == total(same, "allocated_catch")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_hints_only_small_frames(tables):
    frames = measured(max_bytes=5000, small=tables.gear, large=tables.allocation_result)
    plans = {n: df._jdf.queryExecution().analyzed().toString() for n, df in frames.items()}
    assert "ResolvedHint" in plans["small"] and "ResolvedHint" not in plans["large"]
