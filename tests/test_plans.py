"""The physical plans are the ones meant."""

import contextlib
import io
import re

from catchlake.checks.facts import layer_fact
from catchlake.checks.summaries import lookups
from catchlake.layers import LAYERS
from catchlake.plans import stocks, summaries
from catchlake.plans.cells import caught_data, published_data


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange \(", text))


def test_summary_shuffles_partial_sums_once(tables):
    d = lookups(tables)
    text = tree(summaries.summarize_rfmo(tables.allocation_result, d["weights"], d["simple_area"]))
    assert shuffles(text) == 1 and text.count("HashAggregate") == 2
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_four_weighted_layers_share_one_scan(tables):
    d = lookups(tables)
    base = summaries.weighted_base(tables.allocation_result, d["weights"], d["simple_area"], d["layer_pairs"])
    assert plan(base).count("l_orderkey:bigint") == 1


def test_scan_reads_only_what_is_used(tables):
    text = plan(summaries.summarize_eez(tables.allocation_result, tables.allocation_simple_area))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_fact_uses_hash_aggregates_and_no_products(tables):
    for name in LAYERS:
        text = tree(layer_fact(tables, name))
        assert "SortAggregate" not in text and "CartesianProduct" not in text


def test_stock_status_reads_the_fact_once(tables):
    text = plan(stocks.stock_status(tables.stock_fact, tables.stock_years, tables.area))
    assert text.count("user_id:bigint") == 1
    assert "CartesianProduct" not in text


def test_year_reaches_the_scan(tables):
    """The year of the fixture is computed, so its test shows up as a filter right above the scan of the data."""
    scans = [part for part in plan(caught_data(published_data(tables.allocation_data.filter("year = 1997"), tables.time_dim, tables.taxon_name), tables.allocation_result)).split("\n\n") if "Filter" in part and "o_orderdate" in part]
    assert any("= 1997" in part for part in scans)
