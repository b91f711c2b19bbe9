import contextlib
import io
import re
from functools import reduce

from pyspark.sql import DataFrame
from test_plans import tree

from catchlake.checks import CHECKS
from catchlake.checks.facts import layer_fact, layer_facts, published
from catchlake.plans import facts

NAMES = ("eez", "high_seas", "global")


def test_three_layers_join_the_data_once(tables):
    together = layer_facts(tables, *NAMES)
    alone = reduce(DataFrame.unionByName, [layer_fact(tables, n) for n in NAMES])
    assert tree(together).count("Exchange") < tree(alone).count("Exchange")
    one, other = (sorted(map(repr, published(df).collect())) for df in (together, alone))
    assert one == other


def dealt_by_area_and_dimensions(df) -> list[str]:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    keys = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text.getvalue())
    return [k for k in keys if "marine_layer_id" in k and "taxon_key" in k]


def test_catch_travels_to_the_dimensions_once(tables):
    """Neither sum deals out rows by area and dimensions, which are many more than ids; both follow the deal by the keys of the end uses."""
    for df in (CHECKS["b18_all_facts"].run(tables), CHECKS["b10_eez_fact"].run(tables), layer_facts(tables, *NAMES)):
        assert not dealt_by_area_and_dimensions(df)


def test_hot_end_use_keys_are_summed_before_they_travel(tables, monkeypatch):
    """Same rows, whether buckets of end-use keys are hot, and then those are dealt out as sums."""
    usual = CHECKS["b18_all_facts"].run(tables)
    rows = sorted(map(str, usual.collect()))
    monkeypatch.setattr(facts, "HOT_IDS", 1)
    monkeypatch.setattr(facts, "STANDS_OUT", 0)
    counted = tables.allocation_data
    assert 0 < len(facts.hot_buckets([counted])) < counted.select(facts._bucket()).distinct().count()
    hot = CHECKS["b18_all_facts"].run(tables)
    assert len(dealt_by_area_and_dimensions(hot)) >= 2 and sorted(map(str, hot.collect())) == rows
    monkeypatch.setattr(facts, "HOT_IDS", 0)
    assert sorted(map(str, CHECKS["b18_all_facts"].run(tables).collect())) == rows  # no bucket is left for the usual way
