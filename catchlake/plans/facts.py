"""The star-schema fact of the marine layers.

All layers go through one plan: rows carry their layer id, and what differs between layers is a condition on it. So the
allocation data, end uses, prices and scores are each joined once, not once per layer.

All measures are linear in catch, so catch is first summed over row ids to the grain of the data's dimensions. The joins
to end uses, prices and scores then run on that frame, a second sum brings together rows that the end-use
split made alike, and the dimensions, each with one row per key, are joined to the result.

Catch travels to the dimensions once: the areas of an id go as one list beside the id's dimensions, dealt out by the keys
of the end uses. Both sums and the join to end uses have these keys among theirs, so no other exchange of catch follows. Keys
with very many ids are summed before they travel instead (see hot_buckets).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.functions.columns import ppr
from catchlake.layers import LAYERS, Layer
from catchlake.operators.aggregates import narrowed
from catchlake.operators.clean import merge_entity
from catchlake.operators.joins import END_USE_KEYS, area_join, split_end_use, star, with_price, with_score

DATA_KEYS = (
    "year", "taxon_key", "data_layer_id", "fishing_entity_id", "gear_type_id", "catch_type_id", "reporting_status_id",
    "sector_type_id",
)

#: Prices have ten digits before the point at most, and amounts 12 after it, so that a product has room for all of them.
PRICE_TYPE, AMOUNT_TYPE = "decimal(12,2)", "decimal(26,12)"

AREA_KEYS = ("marine_layer_id", "main_area_id", "sub_area_id")

ID = "universal_data_id"

#: Buckets of end-use keys in which ids are counted, and the ids from which a bucket that stands out is hot.
BUCKETS, HOT_IDS, STANDS_OUT = 4096, 100_000, 4


def allowed_areas(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The lists of allowed areas as one table (marine_layer_id, main_area_id), from layer name -> (list, its column)."""
    lists = [df.select(F.lit(LAYERS[name].layer_id).alias("marine_layer_id"), F.col(column).alias("main_area_id"))
             for name, (df, column) in tables.items()]
    return reduce(DataFrame.unionByName, lists).distinct()


def layer_rows(summary: DataFrame, layer: Layer) -> DataFrame:
    """A summary with the columns all layers share. eez_id is kept only where it leads to a score."""
    def column(source: str | int) -> Column:
        return F.col(source) if isinstance(source, str) else F.lit(source)

    eez = F.col("eez_id") if layer.score == "lookup" else F.lit(None).cast("int")
    return summary.select(F.lit(layer.layer_id).alias("marine_layer_id"), "universal_data_id",
                          column(layer.main).alias("main_area_id"), column(layer.sub).alias("sub_area_id"),
                          eez.alias("eez_id"), "total_catch")


def rows_of_bases(simple: DataFrame, weighted: DataFrame) -> list[DataFrame]:
    """The rows of all seven layers straight from the two base summaries, those of each base by themselves.

    A simple row counts twice, in its own layer and in the global one; the global sum over ids happens with the sum to
    the dimensions. A weighted row already carries its layer.
    """
    in_eez = F.col("eez_id") > 0
    no_eez = F.lit(None).cast("int")

    def place(layer: int, main: Column, sub: Column, eez: Column) -> Column:
        return F.struct(F.lit(layer).alias("marine_layer_id"), main.cast("int").alias("main_area_id"),
                        sub.cast("int").alias("sub_area_id"), eez.alias("eez_id"))

    own = F.when(in_eez, place(C.EEZ, F.col("eez_id"), F.col("fao_area_id"), F.col("eez_id"))).otherwise(
        place(C.HIGH_SEAS, F.col("fao_area_id"), F.lit(0), no_eez))
    world = place(C.GLOBAL, F.lit(1), F.when(in_eez, 1).otherwise(2), no_eez)
    columns = ["marine_layer_id", ID, "main_area_id", "sub_area_id", "eez_id", "total_catch"]
    simple_rows = simple.repartition(ID).select(ID, "total_catch", F.inline(F.array(own, world))).select(*columns)

    ifa = F.col("marine_layer_id") == C.IFA
    weighted_rows = weighted.repartition(ID).withColumns({
        "main_area_id": F.col("area_id"),
        "sub_area_id": F.when(ifa, F.col("cell_fao_area_id")).otherwise(0),
        "eez_id": F.when(ifa, F.col("area_id")).otherwise(F.col("eez_id")),
    }).select(*columns)
    return [simple_rows, weighted_rows]


def _in(layers: Sequence[Layer], test: Callable[[Layer], bool]) -> Column:
    """Whether a row's layer passes a test."""
    ids = [layer.layer_id for layer in layers if test(layer)]
    if len(ids) in (0, len(layers)):
        return F.lit(bool(ids))
    return F.col("marine_layer_id").isin(*ids)


#: Rows and allocation data, or several pairs of them that are joined one by one (see sources.layout.pairs_of).
Parts = Sequence[tuple[DataFrame, DataFrame]]


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*END_USE_KEYS), F.lit(BUCKETS)).cast("int")


def hot_buckets(data: Sequence[DataFrame]) -> list[int]:
    """Buckets of end-use keys with many more ids than others, too many for one task. The answer has a row for each bucket at most."""
    buckets = reduce(DataFrame.unionByName, [df.select(_bucket().alias("bucket")) for df in data])
    counts = {r["bucket"]: r["count"] for r in buckets.groupBy("bucket").count().collect()}
    return sorted(b for b, n in counts.items() if n > max(HOT_IDS, STANDS_OUT * sum(counts.values()) / BUCKETS))


def catch_by_dimensions(parts: Parts, unit_price: bool) -> list[DataFrame]:
    """Catch, and its value at unit price where a layer uses that, at the grain of the data's dimensions: one frame for most end-use keys,
    dealt out by them, and one for those in hot buckets, if there are any. Rows of a grain are in one of the two.

    The list of an id has one entry for each of its areas at most, whatever the number of its cells.
    """
    sums = [F.sum("total_catch").alias("catch")]
    wanted = [ID, *DATA_KEYS]
    if unit_price:
        sums.append(F.sum(F.col("unit_price").cast(PRICE_TYPE) * F.col("total_catch").cast(AMOUNT_TYPE)).alias("catch_value"))
        wanted.append("unit_price")
    places = [*AREA_KEYS, "eez_id", "total_catch"]
    kinds = reduce(DataFrame.unionByName, [rows.select(ID, *places) for rows, _ in parts]).schema
    pairs = [(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds]), data.select(*wanted)) for rows, data in parts]
    hot = hot_buckets(list({id(data): data for _, data in parts}.values()))

    def summed(rows: DataFrame) -> DataFrame:
        return narrowed(rows.groupBy(*AREA_KEYS, "eez_id", *DATA_KEYS).agg(*sums), *["catch", "catch_value"][:len(sums)])

    listed = [(rows.groupBy(ID).agg(F.collect_list(F.struct(*places)).alias("_places")), data) for rows, data in pairs]
    usual = reduce(DataFrame.unionByName, [rows.join(data.filter(~_bucket().isin(hot)) if hot else data, ID).drop(ID) for rows, data in listed])
    made = [summed(usual.repartition(*END_USE_KEYS).select("*", F.inline("_places")).drop("_places"))]
    if hot:
        made.append(summed(reduce(DataFrame.unionByName, [rows.join(data.filter(_bucket().isin(hot)), ID) for rows, data in pairs])))
    return made


def _at_end_uses(rows: DataFrame, dims: Mapping[str, DataFrame], layers: Sequence[Layer]) -> DataFrame:
    """Catch and value by end use and score, from catch at the grain of the data's dimensions (see catch_by_dimensions)."""
    def any_layer(test: Callable[[Layer], bool]) -> bool:
        return any(test(layer) for layer in layers)

    priced = _in(layers, lambda x: x.end_use_price)
    at_unit_price = any_layer(lambda x: not x.end_use_price)
    amounts = ["catch", "catch_value"] if at_unit_price else ["catch"]
    rows = split_end_use(rows, dims["end_use"], amounts, _in(layers, lambda x: x.discard_rule))

    if any_layer(lambda x: x.end_use_price):
        # A layer at unit price must not be repeated by the price table, so it brings no end use to that join.
        rows = rows.withColumns({"_use": F.col("end_use_type_id"), "end_use_type_id": F.when(priced, F.col("end_use_type_id"))})
        rows = with_price(rows, dims["price"]).withColumn("end_use_type_id", F.col("_use")).drop("_use")
        value = F.coalesce("price", F.lit(C.DEFAULT_UNIT_PRICE)).cast(PRICE_TYPE) * F.col("catch").cast(AMOUNT_TYPE)
        rows = rows.withColumn("catch_value", F.when(priced, value).otherwise(F.col("catch_value")) if at_unit_price else value)
    if any_layer(lambda x: x.score == "lookup"):
        rows = with_score(rows, dims["scores"])
    else:
        rows = rows.withColumn("score", F.lit(None).cast("int"))

    # Grouped by the raw score, filled afterwards: an unknown score and a score of 1 stay two rows.
    keys = [*AREA_KEYS, *DATA_KEYS, "end_use_type_id", "score"]
    fact = rows.groupBy(*keys).agg(F.sum("catch").alias("catch_sum"), F.sum("catch_value").alias("real_value"))
    return narrowed(fact, "catch_sum").withColumnRenamed("gear_type_id", "gear_id")


def build_facts(parts: Parts, dims: Mapping[str, DataFrame], layers: Sequence[Layer]) -> DataFrame:
    """The 22 fact columns of all rows of the given layers.

    dims: end_use, price, scores (see uncertainty_periods), cube_dim_taxon, area, time_dim, catch_type,
    reporting_status, gear, allowed_area. Hint the small ones with sizing.measured.
    """
    def any_layer(test: Callable[[Layer], bool]) -> bool:
        return any(test(layer) for layer in layers)

    if any_layer(lambda x: x.allowed):
        listed = dims["allowed_area"].withColumn("_listed", F.lit(True))
        unlisted = ~_in(layers, lambda x: x.allowed)
        parts = [(rows.join(listed, ["marine_layer_id", "main_area_id"], "left").filter(unlisted | F.col("_listed")).drop("_listed"), data)
                 for rows, data in parts]

    fact = reduce(DataFrame.unionByName, [_at_end_uses(rows, dims, layers) for rows in catch_by_dimensions(parts, any_layer(lambda x: not x.end_use_price))])

    # Every key the dimensions are joined on is a group key by now, so the joins see final rows only, and the measures
    # that need the taxon are products of sums.
    fact = area_join(fact, dims["area"], layers)
    fact = star(fact, {
        "taxon_key": (dims["cube_dim_taxon"], "taxon_key", ["tl", "sl_max"]),
        "catch_type_id": (dims["catch_type"], "catch_type_id", [F.col("abbreviation").alias("catch_status")]),
        "reporting_status_id": (dims["reporting_status"], "reporting_status_id",
                                [F.col("abbreviation").alias("reporting_status")]),
        "year": (dims["time_dim"], "time_business_key", ["time_key"]),
    })
    if any_layer(lambda x: x.gear_join):
        fact = fact.join(dims["gear"].select("gear_id", F.lit(True).alias("_gear")), "gear_id", "left")
        fact = fact.filter(~_in(layers, lambda x: x.gear_join) | F.col("_gear"))
    return fact.withColumns({
        "score": F.coalesce("score", F.when(~_in(layers, lambda x: x.score == "null"), 1)),
        "primary_production_required": ppr(F.col("catch_sum"), F.col("tl")),
        "catch_trophic_level": F.col("catch_sum") * F.col("tl"),
        "catch_max_length": F.col("catch_sum") * F.col("sl_max"),
    }).select(*C.FACT_COLUMNS)


def build_fact(summary: DataFrame, data: DataFrame, dims: Mapping[str, DataFrame], layer: Layer) -> DataFrame:
    """The fact of one layer from its summary."""
    return build_facts([(layer_rows(summary, layer).repartition(ID), data)], dims, [layer])


def build_layer_facts(summaries: Mapping[str, DataFrame], data: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The facts of several layers from their summaries, in one pass over everything else."""
    layers = [LAYERS[n] for n in summaries]
    rows = reduce(DataFrame.unionByName, [layer_rows(summary, layer) for summary, layer in zip(summaries.values(), layers, strict=True)])
    return build_facts([(rows.repartition(ID), data)], dims, layers)


def build_fact_of_parts(parts: Parts, dims: Mapping[str, DataFrame], layer: Layer) -> DataFrame:
    """The fact of one layer from the summaries of a table's parts, each with the data that belongs to it."""
    return build_facts([(layer_rows(summary, layer), data) for summary, data in parts], dims, [layer])


def build_all_facts(simple: DataFrame, weighted: DataFrame, data: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The facts of all seven layers in one pass, with merged fishing entities; merged rows are not summed again."""
    facts = build_facts([(rows, data) for rows in rows_of_bases(simple, weighted)], dims, list(LAYERS.values()))
    return merge_entity(facts, "fishing_entity_id", C.MERGED_ENTITIES)


def audit_area(result, weights, simple_area, pairs, data, dims, layer: Layer, area_id: int, summarize) -> DataFrame:
    """Summary and fact of a single area in one plan; the area test reaches the weights before the result is joined."""
    summary = summarize(result, weights.filter(F.col("area_id") == area_id), simple_area, pairs)
    return build_fact(summary, data, dims, layer)
