"""CSV and JSON documents, as lines or blocks of bounded size rather than one value that holds everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.functions.columns import has_key_prefix, money_text, tally_bucket
from catchlake.operators.aggregates import with_bounds
from catchlake.session import materialize
from catchlake.sources.writers import CSV_OPTIONS, write_csv_per_entity

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _entity_rows(fact: DataFrame, layer: int, exclude: Sequence[int]) -> DataFrame:
    return fact.filter((F.col("marine_layer_id") == layer) & ~F.col("main_area_id").isin(*exclude))


def csv_cache(fact: DataFrame, columns: Sequence[str], layer: int = C.RFMO,
              exclude: Sequence[int] = C.CSV_CACHE_EXCLUDED) -> DataFrame:
    """Catch rows of each entity as CSV lines: (entity_layer_id, entity_id, csv_data), one row per line.

    An entity may hold any share of the fact, so its lines are not gathered into one value.
    """
    rows = _entity_rows(fact, layer, exclude)
    return rows.select(F.lit(layer).alias("entity_layer_id"), F.col("main_area_id").alias("entity_id"),
                       F.to_csv(F.struct(*columns), CSV_OPTIONS).alias("csv_data"))


def write_csv_cache(fact: DataFrame, columns: Sequence[str], path: str, layer: int = C.RFMO,
                    exclude: Sequence[int] = C.CSV_CACHE_EXCLUDED) -> None:
    """The cache as files: one folder per entity, CSV with a header."""
    rows = _entity_rows(fact, layer, exclude).withColumn("entity_id", F.col("main_area_id"))
    write_csv_per_entity(rows.select("entity_id", *columns), "entity_id", path)


def cell_catch_json(cells: DataFrame, width: int = 1000) -> DataFrame:
    """Catch per cell of a year as JSON arrays: (year, block, result), a block being `width` consecutive cell ids."""
    sums = cells.groupBy("year", "cell_id").agg(F.sum("catch_sum").alias("catch"))
    block = F.floor(F.col("cell_id") / width).cast("bigint").alias("block")
    return sums.groupBy("year", block).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("cell_id", "catch")))).alias("result"))


def document_lines(children: DataFrame, order: Sequence[str], fields: Sequence[Column | str], head: str, tail: str) -> DataFrame:
    """A JSON document with a list of children as lines (section, <order>, text), to be read in that order.

    order must tell the children apart. Any number of children fits, for no task holds more than its lines.
    """
    first = children.agg(F.min(F.struct(*order))).scalar()
    comma = F.when(F.struct(*order) == first, F.lit("")).otherwise(F.lit(","))
    text = F.concat(comma, F.to_json(F.struct(*fields), JSON_OPTIONS))
    lines = children.select(F.lit(1).alias("section"), *order, text.alias("text"))
    nothing = [F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in order]
    one = children.sparkSession.range(1)
    ends = [one.select(F.lit(s).alias("section"), *nothing, F.lit(t).alias("text")) for s, t in ((0, head), (2, tail))]
    return lines.unionByName(ends[0]).unionByName(ends[1])


def taxon_list(taxa: DataFrame) -> DataFrame:
    """Flat list of taxa under one root."""
    named = taxa.select(F.col("common_name").alias("name"), "taxon_key", F.col("level").alias("taxon_level_id"), "lineage")
    return document_lines(named, ["name", "taxon_key"], ["taxon_key", "name", "taxon_level_id", "lineage"],
                          '{"name":"taxon","children":[', "]}")


def entity_sums(fact: DataFrame) -> DataFrame:
    """Catch and value of each fishing entity in the EEZ and high seas layers."""
    rows = fact.filter(F.col("marine_layer_id").isin(C.EEZ, C.HIGH_SEAS))
    return rows.groupBy("fishing_entity_id").agg(F.sum("catch_sum").alias("catch"), F.sum("real_value").alias("value"))


def entity_totals(sums: DataFrame, entity: DataFrame) -> DataFrame:
    """Named entities with their place among all of them. sums (entity_sums) is read twice, so write it first."""
    placed = with_bounds(sums, "catch", "value").withColumns({
        f"{c}_bucket": tally_bucket(F.col(c), F.col(f"min_{c}"), F.col(f"max_{c}")) for c in ("catch", "value")})
    named = placed.join(entity.select("fishing_entity_id", "name"), "fishing_entity_id")
    return named.select(F.col("fishing_entity_id").alias("id"), "name", F.col("catch").cast("decimal(30,2)").alias("catch"),
                        "catch_bucket", F.col("value").cast("decimal(30,2)").alias("value"), "value_bucket")


def entity_treemap(sums: DataFrame, entity: DataFrame) -> DataFrame:
    return document_lines(entity_totals(sums, entity), ["id"],
                          ["id", "name", "catch", "catch_bucket", "value", "value_bucket"],
                          '{"id":0,"name":"All Fishing Entities","children":[', "]}")


AFTER_ALL, STEP = "\uffff", "\u0001"
MOST_DOUBLINGS = 12  #: chains of up to 4096 taxa; a ring of parents, which no chain leaves, ends there


def taxon_walk(taxa: DataFrame, prefix: str) -> DataFrame:
    """Every taxon that a walk down from the roots meets, with root_order and path: one step for each taxon on the way.

    A taxon whose chain of parents has a gap is not met. Taxa that share a lineage are siblings, and what lies below the
    lineage is met below each of them. Each round doubles the chains: what hangs under a taxon is joined to the chains that this taxon
    hangs under itself, so the rounds, each one join of written tables, grow with the logarithm of the depth.
    """
    step = F.concat(F.element_at(F.split("lineage", r"\."), -1), F.lit(STEP), F.lpad(F.col("taxon_key").cast("string"), 20, "0"))
    is_root = (F.col("level") == 1) & has_key_prefix(F.col("taxon_key"), prefix)
    taxa = materialize(taxa.withColumns({"step": step, "_root": F.coalesce(is_root, F.lit(False))}), "taxa")
    below = taxa.filter("lineage <> parent")
    above = taxa.select(F.col("lineage").alias("_lineage"), F.col("taxon_key").alias("top"), F.col("step").alias("_step"))
    no_top = F.lit(None).cast(taxa.schema["taxon_key"].dataType)
    roots = taxa.filter("_root").select("taxon_key", F.col("common_name").alias("root_order"), no_top.alias("top"), F.array("step").alias("path"))
    # a chain is whole once it begins at a root; until then top is the taxon that it hangs under
    chains = below.join(above, F.col("parent") == F.col("_lineage")).select("taxon_key", F.lit(None).cast("string").alias("root_order"), "top", F.array("step").alias("path"))
    chains = materialize(roots.unionByName(chains), "chains")
    for _ in range(MOST_DOUBLINGS):
        if chains.filter("top IS NOT NULL").isEmpty():
            break
        upper = chains.select(F.col("taxon_key").alias("_key"), F.col("root_order").alias("_order"), F.col("top").alias("_top"), F.col("path").alias("_path"))
        longer = chains.filter("top IS NOT NULL").join(upper, F.col("top") == F.col("_key")).select(
            "taxon_key", F.col("_order").alias("root_order"), F.col("_top").alias("top"), F.concat("_path", "path").alias("path"))
        chains = materialize(chains.filter("top IS NULL").unionByName(longer), "chains")
    whole = chains.filter("top IS NULL")
    return taxa.drop("step", "_root").join(whole.drop("top"), "taxon_key")


def taxon_tree(taxa: DataFrame, prefix: str, root_name: str) -> DataFrame:
    """The taxon tree as text pieces (root_order, path, text); read in that order they are one nested JSON document.

    A node opens in one piece and, if it has children, closes in another that sorts behind all its descendants. The
    nesting comes out of the sort, so no node is gathered with its descendants.
    """
    node = F.struct(F.col("taxon_key").alias("key"), F.col("common_name").alias("name"), "level", "lineage", "parent",
                    F.col("is_distribution_available").alias("is_dist"), F.col("is_extent_available").alias("is_extent"),
                    money_text(F.col("total_catch")).alias("total_catch"), money_text(F.col("total_value")).alias("total_value"))
    json = F.to_json(node, JSON_OPTIONS)
    nodes = taxon_walk(taxa, prefix).select(
        "root_order", "path", F.substring(json, F.lit(1), F.length(json) - 1).alias("body"),
        F.slice("path", F.lit(1), F.size("path") - 1).alias("above"))

    # Order among children is (root name at the top level, own path below); the first one carries no comma.
    place = F.struct("root_order", "path")
    families = nodes.groupBy("above").agg(F.min(place).alias("first"))
    parents = families.select(F.col("above").alias("path"), F.lit(True).alias("is_parent"))
    nodes = nodes.join(families, "above").join(parents, "path", "left")
    comma = F.when(place == F.col("first"), F.lit("")).otherwise(F.lit(","))
    opened = F.concat(comma, "body", F.when(F.col("is_parent"), F.lit(',"children":[')).otherwise(F.lit("}")))
    closed = F.struct(F.concat("path", F.array(F.lit(AFTER_ALL))).alias("path"), F.lit("]}").alias("text"))
    pieces = F.when(F.col("is_parent"), F.array(F.struct("path", opened.alias("text")), closed)).otherwise(
        F.array(F.struct("path", opened.alias("text"))))
    rows = nodes.select("root_order", F.inline(pieces))

    one = taxa.sparkSession.range(1)
    head = f'{{"name":"{root_name}","key":"N/A","lineage":"root","children":['
    ends = [one.select(F.lit(o).alias("root_order"), F.array(F.lit(o)).alias("path"), F.lit(t).alias("text"))
            for o, t in (("", head), (AFTER_ALL, "]}"))]
    return rows.unionByName(ends[0]).unionByName(ends[1])
