"""Layouts by key, ranges, Bloom filters, covers, versions, ordered reading and planned pulls."""

import json
import random
import re
import warnings

import pytest
from pyspark.sql import functions as F

from catchlake.checks.facts import bucketed_cells, bucketed_fact, laid_out, layer_fact
from catchlake.checks.movement import MANIFEST_ROWS
from catchlake.operators import blooms, grid, sizing
from catchlake.operators.partitions import place_among, ranged, running_total, with_partition_id
from catchlake.plans import documents
from catchlake.plans.summaries import summarize_eez
from catchlake.session import shared_path
from catchlake.sources import layout, readers, versions, writers


def tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|round|Single)", tree(df), re.IGNORECASE))


def test_bucketed_join_has_no_exchange(spark, tables):
    by_id, root = layout.Layout("universal_data_id", 4), shared_path(spark, "laid-out")
    result = layout.lay_out(tables.allocation_result, f"{root}/result", by_id)
    side = layout.lay_out_side(tables.allocation_data, f"{root}/data", by_id)
    even, data = layout.pairs_of(result, side)[0]
    summed = summarize_eez(even, F.broadcast(tables.allocation_simple_area))
    assert exchanges(summed) == 0 and exchanges(summed.join(data, "universal_data_id")) == 0
    assert exchanges(summarize_eez(tables.allocation_result, F.broadcast(tables.allocation_simple_area)).join(tables.allocation_data.hint("merge"), "universal_data_id")) >= 2
    assert "SortMergeJoin" in tree(summed.join(data, "universal_data_id"))


def test_both_layouts_give_one_fact(tables):
    plain, laid = (sorted(map(repr, df.collect())) for df in (layer_fact(tables, "eez"), bucketed_fact(tables)))
    assert plain == laid
    assert bucketed_cells(tables).count() > 0


def test_hot_keys_have_a_part_of_their_own(spark):
    rows = spark.range(1200).select(F.when(F.col("id") < 500, 7).when(F.col("id") < 510, None).otherwise(F.col("id")).alias("k"), "id")
    by_k, root = layout.Layout("k", 8), shared_path(spark, "laid-out")
    laid = layout.lay_out(rows, root, by_k)
    assert [r["k"] for r in laid.hot_keys.collect()] == [7] and laid.hot.count() == 500 and laid.even.count() == 700
    side = layout.lay_out_side(spark.range(1200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), f"{root}-side", by_k)
    joined = [a.join(b, "k") for a, b in layout.pairs_of(laid, side)]
    assert sum(j.count() for j in joined) == 1190 and joined[1].select("v").distinct().count() == 1
    schema = "k bigint, id bigint"
    again = layout.attach(spark, root, schema, by_k, f"attached_{root[-8:]}")
    assert again.count() == 700 and exchanges(again.groupBy("k").count()) == 0


def test_place_among(spark):
    rng = random.Random(1)
    ends = sorted(rng.randrange(-50, 50) for _ in range(20))
    values = [*range(-60, 60), None]
    df = spark.createDataFrame([(v,) for v in values], "v int").withColumn("ends", F.array(*[F.lit(e) for e in ends]))
    for most in (20, 1 << 24):
        got = dict(df.select("v", place_among(F.col("v"), F.col("ends"), most)).collect())
        assert got == {v: sum(e <= v for e in ends) if v is not None else 0 for v in values}
    none = df.select(place_among(F.col("v"), F.array().cast("array<int>"))).distinct().collect()
    assert [r[0] for r in none] == [0]


def test_a_far_key_meets_one_range(spark):
    keys = [*range(1000), 9 * 10**15, None, -5]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    ranges = spark.createDataFrame([(3, 9 * 10**15 - 1, 9 * 10**15), (1, 0, 9), (2, 20, 499)], "partition_id int, begin_universal_data_id long, end_universal_data_id long")
    found = with_partition_id(df, ranges, "k")
    assert "Join" not in tree(found)
    assert sorted(map(tuple, found.collect())) == sorted([(k, 1) for k in range(10)] + [(k, 2) for k in range(20, 500)] + [(9 * 10**15, 3)])
    assert with_partition_id(df, ranges.limit(0), "k").count() == 0


def test_ranges_come_from_a_sketch(spark):
    keys = spark.range(10_000).select((F.col("id") * F.col("id")).alias("k"), F.lit(1).alias("n"))
    cut = ranged(keys, "k", 16)
    assert exchanges(cut) == 0 and "Sort" not in tree(cut)
    sizes = [r["count"] for r in cut.groupBy("_stretch").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * 10_000 / 16
    assert running_total(keys, "k", "n", "t").filter("t <> sqrt(k) + 1").count() == 0
    assert ranged(keys.limit(0), "k", 16).count() == 0 and ranged(keys, "k", 1).select("_stretch").distinct().count() == 1


def test_bloom_filter_lets_few_others_pass(spark):
    ids = spark.range(5000).select((F.col("id") * 7).alias("k"))
    rows = spark.range(350_000).withColumnRenamed("id", "k")
    kept = blooms.thinned(rows, "k", ids)
    assert kept.join(ids, "k", "left_semi").count() == 5000 * 7 * 10 // 70  # none is lost
    assert kept.filter("k < 35000").count() <= 1.2 * 5000 and kept.count() <= 5000 + 0.02 * 350_000
    assert blooms.thinned(rows, "k", ids.limit(0)).count() == 0
    assert blooms.bits_for(10**12) == blooms.MOST_BITS and blooms.bits_for(0) == 1024


def test_covers_are_small_at_every_size(spark):
    boxes = [(1, -180.0, -90.0, 180.0, 90.0), (2, 0.0, 0.0, 1e-9, 1e-9), (3, 5.0, 5.0, 5.0, 5.0), (4, -1e6, -3.0, 1e6, 3.0), (5, 0.5, 0.5, 0.75, 30.0), (6, None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(boxes, "id int, xmin double, ymin double, xmax double, ymax double")
    counts = dict(grid.cover(df).groupBy("id").count().collect())
    assert set(counts) == {1, 2, 3, 4, 5} and max(counts.values()) <= 300


def test_purge_against_all_pairs(spark):
    rng = random.Random(2)
    boxes = []
    for i in range(400):
        x, y, w = rng.uniform(-100, 100), rng.uniform(-100, 100), 2.0 ** rng.uniform(-12, 7)
        boxes.append((i % 3, i, x, y, x + w, y + w * rng.choice((0.01, 1, 3))))
        if i % 5 == 0:
            boxes.append((i % 3, 1000 + i, *boxes[-1][2:]))
    df = spark.createDataFrame(boxes, "k int, gid int, xmin double, ymin double, xmax double, ymax double").repartition(3)
    unique = {b[:1] + b[2:]: b[1] for b in sorted(boxes, key=lambda b: -b[1])}
    inside = lambda a, b: a[0] == b[0] and a != b and b[1] <= a[1] and b[2] <= a[2] and b[3] >= a[3] and b[4] >= a[4]
    expected = sorted(g for a, g in unique.items() if not any(inside(a, b) for b in unique))
    assert sorted(r["gid"] for r in grid.purge_contained(df, "k", "gid").collect()) == expected and len(expected) < len(unique)


def test_a_broken_refresh_leaves_the_old_content(spark, monkeypatch):
    path = shared_path(spark, "versions")
    rows = lambda *pairs: spark.createDataFrame(pairs, "year int, v int")
    content = lambda: sorted(map(tuple, readers.read_current(spark, path).collect()))
    writers.write_partitioned(rows((1, 10), (2, 20), (3, 30)), path, "year")
    broken = rows((2, 21)).withColumn("v", F.when(F.col("v") > 0, F.raise_error(F.lit("stop")).cast("int")))
    with pytest.raises(Exception, match="stop"):
        writers.write_partitioned(broken, path, "year", [1, 2])
    assert content() == [(1, 10), (2, 20), (3, 30)]
    with monkeypatch.context() as m:
        def no_switch(*_):
            raise OSError("no switch")
        m.setattr(versions.Folder, "replace_text", no_switch)
        with pytest.raises(OSError, match="no switch"):
            writers.write_partitioned(rows((2, 21)), path, "year", [1, 2])
    assert content() == [(1, 10), (2, 20), (3, 30)]
    reader = readers.read_current(spark, path)  # goes on with what it has found
    writers.write_partitioned(rows((2, 21)), path, "year", [1, 2])
    assert content() == [(2, 21), (3, 30)] and reader.count() == 3
    writers.write_partitioned(rows(), path, "year", [2, 3])
    assert content() == [] and readers.read_current(spark, path).columns == ["year", "v"]
    with pytest.raises(ValueError, match="partitioned by year"):
        writers.write_partitioned(rows((1, 1)), path, "v")


def test_whole_tables_are_replaced_in_one_step(spark):
    path = shared_path(spark, "versions")
    for i in range(4):
        writers.full_refresh(spark.range(i), path)
        assert readers.read_current(spark, path).count() == i
    assert len(versions.Folder(spark, path).names("versions")) == 2  # this content and the one before
    with pytest.raises(FileNotFoundError):
        readers.read_current(spark, f"{path}-none")


def test_reading_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select(F.concat(F.lit("line "), (F.lit(5000) - F.col("id")).cast("string")).alias("value"), (F.lit(5000) - F.col("id")).alias("n"))
    texts, table = shared_path(spark, "lines"), shared_path(spark, "table")
    df.orderBy("n").select("value").write.text(texts)
    df.orderBy("n").write.parquet(table)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several stretches a file
        lines = readers.read_in_order(spark, texts, "place", "text", lineSep="\n")
        assert lines.filter("value <> concat('line ', place)").count() == 0 and lines.count() == 5000
        rows = readers.read_in_order(spark, table)
        assert rows.filter("n <> position").count() == 0 and rows.count() == 5000
        assert not re.search(r"Window.*windowspecdefinition\((?!_stretch)", tree(rows))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


class Database(readers.JdbcReader):
    """Answers what the reader asks for from a list, and notes the options of each read."""

    def load(self, spark, options):
        asked.append(options)
        if options["dbtable"].endswith(" ends"):
            return spark.createDataFrame([(None, None) if "empty" in options["dbtable"] else (1, 600)], "low long, high long")
        if options["dbtable"].endswith(" counts"):
            return spark.range(1, 601).select(F.col("id").alias("l_orderkey"), F.lit(3).alias("record_count"))
        return spark.range(1)

    def read_ranges(self, spark, source, ranges):
        asked.append({"predicates": readers.predicates(ranges, source.key)})
        return spark.range(1)


asked: list[dict] = []


def test_pulls_are_planned_by_the_data(spark):
    extra = [(6, "Catch", "empty_table", "k", None, None, "master", "nothing", None, 4), (7, "Catch", "given", "k", None, None, "master", "given", None, 4),
             (8, "Catch", "no_key", "k", "a, b", None, "master", "no_key", None, 4)]
    manifest = spark.createDataFrame(MANIFEST_ROWS + extra, readers.MANIFEST_SCHEMA)
    database, root = Database("postgres", "host", 5432, "db", bounds={"given": (5, 9)}), shared_path(spark, "pulled")
    asked.clear()
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        paths = readers.pull_all(spark, manifest, database, root)
    assert len(paths) == 8 and all(readers.read_current(spark, p).count() == 1 for p in paths)
    assert [str(w.message) for w in said if "no_key" in str(w.message)] == ["no_key is read by one task: its key k is not among the columns selected"]
    reads = [a for a in asked if "predicates" in a or not a["dbtable"].endswith((" ends", " counts"))]
    assert [a.get("numPartitions") for a in reads] == ["2", "8", None, None, None, None, "4", None]
    assert [a.get("lowerBound") for a in reads] == ["1", "1", None, None, None, None, "5", None]
    ranges = reads[3]["predicates"]
    assert len(ranges) == 150 and ranges[0] == "l_orderkey between 1 and 4" and ranges[-1].endswith(" and 600")


def test_arrays_count_for_broadcasts(spark):
    rows = spark.range(100).select("id", F.array_repeat(F.col("id"), 1000).alias("many"))
    nested = spark.range(100).select("id", F.array_repeat(F.struct(F.lit("x" * 50).alias("a.b"), F.map_from_arrays(F.array(F.lit(1)), F.array(F.lit("y" * 40)))), 100).alias("deep"))
    size = lambda df: sizing._row_sizes("x", df).agg(F.sum("bytes")).first()[0]
    assert 800_000 <= size(rows) <= 900_000 and size(nested) >= 100 * 100 * 90
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    few = spark.range(10)
    both = sizing.measured(500_000, rows=rows, few=few)
    assert not hinted(both["rows"]) and hinted(both["few"])
    together = sizing.measured(900_000, rows=rows, same=rows.select("*"), few=few)  # the bound is for all that are hinted
    assert [hinted(together[n]) for n in ("few", "rows", "same")] == [True, True, False]
    empty = spark.range(3).select(F.lit(None).cast("array<string>").alias("a"), F.lit(None).cast("map<int,string>").alias("m"))
    assert size(empty) == 3 * 80


def test_the_walk_doubles_its_chains(spark):
    """A chain of 40 taxa takes seven written steps and not forty, and a ring of parents ends."""
    name = lambda i: ".".join(f"n{j}" for j in range(i + 1))
    rows = [(1900 + i if i == 0 else 5000 + i, f"t{i}", min(i + 1, 2), name(i), name(i - 1) if i else None) for i in range(40)]
    rows += [(1, "ring", 2, "r.a", "r.b"), (2, "ring", 2, "r.b", "r.a")]
    taxa = spark.createDataFrame(rows, "taxon_key long, common_name string, level int, lineage string, parent string")
    found = documents.taxon_walk(taxa, "19")
    assert sorted(len(r["path"]) for r in found.select("path").collect()) == list(range(1, 41))
    assert tree(found).count("Join") <= 1


def test_versions_name_what_they_hold(spark):
    path = shared_path(spark, "versions")
    writers.write_partitioned(spark.createDataFrame([("a/b=c", 1), (None, 2)], "k string, v int"), path, "k")
    said = json.loads(spark.read.text(f"{path}/current.json", wholetext=True).first()[0])
    assert said["key"] == "k" and len(said["parts"]) == 2
    assert sorted(map(tuple, readers.read_current(spark, path).collect()), key=str) == sorted([("a/b=c", 1), (None, 2)], key=str)


def test_laid_out_pairs_cover_the_result(tables):
    assert sum(result.count() for result, _ in laid_out(tables)) == tables.allocation_result.count()


def test_layouts_grow_with_the_table(spark):
    buckets = [layout.layout_for(spark.range(n), "id", rows=10, least=2).buckets for n in (0, 15, 21, 500)]
    assert buckets == [2, 2, 3, 50]
