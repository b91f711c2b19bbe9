"""Sources and sinks."""

from catchlake.operators.partitions import key_distribution, partition_map
import pytest

from catchlake.plans import documents, quality
from catchlake.session import shared_dir, shared_path
from catchlake.sources import readers, writers


def test_jdbc_options():
    source = readers.SourceTable("allocation_result", select="*", clause="where AllocatedCatch > 0", key="id", threads=16)
    reader = readers.JdbcReader("postgres", "db.example.com", 5432, "catch", {"user": "u"}, {"allocation_result": (1, 900)})
    options = reader.options(source)
    assert options["url"] == "jdbc:postgresql://db.example.com:5432/catch"
    assert options["dbtable"] == "(select * from allocation_result where AllocatedCatch > 0) source"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "900", "16")
    plain = readers.JdbcReader("sqlserver", "db.example.com", 1433, "catch").options(readers.SourceTable("taxon"))
    assert plain == {"url": "jdbc:sqlserver://db.example.com:1433;databaseName=catch", "dbtable": "(select * from taxon) source"}


def test_manifest_choice_and_order(spark):
    from catchlake.checks.movement import MANIFEST_ROWS
    manifest = spark.createDataFrame(MANIFEST_ROWS, readers.MANIFEST_SCHEMA)
    assert [r["id"] for r in readers.manifest_for(manifest, database="catch").collect()] == [1, 2, 4, 5]
    assert [r["id"] for r in readers.manifest_for(manifest, schema="master").collect()] == [1, 3, 5]


def test_clauses_stay_as_they_are():
    def clause(text):
        return readers.SourceTable.from_manifest({
            "source_table_name": "t", "source_select_clause": None, "source_where_clause": text, "target_excluded_columns": None,
            "source_key_column": None, "number_of_threads": None}).query
    assert clause("GROUP BY UniversalDataID") == "select * from t GROUP BY UniversalDataID"
    assert clause("where a = 1 group by b") == "select * from t where a = 1 group by b"
    assert clause("a = 1 and wherever = 2") == "select * from t where a = 1 and wherever = 2"
    assert clause(" ") == clause(None) == "select * from t"


def test_keyed_tables_are_never_read_by_one_task(spark):
    source = readers.SourceTable("allocation_result", key="id", threads=150)
    reader = readers.JdbcReader("postgres", "db.example.com", 5432, "catch", {"user": "u"})
    with pytest.raises(ValueError, match="no bounds"):
        reader.options(source)
    ends = reader.bounds_options(source)["dbtable"]
    assert ends == "(select min(id) as low, max(id) as high from (select * from allocation_result) source) ends"
    ranges = spark.createDataFrame([(2, 8, 20, 3), (1, 1, 7, 4)], "partition_id int, begin_universal_data_id long, end_universal_data_id long, record_count long")
    assert readers.predicates(ranges, "id") == ["id between 1 and 7", "id between 8 and 20"]
    assert reader.write_options("log.errors") == {"user": "u", "url": "jdbc:postgresql://db.example.com:5432/catch", "dbtable": "log.errors"}


def test_listed_partitions_are_emptied(spark):
    path = shared_path(spark, "refresh-test")
    schema = "rule_id int, id int"
    quality.write_rule_results(spark.createDataFrame([(1, 10), (2, 20), (3, 30)], schema), path, [1, 2, 3])
    quality.write_rule_results(spark.createDataFrame([(1, 11)], schema), path, [1, 2])
    assert {(r["rule_id"], r["id"]) for r in readers.read_current(spark, path).collect()} == {(1, 11), (3, 30)}
    quality.write_rule_results(spark.createDataFrame([], schema), path, [1, 3])
    assert readers.read_current(spark, path).count() == 0


HARD = ["", "\\N", "\\", "\\\\n", "\\n", "a\tb", " x ", "\r\n", "\n", '"', '","', "\u0000", "é", "\\t\t\\", None]


def test_texts_come_back_as_they_were(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), "id int, name string")
    path = shared_path(spark, "text-test")
    writers.write_text(df, path)
    assert dict(readers.read_text(spark, path, df.schema).collect()) == dict(enumerate(HARD))
    path = shared_path(spark, "csv-test")
    writers.write_csv_per_entity(df.selectExpr("1 AS entity", "*"), "entity", path)
    assert {r["id"]: r["name"] for r in readers.read_csv(spark, path, df.schema).collect()} == dict(enumerate(HARD))


def test_text_keeps_nulls_and_letters(spark):
    df = spark.createDataFrame([(1, "Ærø"), (2, None), (3, "a b")], "id int, name string")
    path = shared_path(spark, "text-test")
    writers.write_text(df, path)
    assert sorted(map(tuple, readers.read_text(spark, path, df.schema).collect())) == [(1, "Ærø"), (2, None), (3, "a b")]


def test_only_written_partitions_are_replaced(spark):
    path = shared_path(spark, "partition-test")
    writers.write_fact(spark.createDataFrame([(1, 10), (2, 20)], "marine_layer_id int, v int"), path)
    writers.write_fact(spark.createDataFrame([(2, 21)], "marine_layer_id int, v int"), path)
    assert {(r["marine_layer_id"], r["v"]) for r in readers.read_current(spark, path).collect()} == {(1, 10), (2, 21)}


def test_year_copy_drops_old_years(spark, tables):
    path = shared_path(spark, "year-test")
    writers.write_by_year(tables.allocation_data, path)
    writers.write_by_year(tables.allocation_data.filter("year = 1997"), path)
    assert [r["year"] for r in spark.read.parquet(path).select("year").distinct().collect()] == [1997]


def test_pull_by_partition_takes_each_row_once(tables):
    ranges = partition_map(key_distribution(tables.allocation_result, "universal_data_id"), "universal_data_id", 7)
    pulled = readers.pull_by_partition(tables.allocation_result, ranges)
    assert pulled.count() == tables.allocation_result.filter("allocated_catch > 0").count()
    assert pulled.select("partition_id").distinct().count() == 7


def test_empty_entities_have_no_folder(spark):
    path = shared_path(spark, "csv-test")
    writers.write_csv_per_entity(spark.createDataFrame([(1, "x"), (3, "y")], "entity_id int, v string"), "entity_id", path)
    found = spark.read.option("header", True).csv(path)
    assert sorted(r["entity_id"] for r in found.collect()) == [1, 3]


def test_csv_cache_leaves_out_the_excluded_entity(spark):
    fact = spark.createDataFrame([(4, 1, 7, "a,b"), (4, 9, 8, "x"), (3, 1, 9, "y")],
                                 "marine_layer_id int, main_area_id int, taxon_key int, name string")
    path = shared_path(spark, "csv-cache-test")
    documents.write_csv_cache(fact, ["taxon_key", "name"], path)
    assert [tuple(r) for r in spark.read.option("header", True).csv(path).collect()] == [("7", "a,b", 1)]
    assert [tuple(r) for r in documents.csv_cache(fact, ["taxon_key", "name"]).collect()] == [(4, 1, '7,"a,b"')]


def test_extent_files_are_listed_with_their_folder(spark, tmp_path):
    (tmp_path / "Gadus_morhua").mkdir()
    (tmp_path / "Gadus_morhua" / "600069.shp").write_bytes(b"shape")
    (tmp_path / "Gadus_morhua" / "notes.txt").write_bytes(b"text")
    assert [r["path"].rsplit("/", 2)[1:] for r in readers.list_files(spark, str(tmp_path)).collect()] == [["Gadus_morhua", "600069.shp"]]


def test_shared_folder_comes_from_the_session(spark):
    class Session:
        class sparkContext:  # noqa: N801
            master = "local-cluster[3,2,1024]"

        conf = {"spark.checkpoint.dir": "hdfs://host/shared/"}

    assert shared_dir(Session) == "hdfs://host/shared/"
    Session.conf = {}
    with pytest.raises(ValueError, match="every executor"):
        shared_dir(Session)
