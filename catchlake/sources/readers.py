"""Sources: tables named by a manifest, read over JDBC or from files, and delimited text."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.constants import RESULT_PARTITIONS
from catchlake.operators.partitions import partition_map, with_partition_id
from catchlake.session import materialize
from catchlake.sources.versions import read_current  # noqa: F401  (readers of refreshed tables look for it here)
from catchlake.sources.writers import CSV_OPTIONS, ESCAPES, NULL_TEXT, full_refresh

# JDBC address by kind of server.
JDBC_URLS = {
    "postgres": "jdbc:postgresql://{server}:{port}/{dbname}",
    "sqlserver": "jdbc:sqlserver://{server}:{port};databaseName={dbname}",
}

#: What the parser puts for a value that is not there; no text is this.
NO_TEXT = "\u0000NULL\u0000"

CLAUSE = re.compile(r"(where|group\s+by|having|order\s+by|limit|join|inner|left|right|full|cross|union)\b", re.IGNORECASE)

MANIFEST_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("source_database_name", T.StringType()),
    T.StructField("source_table_name", T.StringType()),
    T.StructField("source_key_column", T.StringType()),
    T.StructField("source_select_clause", T.StringType()),
    T.StructField("source_where_clause", T.StringType()),
    T.StructField("target_schema_name", T.StringType()),
    T.StructField("target_table_name", T.StringType()),
    T.StructField("target_excluded_columns", T.ArrayType(T.StringType())),
    T.StructField("number_of_threads", T.IntegerType()),
])


@dataclass(frozen=True)
class SourceTable:
    """What to read of one table. `clause` is what follows the table in a query; a bare condition is given its WHERE."""

    table: str
    select: str = "*"
    clause: str = ""
    excluded: tuple[str, ...] = ()
    key: str | None = None
    threads: int = 8

    @classmethod
    def from_manifest(cls, row) -> "SourceTable":
        clause = (row["source_where_clause"] or "").strip()
        if clause and not CLAUSE.match(clause):
            clause = f"where {clause}"
        return cls(row["source_table_name"], row["source_select_clause"] or "*", clause,
                   tuple(row["target_excluded_columns"] or ()), row["source_key_column"], row["number_of_threads"] or 8)

    def selects(self, column: str) -> bool:
        """Whether a column is among those selected, as far as the clause's words say."""
        return self.select.strip() == "*" or re.search(rf"(?<![\w.])(\w+\.)?{re.escape(column)}(?!\w)", self.select, re.IGNORECASE) is not None

    @property
    def query(self) -> str:
        return f"select {self.select} from {self.table} {self.clause}".rstrip()


@dataclass(frozen=True)
class JdbcReader:
    """Reads through Spark's JDBC source, split by the source's key: into equal ranges between bounds, or by a partition map.

    How a source is read follows from its description and the data: without a key or with one thread in one piece; with a key between
    bounds, those given or else those that the database is asked for; with as many threads as a result has partitions by ranges of about equal
    numbers of rows, which the database counts. A key that the source's select clause leaves out can't split it, which is said in
    a warning.
    """

    kind: str
    server: str
    port: int
    dbname: str
    properties: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def url(self) -> str:
        return JDBC_URLS[self.kind].format(server=self.server, port=self.port, dbname=self.dbname)

    def whole_options(self, source: SourceTable) -> dict[str, str]:
        return dict(self.properties, url=self.url, dbtable=f"({source.query}) source")

    def options(self, source: SourceTable, bounds: tuple[int, int] | None = None) -> dict[str, str]:
        """What reads a source in as many pieces as it has threads, between the bounds given here or to the reader; in one piece if it has no
        key or one thread."""
        options = self.whole_options(source)
        if source.key and source.threads > 1:
            bounds = bounds or self.bounds.get(source.table)
            if not bounds:
                raise ValueError(f"{source.table} has the key {source.key} but no bounds; see key_bounds")
            options |= {"partitionColumn": source.key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(source.threads)}
        return options

    def split(self, source: SourceTable) -> str:
        """How a source is read: "whole", between "bounds" of its key, or by counted "ranges" of it."""
        if not source.key or source.threads < 2:
            return "whole"
        if not source.selects(source.key):
            warnings.warn(f"{source.table} is read by one task: its key {source.key} is not among the columns selected", stacklevel=2)
            return "whole"
        return "ranges" if source.threads >= RESULT_PARTITIONS else "bounds"

    def read(self, spark: SparkSession, source: SourceTable) -> DataFrame:
        how = self.split(source)
        bounds = None if how == "whole" else self.bounds.get(source.table) or self.key_bounds(spark, source)
        if not bounds:  # no way to split it, or nothing to split
            return self.load(spark, self.whole_options(source))
        if how == "ranges":
            return self.read_ranges(spark, source, partition_map(self.key_counts(spark, source, bounds), source.key, source.threads))
        return self.load(spark, self.options(source, bounds))

    def load(self, spark: SparkSession, options: dict[str, str]) -> DataFrame:
        return spark.read.format("jdbc").options(**options).load()

    def bounds_options(self, source: SourceTable) -> dict[str, str]:
        """What asks the database for the least and the largest key of a source, in one row."""
        ends = f"(select min({source.key}) as low, max({source.key}) as high from ({source.query}) source) ends"
        return dict(self.properties, url=self.url, dbtable=ends)

    def key_bounds(self, spark: SparkSession, source: SourceTable) -> tuple[int, int] | None:
        """The least and the largest key, or None where there is none."""
        row = self.load(spark, self.bounds_options(source)).first()
        return None if row["low"] is None else (row["low"], row["high"])

    def counts_options(self, source: SourceTable, bounds: tuple[int, int]) -> dict[str, str]:
        """What asks the database for the number of rows of each key, in as many pieces as the source has threads."""
        counts = f"(select {source.key}, count(*) as record_count from ({source.query}) source group by {source.key}) counts"
        return self.options(source, bounds) | {"dbtable": counts}

    def key_counts(self, spark: SparkSession, source: SourceTable, bounds: tuple[int, int]) -> DataFrame:
        """The counted keys, written, since the map reads them several times."""
        counts = self.load(spark, self.counts_options(source, bounds))
        return materialize(counts.filter(F.col(source.key).isNotNull()).withColumn("record_count", F.col("record_count").cast("bigint")), "key-counts")

    def read_ranges(self, spark: SparkSession, source: SourceTable, ranges: DataFrame) -> DataFrame:
        """One task for each range of a partition map, of about equal numbers of rows, and one for rows without a key."""
        return spark.read.jdbc(self.url, f"({source.query}) source", predicates=[*predicates(ranges, source.key), f"{source.key} is null"],
                               properties=dict(self.properties))

    def write_options(self, table: str) -> dict[str, str]:
        return dict(self.properties, url=self.url, dbtable=table)

    def write(self, df: DataFrame, table: str) -> None:
        """Append to a table of the database."""
        df.write.format("jdbc").options(**self.write_options(table)).mode("append").save()


def predicates(ranges: DataFrame, key: str) -> list[str]:
    """A condition for each range of a partition map, which has as many rows as the read has tasks."""
    rows = ranges.orderBy("partition_id").collect()
    return [f"{key} between {r['begin_universal_data_id']} and {r['end_universal_data_id']}" for r in rows]


@dataclass(frozen=True)
class ParquetReader:
    """Reads the same descriptions from a folder of Parquet tables; filter and columns reach the scan."""

    root: str

    def read(self, spark: SparkSession, source: SourceTable) -> DataFrame:
        df = spark.read.parquet(f"{self.root}/{source.table}.parquet")
        return spark.sql(f"select {source.select} from {{source}} {source.clause}", source=df)


def read_source(spark: SparkSession, source: SourceTable, reader) -> DataFrame:
    return reader.read(spark, source).drop(*source.excluded)


def pull_all(spark: SparkSession, manifest: DataFrame, reader, root: str) -> list[str]:
    """Read every row of a manifest in id order, leave out its excluded columns and replace the target table by it.

    Gives the tables' paths in that order. A manifest has a row for each table, so it is small.
    """
    paths = []
    for row in manifest.orderBy("id").collect():
        source = SourceTable.from_manifest(row)
        paths.append(f"{root}/{row['target_schema_name']}/{row['target_table_name']}")
        full_refresh(reader.read(spark, source), paths[-1], source.excluded)
    return paths


def manifest_for(manifest: DataFrame, schema: str | None = None, database: str | None = None) -> DataFrame:
    """Manifest rows of a target schema, or of a source database whatever its case, in id order."""
    if schema is not None:
        manifest = manifest.filter(F.col("target_schema_name") == schema)
    if database is not None:
        manifest = manifest.filter(F.lower("source_database_name") == database.lower())
    return manifest.orderBy("id")


def pull_by_partition(result: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with catch whose id lies in a range of the map, marked with the range; write them by partition_id."""
    caught = result.filter(F.col("allocated_catch") > 0)
    return with_partition_id(caught, ranges, "universal_data_id")


def unescaped(column: Column) -> Column:
    """A value of COPY text. Doubled backslashes are cut out first, so that what follows one is never taken for an escape."""
    def plain(part: Column) -> Column:
        for char, mark in ESCAPES[1:]:
            part = F.replace(part, F.lit(mark), F.lit(char))
        return part

    whole = F.array_join(F.transform(F.split(column, r"\\\\"), plain), "\\")
    return F.when(column != NULL_TEXT, whole)


def read_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The text format of COPY (see writers.write_text), typed by an explicit schema."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.split("value", "\t").alias("_values"))
    return lines.select(*[unescaped(F.get("_values", F.lit(i))).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header as the writers make it: line ends may stand inside quotes, and an empty text is quoted, unlike NULL."""
    return spark.read.schema(schema).options(header=True, multiLine=True, nullValue=NO_TEXT, **CSV_OPTIONS).csv(path)


def read_in_order(spark: SparkSession, path: str, name: str = "position", file_format: str = "parquet", **options: str) -> DataFrame:
    """The rows of a folder of part files with their position, from 1, as the files read one after the other have them.

    A large file is read in several stretches. Rows are counted by file and stretch, and each stretch begins where those before it
    end, so the only window is over a row for each of them; a row's place in its stretch comes from the order of reading.
    """
    lines = spark.read.format(file_format).options(**options).load(path)
    kept = lines.columns
    rows = lines.select("*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start")).alias("_stretch"),
                        F.monotonically_increasing_id().alias("_at"))
    sizes = rows.groupBy("_stretch").agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)  # a row for each stretch
    starts = sizes.select("_stretch", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = rows.join(F.broadcast(starts), "_stretch")
    return found.select(*kept, (F.col("_before") + F.col("_at") - F.col("_low") + 1).alias(name))


def list_files(spark: SparkSession, root: str, pattern: str = "*.shp") -> DataFrame:
    """Paths of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=pattern).load(root)
    return files.select("path")
