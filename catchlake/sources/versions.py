"""Tables that are replaced as a whole or by partition in one step, so that a reader sees the old content or the new one and nothing between.

Below the table's folder every refresh writes a version of its own, and `current.json` says which version the table, or each of its
partitions, is to be read from. It is replaced by a rename once the version is complete; a refresh that breaks off leaves a version
that nothing points at, which the next refresh deletes. Versions of the content before the last stay for those who still read them. One
refresh of a table runs at a time. On a store whose rename isn't atomic, neither is the switch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "current.json"


@dataclass(frozen=True)
class Current:
    """Where a table's content is: the schema, the partition column, and the version of each partition's folder ("" for a whole table)."""

    schema: T.StructType
    key: str | None = None
    parts: dict[str, str] = field(default_factory=dict)


class Folder:
    """The files of a folder, by Hadoop's own interface, so that any store that Spark writes to will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def names(self, *below: str) -> list[str]:
        place = self.path(*below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place) if s.isDirectory()) if self.fs.exists(place) else []

    def replace_text(self, name: str, text: str) -> None:
        """Write a small file aside and rename it over the old one."""
        aside, hadoop = self.path(f".{name}-{uuid.uuid4().hex}"), self.spark._jvm.org.apache.hadoop.fs
        out = self.fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        rename = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        hadoop.FileContext.getFileContext(self.path().toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, self.path(name), options)


def current(spark: SparkSession, root: str) -> Current | None:
    """What the pointer of a table says, or None where there is no table yet."""
    folder = Folder(spark, root)
    if not folder.fs.exists(folder.path(POINTER)):
        return None
    said = json.loads(spark.read.text(f"{folder.root}/{POINTER}", wholetext=True).first()[0])
    return Current(T.StructType.fromJson(said["schema"]), said["key"], said["parts"])


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The table as it is now. Later refreshes don't change what the frame reads, up to the second one."""
    now = current(spark, root)
    if now is None:
        raise FileNotFoundError(f"{root} holds no {POINTER}")
    names = [f.name for f in now.schema]
    folders: dict[str, list[str]] = {}
    for part, version in now.parts.items():
        folders.setdefault(version, []).append(part)
    read = spark.read.schema(now.schema)
    frames = [read.option("basePath", f"{root}/versions/{v}").parquet(*[f"{root}/versions/{v}/{p}".rstrip("/") for p in parts]) for v, parts in folders.items()]
    if not frames:
        return spark.createDataFrame([], now.schema)
    return reduce(DataFrame.unionByName, frames).select(*names)


def _switch(folder: Folder, old: Current | None, new: Current) -> None:
    said = {"schema": json.loads(new.schema.json()), "key": new.key, "parts": new.parts}
    folder.replace_text(POINTER, json.dumps(said))
    wanted = set(new.parts.values()) | (set(old.parts.values()) if old else set())
    for version in folder.names("versions"):
        if version not in wanted:
            folder.fs.delete(folder.path("versions", version), True)


def replace_table(df: DataFrame, root: str) -> None:
    """The frame becomes the table's whole content."""
    folder, version = Folder(df.sparkSession, root), uuid.uuid4().hex
    old = current(df.sparkSession, root)
    df.write.parquet(f"{folder.root}/versions/{version}")
    _switch(folder, old, Current(df.schema, None, {"": version}))


def replace_partitions(df: DataFrame, root: str, key: str, refreshed: Iterable[int | str] = ()) -> None:
    """The frame becomes the content of the partitions that it has rows of, and of those listed, which may have none. Others stay."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder, old = Folder(spark, root), current(spark, root)
    if old and old.key != key:
        raise ValueError(f"{root} is partitioned by {old.key}, not by {key}")
    df.write.partitionBy(key).parquet(f"{folder.root}/versions/{version}")
    emptied = {f"{key}={value}" for value in refreshed}
    parts = {part: v for part, v in old.parts.items() if part not in emptied} if old else {}
    parts |= {part: version for part in folder.names("versions", version) if part.startswith(f"{key}=")}
    _switch(folder, old, Current(df.schema, key, parts))
