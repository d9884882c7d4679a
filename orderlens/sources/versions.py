"""Tables in versions: what readers see is named by one small file, replaced in one step.

A table is a folder. Its rows lie in leaf folders ``<partition columns>/version_=<id>``; the file ``_current``
lists the leaf folders that make up the table now, those it replaced, and the schema. A write adds leaf folders
that nobody sees yet and then swaps the file, so a reader finds one whole version at any time: the old one
if the write stops anywhere, the new one afterwards. An update writes the touched partitions anew and lists
the files of all others as they are. Folders of the version before stay for readers that have begun with it;
older ones are deleted after the swap. Half-written ones are deleted once they are older than ``grace`` hours.

The swap is a rename over the old file, atomic on HDFS and local disks. Two writers at once: the later
swap wins, and an update whose table has changed meanwhile stops with an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import shuffles_deleted

POINTER, VERSION = "_current", "version_"


class Changed(RuntimeError):
    """The table was replaced while an update of it was running."""


@dataclass(frozen=True)
class Version:
    """One version of a table: its leaf folders, relative to the table's, and those it replaced."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: tuple[str, ...]
    replaced: tuple[str, ...] = ()
    #: Name of the write that made it.
    made_by: str = ""

    def to_json(self) -> str:
        return json.dumps({
            "number": self.number, "schema": json.loads(self.schema.json()), "partition_by": self.partition_by,
            "folders": self.folders, "replaced": self.replaced, "made_by": self.made_by})

    @staticmethod
    def from_json(text: str) -> Version:
        raw = json.loads(text)
        return Version(raw["number"], T.StructType.fromJson(raw["schema"]), tuple(raw["partition_by"]),
                       tuple(raw["folders"]), tuple(raw["replaced"]), raw["made_by"])


class Folder:
    """The table's folder in the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.at("").getFileSystem(self._conf)

    def at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def current(self) -> Version | None:
        pointer = self.at(POINTER)
        if not self.files.exists(pointer):
            return None
        stream = self.files.open(pointer)
        try:
            return Version.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_pointer(self, version: Version) -> str:
        """The pointer's next text in a file of its own; readers do not look at it."""
        name = f"{POINTER}.{version.made_by}"
        stream = self.files.create(self.at(name), True)
        try:
            stream.write(bytearray(version.to_json().encode()))
        finally:
            stream.close()
        return name

    def swap(self, name: str) -> None:
        """The file ``name`` becomes the pointer, in one step."""
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at("").toUri(), self._conf)
        context.rename(context.makeQualified(self.at(name)), context.makeQualified(self.at(POINTER)), how)

    def leaves(self, depth: int, made_by: str = "*") -> dict[str, int]:
        """Leaf folders below ``depth`` partition columns, with the times of their last change."""
        pattern = self.at("*=*/" * depth + f"{VERSION}={made_by}")
        root = self.files.makeQualified(self.at("")).toString().rstrip("/") + "/"
        found = self.files.globStatus(pattern) or []
        return {f.getPath().toString().removeprefix(root): f.getModificationTime() for f in found if f.isDirectory()}

    def delete(self, names: Sequence[str]) -> None:
        for name in names:
            self.files.delete(self.at(name), True)


def open_table(spark: SparkSession, path: str, folders: Sequence[str] | None = None) -> DataFrame:
    """The current version of the table at ``path``, or only its leaf ``folders``; a plain Parquet folder as it is."""
    version = Folder(spark, path).current()
    if version is None:
        return spark.read.parquet(path)
    return _read(spark, path, version, folders)


def _read(spark: SparkSession, path: str, version: Version, folders: Sequence[str] | None = None) -> DataFrame:
    chosen = version.folders if folders is None else folders
    if not chosen:
        return spark.createDataFrame([], version.schema)
    stored = T.StructType([*version.schema.fields, T.StructField(VERSION, T.StringType())])
    paths = [f"{path.rstrip('/')}/{name}" for name in chosen]
    return spark.read.option("basePath", path).schema(stored).parquet(*paths).select(version.schema.names)


def _add(df: DataFrame, path: str, partition_by: Sequence[str], made_by: str, laid_out: bool = False) -> tuple[str, ...]:
    """Write rows into leaf folders of their own, which no version lists yet; ``laid_out`` rows are not shuffled for that."""
    if partition_by and not laid_out:
        df = df.hint("rebalance", *partition_by)
    with shuffles_deleted(df.sparkSession):
        df.withColumn(VERSION, F.lit(made_by)).write.mode("append").partitionBy(*partition_by, VERSION).parquet(path)
    return tuple(sorted(Folder(df.sparkSession, path).leaves(len(partition_by), made_by)))


def _put(folder: Folder, version: Version, before: Version | None, grace: float) -> None:
    """Make ``version`` the current one if the table still is at ``before``; then clean up."""
    name = folder.write_pointer(version)
    now = folder.current()
    if (now and now.made_by) != (before and before.made_by):
        folder.delete([name])
        raise Changed(f"{folder.path} was replaced meanwhile")
    folder.swap(name)
    folder.spark.catalog.refreshByPath(folder.path)
    clean_up(folder.spark, folder.path, grace, before)


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), grace: float = 24.0, laid_out: bool = False,
) -> DataFrame:
    """Create or replace the table at ``path`` and return it as read back; ``df`` may read the old one.

    With partition columns the rows are first rebalanced on them, so each folder gets a few well-sized files
    and a folder holding most of the rows is split over several writers. Rows that lie so already are ``laid_out``.
    """
    spark, made_by = df.sparkSession, uuid.uuid4().hex
    folder = Folder(spark, path)
    before = folder.current()
    folders = _add(df, path, partition_by, made_by, laid_out)
    version = Version(before.number + 1 if before else 1, df.schema, tuple(partition_by), folders,
                      before.folders if before else (), made_by)
    # A replacement does not depend on what it replaces, so the latest one counts.
    _put(folder, version, folder.current(), grace)
    return _read(spark, path, version)


def clean_up(spark: SparkSession, path: str, grace: float = 24.0, before: Version | None = None) -> list[str]:
    """Delete leaf folders that neither the current version nor the one it replaced lists; returns them.

    Those that ``before`` listed are deleted at once, any others, which may belong to a write under way, when
    they are ``grace`` hours old. The files of a plain Parquet folder that became a table go likewise.
    """
    folder = Folder(spark, path)
    now = folder.current()
    if now is None:
        return []
    kept = {*now.folders, *now.replaced}
    known = set(before.replaced) if before else set()
    youngest = folder.spark._jvm.java.lang.System.currentTimeMillis() - grace * 3_600_000
    ages = folder.leaves(len(now.partition_by)) | (folder.leaves(len(before.partition_by)) if before else {})
    gone = [n for n, age in ages.items() if n not in kept and (n in known or age < youngest)]
    for f in folder.files.listStatus(folder.at("")):
        name = f.getPath().getName()
        pending = name.startswith(f"{POINTER}.")
        if (pending or f.isFile() and not name.startswith("_")) and f.getModificationTime() < youngest:
            gone.append(name)
    folder.delete(gone)
    return gone


def replace_from_self(spark: SparkSession, path: str, transform) -> DataFrame:
    """Replace a table by a query over itself, written once, in the same partitions."""
    folder = Folder(spark, path)
    before = folder.current()
    if before is None:
        return publish(transform(spark.read.parquet(path)), path)
    made = transform(_read(spark, path, before))
    made_by = uuid.uuid4().hex
    folders = _add(made, path, before.partition_by, made_by)
    version = Version(before.number + 1, made.schema, before.partition_by, folders, before.folders, made_by)
    _put(folder, version, before, 24.0)
    return _read(spark, path, version)


def touched_folders(table: DataFrame, version: Version, condition: Column) -> list[str]:
    """Leaf folders with a row that meets ``condition``; one pass over the columns it reads, at most a row each."""
    place = F.regexp_extract(F.input_file_name(), r"/((?:[^/]+=[^/]*/)*" + VERSION + r"=[^/]+)/[^/]+$", 1)
    met = table.filter(condition).select(place.alias("folder")).distinct()
    listed = {_decoded(n): n for n in version.folders}
    return sorted({listed[_decoded(r["folder"])] for r in met.collect()})


def _decoded(name: str) -> str:
    from urllib.parse import unquote

    while (plain := unquote(name)) != name:
        name = plain
    return name


def update_where(spark: SparkSession, path: str, condition: Column, assignments: dict[str, Column]) -> list[str]:
    """UPDATE ... SET ... WHERE: rows that meet ``condition`` get new values, in the leaf folders that hold any.

    Partition columns stay as they are. Folders without such a row keep their files; a table without any is left as
    it is. Returns the folders written anew.
    """
    folder = Folder(spark, path)
    before = folder.current()
    if before is None:
        raise ValueError(f"{path} is no table in versions")
    if fixed := set(assignments) & set(before.partition_by):
        raise ValueError(f"partition columns {sorted(fixed)} are not updated")
    touched = touched_folders(_read(spark, path, before), before, condition)
    if not touched:
        return []
    rows = _read(spark, path, before, touched)
    # Several assignments all read the row as it was.
    changed = rows.withColumns({
        name: F.when(condition, value.cast(before.schema[name].dataType)).otherwise(F.col(name))
        for name, value in assignments.items()}).select(before.schema.names)
    made_by = uuid.uuid4().hex
    added = _add(changed, path, before.partition_by, made_by)
    kept = tuple(n for n in before.folders if n not in set(touched))
    version = replace(before, number=before.number + 1, folders=kept + added, replaced=tuple(touched), made_by=made_by)
    _put(folder, version, before, 24.0)
    return list(added)


def _is_in(folder: str, column: str, values: set[str]) -> bool:
    return any(_decoded(part) in {f"{column}={v}" for v in values} for part in folder.split("/"))


def replace_partitions(
    df: DataFrame, path: str, column: str, values: Sequence[str], laid_out: bool = False,
) -> DataFrame:
    """Replace the partitions whose ``column`` (a string) is one of ``values`` by the rows of ``df``, all of which lie there.

    Other partitions keep their files. A table that is not there yet is created.
    """
    spark, made_by = df.sparkSession, uuid.uuid4().hex
    folder = Folder(spark, path)
    before = folder.current()
    if before is None:
        return publish(df, path, [column], laid_out=laid_out)
    if before.schema != df.schema or column not in before.partition_by:
        raise ValueError(f"rows do not fit the table at {path}")
    added = _add(df, path, before.partition_by, made_by, laid_out)
    wanted = set(values)
    if strays := [n for n in added if not _is_in(n, column, wanted)]:
        raise ValueError(f"rows outside the replaced partitions: {strays[:3]}")
    gone = tuple(n for n in before.folders if _is_in(n, column, wanted))
    kept = tuple(n for n in before.folders if n not in set(gone))
    version = replace(before, number=before.number + 1, folders=kept + added, replaced=gone, made_by=made_by)
    _put(folder, version, before, 24.0)
    return _read(spark, path, version)
