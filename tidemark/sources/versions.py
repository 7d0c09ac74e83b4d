"""Tables kept as versions: files are only added, and one rename switches readers.

A folder holds several tables whose states change together. Rows are written
under a commit folder of their own, partitioned by the table's key. The state —
which partition of which table consists of which folders — is a JSON manifest,
committed by renaming a finished file to the next version's name. A reader is
bound to the version it started from: nothing it reads is changed or removed
before ``vacuum``. A writer that dies leaves files no manifest names; a writer
that comes second finds the version taken and fails instead of overwriting.

The manifest has an entry for each partition and folder, not for each file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FILE = 1_000_000
Folders = dict[str, list[str]]          # partition value → folders, oldest first


class VersionConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class State:
    """What a version consists of; ``batch`` is the last stream batch in it."""
    version: int = 0
    batch: int = -1
    tables: dict[str, Folders] = field(default_factory=dict)

    def folders(self, table: str, values: list | None = None) -> list[str]:
        own = self.tables.get(table, {})
        return [f for v, folders in own.items() if values is None or v in {str(x) for x in values} for f in folders]


def slices(rows: int) -> int:
    """Files that ``rows`` rows of one partition are written to."""
    return max(1, -(-rows // ROWS_PER_FILE))


def dealt(df: DataFrame, partition: str, keys: list[str], largest: int) -> DataFrame:
    """Rows of a partition together, spread over as many tasks as its largest has files."""
    part: Column = F.pmod(F.xxhash64(*keys), F.lit(slices(largest)))
    return df.repartition(partition, part)


class VersionedTables:
    """``keys``: table → its partition column."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str]):
        self.spark, self.root, self.keys = spark, root, keys
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._none = getattr(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), "NONE")
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), spark._jsc.hadoopConfiguration())

    # --- versions

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.root}/versions") if n.startswith("v") and n.endswith(".json"))

    def state(self, version: int | None = None) -> State:
        """The state of a version (default: the last; before any commit an empty one)."""
        if version is None:
            known = self.versions()
            if not known:
                return State()
            version = known[-1]
        stream = self._fs.open(self._path(f"{self.root}/versions/v{version:012d}.json"))
        try:
            raw = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return State(raw["version"], raw["batch"], raw["tables"])

    def commit(self, base: State, tables: dict[str, Folders], batch: int | None = None) -> State:
        """The version after ``base`` with ``tables``, if nobody else has made one."""
        state = State(base.version + 1, base.batch if batch is None else batch, {**base.tables, **tables})
        final = self._path(f"{self.root}/versions/v{state.version:012d}.json")
        temp = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(temp, False)
        out.write(bytearray(json.dumps({"version": state.version, "batch": state.batch, "tables": state.tables}).encode()))
        out.close()
        try:
            self._context.rename(temp, final, self._rename_options())
        except Exception as e:  # noqa: BLE001 - py4j wraps the file system's own error
            self._fs.delete(temp, False)
            if "FileAlreadyExists" in str(e):
                raise VersionConflict(f"version {state.version} of {self.root} is taken") from e
            raise
        return state

    def _rename_options(self):
        options = self.spark.sparkContext._gateway.new_array(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = self._none
        return options

    # --- rows

    def write(self, table: str, rows: DataFrame) -> Folders:
        """Write rows to a new commit folder, by partition; no reader sees them before ``commit``."""
        key, commit = self.keys[table], f"{self.root}/{table}/commit=c{uuid.uuid4().hex}"
        rows.write.partitionBy(key).parquet(commit)
        return {n.split("=", 1)[1]: [f"{commit}/{n}"] for n in self._names(commit) if n.startswith(f"{key}=")}

    def read(self, table: str, schema: T.StructType, state: State | None = None, values: list | None = None, more: Folders | None = None) -> DataFrame:
        """Rows of the partitions ``values`` (default: all) of a version, and of uncommitted folders ``more``."""
        state = self.state() if state is None else state
        folders = state.folders(table, values) + (State(tables={table: more}).folders(table, values) if more else [])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*folders).select(*schema.fieldNames())

    @staticmethod
    def added(own: Folders, new: Folders) -> Folders:
        return {**own, **{v: own.get(v, []) + f for v, f in new.items()}}

    @staticmethod
    def replaced(own: Folders, new: Folders, values: list) -> Folders:
        """``new`` in place of the partitions ``values``, which may be gone."""
        return {**{v: f for v, f in own.items() if v not in {str(x) for x in values}}, **new}

    def compact(self, table: str, schema: T.StructType, keys: list[str], most: int = 8, reduce: Callable[[DataFrame], DataFrame] = lambda df: df) -> State:
        """A version in which partitions of over ``most`` folders are one folder; ``reduce`` may drop rows that later ones replace."""
        state = self.state()
        own = state.tables.get(table, {})
        crowded = [v for v, folders in own.items() if len(folders) > most]
        if not crowded:
            return state
        rows, key = reduce(self.read(table, schema, state, crowded)), self.keys[table]
        largest = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        made = self.write(table, dealt(rows, key, keys, largest))
        return self.commit(state, {table: self.replaced(own, made, crowded)})

    def vacuum(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions and every commit folder that none of these names; how many folders went."""
        known = self.versions()
        named = {f.rsplit("/", 1)[0] for v in known[-keep:] for t in self.keys for f in self.state(v).folders(t)}
        for v in known[:-keep]:
            self._fs.delete(self._path(f"{self.root}/versions/v{v:012d}.json"), False)
        unused = [c for t in self.keys for n in self._names(f"{self.root}/{t}") if (c := f"{self.root}/{t}/{n}") not in named]
        return sum(bool(self._fs.delete(self._path(c), True)) for c in unused)
