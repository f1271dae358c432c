"""A target whose versions share files: a log of folders added and dropped.

Parquet has no transactions, so a load never touches files that are in use.  It
writes new folders, one for each tenant where a table is kept by tenant, and then
adds its lines to the log.  A version is all folders added and not dropped up to
it, so an insert writes its batch only, a change to a tenant writes that tenant's
folder only, and who reads an older version is not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantry.model import Tables
from tenantry.sources.tables import write_manifest, write_table

LOG_SCHEMA = "version BIGINT, note STRING, table_name STRING, action STRING, folder STRING, tenant STRING, schema STRING"
#: Fixed: the name of a partition folder without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_TENANT = "__tenant"


@dataclass(frozen=True)
class Folder:
    """Rows of one table and, where the table is kept by tenant, of one tenant; null and empty are one."""

    path: str
    tenant: str | None


@dataclass(frozen=True)
class Change:
    """What a version does to a table: the folders of ``drop`` go (all, if ``drop`` is None), the rows of ``add`` come."""

    add: DataFrame | None = None
    drop: Sequence[str | None] | None = ()


@dataclass(frozen=True)
class Target:
    """Versions of a dataset under one folder; ``by`` names the column by which a table is kept, if any."""

    spark: SparkSession
    root: str
    by: Mapping[str, str] = field(default_factory=dict)

    @property
    def _log(self) -> str:
        return f"{self.root.rstrip('/')}/_log"

    def _path(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self) -> DataFrame | None:
        path, system = self._path(self._log)
        return self.spark.read.schema(LOG_SCHEMA).json(self._log) if system.exists(path) else None

    def version(self) -> int:
        """Number of the current version, 0 before the first."""
        return self._state(None)[0]

    def folders(self, version: int | None = None) -> dict[str, list[Folder]]:
        """Live folders of each table."""
        return {name: folders for name, (folders, _) in self._state(version)[1].items()}

    def _state(self, version: int | None) -> tuple[int, dict[str, tuple[list[Folder], str]]]:
        """The version's number, and of each table the live folders and the schema.

        The last word on a folder counts; only that leaves the log.
        """
        entries = self._entries()
        if entries is None:
            return 0, {}
        if version is not None:
            entries = entries.filter(F.col("version") <= version)
        last = entries.groupBy("table_name", "folder", "tenant").agg(F.max_by(F.struct("action", "schema", "version"), "version").alias("last"))
        number, found = 0, {}
        for row in sorted(last.select("table_name", "folder", "tenant", "last.*").collect(), key=lambda r: (r.version, r.folder or "")):
            number = row.version
            if row.table_name is None:
                continue
            folders, _ = found.get(row.table_name, ([], None))
            if row.action == "add":
                folders.append(Folder(row.folder, row.tenant))
            found[row.table_name] = (folders, row.schema)
        return number, {name: state for name, state in found.items() if state[1] is not None}

    def read(self, version: int | None = None, tenants: Sequence[str | None] | None = None, only: Sequence[str] | None = None) -> Tables:
        """The tables of a version; of tables kept by tenant only some tenants' folders, if ``tenants`` are given."""
        result: Tables = {}
        for name, (folders, schema) in self._state(version)[1].items():
            if only is not None and name not in only:
                continue
            wanted = [f.path for f in folders if tenants is None or f.tenant in tenants or name not in self.by]
            kind = T.StructType.fromJson(json.loads(schema))
            if wanted:
                result[name] = self.spark.read.schema(kind).option("recursiveFileLookup", True).parquet(*[f"{self.root.rstrip('/')}/{p}" for p in wanted])
            else:
                result[name] = self.spark.createDataFrame([], kind)
        return result

    def tenant_of(self, name: str) -> Column:
        """The folder key of a table's rows."""
        return F.nullif(F.col(self.by[name]).cast("string"), F.lit("")) if name in self.by else F.lit(None).cast("string")

    def tenants(self, name: str, rows: DataFrame) -> list[str | None]:
        """The folder keys that some rows of a table have; at most one for each tenant."""
        if name not in self.by:
            return [] if rows.isEmpty() else [None]
        return [r.t for r in rows.select(self.tenant_of(name).alias("t")).distinct().collect()]

    def among(self, name: str, rows: DataFrame, tenants: Sequence[str | None]) -> DataFrame:
        """The rows of a table that are in the folders of some tenants."""
        key = self.tenant_of(name)
        hit = key.isin([t for t in tenants if t is not None])
        return rows.filter(F.coalesce(hit, F.lit(False)) | (key.isNull() & F.lit(None in tenants)))

    def commit(self, changes: Mapping[str, Change], note: str = "") -> int:
        """A new version; nothing becomes visible before the last table is written."""
        (latest, state), lines = self._state(None), []
        number = latest + 1
        for name, change in changes.items():
            folders, schema = state.get(name, ([], None))
            gone = [f for f in folders if change.drop is None or f.tenant in change.drop]
            if change.add is not None:
                schema = change.add.schema.json()
                lines += [(number, note, name, "add", f.path, f.tenant, schema) for f in self._write(name, change.add, number)]
            lines += [(number, note, name, "drop", f.path, f.tenant, schema) for f in gone]
        self._append(lines or [(number, note, None, None, None, None, None)])
        return number

    def _write(self, name: str, rows: DataFrame, number: int) -> list[Folder]:
        place = f"v{number}/{name}"
        full = f"{self.root.rstrip('/')}/{place}"
        if name not in self.by:
            write_table(rows, full, mode="overwrite")
            return [Folder(place, None)]
        write_table(rows.withColumn(_TENANT, self.tenant_of(name)), full, _TENANT, mode="overwrite")
        path, system = self._path(full)
        names = sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(f"{_TENANT}="))
        values = [n.removeprefix(f"{_TENANT}=") for n in names]
        return [Folder(f"{place}/{n}", None if v == NO_VALUE else unquote(v)) for n, v in zip(names, values, strict=True)]

    def _append(self, lines: list[tuple]) -> None:
        write_manifest(self.spark.createDataFrame(lines, LOG_SCHEMA), self._log)

    def publish(self, tables: Tables, note: str = "") -> int:
        """A new version in which the given tables are replaced as a whole; others keep their folders."""
        return self.commit({name: Change(df, None) for name, df in tables.items()}, note)

    def restore(self, version: int) -> int:
        """Make an earlier version current again; only the log grows."""
        latest, now = self._state(None)
        if not 0 < version <= latest:
            raise ValueError(f"no version {version}")
        then, lines = self._state(version)[1], []
        for name in {*now, *then}:
            (live, _), (wanted, old) = now.get(name, ([], None)), then.get(name, ([], None))
            note = f"restore {version}"
            lines += [(latest + 1, note, name, "drop", f.path, f.tenant, old) for f in live if f not in wanted]
            lines += [(latest + 1, note, name, "add", f.path, f.tenant, old) for f in wanted if f not in live]
            if old is None:  # there was no such table
                lines.append((latest + 1, note, name, "drop", None, None, None))
        self._append(lines or [(latest + 1, f"restore {version}", None, None, None, None, None)])
        return latest + 1

    def compact(self, folders: int = 8) -> int | None:
        """Rewrite what is spread over more than so many folders as one for each tenant; the rows stay the same."""
        changes = {}
        for name, live in self.folders().items():
            many: dict[str | None, int] = {}
            for f in live:
                many[f.tenant] = many.get(f.tenant, 0) + 1
            spread = [t for t, n in many.items() if n > folders]
            if spread:
                changes[name] = Change(self.read(tenants=spread, only=[name])[name], spread)
        return self.commit(changes, "compact") if changes else None
