"""Parquet tables whose versions are switched by one small file.

Layout of a table::

    root/data/_version=<folder>/<partition>=<value>/part-*.parquet
    root/_versions/<number>.json

A version file names the folder that holds each partition now, the schema, and
what was last written by whom. A write fills a folder of its own and adds the
next version file last, by a rename that fails if the number is taken. So

* a reader sees the version that was current when it asked, whole;
* a write that stops before the rename leaves the table as it was, and its
  folder is referred to by nothing; the same write can run again;
* a numbered batch of a writer is applied once: its number is in the version
  that holds its rows;
* of two writers that start from one version, one fails (``VersionConflict``).

All files are reached through Spark's file systems. Partition values are listed
on the driver, rows never are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapecraft.session import checkpoint_root

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class VersionConflict(RuntimeError):
    """Another writer has added the version that this one was about to add."""


@dataclass(frozen=True)
class Version:
    """One version of a table: ``folders`` maps partition values (None is NULL) to data folders,
    ``batches`` writers to their last batch, ``inputs`` names to versions it was made from."""

    number: int
    schema: T.StructType
    folders: dict[str | None, str]
    batches: dict[str, int] = field(default_factory=dict)
    inputs: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "batches": self.batches, "inputs": self.inputs,
            "folders": [[value, folder] for value, folder in self.folders.items()]})

    @classmethod
    def from_json(cls, text: str) -> Version:
        read = json.loads(text)
        return cls(read["number"], T.StructType.fromJson(read["schema"]), {v: f for v, f in read["folders"]},
                   read["batches"], read["inputs"])


class VersionedTable:
    """A table at ``root``, partitioned by one text column (``partition``) or not at all (None)."""

    def __init__(self, spark: SparkSession, root: str, partition: str | None = "dt"):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition

    # --- files -------------------------------------------------------------------------------------------------

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, *names: str) -> list[str]:
        path, files = self._path(*names), self._files()
        return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []

    def _read_text(self, *names: str) -> str:
        stream = self._files().open(self._path(*names))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _add_version(self, version: Version) -> None:
        """Write beside, then rename without overwriting: the switch."""
        jvm, files = self.spark._jvm, self._files()
        beside = self._path("_versions", f".{uuid.uuid4().hex}.tmp")
        stream = files.create(beside, False)
        try:
            stream.write(bytearray(version.to_json().encode()))
        finally:
            stream.close()
        to = self._path("_versions", f"{version.number:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.getFileSystem(
            self.spark._jsc.hadoopConfiguration()).getUri(), self.spark._jsc.hadoopConfiguration())
        rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        none = jvm.java.lang.reflect.Array.newInstance(rename, 0)
        try:
            context.rename(beside, to, none)
        except Exception as e:
            files.delete(beside, False)
            if files.exists(to):
                raise VersionConflict(f"version {version.number} of {self.root} exists already") from e
            raise

    # --- reading -----------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(name[:-5]) for name in self._listed("_versions") if name.endswith(".json")]

    def version(self, number: int | None = None) -> Version | None:
        """The current version, or an earlier one that is still kept; None before the first."""
        if number is None:
            number = max(self.versions(), default=None)
        return None if number is None else Version.from_json(self._read_text("_versions", f"{number:012d}.json"))

    def read(self, values: Sequence[str | None] | None = None, version: Version | None = None) -> DataFrame | None:
        """The rows of a version (the current one), or of some of its partitions only: no
        other folder is listed. None before the first version."""
        version = version or self.version()
        if version is None:
            return None
        wanted = version.folders if values is None else {v: version.folders[v] for v in values if v in version.folders}
        paths = [f"{self.root}/data/{folder}" + (f"/{self._folder_name(value)}" if self.partition else "")
                 for value, folder in wanted.items()]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        found = self.spark.read.schema(self._with_folder(version.schema)).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*version.schema.names)

    def _with_folder(self, schema: T.StructType) -> T.StructType:
        """The schema as files have it: the partition column last, a text."""
        own = [f for f in schema.fields if f.name != self.partition]
        last = [T.StructField(self.partition, T.StringType())] if self.partition else []
        return T.StructType(own + last)

    def _folder_name(self, value: str | None) -> str:
        if value is None:
            return f"{self.partition}={NULL_PARTITION}"
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{self.partition}={escape(value)}"

    # --- writing -----------------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, number: int) -> dict[str | None, str]:
        """Rows into a folder of their own; the partitions it has."""
        folder = f"_version={number:012d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/data/{folder}"
        if self.partition is None:
            rows.write.parquet(path)
            return {None: folder}
        # one writer a partition, or several where its bytes ask for them
        rows.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(path)
        names = [n.partition("=")[2] for n in self._listed("data", folder) if n.startswith(f"{self.partition}=")]
        return {None if n == NULL_PARTITION else unquote(n): folder for n in names}

    def is_applied(self, batch: tuple[str, int] | None, version: Version | None = None) -> bool:
        """Whether a writer's batch (its name and number) is in the table already."""
        version = version or self.version()
        return batch is not None and version is not None and version.batches.get(batch[0], -1) >= batch[1]

    def replace(self, rows: DataFrame, values: Sequence[str | None] | None = None, batch: tuple[str, int] | None = None,
                inputs: dict[str, int] | None = None, base: Version | None = None) -> Version:
        """The next version: all rows replaced, or those of some partitions (``values``) only.

        ``rows`` may read the table itself. ``base`` is the version they were made
        from (the current one); if that is not the latest any more, VersionConflict.
        """
        base = base or self.version()
        number = base.number + 1 if base else 1
        rows = rows if self.partition is None else rows.withColumn(self.partition, F.col(self.partition).cast("string"))
        made = self._write(rows, number)
        kept = {} if base is None or values is None else {v: f for v, f in base.folders.items() if v not in set(values)}
        batches = dict(base.batches) if base else {}
        if batch is not None:
            batches[batch[0]] = batch[1]
        version = Version(number, rows.schema, {**kept, **made}, batches, inputs or (base.inputs if base else {}))
        self._add_version(version)
        return version

    def remove(self, values: Sequence[str | None]) -> Version | None:
        """The next version: without some partitions. Nothing is written but the switch."""
        base = self.version()
        if base is None:
            return None
        kept = {v: f for v, f in base.folders.items() if v not in set(values)}
        version = Version(base.number + 1, base.schema, kept, base.batches, base.inputs)
        self._add_version(version)
        return version

    def merge(self, updates: DataFrame, keys: Sequence[str], batch: tuple[str, int] | None = None,
              materialized: bool = False) -> Version | None:
        """Update-or-insert by ``keys`` (NULL keys match NULL keys); one row a key in ``updates``.

        Only partitions with an update are read and written, and rows of a key stay
        in its partition: the partition is a function of the keys. The updates are
        checkpointed, as they are read for their partitions, keys and rows, unless they
        are ``materialized`` already. None if there is nothing to do: no update, or the
        batch is applied already.
        """
        base = self.version()
        if self.is_applied(batch, base):
            return None
        ups = updates.withColumn(self.partition, F.col(self.partition).cast("string"))
        if not materialized:
            checkpoint_root(self.spark)
            ups = ups.checkpoint(eager=True)
        values = [row[0] for row in ups.select(self.partition).distinct().collect()]   # calendar days
        if not values and batch is None:
            return None
        if base is None:
            return self.replace(ups, batch=batch)
        ups = ups.select(*base.schema.names)
        current = self.read(values, base)
        mine = ups.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        return self.replace(current.join(mine, same, "left_anti").unionByName(ups), values, batch, base=base)

    # --- old versions ------------------------------------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` versions and the data folders that none of these
        refers to, those of writes that never ended included; returns the folders.

        Not while a writer runs, and with ``keep`` versions for readers to finish on.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        numbers = self.versions()
        used = {folder for n in numbers[-keep:] for folder in self.version(n).folders.values()}
        for number in numbers[:-keep]:
            self._files().delete(self._path("_versions", f"{number:012d}.json"), False)
        gone = [name for name in self._listed("data") if name not in used]
        for name in gone:
            self._files().delete(self._path("data", name), True)
        return gone
