"""Parquet tables in three layers, stored in versions.

``<root>/<layer>/<table>/v=<number>/`` holds one version, ``load=<number>/`` below it what one write brought,
and partition folders lie below that. A load counts once Spark has committed it and left its ``_SUCCESS`` mark;
the highest version with a load is the table. A replaced table can therefore be read while its successor is
written, and a job that dies half way changes nothing, whether it replaces or appends. The root lies on storage
all executors share.

Small loads can be merged: ``load=<first>-<last>`` holds the rows of all loads from the first number to the last, and
once it is committed they count no longer. It goes by the last number. A merge that is lost changes nothing either.

A table written with ``find_by`` is sorted by that column over all files and has Bloom filters for it: rows of given
values are read from the one row group that can hold them.

One writer at a time: whoever writes a load first creates a claim file for its number, which only one can do, and
removes it afterwards. A claim left by a lost job gives way after ``lease_seconds``.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerloom.operators.merge import require_unique, upsert
from ledgerloom.schemas import empty

STAGING, WAREHOUSE, ANALYTICS = "staging", "warehouse", "analytics"


class MissingTable(LookupError):
    """The table has never been written."""


class BusyTable(RuntimeError):
    """Another job is writing this, or has just written it."""


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str
    lease_seconds: float = 6 * 3600

    def versions(self, layer: str, table: str) -> list[int]:
        """Numbers of the committed versions, oldest first."""
        return sorted({version for version, _ in self.loads(layer, table)})

    def loads(self, layer: str, table: str) -> list[tuple[int, int]]:
        """(version, load) of everything committed, in order; merged loads go by their last number."""
        return [(version, last) for version, _, last in self.ranges(layer, table)]

    def ranges(self, layer: str, table: str, merged_away: bool = False) -> list[tuple[int, int, int]]:
        """(version, first, last load) of every folder that counts, in order; or of those merged into another."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self._folder(layer, table)}/v=*/load=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        folders = [mark.getPath().getParent() for mark in files.globStatus(pattern) or []]

        def numbers(folder) -> tuple[int, int, int]:
            first, _, last = folder.getName().partition("=")[2].partition("-")
            return int(folder.getParent().getName().partition("=")[2]), int(first), int(last or first)

        # the widest range comes first among those that begin alike
        found = sorted(map(numbers, folders), key=lambda of: (of[0], of[1], -of[2]))
        counting: list[tuple[int, int, int]] = []
        covered = []
        for version, first, last in found:
            inside = counting and counting[-1][0] == version and last <= counting[-1][2]
            (covered if inside else counting).append((version, first, last))
        return covered if merged_away else counting

    def load_bytes(self, layer: str, table: str, version: int, first: int, last: int) -> int:
        """Size of one load's files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._load(layer, table, version, last, first))
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.getContentSummary(path).getLength()

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.versions(layer, table))

    def read(
        self, layer: str, table: str, schema: T.StructType | None = None, upto: int | None = None, only: Sequence[int] | None = None
    ) -> DataFrame:
        """The current version. With ``schema`` a table that was never written reads as empty; any other
        failure stays a failure. ``upto`` leaves out later loads, ``only`` names the loads to read."""
        ranges = self.ranges(layer, table)
        if ranges:
            newest = ranges[-1][0]
            chosen = [(first, last) for version, first, last in ranges if version == newest]
            chosen = [of for of in chosen if (upto is None or of[1] <= upto) and (only is None or of[1] in only)]
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            if chosen:
                paths = [self._load(layer, table, newest, last, first) for first, last in chosen]
                return reader.option("basePath", self._version(layer, table, newest)).parquet(*paths).drop("load")
        if schema is None:
            raise MissingTable(f"{layer}.{table}")
        return empty(self.spark, schema)

    def replace(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        partition_by: Sequence[str] = (),
        load: int = 0,
        find_by: str | None = None,
    ) -> DataFrame:
        """Write a new version holding exactly ``rows``, as its load number ``load``, and return it.

        ``find_by`` names a column whose values are looked up one by one. It costs a shuffle, and one more pass over
        the input that draws the bounds.
        """
        versions = self.versions(layer, table)
        self._write(layer, table, versions[-1] + 1 if versions else 1, load, rows, partition_by, find_by=find_by)
        # without rows there are no partition folders, and no file to tell the columns from
        return self.read(layer, table, rows.schema if partition_by else None)

    def append(
        self, layer: str, table: str, rows: DataFrame, partition_by: Sequence[str] = (), load: int | None = None
    ) -> DataFrame:
        """Add rows to the current version, or write the first one.

        A load is given the next number, unless the caller keeps numbers of its own: then ``load`` replaces what
        an earlier attempt has left under that number.
        """
        loads = self.loads(layer, table)
        version, last = loads[-1] if loads else (1, -1)
        self._write(layer, table, version, last + 1 if load is None else load, rows, partition_by, again=load is not None)
        return self.read(layer, table)

    def merge(
        self, layer: str, table: str, first: int, last: int, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
    ) -> None:
        """Write the loads ``first`` to ``last`` of the current version as one, which replaces them."""
        version = self.loads(layer, table)[-1][0]
        inside = [of for of in self.ranges(layer, table) if of[0] == version and first <= of[1] and of[2] <= last]
        if len(inside) < 2 or inside[0][1] != first or inside[-1][2] != last:
            raise ValueError(f"{layer}.{table}: {first} to {last} are not whole loads of version {version}")
        rows = self.read(layer, table, schema, only=[of[2] for of in inside])
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self._load(layer, table, version, last, first))

    def drop_merged(self, layer: str, table: str) -> int:
        """Delete the loads that were merged into another, and return their number. Jobs that read them must be over."""
        jvm = self.spark._jvm
        old = self.ranges(layer, table, merged_away=True)
        for version, first, last in old:
            path = jvm.org.apache.hadoop.fs.Path(self._load(layer, table, version, last, first))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(old)

    def _write(
        self,
        layer: str,
        table: str,
        version: int,
        load: int,
        rows: DataFrame,
        partition_by: Sequence[str],
        again: bool = False,
        find_by: str | None = None,
    ) -> None:
        with self.claim(f"{layer}/{table}/v={version:08d}-load={load:08d}"):
            if not again and (version, load) in self.loads(layer, table):
                raise BusyTable(f"{layer}.{table}: version {version}, load {load} was written meanwhile")
            # overwrite: a load left unfinished by a lost job may lie there
            options = {}
            if find_by is not None:
                rows = rows.repartitionByRange(find_by).sortWithinPartitions(*partition_by, find_by)
                options = {f"parquet.bloom.filter.enabled#{find_by}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
            writer = rows.write.mode("overwrite").options(**options).partitionBy(*partition_by)
            writer.parquet(self._load(layer, table, version, load))

    @contextmanager
    def claim(self, name: str) -> Iterator[None]:
        """Hold the claim file of ``name`` for the time of a block; refused while another job holds it."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/_claims/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())

        def created() -> bool:
            try:
                files.create(path, False).close()
                return True
            except Py4JJavaError as error:
                if not files.exists(path):
                    raise error
                return False

        if not created():
            age = time.time() - files.getFileStatus(path).getModificationTime() / 1000
            if age < self.lease_seconds:
                raise BusyTable(f"{name} is being written, since {age:.0f} seconds")
            files.delete(path, False)  # left by a lost job
            if not created():
                raise BusyTable(f"{name} is being written")
        try:
            yield
        finally:
            files.delete(path, False)

    def upsert(
        self, layer: str, table: str, updates: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the rows of known keys and add the others; refuses updates that repeat a key."""
        require_unique(updates, keys)
        stored = self.read(layer, table, updates.schema)
        return self.replace(layer, table, upsert(stored, updates, keys, keep))

    def expire(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest versions, and return the numbers deleted."""
        jvm = self.spark._jvm
        old = self.versions(layer, table)[: -max(keep, 1)]
        for number in old:
            path = jvm.org.apache.hadoop.fs.Path(self._version(layer, table, number))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return old

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def _version(self, layer: str, table: str, number: int) -> str:
        return f"{self._folder(layer, table)}/v={number:08d}"

    def _load(self, layer: str, table: str, version: int, load: int, first: int | None = None) -> str:
        name = f"{load:08d}" if first in (None, load) else f"{first:08d}-{load:08d}"
        return f"{self._version(layer, table, version)}/load={name}"
