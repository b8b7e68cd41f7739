"""Ids already loaded, in a table bucketed by id.

Rows of one id always lie in the same bucket, so that a batch finds out what is known by being shuffled itself, into
as many buckets; the index, which grows with the history, is only scanned. Spark keeps the buckets of a table in
its catalog; the files lie below the store's root like all others, and a session that does not know them yet
declares them anew. The ids of a load are one partition, which counts once its mark is set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerloom.sources.tables import TableStore

BUCKETS = 64


@dataclass(frozen=True)
class IdIndex:
    """``buckets`` holds for the life of an index; take about one per 128 MB of ids to expect."""

    store: TableStore
    layer: str
    table: str
    column: str
    buckets: int = BUCKETS

    @property
    def folder(self) -> str:
        # below a version folder, so that the store finds its loads like those of any table
        return f"{self.store.root.rstrip('/')}/{self.layer}/{self.table}/v=00000001"

    @property
    def name(self) -> str:
        return f"ids_{hashlib.md5(f'{self.folder}/{self.buckets}'.encode()).hexdigest()}"

    def loads(self) -> list[int]:
        """Numbers of the loads whose ids are in."""
        return [load for _, load in self.store.loads(self.layer, self.table)]

    def read(self) -> DataFrame:
        """All ids of committed loads, known to lie in buckets."""
        self._declare()
        rows = self.store.spark.table(self.name)
        return rows.filter(F.col("load").isin(self.loads())).select(self.column)

    def add(self, load: int, ids: DataFrame) -> None:
        """Put in the ids of a load; what a lost job has left of them is overwritten."""
        spark = self.store.spark
        self._declare()
        with self.store.claim(f"{self.layer}/{self.table}/load={load:08d}"):
            view = f"added_{self.name}"
            ids.select(self.column).repartition(self.buckets, self.column).createOrReplaceTempView(view)
            spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (load = {int(load)}) SELECT {self.column} FROM {view}")
            spark.catalog.dropTempView(view)
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/load={int(load)}/_SUCCESS")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()

    def catch_up(self, loads: Sequence[int], ids_of) -> list[int]:
        """Put in the ids of every load that is not in yet."""
        known = set(self.loads())
        added = [load for load in loads if load not in known]
        for load in added:
            self.add(load, ids_of(load))
        return added

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of the batch whose id is not known. The batch is shuffled, the index is not."""
        return batch.join(self.read(), self.column, "left_anti")

    def _declare(self) -> None:
        spark = self.store.spark
        if not spark.catalog.tableExists(self.name):
            path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
            spark.sql(
                f"CREATE TABLE {self.name} ({self.column} STRING, load INT) USING parquet PARTITIONED BY (load)"
                f" CLUSTERED BY ({self.column}) SORTED BY ({self.column}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
            )
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
