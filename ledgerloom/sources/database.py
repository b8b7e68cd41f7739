"""Tables in a database, over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import sink_decimals


@dataclass(frozen=True)
class KeyRange:
    """Integer column and range by which a table is read in parallel; without one a read is a single task."""

    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


@dataclass(frozen=True)
class Database:
    """Connection to one database, for example ``Database(url, {"user": ..., "password": ..., "driver": ...})``."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def read(self, spark: SparkSession, table: str, by: KeyRange | None = None) -> DataFrame:
        options = {**self._connection(table), "fetchsize": str(self.fetch_size), **(by.options() if by else {})}
        return spark.read.format("jdbc").options(**options).load()

    def append(self, rows: DataFrame, table: str) -> None:
        self._write(rows, table, "append")

    def replace(self, rows: DataFrame, table: str) -> None:
        """Empty the table, keeping its definition, and write the rows."""
        self._write(rows, table, "overwrite", truncate="true")

    def _write(self, rows: DataFrame, table: str, mode: str, **options: str) -> None:
        options = {**self._connection(table), "batchsize": str(self.batch_size), **options}
        sink_decimals(rows).write.format("jdbc").options(**options).mode(mode).save()

    def _connection(self, table: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": table, **self.properties}
