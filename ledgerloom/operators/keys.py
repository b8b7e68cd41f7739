"""Stable integer keys for business ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_GROUP = "_group"
MOST_DIGITS = 4


def number_ids(ids: DataFrame, id_column: str, key_column: str, taken: DataFrame, digits: int = MOST_DIGITS) -> DataFrame:
    """``ids`` with the next free numbers in ``key_column``, following the largest key of ``taken``.

    Rows are numbered without gaps in the order of (leading md5 digits of the id, id). The digits split the ids
    into 16**digits even groups that are numbered side by side; only the group sizes, at most 65,536 rows, pass
    through one task and are broadcast. Ids must be unique. Give it only the columns that are needed: the rows
    are shuffled.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must lie between 1 and {MOST_DIGITS}: their groups are broadcast")
    grouped = ids.withColumn(_GROUP, F.substring(F.md5(F.col(id_column)), 1, digits))
    # keys in use form the group "", which sorts first
    largest = taken.agg(F.max(key_column).alias("_size")).select(F.lit("").alias(_GROUP), "_size")
    sizes = grouped.groupBy(_GROUP).agg(F.count("*").alias("_size")).unionByName(largest)
    before = Window.orderBy(_GROUP).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_GROUP, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(_GROUP).orderBy(id_column))
    numbered = grouped.join(F.broadcast(offsets), _GROUP).withColumn(key_column, (F.col("_offset") + place).cast("long"))
    return numbered.drop(_GROUP, "_offset")


def fill_keys(rows: DataFrame, id_column: str, key_column: str, taken: DataFrame | None = None, digits: int = MOST_DIGITS) -> DataFrame:
    """Give every row without a key the next free number; rows with a key keep it.

    Only the ids without a key are numbered; the rows are shuffled once, to join them. When no row has a key
    yet, ``taken`` may hold the keys given out elsewhere.
    """
    fresh = rows.filter(F.col(key_column).isNull()).select(id_column)
    numbers = number_ids(fresh, id_column, "_number", (rows if taken is None else taken).select(F.col(key_column).alias("_number")), digits)
    numbers = numbers.withColumnRenamed(id_column, "_id")
    joined = rows.join(numbers, F.col(id_column) == F.col("_id"), "left")
    return joined.withColumn(key_column, F.coalesce(key_column, "_number")).select(*rows.columns)
