"""Combining a stored table with new rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class DuplicateKeys(ValueError):
    """The new rows name a key more than once, so there is no single row to store for it."""


class MissingKeys(ValueError):
    """Some new rows have no key, so they can never be told from rows already stored."""


def new_rows(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key is not stored yet.

    The stored keys are first reduced to those of the batch. When the batch is small enough for Spark to
    broadcast its keys, the large stored table is then only scanned, one column of it, and never shuffled.
    """
    seen = stored.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(seen, key, "left_anti")


def require_unique(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows unchanged, or an error naming some keys that occur more than once or have an empty part."""
    empty = reduce(lambda left, right: left | right, [F.col(key).isNull() for key in keys])
    found = rows.groupBy(*keys).count().filter((F.col("count") > 1) | empty).limit(5).collect()
    named = f"({', '.join(keys)}): {[tuple(row)[:-1] for row in found]}"
    if any(None in tuple(row)[:-1] for row in found):
        raise MissingKeys(f"rows without a key {named}")
    if found:
        raise DuplicateKeys(f"several rows for one key {named}")
    return rows


def upsert(stored: DataFrame, updates: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Stored rows with the updates put in: every column of a known key is replaced, unknown keys are added.

    Columns in ``keep`` hold on to their stored value. Both inputs have one row per key and the columns of
    ``stored``; one full outer join does it all.
    """
    old, new = stored.alias("old"), updates.withColumn("_updated", F.lit(True)).alias("new")
    same_key = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys]
    updated = F.col("_updated").isNotNull()

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keep:
            after = F.coalesce(before, after)
        return F.when(updated, after).otherwise(before).alias(name)

    return old.join(new, same_key, "full").select(*[merged(name) for name in stored.columns])


def patch(stored: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Stored rows with only ``columns`` overwritten for the keys in ``changes``; other keys are ignored."""
    changed = changes.select(key, F.struct(*columns).alias("_change"))
    joined = stored.join(changed, key, "left")
    overwritten = {
        name: F.when(F.col("_change").isNotNull(), F.col(f"_change.{name}")).otherwise(F.col(name)) for name in columns
    }
    return joined.withColumns(overwritten).select(*stored.columns)


def keep_first(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of every key; rows without a key are all kept, since they cannot be told to repeat.

    The choice is one aggregate with a map-side step, so the rows are read once and a key with very many rows
    does not meet in one task. A row without a key is a group of its own.
    """
    first = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("_alone")
    return rows.groupBy(F.col(key).alias("_key"), alone).agg(first).select("_row.*")
