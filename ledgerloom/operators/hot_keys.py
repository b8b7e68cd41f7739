"""Cutting the rows of very large customers into ordered slices.

A window over one customer runs in one task. That is right for all but a few customers; one that holds a
third of a fact table would stop the job. Customers of more than ``slice_rows`` rows are found by an exact
count, and their rows are cut at sampled rows into slices of about that size that follow the sort order.
Every row lies in exactly one slice, so a window per slice plus a carry from the slices before gives the exact
result. A slice has the same size whatever the size of the table.

What is collected and broadcast is one row per slice: a millionth of the rows of hot customers. ``MOST_SLICES``
bounds it by construction; a table beyond it is refused before anything is collected, and takes larger slices.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

SLICE = "_slice"
MOST_SLICES = 1_000_000


class TooManySlices(ValueError):
    """The slices are too small for the table."""


@dataclass(frozen=True)
class HotKeyPolicy:
    """A key is hot above ``slice_rows`` rows, which is also the size of a slice."""

    slice_rows: int = 1_000_000


@dataclass(frozen=True)
class Slicing:
    """Hot keys with the sorted rows they are cut at; ``most`` is the largest number of cuts of one key."""

    key: str
    order: tuple[str, ...]
    cuts: DataFrame
    most: int

    def hot_rows(self, rows: DataFrame) -> DataFrame:
        cuts = F.broadcast(self.cuts.select(F.col(self.key).alias("_hot_key")))
        return rows.join(cuts, F.col(self.key).eqNullSafe(F.col("_hot_key")), "left_semi")

    def add_slice(self, rows: DataFrame) -> DataFrame:
        """Append the slice number: how many cuts lie at or before the row, so 0 for a key that is not hot.

        A binary search over the key's cuts, one column per halving. Reading past the last cut gives null,
        which counts as a cut that lies behind the row.
        """
        cuts = F.broadcast(self.cuts.withColumnRenamed(self.key, "_hot_key"))
        here = F.struct(*[F.col(name).alias(name) for name in self.order])
        found = rows.join(cuts, F.col(self.key).eqNullSafe(F.col("_hot_key")), "left").withColumns(
            {"_here": here, SLICE: F.lit(0)}
        )
        for power in reversed(range(self.most.bit_length())):
            further = F.col(SLICE) + 2**power
            reached = F.get("_cuts", further - 1) <= F.col("_here")
            found = found.withColumn(SLICE, F.when(reached, further).otherwise(F.col(SLICE)))
        return found.drop("_hot_key", "_cuts", "_here")


def find_hot_keys(
    rows: DataFrame,
    key: str,
    order: list[str],
    policy: HotKeyPolicy | None = None,
    counts: DataFrame | None = None,
) -> Slicing | None:
    """Plan slices for the hot keys of ``rows``, or None when there are none (the usual case).

    ``order`` must be a total order within a key: its last column is unique. ``counts`` (key, rows) are the
    rows per key where they are known, so that nothing has to be counted; a key may be missing if it is small.
    """
    policy = policy or HotKeyPolicy()
    size = policy.slice_rows
    counted = rows.groupBy(key).agg(F.count("*").alias("rows")) if counts is None else counts
    hot = counted.filter(F.col("rows") > size)
    expected = hot.agg(F.coalesce(F.sum(F.ceil(F.col("rows") / size)), F.lit(0))).first()[0]
    if not expected:
        return None
    if expected > MOST_SLICES:
        raise TooManySlices(f"{expected} slices of {size} rows: raise slice_rows above {size * expected // MOST_SLICES}")

    spark = rows.sparkSession
    names = hot.select(key).collect()
    key_only = rows.select(key).schema
    hot_keys = F.broadcast(spark.createDataFrame(names, key_only).withColumnRenamed(key, "_hot_key"))
    picked = F.pmod(F.xxhash64(*[F.col(name) for name in order]), F.lit(size)) == 0
    sample = (
        rows.select(key, *order)
        .filter(picked)
        .join(hot_keys, F.col(key).eqNullSafe(F.col("_hot_key")), "left_semi")
        .distinct()
    )
    # About one row in `size`. Collected once: both the slices and the carry must see the same cuts.
    cut_rows = sample.collect()
    cuts = (
        spark.createDataFrame(cut_rows, sample.schema)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))
    )
    most = max(Counter(row[key] for row in cut_rows).values(), default=0)
    return Slicing(key, tuple(order), cuts, most)
