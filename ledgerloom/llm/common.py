"""Stored intermediates, runs of sorted rows in Arrow batches, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.session import remove_folder, scratch_folder


class Scratch:
    """Intermediate tables of one call, written to the folder all executors share.

    A stored table cuts the lineage: a lost executor never makes earlier steps run again, and its file sizes
    let Spark choose the joins that follow. The folder goes with the process; ``drop`` frees one table early.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_folder(spark)
        self.number = 0

    def store(self, rows: DataFrame, name: str = "rows") -> DataFrame:
        self.number += 1
        path = f"{self.folder}/{self.number:04d}-{name}"
        rows.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        stored._scratch_path = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Remove stored tables that no later result reads."""
        for rows in stored:
            remove_folder(self.spark, rows._scratch_path)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup sorted Arrow batches so that no run of equal keys is cut.

    Each table yielded holds one or more complete runs of the long column ``key``; only rows of the run that
    is still open are held back.
    """
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        keys = rows.column(key).to_numpy()
        if held and keys[0] != held_key:
            yield pa.concat_tables(held)
            held = []
        others = np.flatnonzero(keys != keys[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield pa.concat_tables([*held, rows.slice(0, cut)])
            held = []
        held.append(rows.slice(cut))
        held_key = keys[-1]
    if held:
        yield pa.concat_tables(held)


def run_bounds(keys: np.ndarray) -> list[tuple[int, int]]:
    """First and last-plus-one row of every run of equal keys."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    return list(zip(edges[:-1], edges[1:]))


def spanning_labels(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row number reachable from each of ``count`` rows over the links left[i] - right[i]."""
    label = np.arange(count)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long); component is the smallest node.

    Alternating large-star and small-star steps. Each step is a grouped minimum, stored, and a join with it,
    so that Spark can split the join of a node with very many neighbours; nothing is collected but two sums
    that show whether a round changed anything. Rounds grow with the logarithm of the longest chain.
    """
    u, v = F.col("u"), F.col("v")
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = scratch.store(pairs.distinct(), "links")
    seen = None
    while True:
        both = links.unionByName(links.select(v.alias("u"), u.alias("v")))
        low = scratch.store(both.groupBy("u").agg(F.min("v").alias("low")), "low")
        step = both.where("v > u").join(low, "u").select(v.alias("u"), F.least("u", "low").alias("v"))
        wide = scratch.store(step.distinct(), "links")
        scratch.drop(links, low)

        low = scratch.store(wide.groupBy("u").agg(F.min("v").alias("low")), "low")
        step = wide.join(low, "u").where("v <> low").select(v.alias("u"), F.col("low").alias("v"))
        links = scratch.store(step.unionByName(low.withColumnRenamed("low", "v")).distinct(), "links")
        scratch.drop(wide, low)
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = links.select(v.alias("node"), v.alias("component")).distinct()
    return links.select(u.alias("node"), v.alias("component")).unionByName(roots)
