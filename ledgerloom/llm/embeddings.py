"""Embedding near-dedup: Euclidean p-stable hashing of normalised vectors, then exact cosine checks.

Each table joins several quantised random projections to one bucket. The width, the number of projections and
the number of tables follow from the number of vectors and from the chance to miss a pair that lies right at
the threshold (``MISS``); closer pairs are missed far more rarely. Pairs that meet in a bucket are checked by
cosine in double precision and counted in the first table where they meet, so no pair leaves a task: tasks
return link counts and spanning links only. Equal vectors are one vector with a number of copies.

Vectors and projections are rounded to whole numbers before they are multiplied, so every task finds the same
buckets whatever the order of the sums. A bucket of more than ``BLOCK`` vectors is cut into blocks, and every
pair of blocks is a task of its own.

* vectors that are null, empty, zero or hold null or non-finite components link with nothing;
* vectors of different lengths never link; repeated rows link with each other;
* a null ``vec_id`` names no component unless all its ids are null; it is never kept;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch, components, run_bounds, spanning_labels, whole_runs

MIN_COSINE = 0.9
ROUNDING = 1e-9
MISS = 0.002
WIDTH = 4.0  # in units of the distance at the threshold
MATES = 128  # unrelated vectors that a bucket may hold, about
BLOCK = 1024
SEED = 11
SCALE = 1 << 20


def usable(vector: Column) -> Column:
    """Whether all components are finite and not all are zero; false for null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def meet_chance(distance: float, width: float) -> float:
    """Chance that two points this far apart fall into one cell of a projection of this width."""
    t = width / distance
    tail = math.erfc(t / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def hash_plan(rows: int, min_cosine: float = MIN_COSINE, miss: float = MISS) -> tuple[float, int, int]:
    """Width, projections per table and tables."""
    threshold = math.sqrt(2 - 2 * min_cosine)
    width = WIDTH * threshold
    near, far = meet_chance(threshold, width), meet_chance(math.sqrt(2), width)
    projections = max(1, round(math.log(max(1.0, rows / MATES)) / -math.log(far)))
    tables = math.ceil(math.log(miss) / math.log(1 - near**projections))
    return width, projections, tables


@lru_cache(maxsize=4)
def _projections(size: int, width: float, projections: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, size])
    # products stay below 2**53 in sum: exact in double precision
    directions = np.rint(random.standard_normal((size, projections * tables)) * (1 << 12))
    shifts = random.random(projections * tables)
    mixers = random.integers(1, 1 << 62, projections * tables, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    return directions, shifts, mixers


def buckets(units: np.ndarray, plan: tuple[float, int, int]) -> np.ndarray:
    """64-bit bucket of every unit vector in every table."""
    width, projections, tables = plan
    directions, shifts, mixers = _projections(units.shape[1], width, projections, tables)
    exact = np.rint(units * SCALE) @ directions
    cells = np.floor(exact / (float(SCALE) * (1 << 12) * width) + shifts).astype(np.int64).astype(np.uint64)
    mixed = (cells + np.uint64(0x9E3779B97F4A7C15)) * mixers
    mixed ^= mixed >> np.uint64(29)
    return mixed.reshape(len(units), tables, projections).sum(axis=2, dtype=np.uint64).view(np.int64)


def unit_vectors(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """Groups of rows of equal vector length: (row numbers, vectors) as double precision arrays."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.append(0, np.cumsum(lengths))
    groups = []
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        vectors = flat[starts[rows][:, None] + np.arange(size)]
        groups.append((rows, vectors))
    return groups


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that nothing overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _hasher(plan: tuple[float, int, int]):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = plan[2]
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for rows, vectors in unit_vectors(batch.column(1)):
                found = buckets(normalised(vectors), plan)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(nodes[rows], tables)),
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * tables, vectors.shape[1], np.int32)),
                        pa.array(found.ravel()),
                    ],
                    ["node", "tab", "size", "bucket"],
                )

    return hashed


def _checker(plan: tuple[float, int, int], min_cosine: float):
    """Link counts and spanning links of every run of rows that share a bucket, or a pair of its blocks."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "key"):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            keys = table.column("key").to_numpy()
            nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            halves, tabs = table.column("half").to_numpy(), table.column("tab").to_numpy()
            vectors = unit_vectors(table.column("vector"))
            units: list[np.ndarray | None] = [None] * len(keys)
            for rows, found in vectors:
                for row, unit in zip(rows.tolist(), normalised(found)):
                    units[row] = unit
            for a, b in run_bounds(keys):
                if b - a > 1:
                    links = _links(np.array(units[a:b]), halves[a:b], int(tabs[a]), plan, min_cosine)
                    if links is not None:
                        left, right, first = links
                        counts = np.zeros(b - a, np.int64)
                        np.add.at(counts, left[first], copies[a:b][right[first]])
                        np.add.at(counts, right[first], copies[a:b][left[first]])
                        order = np.argsort(nodes[a:b], kind="stable")
                        place = np.empty_like(order)
                        place[order] = np.arange(len(order))
                        label = nodes[a:b][order[spanning_labels(b - a, place[left], place[right])]][place]
                        linked = np.unique(np.concatenate([left, right]))
                        out.append((nodes[a:b][linked], counts[linked], label[linked]))
            if out:
                columns = [pa.array(np.concatenate(column)) for column in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "root"])

    return checked


def close_pairs(one: np.ndarray, two: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two sets of unit vectors whose cosine is ``least`` or more.

    Matrix products of different shape round differently. Pairs within that rounding of the threshold are decided
    by a sum in one fixed order, so that a pair gets the same answer in every bucket.
    """
    rough = one @ two.T
    left, right = np.nonzero(rough >= least - ROUNDING)
    unsure = np.flatnonzero(rough[left, right] < least + ROUNDING)
    kept = np.ones(len(left), bool)
    kept[unsure] = (one[left[unsure]] * two[right[unsure]]).sum(axis=1) >= least
    return left[kept], right[kept]


def _links(units: np.ndarray, halves: np.ndarray, tab: int, plan: tuple[float, int, int], min_cosine: float):
    """Linked pairs of rows, and which of them have met in no earlier table."""
    if halves[0] < 0:
        left, right = close_pairs(units, units, min_cosine)
        left, right = left[left < right], right[left < right]
    else:
        one, two = np.flatnonzero(halves == 0), np.flatnonzero(halves == 1)
        left, right = close_pairs(units[one], units[two], min_cosine)
        left, right = one[left], two[right]
    if not len(left):
        return None
    rows, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    earlier = buckets(units[rows], plan)[:, :tab]
    one, two = place[: len(left)], place[len(left) :]
    first = np.ones(len(left), bool)
    for column in earlier.T:
        first &= column[one] != column[two]
    return left, right, first


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, miss: float = MISS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        F.when(usable(vectors["embedding"]), vectors["embedding"]).alias("vector"),
    )
    distinct = rows.where("vector IS NOT NULL").groupBy("vector").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies")
    )
    distinct = scratch.store(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    plan = hash_plan(distinct.count(), min_cosine, miss)

    met = distinct.select("node", "vector").mapInArrow(_hasher(plan), "node long, tab int, size int, bucket long")
    key = ["tab", "size", "bucket"]
    shared = met.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")
    shared = scratch.store(shared.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")).drop("rows"), "shared")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = met.join(shared, key).withColumn("own", own)
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    half = F.when(low == high, -1).otherwise((F.col("own") == high).cast("int"))
    met = met.select("node", "tab", F.xxhash64(*key, low, high).alias("key"), half.alias("half"))
    met = met.join(distinct.select("node", "copies", "vector"), "node")
    links = met.repartition("key").sortWithinPartitions("key").mapInArrow(
        _checker(plan, min_cosine), "node long, n long, root long"
    )
    links = scratch.store(links, "links")

    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    names = components(scratch, links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = distinct.select("node", "first", "copies", "vector")
    named = known.join(names, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    named = names.join(named, "component").select("node", "component_id")
    known = known.join(counts, "node", "left").join(named, "node", "left").select(
        "vector",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component_id", "first").alias("of"),
    )
    known = scratch.store(known.withColumnRenamed("vector", "known"), "known")
    found = rows.join(known, F.col("vector") == F.col("known"), "left")
    component = F.coalesce("of", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
