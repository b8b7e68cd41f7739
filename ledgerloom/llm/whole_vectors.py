"""Vectors in whole numbers, exact inner products, and blocks of rows that meet the queries sent to them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch, run_bounds, whole_runs

STEPS = 256
BLOCK_VALUES = 1 << 19  # components in a block: 4 MB as doubles
MOST_ASKS = 8192  # queries that meet one copy of a block, about
MOST_PARTS = 1 << 20  # copies of a block
LONG = np.iinfo(np.int64)


def finite(vector: Column) -> Column:
    """Whether there is a vector and all its components are finite; an empty one counts, a null one does not."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(whole, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component, as long; a component beyond long ends at its limit."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * STEPS))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists of longs."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(lists):
        return np.zeros((0, 0), np.int64)
    flat = np.asarray(lists.flatten()).astype(np.int64, copy=False)
    return flat.reshape(len(lists), len(flat) // len(lists))


def largest(rows: np.ndarray) -> int:
    """Largest absolute component, exact for every long."""
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


def as_longs(values: np.ndarray) -> np.ndarray:
    """Exact whole numbers of any kind as longs; what is beyond long ends at its limit."""
    if values.dtype == object:
        values = np.clip(values, int(LONG.min), int(LONG.max))
    return values.astype(np.int64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of longs.

    In doubles while every partial sum is below 2**53, in longs below 2**63, in unbounded integers beyond.
    """
    most = left.shape[1] * largest(left) * largest(right)
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return left @ right.T
    return as_longs(left.astype(object) @ right.astype(object).T)


def leading(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, ties to the smaller id."""
    near = np.arange(len(scores))
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], ~scores[near]))[:k]]  # ~ turns the order around without leaving long


def in_blocks(scratch: Scratch, rows: DataFrame, order: list[str], cut: list[str], name: str) -> DataFrame:
    """``rows`` sorted over all tasks by ``order`` and numbered in blocks (column ``block``, from 0, no gaps).

    A block never spans two values of the columns ``cut``, all of them long or int; ``size``, the vector length,
    must be among them: a block has about BLOCK_VALUES components, and at least one row. One count per partition
    passes through the driver.
    """
    fields = [*rows.schema.fieldNames(), "_part", "_place"]
    shape = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema) + ", _part int, _place long"

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, left, before = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(column)).astype(np.int64) for column in cut], axis=1)
            places = np.empty(len(keys), np.int64)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for at, end in zip(edges[:-1], edges[1:]):
                key = tuple(keys[at])
                if key != before:
                    before, left = key, 0
                room = max(1, BLOCK_VALUES // max(1, int(keys[at][cut.index("size")])))
                while at < end:
                    if not left:
                        place, left = place + 1, room
                    taken = min(left, end - at)
                    places[at : at + taken] = place
                    at, left = at + taken, left - taken
            columns = [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(places)]
            yield pa.RecordBatch.from_arrays(columns, fields)

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.store(sorted_rows.mapInArrow(numbered, shape), f"{name}-placed")
    counts = sorted(placed.groupBy("_part").agg(F.max("_place") + 1).collect())  # a row per partition
    offsets, total = [], 0
    for part, count in counts:
        offsets.append((part, total))
        total += count
    before = placed.sparkSession.createDataFrame(offsets, "_part int, _before long")
    block = (F.col("_before") + F.col("_place")).alias("block")
    return placed.join(F.broadcast(before), "_part").select(block, *rows.columns)


Work = Callable[[pa.Table, pa.Table], pa.Table | None]


def meet(scratch: Scratch, blocks: DataFrame, visits: DataFrame, asks: DataFrame, work: Work, shape: str) -> DataFrame:
    """What ``work(rows of a block, its queries)`` finds for every block and the queries that visit it.

    ``blocks`` holds the rows by ``block``, ``visits`` (block, ask) says which query goes where, ``asks`` (ask, x,
    ...) what a query carries. A block's rows are moved once, or once for every MOST_ASKS queries; a task holds one
    block and that many queries.
    """
    parts = visits.groupBy("block").agg(F.ceil(F.count("*") / MOST_ASKS).cast("int").alias("parts"))
    parts = scratch.store(parts, "parts")
    rows = blocks.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = visits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("ask"), F.col("parts")).cast("int")).join(asks, "ask")
    row, asked = (F.struct(*[name for name in side.columns if name not in ("block", "part", "parts")]) for side in (rows, sent))
    row_type, asked_type = rows.select(row).schema[0].dataType, sent.select(asked).schema[0].dataType
    rows = rows.select("block", "part", row.alias("row"), F.lit(None).cast(asked_type).alias("asked"))
    sent = sent.select("block", "part", F.lit(None).cast(row_type).alias("row"), asked.alias("asked"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "run"):
            for a, b in run_bounds(table.column("run").to_numpy()):
                sides = [table.slice(a, b - a).column(name).combine_chunks() for name in ("row", "asked")]
                here, asking = (pa.Table.from_struct_array(side.filter(side.is_valid())) for side in sides)
                out = work(here, asking) if here.num_rows and asking.num_rows else None
                if out is not None and out.num_rows:
                    yield from out.combine_chunks().to_batches()

    both = rows.unionByName(sent).repartition("block", "part").sortWithinPartitions("block", "part")
    run = F.col("block") * MOST_PARTS + F.col("part")  # one long that tells the runs apart
    return both.select(run.alias("run"), "row", "asked").mapInArrow(found, shape)
