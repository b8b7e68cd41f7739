"""Hard negatives by Kronecker-packed products.

Components are whole numbers, so several inner products can be had from one multiplication: the components of a
few candidates, raised to be non-negative, are put side by side as separated fields of one wide integer. An anchor's
components, raised too, multiply these words, the products are summed, and every field of the sum is the exact inner
product of one candidate, once the known share of the raising is taken off (``packed_products``). Fields are as wide
as the largest possible sum needs, so none runs into its neighbour. Words of up to 53 bits are multiplied as doubles,
which are exact there, up to 63 bits as longs, and wider ones as unbounded integers.

Rows lie in blocks sorted by label. A first pass sends an anchor to the blocks that hold its own label and keeps its
best ``POSITIVES``; a second one sends it, with their scores, to every block and keeps for each positive the best
``NEGATIVES`` of other labels whose score lies between ``LEAST_PERCENT`` of the positive's and the positive's. Every
block returns a few rows per anchor and positive, and a grouped limit merges them.

* rows with a null label, vec_id or vector, or with null or non-finite components, take no part;
* vectors of another length never meet; zero and empty vectors score 0;
* higher scores come first, ties by smaller vec_id; repeated rows and ids are rows of their own, an anchor is only
  left out of its own positives; a repeated anchor answers once for each row;
* a positive with a negative score has no negatives, as the bounds exclude each other;
* scores beyond long end at its limits; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import Scratch
from ledgerloom.llm.whole_vectors import as_longs, finite, in_blocks, largest, leading, matrix, meet, whole_numbers

EVERY, POSITIVES, NEGATIVES, LEAST_PERCENT = 100, 5, 5, 80
WIDE_FIELDS = 8
CHUNK = 512


def shifted_label(vec_id: Column, label: Column) -> Column:
    """The label the contract asks for: every seventh row is moved to the next of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of longs, several candidates to a multiplication."""
    if not anchors.size or not candidates.size:
        return np.zeros((len(anchors), len(candidates)), np.int64)
    # sums, also those of what was added, stay in long; otherwise they are unbounded integers
    small = 8 * anchors.shape[1] * (largest(anchors) + 1) * (largest(candidates) + 1) < 1 << 63
    whole = np.int64 if small else object
    anchors, candidates = anchors.astype(whole), candidates.astype(whole)
    low_anchor, low_candidate = anchors.min(axis=0), candidates.min(axis=0)
    raised, fields = anchors - low_anchor, candidates - low_candidate
    most = sum(int(a) * int(c) for a, c in zip(raised.max(axis=0), fields.max(axis=0)))
    width = max(1, most.bit_length())
    if 2 * width <= 53:
        count, kind = 53 // width, np.float64
    elif 2 * width <= 63:
        count, kind = 2, np.int64
    else:
        count, kind = WIDE_FIELDS, object
    words = -(-len(fields) // count)
    padded = np.zeros((words * count, fields.shape[1]), fields.dtype)
    padded[: len(fields)] = fields
    packed = np.zeros((words, fields.shape[1]), kind)
    for place in range(count):
        # candidates of a word follow each other, the first in the lowest field
        packed = packed + padded[place::count].astype(kind) * (1 << width * place)
    sums = raised.astype(kind) @ packed.T
    sums = sums.astype(np.int64) if kind is np.float64 else sums
    mask = (1 << width) - 1
    found = np.stack([(sums >> (width * place)) & mask for place in range(count)], axis=2)
    found = found.reshape(len(anchors), words * count)[:, : len(fields)]
    return as_longs(found + fields @ low_anchor + (anchors @ low_candidate)[:, None])


def _positives(k: int):
    """The k best of an anchor's own label in a block."""

    def search(rows: pa.Table, asks: pa.Table) -> pa.Table | None:
        labels, nodes, ids = (rows.column(name).to_numpy() for name in ("label", "node", "vec_id"))
        asking, wanted = asks.column("ask").to_numpy(), asks.column("label").to_numpy()
        vectors, anchors = matrix(rows.column("x")), matrix(asks.column("x"))
        out = []
        for label in np.unique(wanted):
            same = np.flatnonzero(labels == label)
            those = np.flatnonzero(wanted == label)
            for at in range(0, len(those), CHUNK):
                some = those[at : at + CHUNK]
                for ask, line in zip(asking[some], packed_products(anchors[some], vectors[same])):
                    others = np.flatnonzero(nodes[same] != ask)
                    best = others[leading(line[others], ids[same][others], k)]
                    out.append((np.full(len(best), ask), ids[same][best], nodes[same][best], line[best]))
        return _table(out, ["ask", "vec_id", "node", "score"])

    return search


def _negatives(k: int, percent: int):
    """For each positive of an anchor the k best of other labels whose score lies within its bounds."""

    def search(rows: pa.Table, asks: pa.Table) -> pa.Table | None:
        labels, nodes, ids = (rows.column(name).to_numpy() for name in ("label", "node", "vec_id"))
        asking, wanted = asks.column("ask").to_numpy(), asks.column("label").to_numpy()
        scores = [np.array(one, np.int64) for one in asks.column("scores").to_pylist()]
        vectors, anchors = matrix(rows.column("x")), matrix(asks.column("x"))
        out = []
        for at in range(0, len(asking), CHUNK):
            for row, line in enumerate(packed_products(anchors[at : at + CHUNK], vectors), start=at):
                lowest = [-(-percent * int(positive) // 100) for positive in scores[row]]
                near = np.flatnonzero((line >= min(lowest)) & (line <= scores[row].max()) & (labels != wanted[row]))
                for place, (low, high) in enumerate(zip(lowest, scores[row].tolist())):
                    within = near[(line[near] >= low) & (line[near] <= high)]
                    best = within[leading(line[within], ids[within], k)]
                    found = np.full(len(best), asking[row]), np.full(len(best), place, np.int32)
                    out.append((*found, ids[best], nodes[best], line[best]))
        return _table(out, ["ask", "place", "vec_id", "node", "score"])

    return search


def _table(found: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.Table | None:
    return pa.table([pa.array(np.concatenate(column)) for column in zip(*found)], names=names) if found else None


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every ``every``-th vec_id."""
    scratch = Scratch(vectors.sparkSession)
    vec_id, label = vectors["vec_id"].cast("long"), vectors["label"].cast("long")
    rows = vectors.where(finite(vectors["embedding"]) & label.isNotNull() & vec_id.isNotNull()).select(
        F.monotonically_increasing_id().alias("node"),
        vec_id.alias("vec_id"),
        label.alias("label"),
        F.size(vectors["embedding"]).alias("size"),
        whole_numbers(vectors["embedding"]).alias("x"),
    )
    rows = scratch.store(rows, "rows")  # numbers a row once and for all
    blocks = scratch.store(in_blocks(scratch, rows, ["size", "label", "node"], ["size"], "blocks"), "blocks")
    candidates = blocks.select("block", "node", "vec_id", "label", "x")
    anchors = rows.where(F.col("vec_id") % every == 0).select(
        F.col("node").alias("ask"), F.col("vec_id").alias("anchor_id"), "label", "size", "x"
    )
    anchors = scratch.store(anchors, "anchors")
    carried = anchors.select("ask", "label", "x")

    # an anchor's own label, then its best rows as one list, in their order
    labels = blocks.select("size", "label", "block").distinct()
    visits = scratch.store(anchors.select("ask", "size", "label").join(labels, ["size", "label"]).select("block", "ask"), "visits")
    shape = "ask long, vec_id long, node long, score long"
    near = meet(scratch, candidates, visits, carried, _positives(positives), shape)
    order = [F.desc("score"), F.col("vec_id"), F.col("node")]
    place = F.row_number().over(Window.partitionBy("ask").orderBy(*order)) - 1
    near = near.withColumn("place", place).where(F.col("place") < positives)
    near = scratch.store(near.select("ask", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "near")
    bounds = near.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("list"))
    bounds = bounds.select("ask", F.col("list.positive_score").alias("scores"))

    # every block of the anchor's length: their numbers follow each other
    spans = blocks.groupBy("size").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    visits = anchors.select("ask", "size").join(near.select("ask").distinct(), "ask", "left_semi").join(spans, "size")
    visits = scratch.store(visits.select(F.explode(F.sequence("low", "high")).alias("block"), "ask"), "visits")
    shape = "ask long, place int, vec_id long, node long, score long"
    far = meet(scratch, candidates, visits, carried.join(bounds, "ask"), _negatives(negatives, least_percent), shape)
    rank = F.row_number().over(Window.partitionBy("ask", "place").orderBy(*order))
    far = far.withColumn("rank", rank).where(F.col("rank") <= negatives).join(near, ["ask", "place"])
    return far.join(anchors.select("ask", "anchor_id"), "ask").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
