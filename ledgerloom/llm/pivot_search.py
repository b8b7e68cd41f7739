"""Exact top-k by integer inner product over a pivot-distance index.

Every vector gets one more component that lifts it to the length of the longest, and a query a zero: then the
largest inner product is the least distance. Pivots are taken farthest first from a bounded sample (``SAMPLE``
vectors of each length); every vector is keyed by its nearest pivot and its distance to it, sorted by that key and
cut into annuli: runs of neighbouring distances around one pivot. A query starts in the annulus of its own nearest
pivot at its own distance. That bounds its worst answer, and with it the distances that can still matter: by the
triangle inequality an annulus whose distances all differ from the query's by more than that holds no answer. The
query then expands ring by ring (``RINGS``) over the annuli of all pivots, its bound tightened after every ring, and
stops when none is left that could hold an answer. The index prunes, it never decides: scores are exact, and bounds
carry a margin (``SLACK``) for rounding, so ties at the bound are looked at.

On vectors without structure all distances are alike and hardly an annulus is excluded; the search is then a scan
of all rows in blocks. Equal vectors are indexed once, with their k + 1 smallest ids, which are all that can be among
k answers; equal queries ask once.

* vectors that are null or hold null or non-finite components take no part, nor do rows without a vec_id;
* vectors of another length never meet; zero and empty vectors score 0 with all of their length;
* ties go to the smaller vec_id; repeated ids are each other's candidates, and each repeated query row answers;
* scores beyond long end at its limits; fewer candidates than k give shorter lists; an empty table gives none;
* other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import Scratch
from ledgerloom.llm.whole_vectors import LONG, finite, in_blocks, leading, matrix, meet, products, whole_numbers

EVERY, ANSWERS = 50, 5
SAMPLE, PIVOTS = 2048, 64
ROWS_PER_PIVOT = 512
RINGS = (0.5, 1.0)  # shares of the distance that can still matter
SLACK = 1e-6

#: For every vector length: the pivots, lifted, and the length of the longest vector.
Index = dict[int, tuple[np.ndarray, float]]


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    points = vectors.astype(np.float64)
    return np.hstack([points, np.sqrt(np.maximum(longest**2 - (points**2).sum(axis=1), 0))[:, None]])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each the farthest from those before; fewer if the points repeat."""
    chosen = [0]
    away = distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        far = int(away.argmax())
        if away[far] <= 0:
            break
        chosen.append(far)
        away = np.minimum(away, distances(points, points[far : far + 1])[:, 0])
    return points[chosen]


def fit(distinct: DataFrame) -> Index:
    """Pivots from at most SAMPLE vectors of each length, by the order of their hash."""
    square = F.aggregate("x", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    sizes = distinct.groupBy("size").agg(F.count("*").alias("rows"), F.sqrt(F.max(square)).alias("longest")).collect()
    place = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64("x"), "node"))
    sample = distinct.select("size", "x", place.alias("place")).where(F.col("place") <= SAMPLE).orderBy("size", "place").collect()
    index: Index = {}
    for row in sizes:
        members = [one["x"] for one in sample if one["size"] == row["size"]]
        points = np.array(members, np.int64).reshape(len(members), row["size"])
        count = min(PIVOTS, row["rows"] // ROWS_PER_PIVOT + 1)
        index[row["size"]] = farthest_first(lift(points, row["longest"]), count), row["longest"]
    return index


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, nodes, vectors) of every batch of (node, size, x)."""
    for batch in batches:
        sizes = np.asarray(batch.column("size"))
        for size in np.unique(sizes):
            some = batch.filter(pa.array(sizes == size))
            yield int(size), some.column("node"), matrix(some.column("x"))


def _keyed(index: Index):
    """Nearest pivot of every vector and the distance to it."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, nodes, vectors in _by_size(batches):
            pivots, longest = index[size]
            away = distances(lift(vectors, longest), pivots)
            nearest = away.argmin(axis=1)
            columns = [nodes, pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(away)), nearest])]
            yield pa.RecordBatch.from_arrays(columns, ["node", "pivot", "away"])

    return keyed


def _reach(index: Index):
    """Distance of every query to every pivot, and whether that is its nearest."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, nodes, vectors in _by_size(batches):
            pivots, longest = index[size]
            away = distances(np.hstack([vectors.astype(np.float64), np.zeros((len(vectors), 1))]), pivots)
            square = (vectors.astype(np.float64) ** 2).sum(axis=1) + longest**2
            count = len(pivots)
            home = np.zeros(away.shape, bool)
            home[np.arange(len(away)), away.argmin(axis=1)] = True
            columns = [
                pa.array(np.repeat(np.asarray(nodes), count)),
                pa.array(np.full(away.size, size, np.int32)),
                pa.array(np.tile(np.arange(count, dtype=np.int32), len(vectors))),
                pa.array(away.ravel()),
                pa.array(home.ravel()),
                pa.array(np.repeat(square, count)),
                pa.array(np.full(away.size, longest * SLACK)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["ask", "size", "pivot", "away", "home", "square", "slack"])

    return reached


def _searched(k: int):
    """The k best rows of an annulus for each of its queries, of those that reach the query's worst answer so far."""

    def search(rows: pa.Table, asks: pa.Table) -> pa.Table:
        vectors, nodes, first = matrix(rows.column("x")), rows.column("node").to_numpy(), rows.column("first").to_numpy()
        asking, least = asks.column("ask").to_numpy(), asks.column("least").to_numpy()
        wanted = matrix(asks.column("x"))
        out = []
        for at in range(0, len(asking), 512):
            scores = products(wanted[at : at + 512], vectors)
            for row, line in enumerate(scores, start=at):
                near = np.flatnonzero(line >= least[row])
                near = near[leading(line[near], first[near], k)]
                out.append((np.full(len(near), asking[row]), nodes[near], first[near], line[near]))
        columns = [pa.array(np.concatenate(column)) for column in zip(*out)]
        return pa.table(columns, names=["ask", "node", "first", "score"])

    return search


def search(vectors: DataFrame, every: int = EVERY, k: int = ANSWERS) -> DataFrame:
    """The k best of all other rows for each whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.where(finite(vectors["embedding"]) & vectors["vec_id"].isNotNull()).select(
        vectors["vec_id"].cast("long").alias("vec_id"), whole_numbers(vectors["embedding"]).alias("x")
    )
    # the limit works before the shuffle, so a vector with very many copies does not meet in one task
    among = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    distinct = rows.withColumn("among", among).where(F.col("among") <= k + 1).groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = distinct.select(
        F.monotonically_increasing_id().alias("node"), F.size("x").alias("size"), "x", F.get("ids", F.lit(0)).alias("first"), "ids"
    )
    distinct = scratch.store(distinct, "distinct")
    of = distinct.select("node", F.col("x").alias("of"))
    names = rows.where(F.col("vec_id") % every == 0).join(of, F.col("x") == F.col("of")).select(F.col("vec_id").alias("query_id"), F.col("node").alias("own"))
    names = scratch.store(names, "names")
    asks = distinct.select("node", "size", "x").join(names.select(F.col("own").alias("node")).distinct(), "node", "left_semi")
    asks = scratch.store(asks, "asks")

    index = fit(distinct)
    slim = distinct.select("node", "size", "x")
    keys = slim.mapInArrow(_keyed(index), "node long, pivot int, away double")
    indexed = distinct.select("node", "size", "first", "x").join(keys, "node")
    indexed = scratch.store(
        in_blocks(scratch, indexed, ["size", "pivot", "away", "node"], ["size", "pivot"], "index"), "annuli"
    )
    annuli = indexed.groupBy("size", "pivot", "block").agg(F.min("away").alias("low"), F.max("away").alias("high"))
    annuli = scratch.store(annuli, "bounds")
    reach = scratch.store(
        asks.mapInArrow(_reach(index), "ask long, size int, pivot int, away double, home boolean, square double, slack double"), "reach"
    )
    # how far an annulus is from a query at least
    gap = F.greatest(F.lit(0.0), F.col("away") - F.col("high"), F.col("low") - F.col("away"))
    carried = asks.select(F.col("node").alias("ask"), "x")
    shape = "ask long, node long, first long, score long"
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "first", "node")
    blocks = indexed.select("block", "node", "first", "x")

    # the annulus at the query's own distance from its nearest pivot
    start = reach.where("home").join(annuli, ["size", "pivot"]).withColumn("gap", gap)
    start = scratch.store(start.groupBy("ask").agg(F.min_by("block", F.struct("gap", "block")).alias("block")), "start")
    best = meet(scratch, blocks, start.select("block", "ask"), carried.withColumn("least", F.lit(int(LONG.min))), _searched(k + 1), shape)
    best = scratch.store(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place"), "best")
    seen = reach.select("ask").distinct().withColumn("done", F.lit(-1.0))  # gaps looked at so far
    for ring in RINGS:
        worst = best.groupBy("ask").agg(F.min("score").alias("least"), F.count("*").alias("found")).where(F.col("found") > k)
        known = seen.join(worst, "ask", "left").select("ask", "done", F.coalesce("least", F.lit(int(LONG.min))).alias("least"), "found")
        known = scratch.store(known, "known")
        # a query with too few answers looks everywhere
        matters = F.sqrt(F.greatest(F.col("square") - 2 * F.col("least").cast("double"), F.lit(0.0))) + F.col("slack")
        upto = F.when(F.col("found").isNull(), F.lit(float("inf"))).otherwise(matters * ring)
        open_ = reach.join(known, "ask").withColumn("upto", upto)
        visits = open_.join(annuli, ["size", "pivot"]).withColumn("gap", gap).where("gap <= upto AND gap > done").select("block", "ask")
        visits = scratch.store(visits.join(start, ["block", "ask"], "left_anti"), "visits")
        more = meet(scratch, blocks, visits, carried.join(known.select("ask", "least"), "ask"), _searched(k + 1), shape)
        best = best.unionByName(more).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")
        best = scratch.store(best, "best")
        seen = scratch.store(open_.groupBy("ask").agg(F.greatest(F.max("upto"), F.max("done")).alias("done")), "seen")

    ids = distinct.select("node", F.explode("ids").alias("id"))
    ranks = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "id", "node"))
    answers = best.join(ids, "node").withColumn("place", ranks).where(F.col("place") <= k + 1)
    hit = F.struct("place", "node", F.col("id").alias("vec_id"), "score")
    answers = answers.groupBy("ask").agg(F.sort_array(F.collect_list(hit)).alias("answer"))
    answers = scratch.store(answers, "answers")  # so that the join of a query with very many copies can be split
    own = F.transform("answer", lambda one: (one["node"] == F.col("own")) & (one["vec_id"] == F.col("query_id")))
    others = F.filter("answer", lambda one, at: at + 1 != F.col("itself"))
    found = names.join(answers, F.col("own") == F.col("ask")).withColumn("itself", F.array_position(own, True))
    found = found.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
    return found.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
