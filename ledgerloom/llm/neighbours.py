"""Approximate nearest neighbours over shifted Hilbert curves.

Vectors get one more component that makes largest inner product the same as least distance. ``CURVES`` random
rotations, each shifted, project them to a few dimensions and order them along a Hilbert curve; Spark sorts
every curve by range partitioning. A query looks at the vectors within a window around its place on each
curve; the windows of all curves are merged and ranked by the exact inner product. Only candidates have ranks
on the curves, a query stands at the rank of the candidate before it, so queries never push candidates away.

The window is measured, not guessed: for ``MEASURED`` queries the true neighbours are found by a scan of all
vectors, and the window is the distance along the nearest curve that covers ``COVERED`` of them. On data
without structure it is a fixed share of the vectors and the search costs as much as a scan; it never misses
its recall silently. Places are cut into blocks of as many vectors as the window holds, at most ``CELLS``
numbers. A task holds the vectors of one block once and streams the queries past them; only a block that more
than ``SLOT`` queries look at is copied, once for each further ``SLOT`` of them.

* vectors that are null, empty, zero or hold null or non-finite components neither ask nor are found;
* vectors of every length are searched among their own length, each length with its own curves and window; the
  lengths of which a least window holds all vectors need no curve and are searched together;
* of equal vectors only the 21 smallest ids can be among 20 neighbours, the others are left out before the
  search (a grouped limit, not a sample); equal queries ask once, and each gets the answer without itself;
* ties go to the smaller vec_id; a null vec_id is not searched; repeated ids are each other's candidates;
* an empty table gives an empty result; fewer candidates than neighbours give shorter lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import Scratch, run_bounds
from ledgerloom.llm.embeddings import unit_vectors, usable

NEIGHBOURS = 20
CURVES = 8
DIMENSIONS, BITS = 6, 10
MEASURED = 128
COVERED = 0.97
LEAST_WINDOW, SLOT = 256, 65536
#: numbers of a block of vectors, and of the products made at a time: 32 MB in double precision
CELLS = 1 << 22
SEED = 5
TIE = 1e-9


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of every cell (rows of ``bits``-bit coordinates) on a Hilbert curve.

    Coordinates are turned into the transposed index from the highest bit down: each step reflects or swaps
    the lower bits by the quadrant the higher ones lie in; a Gray code and an interleaving follow.
    """
    x = cells.astype(np.uint64).copy()
    size = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, lower = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for axis in range(size):
            inside = (x[:, axis] & bit) == 0
            swap = np.where(inside, (x[:, 0] ^ x[:, axis]) & lower, np.uint64(0))
            x[:, 0] ^= np.where(inside, swap, lower)
            x[:, axis] ^= swap
    for axis in range(1, size):
        x[:, axis] ^= x[:, axis - 1]
    turned = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[:, -1] >> np.uint64(level)) & np.uint64(1) == 1, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turned[:, None]
    place = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(size):
            place = (place << np.uint64(1)) | ((x[:, axis] >> np.uint64(level)) & np.uint64(1))
    return place.astype(np.int64)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, summed in one fixed order, so that equal vectors tie exactly."""
    return (queries * vectors).sum(axis=1)


def best(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, ids: np.ndarray, k: int):
    """(query row, vector row, score) of the k best of ``vectors`` for each query, without the query's own row.

    A matrix product picks what may be among them, with a margin for its rounding; the exact scores decide.
    """
    out = []
    rough = queries @ vectors.T
    rough[own[:, None] == nodes[None, :]] = -np.inf
    for row in range(len(queries)):
        line = rough[row]
        if len(line) > k:
            least = np.partition(line, len(line) - k)[len(line) - k]
            near = np.flatnonzero(line >= least - TIE * max(1.0, abs(least)))
        else:
            near = np.arange(len(line))
        near = near[np.isfinite(line[near])]
        exact = scores(np.broadcast_to(queries[row], (len(near), queries.shape[1])), vectors[near])
        kept = np.lexsort((ids[near], -exact))[:k]
        out.append((np.full(len(kept), row), near[kept], exact[kept]))
    return [np.concatenate(column) for column in zip(*out)] if out else [np.zeros(0, int)] * 3


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    groups = unit_vectors(column)
    return groups[0][1] if groups else np.zeros((0, 0))


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives all of them the length of the longest one."""
    return np.hstack([vectors, np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1, keepdims=True), 0))])


def _moments(longest: float):
    """Number, mean and squared distances of every component of a partition."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, squares = 0, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _lifted(_matrix(batch.column(0)), longest)
            new, centre = len(points), points.mean(axis=0)
            squares = squares + ((points - centre) ** 2).sum(axis=0) + (centre - mean) ** 2 * (count * new / (count + new))
            mean, count = mean + (centre - mean) * (new / (count + new)), count + new
        if count:
            columns = [pa.array(np.arange(len(mean), dtype=np.int32)), pa.array(np.full(len(mean), count)), pa.array(mean), pa.array(squares)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "n", "mean", "squares"])

    return summed


def _spread(found: DataFrame, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the lifted components; a row per partition and component is aggregated."""
    parts = found.select("vector").mapInArrow(_moments(longest), "at int, n long, mean double, squares double")
    here = Window.partitionBy("at")
    parts = parts.withColumn("all", F.sum(F.col("n") * F.col("mean")).over(here) / F.sum("n").over(here))
    apart = F.col("n") * (F.col("mean") - F.col("all")) * (F.col("mean") - F.col("all"))
    sums = parts.groupBy("at").agg(F.first("all").alias("mean"), F.sqrt(F.sum(F.col("squares") + apart) / F.sum("n")).alias("spread"))
    sums = sorted(sums.collect())  # a row per component
    return np.array([row["mean"] for row in sums]), np.array([row["spread"] for row in sums])


def _places(size: int, longest: float, mean: np.ndarray, scale: np.ndarray):
    """Curve keys of a batch: a candidate where it stands, a query at the place it looks from."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(SEED)
        frames = []
        for curve in range(CURVES):
            rotation = np.linalg.qr(random.standard_normal((size + 1, size + 1)))[0][:, :DIMENSIONS]
            frames.append((rotation, random.uniform(-0.5, 0.5, rotation.shape[1])))
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, kinds = _matrix(batch.column("vector")), batch.column("kind").to_numpy()
            lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
            looking = np.hstack([vectors / lengths * longest, np.zeros_like(lengths)])
            points = np.where(kinds[:, None] == 0, _lifted(vectors, longest), looking)
            for curve, (rotation, shift) in enumerate(frames):
                flat = ((points - mean) @ rotation) / np.sqrt(np.maximum((scale**2) @ rotation**2, 1e-300))
                cells = np.clip((flat + shift + 4) / 8, 0, 1 - 1e-9) * (1 << BITS)
                columns = [pa.array(np.full(len(points), curve, np.int32)), pa.array(hilbert(np.floor(cells), BITS))]
                columns += [batch.column("kind"), batch.column("node")]
                yield pa.RecordBatch.from_arrays(columns, ["curve", "place", "kind", "node"])

    return placed


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of candidates up to every row of a sorted partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        rank = before + np.cumsum(batch.column("kind").to_numpy() == 0)
        before = int(rank[-1]) if len(rank) else before
        columns = [pa.array(np.full(len(rank), part)), *[batch.column(name) for name in ("curve", "kind", "node")], pa.array(rank)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "curve", "kind", "node", "rank"])


def _measured_best(queries: np.ndarray, names: np.ndarray, own: np.ndarray, k: int):
    """The best of each batch for a few given queries."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            asked, found, exact = best(queries, own, _matrix(batch.column(1)), nodes, ids, k)
            columns = [pa.array(names[asked]), pa.array(nodes[found]), pa.array(ids[found]), pa.array(exact)]
            yield pa.RecordBatch.from_arrays(columns, ["asked", "node", "vec_id", "score"])

    return scanned


def _met(k: int):
    """The best of every block for the queries that look at it; rows come sorted by cell, candidates first.

    Only the candidates of one cell are held, as a matrix; its queries pass in batches.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            for low, high in run_bounds(cells * 2 + kinds):
                some = batch.slice(low, high - low)
                if cells[low] != cell:
                    cell, held, block = cells[low], [], None
                if kinds[low] == 0:
                    held.append(some)
                    continue
                if held:
                    rows, held = pa.Table.from_batches(held), []
                    block = _matrix(rows.column("vector")), rows.column("node").to_numpy(), rows.column("vec_id").to_numpy()
                if block is None:
                    continue
                vectors, nodes, ids = block
                asks, names = _matrix(some.column("vector")), some.column("node").to_numpy()
                step = max(1, min(512, CELLS // len(nodes)))
                for at in range(0, len(names), step):
                    asking = names[at : at + step]
                    none = np.full(len(asking), -1)  # own rows are taken out where the copies of a query are joined back
                    asked, hit, exact = best(asks[at : at + step], none, vectors, nodes, ids, k)
                    columns = [pa.array(asking[asked]), pa.array(nodes[hit]), pa.array(ids[hit]), pa.array(exact)]
                    yield pa.RecordBatch.from_arrays(columns, ["asked", "node", "vec_id", "score"])

    return search


FOUND = "asked long, node long, vec_id long, score double"


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "node"))


def _hits(candidates: DataFrame, looks: DataFrame, k: int) -> DataFrame:
    """The best candidates of every cell for each query that looks at it (columns cell, node, vec_id, vector)."""
    both = candidates.withColumn("kind", F.lit(0)).unionByName(looks.withColumn("kind", F.lit(1)))
    both = both.select("cell", "kind", "node", "vec_id", "vector").repartition("cell")
    return both.sortWithinPartitions("cell", "kind").mapInArrow(_met(k + 1), FOUND)


def _window(scratch: Scratch, found: DataFrame, queries: DataFrame, placed: DataFrame, k: int, covered: float) -> int | None:
    """Steps along the nearest curve that cover the true neighbours of a few queries; None without a query."""
    few = queries.orderBy(F.xxhash64("vector"), "node").limit(MEASURED).collect()
    if not few:
        return None
    names = [row["node"] for row in few]
    # one candidate of each stands for the query itself, which is not its own neighbour
    selves = found.where(F.col("same").isin(names)).groupBy("same").agg(F.min("node").alias("node"))
    selves = {row["same"]: row["node"] for row in selves.collect()}
    own = np.array([selves[name] for name in names], np.int64)
    asked = np.array([row["vector"] for row in few], np.float64)
    scanned = found.select("node", "vector", "vec_id").mapInArrow(_measured_best(asked, np.array(names, np.int64), own, k), FOUND)
    truth = scanned.withColumn("rank", _rank()).where(F.col("rank") <= k).select("asked", F.col("node").alias("hit"))
    truth = scratch.store(truth, "truth")  # MEASURED x k rows
    from_there = placed.where("kind = 1").join(F.broadcast(truth), F.col("node") == F.col("asked"))
    from_there = from_there.select("asked", "hit", F.col("curve").alias("on"), F.col("at").alias("from"))
    there = placed.where("kind = 0").join(
        F.broadcast(scratch.store(from_there, "from")), (F.col("node") == F.col("hit")) & (F.col("curve") == F.col("on"))
    )
    steps = there.groupBy("asked", "hit").agg(F.min(F.abs(F.col("at") - F.col("from"))).alias("steps"))
    return max(LEAST_WINDOW, int(steps.agg(F.percentile("steps", covered)).first()[0] or 0) + 1)


def _ranks(scratch: Scratch, found: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """(curve, kind, node, at): candidates numbered along the curves, queries at the candidate before them."""
    lengths = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    longest = found.select(F.max(lengths)).first()[0]
    points = found.select("node", "vector", F.lit(0).alias("kind")).unionByName(queries.select("node", "vector", F.lit(1).alias("kind")))
    shape = "curve int, place long, kind int, node long"
    placed = points.mapInArrow(_places(size, longest, *_spread(found, longest)), shape)
    order = ["curve", "place", "kind", "node"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.store(placed.mapInArrow(_ranked, "part long, curve int, kind int, node long, rank long"), "places")
    before, total = [], 0
    for number, count in sorted(placed.groupBy("part").agg(F.max("rank")).collect()):  # a row per partition
        before.append((number, total))
        total += count
    offsets = found.sparkSession.createDataFrame(before, "part long, before long")
    placed = placed.join(F.broadcast(offsets), "part")
    return scratch.store(placed.select("curve", "kind", "node", (F.col("before") + F.col("rank")).alias("at")), "ranked")


def _curve_hits(scratch: Scratch, found: DataFrame, queries: DataFrame, size: int, k: int, covered: float) -> DataFrame | None:
    """What the queries of one length see in their windows; None without a query."""
    placed = _ranks(scratch, found, queries, size)
    window = _window(scratch, found, queries, placed, k, covered)
    if window is None:
        return None
    block = max(1, min(window, CELLS // size))
    first, last = F.floor((F.col("at") - window) / block), F.floor((F.col("at") + window) / block)
    looks = placed.where("kind = 1").select("curve", "node", F.explode(F.sequence(first, last)).alias("block"))
    looks = scratch.store(looks.select((F.col("block") * CURVES + F.col("curve")).alias("cell"), "node"), "looks")
    lists = placed.where("kind = 0").select((F.floor(F.col("at") / block) * CURVES + F.col("curve")).alias("cell"), "node")
    # cells at which very many queries look are split, and only they are copied
    busy = looks.groupBy("cell").agg(F.ceil(F.count("*") / SLOT).alias("slots")).where("slots > 1")
    busy = scratch.store(busy, "busy")
    most = (busy.agg(F.max("slots")).first()[0] or 1) + 1
    slots = F.coalesce("slots", F.lit(1))
    cell = lambda slot: (F.col("cell") * most + slot).alias("cell")
    lists = lists.join(busy, "cell", "left").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)))
    lists = lists.select(cell(F.col("slot")), "node").join(found.select("node", "vec_id", "vector"), "node")
    looks = looks.join(busy, "cell", "left").select(cell(F.pmod(F.xxhash64("node"), slots)), "node")
    looks = looks.join(queries.select("node", F.lit(-1).cast("long").alias("vec_id"), "vector"), "node")  # no id is read
    return _hits(lists, looks, k)


def search(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, covered: float = COVERED) -> DataFrame:
    """The k nearest of all vectors for each whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # of equal vectors only the k + 1 smallest ids can be neighbours; the limit works before the shuffle
    same = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    tops = rows.withColumn("among", same).where(F.col("among") <= k + 1).groupBy("vector").agg(F.max("vec_id").alias("top"))
    tops = tops.withColumnRenamed("vector", "of").withColumn("same", F.monotonically_increasing_id())
    tops = scratch.store(tops, "tops")
    rows = rows.join(tops, F.col("vector") == F.col("of")).select(
        "same", "vec_id", "vector", (F.col("vec_id") % every == 0).alias("asks"), (F.col("vec_id") <= F.col("top")).alias("found")
    )
    rows = scratch.store(rows.where("asks OR found").withColumn("node", F.monotonically_increasing_id()), "vectors")
    names = rows.where("asks").select("same", F.col("node").alias("own"), F.col("vec_id").alias("query_id"))
    queries = tops.join(names.select("same").distinct(), "same", "left_semi")
    queries = scratch.store(queries.select(F.col("same").alias("node"), F.col("of").alias("vector")), "queries")

    # every length by itself; those whose vectors a least window holds need no curve
    size, found = F.size("vector"), rows.where("found")
    sizes = found.groupBy(size.alias("size")).count().where(F.col("count") > LEAST_WINDOW)
    sizes = sorted(row["size"] for row in sizes.collect())
    few = ~size.isin(sizes) if sizes else F.lit(True)
    cell = size.cast("long").alias("cell")
    looks = queries.where(few).select(cell, "node", F.lit(-1).cast("long").alias("vec_id"), "vector")
    hits = _hits(found.where(few).select(cell, "node", "vec_id", "vector"), looks, k)
    for length in sizes:
        more = _curve_hits(scratch, found.where(size == length), queries.where(size == length), length, k, covered)
        hits = hits if more is None else hits.unionByName(more)

    # one shuffle: what curves share goes and ranks are given where the hits of a query meet
    hits = hits.repartition("asked").distinct().withColumn("rank", _rank()).where(F.col("rank") <= k + 1)
    answers = hits.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("rank", "node", "vec_id", "score"))).alias("answer"))
    answers = scratch.store(answers, "answers")  # so that the join of a query with very many copies can be split
    others = F.slice(F.filter("answer", lambda hit: hit["node"] != F.col("own")), 1, k)
    rows = names.join(answers, F.col("same") == F.col("asked")).select("query_id", F.posexplode(others).alias("at", "hit"))
    return rows.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
