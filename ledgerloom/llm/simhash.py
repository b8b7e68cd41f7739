"""SimHash near-duplicates: fingerprints, and links between them by the general pigeonhole principle.

Bits are grouped into parts; correlated bits go together, so that the other parts tell more apart. With m
parts and radii r_1 .. r_m, where the sum of (r_i + 1) is the bit distance + 1, two fingerprints within that
distance agree within r_i bits on some part i. Dynamic programming picks m and the radii by the estimated
number of probes and candidates. Every fingerprint is indexed by its value on each part and probes all values
within the radius; a candidate is verified on all 64 bits inside the join.

Copies meet as one distinct fingerprint. Before the join, fingerprints are linked with a few pivots of each
bucket, and the join then emits only pairs that these links do not connect yet, so that a large group of near
copies makes links in proportion to its size, not to its square, and no link is lost.

* texts without words (null, empty, blank) have fingerprint zero and link like any other;
* repeated rows share a fingerprint; a null ``doc_id`` never names a component unless all its ids are null;
* very long texts are hashed in pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch, components

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
PIVOTS = 4
PROBE_COST, CANDIDATE_COST = 3.0, 1.0
HASHED_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of UTF-8 bytes: A-Z lowered, words split at ASCII white space, shingles hashed with XXH64."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    shingles = max(1, len(tokens) - words + 1)
    starts, ends = starts[:shingles], ends[-shingles:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, shingles, HASHED_AT_ONCE):
        some = zip(starts[at : at + HASHED_AT_ONCE].tolist(), ends[at : at + HASHED_AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > shingles, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_a, text_b, fp): the id, two hashes of the text, and the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), words) for text in batch.column(3)]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], values], ["doc_id", "text_a", "text_b", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *_text_key(docs), docs["text"].cast("binary").alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, text_a long, text_b long, fp long")


def _text_key(docs: DataFrame) -> list[Column]:
    return [F.xxhash64(docs["text"]).alias("text_a"), F.xxhash64(docs["text"], F.lit("text")).alias("text_b")]


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each pair of bits is set together (64 x 64, summed in Spark)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            rows += len(values)
        counts = np.append(both.astype(np.int64).ravel(), rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["cell", "n"])

    sums = prints.select("fp").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1)
    for cell, n in sums.collect():  # 4,097 rows, whatever the input
        cells[cell] = n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits to ``parts`` groups of even size, each bit to where its correlations are strongest."""
    ones = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.outer(ones * (1 - ones), ones * (1 - ones)))
    close = np.abs(both / max(total, 1) - np.outer(ones, ones)) / np.maximum(spread, 1e-12)
    np.fill_diagonal(close, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda bit: (close[bit, sorted(free)].max(), -bit))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda bit: (close[bit, group].sum(), -bit)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def within(total: int, both: np.ndarray, bits: list[int], radius: int) -> float:
    """Estimated probability that two fingerprints differ in at most ``radius`` of these bits."""
    chance = np.zeros(radius + 1)
    chance[0] = 1
    for bit in bits:
        one = both[bit, bit] / max(total, 1)
        differ = 2 * one * (1 - one)
        chance = chance * (1 - differ) + np.append(0, chance[:-1]) * differ
    return float(chance.sum())


def flips(bits: list[int], radius: int) -> list[int]:
    """Masks of all changes of up to ``radius`` of these bits, as signed longs."""
    masks = [sum(1 << bit for bit in some) for r in range(radius + 1) for some in combinations(bits, r)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def allocate(total: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, radius) of each part that is probed, at the least estimated cost.

    For each number of parts a dynamic program over (part, sum of radius + 1 so far) weighs the probes of a
    radius against the candidates it lets through; a part may be left out (radius -1).
    """
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for parts in range(1, distance + 2):
        groups = group_bits(total, both, parts)
        table = {0: (0.0, [])}
        for bits in groups:
            cost = {-1: 0.0}
            for radius in range(min(distance, 2) + 1):
                probes = total * len(flips(bits, radius))
                cost[radius] = PROBE_COST * probes + CANDIDATE_COST * total**2 / 2 * within(total, both, bits, radius)
            after: dict[int, tuple[float, list]] = {}
            for units, (spent, chosen) in table.items():
                for radius, more in cost.items():
                    reached = units + radius + 1
                    found = (spent + more, [*chosen, (bits, radius)] if radius >= 0 else chosen)
                    if reached <= distance + 1 and found[0] < after.get(reached, (float("inf"),))[0]:
                        after[reached] = found
            table = after
        best = min(best, table.get(distance + 1, best), key=lambda found: found[0])
    return best[1]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << bit for bit in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _at(part: int, bits: list[int], flip: Column) -> Column:
    """Place of the fingerprint in the index of a part, with the bits of ``flip`` changed."""
    value = F.col("fp").bitwiseAND(F.lit(_signed(bits))).bitwiseXOR(flip)
    return F.struct(F.lit(part).alias("part"), value.alias("value"))


def _probes(part: int, bits: list[int], radius: int) -> Column:
    masks = F.array(*[F.lit(mask).cast("long") for mask in flips(bits, radius)])
    return F.transform(masks, lambda flip: _at(part, bits, flip))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def link(scratch: Scratch, prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component) of all distinct fingerprints (column fp) that have a link; component is a fingerprint."""
    total, both = bit_statistics(prints)
    plan = allocate(total, both, distance)
    values = [_at(part, bits, F.lit(0).cast("long")) for part, (bits, _) in enumerate(plan)]
    index = prints.select("fp", F.explode(F.array(*values)).alias("at")).select("fp", "at.part", "at.value")

    # links with a few pivots of every bucket
    pivots = index.groupBy("part", "value").agg(
        F.count("*").alias("size"),
        *[F.min(F.struct(F.xxhash64("fp", F.lit(k)), "fp")).alias(f"pivot{k}") for k in range(PIVOTS)],
    )
    pivots = scratch.store(
        pivots.where("size > 1").select(
            "part", "value", F.array_distinct(F.array(*[F.col(f"pivot{k}.fp") for k in range(PIVOTS)])).alias("pivots")
        ),
        "pivots",
    )
    near = F.filter("pivots", lambda pivot: (_distance(F.col("fp"), pivot) <= distance) & (pivot != F.col("fp")))
    to_pivots = index.join(pivots, ["part", "value"]).select(F.col("fp").alias("a"), F.explode(near).alias("b"))
    known = scratch.store(components(scratch, to_pivots), "known")

    # pairs that the pivots left unconnected
    named = scratch.store(
        prints.join(known, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "fp").alias("component")
        ),
        "named",
    )
    probes = named.select(
        F.col("fp").alias("a"),
        F.col("component").alias("of_a"),
        F.explode(F.flatten(F.array(*[_probes(part, *chosen) for part, chosen in enumerate(plan)]))).alias("at"),
    ).select("a", "of_a", F.col("at.part").alias("part"), F.col("at.value").alias("value"))
    indexed = named.select(
        F.col("fp").alias("b"), F.col("component").alias("of_b"), F.explode(F.array(*values)).alias("at")
    ).select("b", "of_b", F.col("at.part").alias("in_part"), F.col("at.value").alias("in_value"))
    found = probes.join(
        indexed,
        (F.col("part") == F.col("in_part"))
        & (F.col("value") == F.col("in_value"))
        & (F.col("of_a") != F.col("of_b"))
        & (_distance(F.col("a"), F.col("b")) <= distance),
    ).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    merged = components(scratch, found).withColumnRenamed("component", "merged")
    every = named.join(merged, F.col("component") == F.col("node"), "left")
    return every.select("fp", F.coalesce("merged", "component").alias("component"))


def groups(scratch: Scratch, docs: DataFrame, words: int, distance: int) -> DataFrame:
    """Every row's doc_id, text hashes, fingerprint, component (a fingerprint) and smallest doc_id in it."""
    prints = scratch.store(fingerprints(docs, words), "prints")
    distinct = scratch.store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = scratch.store(link(scratch, distinct.select("fp"), distance), "linked")
    firsts = linked.join(distinct, "fp").groupBy("component").agg(F.min("first").alias("component_id"))
    named = scratch.store(linked.join(firsts, "component"), "named")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    rows = groups(Scratch(docs.sparkSession), docs, words, distance)
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one with the smallest doc_id, nulls last.

    Rows are found again by id and text. Only where several rows share both is one of them picked by a
    grouped first; all others pass through a plain semi join.
    """
    scratch = Scratch(docs.sparkSession)
    key = ["doc_id", "text_a", "text_b"]
    rows = groups(scratch, docs, words, distance).groupBy("component", *key).agg(F.count("*").alias("rows"))
    rows = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key, "rows")).alias("kept"))
    kept = scratch.store(rows.select("kept.*"), "kept")
    single = scratch.store(kept.where("rows = 1").select(*key), "single")
    several = scratch.store(kept.where("rows > 1").select(*key), "several")
    whole = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    keyed = docs.select(whole, docs["doc_id"].cast("long").alias("id"), *_text_key(docs))

    def found(of: DataFrame) -> DataFrame:
        of = of.select(F.col("doc_id").alias("of_id"), F.col("text_a").alias("of_a"), F.col("text_b").alias("of_b"))
        same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_a") == F.col("of_a")) & (F.col("text_b") == F.col("of_b"))
        return keyed.join(of, same, "left_semi")

    again = found(several).groupBy("id", "text_a", "text_b").agg(F.first("row").alias("row"))
    return found(single).select("row.*").unionByName(again.select("row.*"))
