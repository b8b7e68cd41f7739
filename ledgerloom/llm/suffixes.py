"""Suffix-array dedup on sparse suffixes: repeated passages of ``MIN_WORDS`` words or more.

Of all suffixes only those at minimiser positions are kept: the smallest hashed ``GRAM``-word gram of every
window of ``MIN_WORDS`` words. Equal windows have their minimiser at the same place, so every repeated passage
keeps a suffix in each of its copies. A suffix owns the consecutive windows it is the minimiser of; together
they are the suffix extended left and right as far as it must be.

1. suffixes whose gram occurs once are dropped;
2. suffixes with equal owned stretch are repeats as a whole, and one of each goes on;
3. the others, and those representatives, are extended: all their windows are sorted over all tasks and each is
   compared with its neighbours; the ends of the sorted parts are compared with the next part's;
4. covered words of a text are merged to spans.

Comparing neighbours by right context alone would lose passages whose longest right neighbour has a shorter
left match, so windows are sorted for every left extension a suffix owns. Words are split at ASCII white
space and compared exactly, by two 64-bit hashes.

* texts of fewer than ``MIN_WORDS`` words, null and empty ones have no span; a passage may repeat within one text;
* the result of a text depends on the text alone, so repeated rows and null or repeated ids are treated alike;
* a very long text is hashed as a whole in one task, eight bytes a word; a group of copies shares one result;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import Scratch

MIN_WORDS = 50
GRAM = 16
BASE = 0x9E3779B97F4A7C15
_LOW = (1 << 64) - 1


class Rolling:
    """Hashes of any stretch of words of one text, from prefix sums of a polynomial modulo 2**64."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, text: bytes):
        words = text.split()
        self.words = len(words)
        self._reserve(self.words + 1)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, self.words)
        self.sums = np.append(np.uint64(0), np.cumsum(hashes * self.powers[: self.words], dtype=np.uint64))

    @classmethod
    def _reserve(cls, size: int) -> None:
        if len(cls.powers) < size:
            size = max(size, 2 * len(cls.powers))
            steps = np.full(size, BASE, np.uint64)
            steps[0] = 1
            cls.powers = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = pow(BASE, -1, 1 << 64)
            cls.inverses = np.cumprod(steps, dtype=np.uint64)

    def stretch(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Mixed hash of the words from each start."""
        x = (self.sums[starts + lengths] - self.sums[starts]) * self.inverses[starts]
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def suffixes(self, min_words: int = MIN_WORDS, gram: int = GRAM):
        """(gram hash, hash of the owned stretch, first owned window, number of owned windows) of every suffix kept."""
        windows = self.words - min_words + 1
        if windows < 1:
            empty = np.zeros(0, np.int64)
            return empty.view(np.uint64), empty.view(np.uint64), empty, empty
        grams = self.stretch(np.arange(self.words - gram + 1), gram)
        span = min_words - gram + 1
        view = np.lib.stride_tricks.sliding_window_view(grams, span)
        at = np.arange(windows) + view.argmin(axis=1)
        first = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
        count = np.diff(np.append(first, windows))
        return grams[at[first]], self.stretch(first, count + (min_words - 1)), first, count


def _keep_suffixes(min_words: int, gram: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                grams, stretches, firsts, counts, rows = [], [], [], [], []
                for row, text in enumerate(part.column(2)):
                    found = Rolling(text.as_py() or b"").suffixes(min_words, gram)
                    for column, values in zip((grams, stretches, firsts, counts), found):
                        column.append(values)
                    rows.append(np.full(len(found[0]), row))
                owner = pa.array(np.concatenate(rows))
                columns = [
                    part.column(0).take(owner),
                    part.column(1).take(owner),
                    pa.array(np.concatenate(grams).view(np.int64)),
                    pa.array(np.concatenate(stretches).view(np.int64)),
                    pa.array(np.concatenate(firsts).astype(np.int32)),
                    pa.array(np.concatenate(counts).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["text_a", "text_b", "gram", "stretch", "first", "count"])

    return kept


def _extend(min_words: int):
    """All windows of the suffixes asked for, by their hash."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                asked = row.column(3).flatten()
                grams = asked.field("gram").to_numpy()
                firsts = asked.field("first").to_numpy().astype(np.int64)
                counts = asked.field("count").to_numpy().astype(np.int64)
                steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = np.repeat(firsts, counts) + steps
                hashes = Rolling(row.column(2)[0].as_py()).stretch(starts, min_words)
                same = pa.array(np.zeros(len(starts), np.int64))
                columns = [
                    pa.array(np.repeat(grams, counts)),
                    pa.array(hashes.view(np.int64)),
                    row.column(0).take(same),
                    row.column(1).take(same),
                    pa.array(starts.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "window", "text_a", "text_b", "start"])

    return extended


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that equal the one before or after them in sorted order; the first and last of the part as well.

    ``edge`` is 0 for a repeat inside the part, 1 for its first and 2 for its last window.
    """
    names = ["gram", "window", "text_a", "text_b", "start"]
    part = TaskContext.get().partitionId()

    def out(rows: pa.RecordBatch, edge: int) -> pa.RecordBatch:
        more = [pa.array(np.full(rows.num_rows, edge, np.int32)), pa.array(np.full(rows.num_rows, part, np.int32))]
        return pa.RecordBatch.from_arrays([*rows.columns, *more], [*names, "edge", "part"])

    held = None  # the last window so far, and whether it equals the one before it
    for batch in batches:
        if not batch.num_rows:
            continue
        grams, windows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        same = (grams[1:] == grams[:-1]) & (windows[1:] == windows[:-1])
        before, after = np.append(False, same), np.append(same, False)
        if held is None:
            yield out(batch.slice(0, 1), 1)
        else:
            row, repeated = held
            before[0] = row.column(0)[0].as_py() == grams[0] and row.column(1)[0].as_py() == windows[0]
            if repeated or before[0]:
                yield out(row, 0)
        repeats = (before | after)[:-1]
        yield out(batch.take(pa.array(np.flatnonzero(repeats))), 0)
        held = batch.slice(batch.num_rows - 1), bool(before[-1])
    if held is not None:
        if held[1]:
            yield out(held[0], 0)
        yield out(held[0], 2)


def _repeated_edges(edges: list) -> list[tuple]:
    """Of the first and last windows of all sorted parts, those that equal a neighbour in another part."""
    ordered = sorted(edges, key=lambda row: (row["part"], row["edge"]))
    found = []
    for one, two in zip(ordered, ordered[1:]):
        if one["part"] != two["part"] and (one["gram"], one["window"]) == (two["gram"], two["window"]):
            found += [(row["text_a"], row["text_b"], row["start"]) for row in (one, two)]
    return found


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching intervals of a text become one span."""
    kind = pa.list_(pa.struct([("start_word", pa.int32()), ("end_word", pa.int32())]))
    for batch in batches:
        merged = []
        for row in batch.column(2):
            parts = row.values
            starts, ends = parts.field("start").to_numpy(), parts.field("end").to_numpy()
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], np.maximum.accumulate(ends[order])
            cut = np.append(True, starts[1:] > ends[:-1])
            last = np.append(np.flatnonzero(cut)[1:] - 1, len(starts) - 1)
            merged.append([{"start_word": a, "end_word": b} for a, b in zip(starts[cut].tolist(), ends[last].tolist())])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(merged, kind)], ["text_a", "text_b", "spans"])


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """One row per repeated passage of a document: doc_id, start_word, end_word (exclusive), n_words."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text_key, stretch_key = ["text_a", "text_b"], ["gram", "stretch"]
    rows = docs.where(docs["text"].isNotNull()).select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("text_a"),
        F.xxhash64(docs["text"], F.lit("text")).alias("text_b"),
        docs["text"].cast("binary").alias("text"),
    )
    suffixes = scratch.store(
        rows.select(*text_key, "text").mapInArrow(
            _keep_suffixes(min_words, gram), "text_a long, text_b long, gram long, stretch long, first int, count int"
        ),
        "suffixes",
    )
    often = scratch.store(suffixes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "often")
    shared = scratch.store(suffixes.join(often, "gram", "left_semi"), "shared")
    scratch.drop(suffixes, often)

    place = F.struct(*text_key, "first", "count")
    stretches = shared.groupBy(*stretch_key).agg(F.count("*").alias("n"), F.min(place).alias("place"))
    stretches = scratch.store(stretches, "stretches")
    whole = scratch.store(stretches.where("n > 1").select(*stretch_key), "whole")
    covered = shared.join(whole, stretch_key, "left_semi").select(
        *text_key, F.col("first").alias("start"), (F.col("first") + F.col("count") + (min_words - 1)).alias("end")
    )

    # representatives of every stretch whose gram has another one
    several = scratch.store(stretches.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "several")
    asked = stretches.join(several, "gram", "left_semi").select("place.*", "gram")
    asked = asked.groupBy(*text_key).agg(F.collect_list(F.struct("gram", "first", "count")).alias("asked"))
    firsts = rows.groupBy(*text_key).agg(F.min("doc_id").alias("reader"))
    asked = scratch.store(asked.join(firsts, text_key), "asked")
    readers = rows.join(asked, text_key).where(F.col("doc_id").eqNullSafe(F.col("reader")))
    windows = readers.select(*text_key, "text", "asked").mapInArrow(
        _extend(min_words), "gram long, window long, text_a long, text_b long, start int"
    )
    order = ["gram", "window", "text_a", "text_b", "start"]
    compared = windows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _compare_neighbours, "gram long, window long, text_a long, text_b long, start int, edge int, part int"
    )
    compared = scratch.store(compared, "compared")
    edges = _repeated_edges(compared.where("edge > 0").collect())  # two rows per sorted part
    at_edges = spark.createDataFrame(edges, "text_a long, text_b long, start int")
    single = compared.where("edge = 0").select(*text_key, "start").unionByName(at_edges)
    single = single.select(*text_key, "start", (F.col("start") + min_words).alias("end"))

    intervals = covered.unionByName(single).distinct()
    intervals = intervals.groupBy(*text_key).agg(F.collect_list(F.struct("start", "end")).alias("parts"))
    shape = "text_a long, text_b long, spans array<struct<start_word: int, end_word: int>>"
    spans = scratch.store(intervals.mapInArrow(_merge, shape), "spans")
    found = rows.select("doc_id", *text_key).join(spans, text_key).select("doc_id", F.inline("spans"))
    return found.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
