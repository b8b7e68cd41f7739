"""Language identification, words first: known words by log frequency, unseen ones by ever shorter n-grams.

Words and their character n-grams are counted per language over all training documents, and all counts score. A
word that was never seen is scored by the longest known n-gram at each of its positions, from ``LONGEST`` letters
down to one. The counts grow with the corpus, what is sent to the tasks does not: the most frequent words up to
``MAX_WORDS`` go there with their counts in every language. The other words of a text are joined with the stored
counts, and the distinct ones that were never seen with the stored n-grams. There is one way to score, whatever the
size of the table and of what is sent.

* a word is a run of letters and of marks that follow a letter, in any script, in lower case; all else parts words;
* documents whose crc32(doc_id) mod 5 is 0, without language or without id are never learned from;
* a text that is null or has no letter is ``und`` with score 0, as is every text where nothing was learned;
* ties between languages go to the first by name; repeated rows are predicted alike;
* very long texts are read whole, once; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch

MAX_WORDS = 150_000
LONGEST = 4
SMOOTHING = 0.5
FOLDS = 5
FLUSHED = 300_000
UNKNOWN = "und"

#: ASCII bytes that are no letters part words; of the others only letters and their marks are left by then.
_LETTERS = bytes(byte if byte > 127 or chr(byte).isalpha() else 32 for byte in range(256))
_OTHER_SIGN = regex.compile(r"[^\x00-\x7F\p{L}\p{M}]\p{M}*|(?<![\p{L}\p{M}])\p{M}+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words as UTF-8; none where the text has no letter."""
    lowered = (text or "").lower()
    if not lowered.isascii():
        lowered = _OTHER_SIGN.sub(" ", lowered)
    return lowered.encode().translate(_LETTERS).split()


def grams_of(word: str) -> Iterator[str]:
    padded = f"^{word}$"
    for size in range(1, LONGEST + 1):
        for at in range(len(padded) - size + 1):
            yield padded[at : at + size]


def _flushed(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, found in counts.items():
        words = pa.array([word.decode() if isinstance(word, bytes) else word for word in found], pa.string())
        columns = [pa.array([lang] * len(found)), words, pa.array(list(found.values()), pa.int64())]
        if found:
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])
    counts.clear()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.setdefault(lang, Counter()).update(words_of(text.as_py()))
            if sum(map(len, counts.values())) > FLUSHED:
                yield from _flushed(counts)
    yield from _flushed(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, word, n in zip(*[column.to_pylist() for column in batch.columns]):
            found = counts.setdefault(lang, Counter())
            for gram in grams_of(word):
                found[gram] += n
            if sum(map(len, counts.values())) > FLUSHED:
                yield from _flushed(counts)
    yield from _flushed(counts)


def most_frequent(rows: DataFrame, at_most: int) -> DataFrame:
    """Rows above the lowest count (in steps of an eighth of a power of two) that keeps no more than ``at_most``."""
    step = F.floor(8 * F.log2("n"))
    sizes = sorted(rows.groupBy(step.alias("step")).count().collect(), reverse=True)  # at most 504 rows
    total, lowest = 0, math.inf
    for size, count in sizes:
        total += count
        if total > at_most:
            break
        lowest = size
    return rows.where(step >= lowest) if math.isfinite(lowest) else rows.limit(0)


@dataclass
class Model:
    """All counts as stored tables (word, n, counts: one per language), what each language's counts are divided by,
    and the most frequent words as log frequencies, a row per word and a column per language."""

    langs: list[str]
    words: dict[bytes, int]
    word_logs: np.ndarray
    all_words: DataFrame
    word_sums: np.ndarray
    all_grams: DataFrame
    gram_sums: np.ndarray


def _by_word(rows: DataFrame, langs: list[str]) -> DataFrame:
    """(word, n, counts): all languages of a word in one row."""
    counts = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)) for lang in langs]
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.array(*counts).cast("array<long>").alias("counts"))


def fit(docs: DataFrame, scratch: Scratch, max_words: int = MAX_WORDS) -> Model:
    """Count words over all training documents and n-grams over all distinct words."""
    train = docs.where((F.crc32(docs["doc_id"].cast("string")) % FOLDS != 0) & docs["lang"].isNotNull())
    shape = "lang string, word string, n long"
    words = train.select(docs["lang"], docs["text"]).mapInArrow(_count_words, shape)
    words = scratch.store(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = {row["lang"]: row["n"] for row in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    order = sorted(langs)
    # every position of a word starts one n-gram, so its letters weigh the languages
    grams = words.mapInArrow(_count_grams, shape).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = scratch.store(grams, "grams")
    one = F.length("word") == 1
    letters = {row["lang"]: row["n"] for row in grams.where(one).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    all_words = scratch.store(_by_word(words, order), "word-counts")
    all_grams = scratch.store(_by_word(grams, order), "gram-counts")
    scratch.drop(words, grams)
    word_sums = np.array([langs[lang] for lang in order], float) + SMOOTHING * max(1, all_words.count())
    gram_sums = np.array([letters.get(lang, 0) for lang in order], float) + SMOOTHING * max(1, all_grams.count())
    # a row holds all languages: with very many of them fewer rows are sent
    sent = most_frequent(all_words, max_words // max(1, len(order) // 8)).orderBy("word").collect()
    counts = np.array([row["counts"] for row in sent], float).reshape(len(sent), len(order))
    index = {row["word"].encode(): k for k, row in enumerate(sent)}
    return Model(order, index, np.log((counts + SMOOTHING) / word_sums), all_words, word_sums, all_grams, gram_sums)


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, at, size, word): the n-grams of every word, by the position where they start."""
    names = ["number", "at", "size", "word"]
    rows: list[tuple[int, int, int, str]] = []
    for batch in batches:
        for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            padded = f"^{word}$"
            for at in range(len(padded)):
                for size in range(1, min(LONGEST, len(padded) - at) + 1):
                    rows.append((number, at, size, padded[at : at + size]))
                if len(rows) >= FLUSHED:
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names)
                    rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names)


def _logs(sums: np.ndarray) -> list[Column]:
    """Log frequency of a row's counts in every language."""
    return [F.log((F.col("counts")[k] + SMOOTHING) / F.lit(float(total))) for k, total in enumerate(sums)]


def _backed_off(words: DataFrame, model: Model) -> DataFrame:
    """(word, log_0, ...) of distinct unseen words: the mean of the longest known n-grams at their positions."""
    every = [f"log_{k}" for k in range(len(model.langs))]
    grams = words.mapInArrow(_positions, "number long, at long, size long, word string").join(model.all_grams, "word")
    grams = grams.select("number", "at", "size", *[log.alias(name) for log, name in zip(_logs(model.gram_sums), every)])
    longest = grams.groupBy("number", "at").agg(*[F.max_by(name, "size").alias(name) for name in every])
    return words.join(longest.groupBy("number").agg(*[F.avg(name).alias(name) for name in every]), "number").drop("number")


def _summed(rows: DataFrame, model: Model) -> DataFrame:
    """(number, doc_id, sums, others, times): logs of the words sent to the tasks, and the other words with their number."""
    sent = rows.sparkSession.sparkContext.broadcast((model.words, model.word_logs))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, word_logs = sent.value
        for batch in batches:
            sums, others, times = [], [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                places = list(map(index.get, words))
                known = [place for place in places if place is not None]
                missing = Counter(word.decode() for word, place in zip(words, places) if place is None)
                sums.append(word_logs[known].sum(axis=0).tolist() if words else None)
                others.append(list(missing))
                times.append(list(missing.values()))
            columns = [
                batch.column(0), batch.column(1), pa.array(sums, pa.list_(pa.float64())),
                pa.array(others, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "sums", "others", "times"])

    shape = "number long, doc_id long, sums array<double>, others array<string>, times array<long>"
    rows = rows.select(F.monotonically_increasing_id().alias("number"), "doc_id", "text")
    return rows.mapInArrow(summed, shape)


def _predicted(rows: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """(doc_id, lang_pred, score). Occurrences of words that were not sent are shuffled once by word; only the unseen
    ones among them meet their n-grams and are shuffled again."""
    rows = scratch.store(_summed(rows, model), "summed")
    others = rows.select("number", F.explode(F.arrays_zip("others", "times")).alias("of"))
    others = others.select("number", F.col("of.others").alias("word"), F.col("of.times").alias("times"))
    met = others.join(model.all_words.select("word", "counts"), "word", "left")
    unseen = F.col("counts").isNull()
    met = scratch.store(met.select("number", "times", F.when(unseen, F.col("word")).alias("word"), "counts"), "met")
    scratch.drop(model.all_words)
    words = met.where(unseen).select("word").distinct().withColumn("number", F.monotonically_increasing_id())
    words = scratch.store(words.select("number", "word"), "unseen")
    backed_off = scratch.store(_backed_off(words, model), "backed-off")
    scratch.drop(words, model.all_grams)

    every = [f"log_{k}" for k in range(len(model.langs))]
    seen = met.where(~unseen).select("number", "times", *[log.alias(name) for log, name in zip(_logs(model.word_sums), every)])
    more = seen.unionByName(met.where(unseen).join(backed_off, "word").select("number", "times", *every))
    more = more.groupBy("number").agg(*[F.sum(F.col("times") * F.col(name)).alias(name) for name in every])
    total = F.array(*[F.col("sums")[k] + F.coalesce(F.col(name), F.lit(0.0)) for k, name in enumerate(every)])
    total = rows.select("number", "doc_id", "sums").join(more, "number", "left").select(
        "doc_id", F.when(F.col("sums").isNotNull(), total).alias("total")
    )
    most = F.array_max("total")
    first = F.get(F.array(*map(F.lit, model.langs)), (F.array_position("total", most) - 1).cast("int"))
    shares = F.aggregate("total", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - most))
    return total.select(
        "doc_id", F.coalesce(first, F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(1 / shares, F.lit(0.0)).alias("score")
    )


def identify(docs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    scratch = Scratch(docs.sparkSession)
    model = fit(docs, scratch, max_words)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    if model.langs:
        rows = _predicted(rows, model, scratch)
    else:
        rows = rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
