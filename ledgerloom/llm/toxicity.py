"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The features are densities of a learned lexicon, its hits near second-person words, capitals, punctuation
and obfuscated spellings. Lexicon, trees and calibration are fitted on a bounded sample of labelled rows
(``FIT_ROWS``, chosen by a hash of the id); every document is then scored as a whole, in one pass.

* labels, language, source and id are no features; label rows whose crc32(doc_id) mod 5 is 0 are never read,
  nor are null labels; the highest label of a repeated doc_id counts;
* null, empty and blank texts have all-zero features and get the score of those;
* near copies in the sample count once, by their smallest shingle, so that no family of copies makes a word;
* without labelled rows every score is 0, with one class only it is that class;
* repeated rows score alike; an empty table gives an empty result; other columns of any name pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch

FIT_ROWS = 24_000
LEXICON_WORDS = 200
LEAST_ODDS, LEAST_GAIN = 1.5, 25.0  # the gain that chance gives to one word in some millions
FOLDS = 5
CALIBRATION_FOLDS = 3
TREES, DEPTH, STEP = 24, 4, 0.2
NEAR_WORDS = 5
FLUSHED_WORDS = 400_000

#: Words of address in the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves du dich dir dein deine deiner deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti usted ustedes tuyo tuya vosotros vuestro".split()
)
#: Signs that stand for letters in obfuscated spellings.
LETTER_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
FEATURES = (
    "hit_rate weighted_rate hits distinct_hits strongest near_you you_rate capitals capital_words punctuation exclaims "
    "obfuscated obfuscated_hits words word_length sign_runs"
).split()

_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"(?<![^\W_])[^\W\d_]+(?:[0-9@$!*|.\-]+[^\W\d_]+)+(?![^\W_])")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .*\-]){3,}[^\W\d_](?![^\W_])")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
#: Letters beyond ASCII three times in a row, which few texts have.
_TRIPLE_BEYOND = re.compile("([\u0080-\U0010ffff])\\1\\1")
_BEYOND_LATIN = re.compile("[\u0100-\U0010ffff]")
#: A sign inside a word; most texts have none, and are spared the search for the whole spelling.
_INNER_SIGN = re.compile(r"[0-9@$!*|.\-][^\W\d_]")
#: Anything but ASCII and Latin-1 letters; without it ASCII signs alone part words.
_OTHER_SIGN = re.compile("[\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u0100-\U0010ffff]")
_ASCII_WORDS = bytes(byte if byte > 127 or chr(byte).isalnum() else 32 for byte in range(256))
_TRIPLES = [3 * letter for letter in "abcdefghijklmnopqrstuvwxyz"]
_CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")
_CAPITAL_RUN = re.compile(r"[^\W\d_a-zß-öø-ÿ]{2}")
_SIGNS = re.compile(r"[^\w\s]{2,}")
_DROPPED = re.compile(r"[ .*\-]+")


def _plain_spelling(text: str) -> str:
    return _DROPPED.sub("", text.translate(LETTER_SIGNS))


def words_of(text: str) -> list[str]:
    """Runs of letters and digits."""
    if _OTHER_SIGN.search(text):
        return _WORD.findall(text)
    return text.encode().translate(_ASCII_WORDS).decode().split()


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Dense features of one text; all zero where it has no word."""
    text = text or ""
    lowered = text.lower()
    words = words_of(lowered)
    if not words:
        return [0.0] * len(FEATURES)
    total, letters = len(words), max(1, sum(map(len, words)))
    hits = [place for place, word in enumerate(words) if word in lexicon]
    weights = [lexicon[words[place]] for place in hits]
    you = [place for place, word in enumerate(words) if word in SECOND_PERSON]
    near = 0
    if hits and you:
        at = 0
        for place in hits:
            while at < len(you) and you[at] < place - NEAR_WORDS:
                at += 1
            near += at < len(you) and you[at] <= place + NEAR_WORDS
    mixed = [_plain_spelling(found) for found in _MIXED.findall(lowered)] if _INNER_SIGN.search(lowered) else []
    mixed += [_plain_spelling(found.group()) for found in _SPACED.finditer(lowered)]
    if any(triple in lowered for triple in _TRIPLES) or not lowered.isascii() and _TRIPLE_BEYOND.search(lowered):
        mixed += [_STRETCHED.sub(r"\1", word) for word in words if _STRETCHED.search(word)]
    hidden = sum(word in lexicon for word in mixed)
    # a text without two capitals in a row has no word in capitals
    cased = _WORD.findall(text) if _CAPITAL_RUN.search(text) else []
    signs = len("".join(text.split())) - letters
    capitals = len(_CAPITAL.findall(text))
    if not text.isascii():
        capitals += sum(map(str.isupper, _BEYOND_LATIN.findall(text)))
    return [
        len(hits) / total,
        sum(weights) / total,
        math.log1p(len(hits)),
        float(len({words[place] for place in hits})),
        max(weights, default=0.0),
        math.log1p(near),
        len(you) / total,
        capitals / letters,
        sum(len(word) > 2 and word.isupper() for word in cased) / total,
        max(0, signs) / len(text),
        (text.count("!") + text.count("?")) / len(text),
        len(mixed) / total,
        math.log1p(hidden),
        math.log1p(total),
        letters / total,
        len(_SIGNS.findall(text)) / total,
    ]


def feature_column(lexicon: dict[str, float]) -> Callable[[Column], Column]:
    @F.pandas_udf("array<double>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(text, lexicon) for text in texts])

    return of_texts


def training_fold(doc_id: Column) -> Column:
    """Whether labels of this document may be learned from; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS != 0, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, toxic, text) of at most ``rows`` labelled documents, chosen by a hash of the id.

    The chosen ids are that many at most and are sent to the documents, which are scanned in place.
    """
    known = labels.where(training_fold(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.where("toxic IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = chosen.withColumnsRenamed({"doc_id": "chosen_id"})
    texts = docs.select(docs["doc_id"], docs["text"])
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("doc_id", "toxic", "text")


def _family(text: str | None) -> int:
    """Smallest hash of five-word shingles: equal for copies, and for most near copies."""
    words = (text or "").encode().split()
    shingles = [b" ".join(words[at : at + 5]) for at in range(max(1, len(words) - 4))]
    return min(map(xxhash.xxh64_intdigest, shingles)) - (1 << 63)


def learn_lexicon(sample: DataFrame, size: int = LEXICON_WORDS) -> dict[str, float]:
    """The ``size`` words that tell toxic documents best, with their log odds; document counts over the sample."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            for toxic, words in counts.items():
                if words:
                    kinds = pa.array([toxic] * len(words), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [kinds, pa.array(list(words)), pa.array(list(words.values()), pa.int64())], ["toxic", "word", "n"]
                    )
                    words.clear()

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[toxic].update(set(words_of((text.as_py() or "").lower())))
                if sum(map(len, counts.values())) > FLUSHED_WORDS:
                    yield from flush()
        yield from flush()

    totals = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    words = sample.select("toxic", "text").mapInArrow(counted, "toxic int, word string, n long")
    words = words.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    # likelihood ratio of a word that keeps to toxic documents more than chance allows
    both, share = F.col("bad") + F.col("good"), toxic / (toxic + clean)
    gain = F.col("bad") * F.log(F.col("bad") / (both * share))
    gain += F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - share)))).otherwise(0)
    words = words.where("bad > 0").select("word", odds.alias("odds"), (2 * gain).alias("gain"))
    words = words.where((F.col("odds") > LEAST_ODDS) & (F.col("gain") > LEAST_GAIN))
    best = words.orderBy(F.desc("gain"), "word").limit(size).collect()
    return {row["word"]: float(row["odds"]) for row in best}


@dataclass(frozen=True)
class Scorer:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float = 0.0

    def score(self, docs: DataFrame) -> DataFrame:
        """(row, score): the whole row of ``docs`` as a struct, and its score between 0 and 1."""
        whole = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
        if self.trees is None:
            return docs.select(whole, F.lit(self.base).alias("score"))
        rows = docs.select(whole, array_to_vector(feature_column(self.lexicon)(docs["text"])).alias("features"))
        return self._scored(rows).select("row", "score")

    def _scored(self, rows: DataFrame) -> DataFrame:
        rows = self.trees.transform(rows)
        if self.calibration is None:
            return rows.withColumn("score", vector_to_array("probability")[1])
        rows = rows.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("prediction")
        scored = self.calibration.transform(rows)
        return scored.withColumn("score", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Scorer:
    """Learn lexicon, trees and calibration. A third of the sample, by id, is kept for the calibration."""
    scratch = Scratch(docs.sparkSession)
    family = F.pandas_udf(lambda texts: texts.map(_family), "long")
    sample = fit_sample(docs, labels, rows).where("toxic IN (0, 1)").withColumn("family", family("text"))
    sample = scratch.store(sample.withColumn("toxic", F.col("toxic").cast("int")), "sample")
    firsts = sample.groupBy("family", "toxic").agg(F.min("doc_id").alias("doc_id"))
    sample = scratch.store(sample.join(firsts, ["family", "toxic", "doc_id"], "left_semi"), "distinct")
    part = F.crc32(F.concat(F.lit("calibrate:"), F.col("doc_id").cast("string"))) % CALIBRATION_FOLDS
    lexicon = learn_lexicon(sample.where(part != 0))
    rows = sample.select(
        F.col("toxic").cast("double").alias("label"),
        array_to_vector(feature_column(lexicon)("text")).alias("features"),
        (part == 0).alias("calibrates"),
    )
    rows = scratch.store(rows, "features")
    counts = {(row[0], row[1]): row[2] for row in rows.groupBy("calibrates", "label").count().collect()}
    if not counts.get((False, 0.0)) or not counts.get((False, 1.0)):
        total = sum(counts.values())
        toxic = sum(n for (_, label), n in counts.items() if label == 1.0)
        return Scorer({}, None, None, toxic / total if total else 0.0)
    booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, seed=7)
    trees = booster.fit(rows.where("not calibrates").coalesce(4))
    if not counts.get((True, 0.0)) or not counts.get((True, 1.0)):
        return Scorer(lexicon, trees, None)
    margins = trees.transform(rows.where("calibrates")).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    return Scorer(lexicon, trees, calibration)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = fit(docs, labels).score(docs)
    held_out = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    return fit(docs, labels).score(docs).where("score < 0.5").select("row.*")
