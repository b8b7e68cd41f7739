from __future__ import annotations

import functools
import math
import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language
from ledgerloom.llm.common import Scratch

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97 and rows.where("score < 0 OR score > 1").count() == 0
    crc = {row["doc_id"]: row["held_out"] for row in rows.collect()}
    assert all(held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0) for doc_id, held_out in crc.items())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


ROWS = [(k, "the cat and the dog", "en", "s") for k in range(30)] + [(100 + k, "der hund und die katze", "de", "s") for k in range(30)]


def test_edges(spark):
    more = [(200, None, "en", None), (201, "12 !!", "de", "a"), (202, "", None, "a"), (None, "the dog", "de", "a"), (203, "THE Dog", None, "a")]
    more += [(204, "hundekatzen", None, "s"), (204, "hundekatzen", None, "s"), (205, "中文", "en", "s")]
    docs = table(spark, ROWS + more).selectExpr("*", "1 as word", "2 as n", "'q' as lang_pred")
    found = language.identify(docs).collect()
    assert len(found) == len(ROWS) + len(more)
    by = {row["doc_id"]: row for row in found}
    assert [by[k]["lang_pred"] for k in (200, 201, 202)] == ["und"] * 3 and by[200]["score"] == 0.0
    assert by[None]["lang_pred"] == "en" and by[None]["held_out"] is False
    assert by[203]["lang_pred"] == "en" and by[204]["lang_pred"] == "de"
    assert language.identify(table(spark, [])).count() == 0
    nothing = language.identify(table(spark, [(1, "the cat", None, None)])).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    held = [k for k in range(300, 420) if zlib.crc32(str(k).encode()) % 5 == 0]
    wrong = [(k, "xyz qqq www", "fr", "x") for k in held] + [(None, "xyz", "fr", "x")]
    assert "fr" not in language.fit(table(spark, ROWS + wrong), Scratch(spark)).langs


def test_counts_cover_every_training_document(spark, monkeypatch):
    monkeypatch.setattr(language, "FLUSHED", 3)
    train = [row for row in ROWS if zlib.crc32(str(row[0]).encode()) % 5]
    model = language.fit(table(spark, ROWS), Scratch(spark))
    counts = Counter(word for _, text, lang, _ in train if lang == "en" for word in text.split())
    share = (counts["the"] + 0.5) / (sum(counts.values()) + 0.5 * len(model.words))
    place = model.langs.index("en")
    assert model.word_logs[model.words[b"the"], place] == pytest.approx(math.log(share), rel=1e-5)


def test_the_model_is_bounded(spark):
    rows = spark.createDataFrame([("en", f"w{k}", k) for k in range(1, 500)], "lang string, word string, n long")
    kept = [row["n"] for row in language.most_frequent(rows, 100).collect()]
    assert 50 < len(kept) <= 100 and min(kept) == 500 - len(kept)
    assert language.most_frequent(rows, 0).count() == 0 and language.most_frequent(rows, 1000).count() == 499


def plain_words(text):
    """Words letter by letter: a mark belongs to the letter or mark before it, anything else ends a word."""
    words, word = [], ""
    for sign in (text or "").lower() + " ":
        if sign.isalpha() or (word and unicodedata.category(sign)[0] == "M"):
            word += sign
        elif word:
            words.append(word)
            word = ""
    return words


def plain(rows):
    """(lang_pred, score) of every row by counting and backing off in plain Python."""
    counts, grams = {}, {}
    for row in rows:
        if row["doc_id"] is not None and row["lang"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5:
            counts.setdefault(row["lang"], Counter()).update(plain_words(row["text"]))
    counts = {lang: found for lang, found in sorted(counts.items()) if found}
    for lang, found in counts.items():
        grams[lang] = Counter()
        for word, n in found.items():
            padded = f"^{word}$"
            for size in range(1, 5):
                for at in range(len(padded) - size + 1):
                    grams[lang][padded[at : at + size]] += n
    known_words, known_grams = set().union(*counts.values()), set().union(*grams.values())
    sums = {lang: sum(found.values()) + 0.5 * len(known_words) for lang, found in counts.items()}
    ends = {lang: sum(n for gram, n in found.items() if len(gram) == 1) + 0.5 * len(known_grams) for lang, found in grams.items()}

    @functools.cache
    def logs(word):
        if word in known_words:
            return [math.log((counts[lang][word] + 0.5) / sums[lang]) for lang in counts]
        padded, found = f"^{word}$", []
        for at in range(len(padded)):
            longest = [padded[at : at + size] for size in (4, 3, 2, 1) if at + size <= len(padded) and padded[at : at + size] in known_grams]
            found += longest[:1]
        return [sum(math.log((grams[lang][gram] + 0.5) / ends[lang]) for gram in found) / max(1, len(found)) for lang in counts]

    out = []
    for row in rows:
        words = plain_words(row["text"])
        if not words or not counts:
            out.append(("und", 0.0))
            continue
        total = [math.fsum(column) for column in zip(*map(logs, words))]
        best = max(range(len(total)), key=total.__getitem__)
        out.append((list(counts)[best], 1 / sum(math.exp(value - total[best]) for value in total)))
    return out


@pytest.mark.parametrize("max_words", [0, 300, language.MAX_WORDS])
def test_every_document_equals_plain_python(spark, max_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(-1, None, "en", "s"), (-2, "12 !", "en", "s"), (-3, "\u00abdit\u00a0:\u00a0oui\u00bb\u2014\u2026 \u4e2d\u6587\u3002", None, "s")]
    rows = docs.collect() + table(spark, odd).collect()
    found = language.identify(spark.createDataFrame(rows, docs.schema).repartition(4), max_words).collect()
    assert len(found) == len(rows) and len({row["doc_id"] for row in rows}) == len(rows)
    by = {row["doc_id"]: row for row in found}
    for row, (lang, score) in zip(rows, plain(rows)):
        assert by[row["doc_id"]]["lang_pred"] == lang and by[row["doc_id"]]["score"] == pytest.approx(score, abs=1e-6)


def test_a_very_long_text(spark):
    long = [(900, "der hund " * 300_000, None, "s"), (901, "hundehundekatzen" * 20_000, None, "s")]
    found = {row["doc_id"]: row["lang_pred"] for row in language.identify(table(spark, ROWS + long)).collect()}
    assert found[900] == found[901] == "de"


def test_words():
    words = [word.decode() for word in language.words_of("The CAT's 2nd \u00c9t\u00e9_x")]
    assert words == ["the", "cat", "s", "nd", "\u00e9t\u00e9", "x"]
    assert language.words_of("\u00ab\u00a0bonjour\u00a0\u00bb \u2014 l\u2019ami") == [b"bonjour", b"l", b"ami"]
    assert language.words_of("1\ufe0f\u20e3 \u2764\ufe0f \u00b2") == [] and len(language.words_of("\u0939\u093f\u0928\u094d\u0926\u0940 e\u0301t")) == 2
    assert language.words_of("\u2026 \u2014 \u00ab\u00bb 12") == [] and language.words_of("\u4e2d\u6587") and not language.words_of(None)


def test_a_small_language_keeps_its_words(spark):
    ids = [k for k in range(500, 600) if zlib.crc32(str(k).encode()) % 5]
    rows = ROWS + [(ids[0], "hela koti meri", "fi", "s"), (ids[1], "koti", None, "s"), (ids[2], "kot", None, "s")]
    found = {row["doc_id"]: row["lang_pred"] for row in language.identify(table(spark, rows), 4).collect()}
    assert found[ids[1]] == found[ids[2]] == "fi" and found[0] == "en" and found[100] == "de"
