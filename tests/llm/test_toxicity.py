from __future__ import annotations

import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import toxicity

LEXICON = {"zorp": 4.0, "fnarg": 3.0}
NAMES = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES))))


def feature(text, name):
    return toxicity.features(text, LEXICON)[NAMES[name]]


@given(st.text(alphabet="aZé0_ .,-!\u2014\u00a0\u00ab\u00b2\u4e2d\u0301\n", max_size=30))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(text):
    assert toxicity.words_of(text) == toxicity._WORD.findall(text)


def test_features():
    assert toxicity.features(None, LEXICON) == toxicity.features("", LEXICON) == toxicity.features(" ?! \n", LEXICON) == [0.0] * len(NAMES)
    assert feature("a zorp b fnarg", "hit_rate") == 0.5 and feature("a zorp b Fnarg!", "distinct_hits") == 2
    assert feature("you are a zorp", "near_you") > 0 and feature("you " + "x " * 20 + "zorp", "near_you") == 0
    assert feature("SHOUTED words", "capital_words") == 0.5 and feature("ABcd", "capitals") == 0.5
    for hidden in ("a z0rp b", "a z*o*r*p b", "f.n.a.r.g", "z o r p", "zoooorp", "Z-O-R-P"):
        assert feature(hidden, "obfuscated_hits") > 0, hidden
    assert feature("well-known co-op", "obfuscated_hits") == 0
    assert feature("what?!!", "exclaims") == pytest.approx(3 / 7) and feature("a ### b", "sign_runs") > 0


def corpus(size=600):
    r = random.Random(6)
    words = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(size):
        text = [r.choice(words) for _ in range(r.randrange(20, 60))]
        toxic = int(k % 6 == 0)
        if toxic:
            for _ in range(4):
                text.insert(r.randrange(len(text)), r.choice(["zorp", "fnarg", "blick"]))
        rows.append((k, " ".join(text), "s"))
        labels.append((k, 1, toxic))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_learns_from_labels_and_generalises(spark, documents, clashing):
    rows, labels = corpus()
    extra = [(1000, None, None), (1001, "", "a"), (None, "you zorp fnarg zorp", "a"), (1002, "zorp you fnarg blick " * 9, "a"), (1002, "zorp you fnarg blick " * 9, "a")]
    docs = clashing(documents(rows + extra))
    found = toxicity.score(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) + len(extra)
    by = {row["doc_id"]: row for row in found}
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in found)
    held = [row for row in found if row["held_out"]]
    assert all(zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 for row in held)
    right = sum(row["predicted"] == int(row["doc_id"] % 6 == 0) for row in held if row["doc_id"] < 1000)
    assert right >= 0.95 * sum(row["doc_id"] < 1000 for row in held)
    assert by[1000]["score"] == by[1001]["score"] < 0.5 and by[1002]["predicted"] == 1 and not by[None]["held_out"]
    kept = toxicity.keep_clean(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    assert kept.count() == sum(row["predicted"] == 0 for row in found)


def test_held_out_labels_teach_nothing(spark, documents):
    rows, labels = corpus(200)
    turned = [(i, q, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, q, t in labels]
    scores = [
        sorted(map(tuple, toxicity.score(documents(rows), spark.createDataFrame(some, LABELS)).collect()))
        for some in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_without_or_with_one_class(spark, documents):
    rows, labels = corpus(40)
    none = toxicity.score(documents(rows), spark.createDataFrame([], LABELS)).collect()
    assert {row["score"] for row in none} == {0.0}
    odd = [(i, 1, 1) for i, _, _ in labels] + [(None, 1, 0), (3, 0, None)]
    assert {row["score"] for row in toxicity.score(documents(rows), spark.createDataFrame(odd, LABELS)).collect()} == {1.0}
    assert toxicity.score(documents([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_copies_make_no_word(spark, documents):
    rows, labels = corpus(200)
    family = "onlyhere marker " + " ".join(f"t{k}" for k in range(60))
    rows += [(500 + k, family + f" {k}", "s") for k in range(60)]
    labels += [(500 + k, 1, 1) for k in range(60)]
    scorer = toxicity.fit(documents(rows), spark.createDataFrame(labels, LABELS))
    assert "onlyhere" not in scorer.lexicon and "zorp" in scorer.lexicon


def test_letters_of_every_script_count():
    """Stretched spellings and capitals beyond ASCII and Latin-1 are seen, with or without other signs around."""
    for text, capitals in (("ÉCOLE été", 5), ("ПРИВЕТ мир", 6), ("ΑΒΓ — δ", 3), ("ŠKODA “auto”", 5), ("Straße ÄÖ", 3), ("plain Text", 1)):
        letters = sum(map(len, toxicity._WORD.findall(text)))
        assert feature(text, "capitals") == capitals / letters
    for text in ("ééééé là", "приииивет мир", "sooo", "ＡＡＡ"):
        assert feature(text, "obfuscated") > 0
    assert feature("éé là ——— 111 ...", "obfuscated") == 0
