from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


LETTERS = list("abzABZ09'sSdtm.,!#<|>_- \t\n\x0b\x1c\x85\xa0éÉßñÑıİΣσς中文²½٣ªµ́̈ÅÅﬁ") + ["<|endoftext|>", "'ll", "don't"]
WORDS = st.lists(st.sampled_from(LETTERS), max_size=40).map("".join)


@given(WORDS)
@settings(max_examples=300, deadline=None)
def test_word_by_word_equals_the_whole_text(text):
    encoder = packing.encoder(vocabulary())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == want


def test_bounded_memory_of_words():
    encoder = packing.WordEncoder(vocabulary(), cached=5)
    text = " ".join(f"word{k}" for k in range(50)) + " word1 word1"
    assert encoder.encode(text.encode()) == packing.WordEncoder(vocabulary()).encode(text.encode())
    assert len(encoder.words) <= 5 and len(encoder.older) <= 5


def fewest_bins(lengths, capacity):
    best = len(lengths)
    for order in set(permutations(lengths)):
        bins = []
        for length in order:
            for k, used in enumerate(bins):
                if used + length <= capacity:
                    bins[k] += length
                    break
            else:
                bins.append(length)
        best = min(best, len(bins))
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=6))
@settings(max_examples=80, deadline=None)
def test_bound_and_packing_enclose_the_best(lengths):
    array = np.array(lengths)
    bins, offsets, room = packing.best_fit(array, 20)
    best = fewest_bins(lengths, 20)
    assert packing.lower_bound(array, 20) <= best <= len(room)
    check_places([(int(b), int(o), n) for b, o, n in zip(bins, offsets, lengths)], 20)


def check_places(placed, capacity):
    by_bin = defaultdict(list)
    for sequence, offset, length in placed:
        by_bin[sequence].append((offset, length))
    for parts in by_bin.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("dealt", [7, 10_000])
def test_every_piece_has_its_place(documents, clashing, tokenizer, dealt):
    rows = [(k, "lorem ipsum " * (k % 13 * 4), "a") for k in range(60)]
    rows += [(None, None, None), (None, "", "a"), (3, "same", "a"), (3, "same", "a"), (100, "x y " * 700, "b")]
    docs = clashing(documents(rows))
    found = packing.pack(docs, vocabulary(), capacity=64, dealt=dealt).collect()
    check_places([(row["sequence_id"], row["offset"], row["length"]) for row in found], 64)
    want = []
    for doc_id, text, _ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            want.append((doc_id, piece, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())))
    got = [tuple(row[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")) for row in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    rest = np.array([row["length"] for row in found if row["length"] < 64])
    fewest = packing.lower_bound(rest, 64) + sum(row["length"] == 64 for row in found)
    assert fewest <= len({row["sequence_id"] for row in found}) <= fewest + 2


def test_empty_table_and_ids(documents, tokenizer):
    assert packing.pack(documents([]), vocabulary()).count() == 0
    row = packing.pieces(documents([(1, "Hello, wörld", "a")]), vocabulary(), keep_ids=True).first()
    assert row["ids"] == [*tokenizer.encode("Hello, wörld", add_special_tokens=False).ids, 0]
