from __future__ import annotations

import random

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import simhash
from ledgerloom.llm.common import Scratch


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ")
    words = [word for word in words.replace(b"\r", b" ").split(b" ") if word]
    if not words:
        return 0
    shingles = [words[at : at + 4] for at in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(shingle), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aAbÉé \t\n\x0b\x0c\r\x1c\x85\xa0", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(1000))
    monkeypatch.setattr(simhash, "HASHED_AT_ONCE", 64)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_any_allocation_finds_all_pairs_within_the_distance():
    random.seed(3)
    total, both = 1000, np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500.0)
    for distance in (0, 1, 3, 4, 6):
        plan = simhash.allocate(total, both, distance)
        assert sum(radius + 1 for _, radius in plan) == distance + 1
        bits = [bit for group, _ in plan for bit in group]
        assert len(bits) == len(set(bits))
        for _ in range(300):
            changed = set(random.sample(range(64), distance))
            assert any(len(changed & set(group)) <= radius for group, radius in plan)


def test_correlated_bits_share_a_part():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500.0)
    twins = [(bit, 63 - bit) for bit in range(16)]
    for a, b in twins:
        both[a, b] = both[b, a] = 500.0
    groups = simhash.group_bits(1000, both, 4)
    together = sum(any(a in group and b in group for group in groups) for a, b in twins)
    assert sorted(bit for group in groups for bit in group) == list(range(64)) and together >= 14


def plain_components(prints, distance):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(a):
                if bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= distance and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_links_equal_brute_force(spark):
    """Chains, dense groups around a centre, and unrelated fingerprints."""
    random.seed(5)
    prints = set()
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(20):
            value = centre
            for bit in random.sample(range(64), random.randint(0, 5)):
                value ^= 1 << bit
            prints.add(value)
    prints |= {random.getrandbits(64) for _ in range(40)} | {0, 0b1111, 2**64 - 1}
    signed = sorted(value - 2**64 if value >> 63 else value for value in prints)
    label = plain_components(signed, 4)
    rows = spark.createDataFrame([(value,) for value in signed], "fp long")
    found = {row["fp"]: row["component"] for row in simhash.link(Scratch(spark), rows).collect()}
    want, got = {}, {}
    for place, value in enumerate(signed):
        want.setdefault(label[place], set()).add(value)
        got.setdefault(found[value], set()).add(value)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


BASE = " ".join(f"word{k}" for k in range(200))


def test_groups_and_edges(documents, clashing):
    near = BASE + " more"
    assert bin(plain_fingerprint(BASE) ^ plain_fingerprint(near)).count("1") <= 4
    rows = [(7, BASE, "a"), (3, BASE.upper(), "b"), (9, near, "a"), (5, None, "a"), (6, "", None), (8, " \n", "a")]
    rows += [(None, "alone and unlike", "a"), (2, "quite other words here", "c"), (2, "quite other words here", "c")]
    docs = clashing(documents(rows))
    found = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert found == sorted([(7, 3), (3, 3), (9, 3), (5, 5), (6, 5), (8, 5), (None, None), (2, 2), (2, 2)], key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((row["doc_id"] for row in kept.collect()), key=repr) == sorted([3, 5, None, 2], key=repr)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0 and simhash.keep_one(documents([])).count() == 0
