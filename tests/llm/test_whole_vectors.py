"""Hard negatives, whitening and pivot search against plain versions of their contracts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives, pivot_search, whitening, whole_vectors

SHAPE = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")
#: Names that the operators use inside.
CLASHING = "1 as node, 2 as block, 'x' as x, 3 as size, 4 as ask, 5 as part, 6 as score, 7 as row, 8 as `first`, 9 as place"


def table(spark, rows):
    """rows: (vec_id, vector, label)"""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows], SHAPE)


def clustered(count=600, size=8, seed=1):
    """Vectors around a few centres, some of them copies, with labels."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, size))
    vectors = centres[random.integers(0, 6, count)] + random.normal(0, 0.2, (count, size))
    vectors[50:90] = vectors[50]
    vectors[7] = 0
    return [(k, vectors[k].tolist(), int(random.integers(0, 4))) for k in range(count)]


def whole(vector):
    return [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in vector]


def usable(rows):
    return [(i, whole(v), y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def inner(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


# --- products --------------------------------------------------------------------------------------------


@given(st.integers(0, 62), st.integers(0, 62), st.integers(1, 5), st.integers(0, 9), st.integers(0, 9), st.randoms())
@settings(max_examples=150, deadline=None)
def test_packed_and_plain_products_are_exact(bits_a, bits_b, size, m, n, random):
    def draw(rows, bits):
        return np.array([[random.randint(-(1 << bits), (1 << bits) - 1) for _ in range(size)] for _ in range(rows)], np.int64).reshape(rows, size)

    a, b = draw(m, bits_a), draw(n, bits_b)
    want = [[inner(x, y) for y in b.tolist()] for x in a.tolist()]
    assert hard_negatives.packed_products(a, b).tolist() == want
    assert whole_vectors.products(a, b).tolist() == want


def test_several_candidates_share_a_word(monkeypatch):
    """What is multiplied are words with several candidates each, for narrow, middle and wide fields."""
    random = np.random.default_rng(4)
    for most, fields in ((100, 2), (10_000, 1), (1 << 30, 8)):
        a, b = random.integers(-most, most, (3, 4)), random.integers(-most, most, (16, 4))
        assert (hard_negatives.packed_products(a, b) == whole_vectors.products(a, b)).all()
        width = int(((a.max(0) - a.min(0)).astype(object) * (b.max(0) - b.min(0)).astype(object)).sum()).bit_length()
        assert (53 // width if 2 * width <= 53 else 2 if 2 * width <= 63 else 8) >= fields


@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 5)), max_size=30), st.integers(1, 8))
@settings(max_examples=100, deadline=None)
def test_leading_takes_the_highest_and_the_smaller_id(rows, k):
    scores = np.array([s - (2**63 - 4 if s == -3 else 0) for s, _ in rows], np.int64)
    ids = np.array([i for _, i in rows], np.int64)
    found = [(int(scores[p]), int(ids[p])) for p in whole_vectors.leading(scores, ids, k)]
    assert found == sorted(zip(scores.tolist(), ids.tolist()), key=lambda one: (-one[0], one[1]))[:k]


def test_floor_in_spark_is_floor_in_doubles(spark):
    values = [0.0, -0.0, 1.0, -1e-9, 0.00390625, -0.00390625, 3.999999, 1e17, -1e300, 1e300]
    row = table(spark, [(1, values, 0)]).select(whole_vectors.whole_numbers(F.col("embedding")).alias("x")).first()
    assert row.x == whole(values)


def test_blocks_keep_to_their_length_and_size(spark, monkeypatch):
    monkeypatch.setattr(whole_vectors, "BLOCK_VALUES", 20)
    from ledgerloom.llm.common import Scratch

    rows = spark.createDataFrame([(k, 2 + k % 3, k % 5) for k in range(200)], "node long, size int, label long").repartition(4)
    found = whole_vectors.in_blocks(Scratch(spark), rows, ["size", "label", "node"], ["size"], "b").collect()
    assert sorted(r.node for r in found) == list(range(200))
    blocks = {}
    for r in found:
        blocks.setdefault(r.block, []).append(r)
    assert sorted(blocks) == list(range(len(blocks)))
    assert all(len({r["size"] for r in b}) == 1 and len(b) <= 20 // b[0]["size"] for b in blocks.values())


# --- hard negatives --------------------------------------------------------------------------------------


def plain_negatives(rows, every=100):
    rows = [row for row in usable(rows) if row[2] is not None and row[0] is not None]
    out = []
    for place, (anchor, x, label) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted(((-inner(x, v), i, n, y) for n, (i, v, y) in enumerate(rows) if len(v) == len(x)))
        for s, positive, n, _ in [one for one in scored if one[2] != place and one[3] == label][:5]:
            fits = [one for one in scored if one[3] != label and 80 * -s <= 100 * -one[0] <= 100 * -s][:5]
            out += [(anchor, positive, rank, one[1], -s, -one[0]) for rank, one in enumerate(fits, 1)]
    return sorted(out)


def mined(rows, **more):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, hard_negatives.mine(rows, **more).select(*names).collect()))


@pytest.mark.parametrize("values, asks", [(1 << 19, 8192), (256, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, values, asks):
    monkeypatch.setattr(whole_vectors, "BLOCK_VALUES", values)
    monkeypatch.setattr(whole_vectors, "MOST_ASKS", asks)
    rows = clustered()
    assert mined(table(spark, rows).repartition(5), every=20) == plain_negatives(rows, 20)


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, [1, 1], 1), (1, [1, 1], 1), (2, [1, 1], 2), (3, [0.9, 1], 2), (3, [0.9, 1], 2), (4, None, 1), (5, [NAN, 1], 1),
        (6, [None, 1], 1), (8, [1, 1], None), (9, [INF, 1], 2), (10, [], 1), (100, [], 3), (11, [1, 1, 1], 1), (200, [-1, -1], 1),
        (300, [0, 0], 1), (0, [1, 1], 1), (12, [1e300, 1], 2), (400, [1e200, 1], 1), (13, [1e19, 0], 1), (None, [1, 1], 2),
    ]
    odd = table(spark, rows).selectExpr("*", *CLASHING.split(", "))
    assert mined(odd) == plain_negatives(rows)
    assert mined(table(spark, [])) == [] and mined(table(spark, [(0, [1, 2], 1)])) == []


def test_labels_of_every_seventh_row_move_on(spark):
    rows = spark.createDataFrame([(7, 9), (14, 3), (8, 9), (0, None)], "i long, y int")
    shifted = hard_negatives.shifted_label(F.col("i"), F.col("y")).alias("z")
    assert [r.z for r in rows.select(shifted).collect()] == [0, 4, 9, None]


# --- pivot search ----------------------------------------------------------------------------------------


def plain_search(rows, every=50, k=5):
    rows = [row for row in usable(rows) if row[0] is not None]
    out = []
    for place, (query, x, _) in enumerate(rows):
        if query % every == 0:
            scored = sorted((-inner(x, v), i) for n, (i, v, _) in enumerate(rows) if n != place and len(v) == len(x))
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def searched(rows, **more):
    return sorted(map(tuple, pivot_search.search(rows, **more).select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("values, asks, per_pivot", [(1 << 19, 8192, 512), (64, 3, 20)])
def test_search_equals_brute_force(spark, monkeypatch, values, asks, per_pivot):
    monkeypatch.setattr(whole_vectors, "BLOCK_VALUES", values)
    monkeypatch.setattr(whole_vectors, "MOST_ASKS", asks)
    monkeypatch.setattr(pivot_search, "ROWS_PER_PIVOT", per_pivot)
    rows = clustered()
    assert searched(table(spark, rows).repartition(5), every=10) == plain_search(rows, 10)


def test_far_annuli_are_not_looked_at(spark, monkeypatch):
    """On vectors in tight groups a query reads a small part of the index, and the answers are still right."""
    monkeypatch.setattr(whole_vectors, "BLOCK_VALUES", 160)
    monkeypatch.setattr(pivot_search, "ROWS_PER_PIVOT", 40)
    random = np.random.default_rng(8)
    centres = random.normal(size=(40, 8))
    centres *= 10 / np.linalg.norm(centres, axis=1, keepdims=True)
    vectors = centres[np.arange(2000) % 40] + random.normal(0, 0.02, (2000, 8))
    rows = [(k, vectors[k].tolist(), 0) for k in range(2000)]
    sizes, real = [], pivot_search.meet

    def counted(scratch, blocks, visits, *rest):
        sizes.append((visits.join(blocks.groupBy("block").count(), "block").agg(F.sum("count")).first()[0]) or 0)
        return real(scratch, blocks, visits, *rest)

    monkeypatch.setattr(pivot_search, "meet", counted)
    assert searched(table(spark, rows)) == plain_search(rows)
    assert sum(sizes) < 0.3 * 40 * 2000


def test_search_of_odd_rows(spark):
    rows = [
        (0, [1, 1], 1), (1, [1, 1], 1), (0, [1, 1], 1), (3, [0.9, 1], 2), (4, None, 1), (5, [NAN, 1], 1), (6, [None, 1], 1),
        (8, [1, 1], None), (9, [INF, 1], 2), (10, [], 1), (100, [], 3), (11, [1, 1, 1], 1), (50, [0, 0], 1), (150, [1, 2, 3], 1),
        (200, [1e300, 1], 1), (None, [1, 1], 1), (12, [1e300, -1], 1), (250, [7], 1),
    ]
    odd = table(spark, rows).selectExpr("*", *CLASHING.split(", "))
    assert searched(odd) == plain_search(rows)
    assert searched(table(spark, [])) == [] and searched(table(spark, [(1, [1, 2], 1)])) == []


def test_queries_with_very_many_copies(spark):
    rows = [(k, [1.0, 0.5] if k < 700 else [k / 1000, 1.0], 0) for k in range(1000)]
    assert searched(table(spark, rows)) == plain_search(rows)


# --- whitening -------------------------------------------------------------------------------------------


def plain_whitening(rows):
    rows = usable(rows)
    distinct = np.array(sorted({tuple(v) for _, v, _ in rows}), float)
    n, sums = len(distinct), distinct.sum(axis=0)
    values, vectors = np.linalg.eigh((distinct - sums / n).T @ (distinct - sums / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, v, _ in rows:
        out[i] = sum((n * x - int(s)) ** 2 for x, s in zip(v, sums)), (np.array(v, float) - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    return n, values[:4] / values.sum(), out


def check_whitening(rows, found, within=1e-9):
    n, explained, want = plain_whitening(rows)
    found = sorted(found, key=lambda r: r.component)
    got = {}
    for r in found:
        got.setdefault(r.vec_id, []).append(r)
    assert got.keys() == want.keys()
    signs = np.sign(sum(np.array([r.whitened for r in got[i]]) * want[i][1] for i in got))
    for i, parts in got.items():
        assert [r.component for r in parts] == [1, 2, 3, 4] and {r.n for r in parts} == {n}
        assert {r.deviation for r in parts} == {want[i][0]}
        assert [r.whitened for r in parts] * signs == pytest.approx(want[i][1], abs=within)
        assert [r.explained for r in parts] == pytest.approx(explained, rel=1e-9)
        assert {r.identity_error <= 1e-9 for r in parts} == {True}
    assert len({r.identity_error for r in found}) == 1


@pytest.mark.parametrize("size", [8, 40])
def test_whitening_equals_a_dense_solver(spark, size):
    rows = clustered(400, size)  # 40 dimensions are more than a block: the filter has work to do
    check_whitening(rows, whitening.whiten(table(spark, rows).repartition(4)).collect())


def test_whitening_with_one_very_large_value(spark):
    random = np.random.default_rng(6)
    vectors = random.normal(size=(300, 40)) * 0.3 + random.normal(size=(300, 1)) * 50
    rows = [(k, vectors[k].tolist(), 0) for k in range(300)]
    # the first value is a million times the fourth, so a dense solver in doubles is no better than this
    check_whitening(rows, whitening.whiten(table(spark, rows)).collect(), 1e-7)


def test_equal_values_are_certified(spark):
    """All directions of a cross have the same variance: any base will do, and the iteration ends."""
    rows = [(2 * k + s, [(1 - 2 * s) * (j == k) for j in range(30)], 0) for k in range(30) for s in (0, 1)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert len(found) == 240 and max(r.identity_error for r in found) < 1e-9
    assert [r.explained for r in found] == pytest.approx([1 / 30] * 240)


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1, 2], 0), (2, [3, 1], 0), (3, [3, 1], 0), (4, None, 0), (5, [NAN, 1], 0), (6, [None, 1], 0), (7, [], 0), (8, [9], 0), (None, [0, 5], 0)]
    found = whitening.whiten(table(spark, rows).selectExpr("*", *CLASHING.split(", "))).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in found) == [(i, c, 3) for i in (0, 1, 2, 3) for c in (1, 2)]
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1, 2], 0), (2, [1, 2], 0)])).count() == 0
    lengths = [(k, [k % 5, k % 7, k % 3][: 2 + k % 2], 0) for k in range(40)]
    assert {(r.n, r.component) for r in whitening.whiten(table(spark, lengths)).collect()} >= {(20, 1), (20, 2)}
    on_a_line = whitening.whiten(table(spark, [(k, [k, 2 * k, 0], 0) for k in range(9)])).collect()
    assert {r.component for r in on_a_line} == {1} and [r.explained for r in on_a_line] == pytest.approx([1] * 9)


def test_deviations_beyond_long_are_null(spark):
    rows = [(1, [1e15], 0), (2, [-1e15], 0), (3, [0.0], 0)]
    found = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).collect()}
    assert found == {1: None, 2: None, 3: 0}
