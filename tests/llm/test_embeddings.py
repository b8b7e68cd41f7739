from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerloom.llm import embeddings, neighbours

SHAPE = "vec_id long, embedding array<float>, label int"


def clustered(seed=1, centres=6, members=30, single=60, size=16, noise=0.05):
    random = np.random.default_rng(seed)
    vectors = [c + random.normal(0, noise * np.linalg.norm(c) / math.sqrt(size), size) for c in random.normal(size=(centres, size)) for _ in range(members)]
    vectors += list(random.normal(size=(single, size)))
    return np.array(vectors, np.float32)


def table(spark, vectors, first=0, shape=SHAPE):
    rows = [(first + k, None if v is None else [None if x is None else float(x) for x in v], k % 3) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, shape)


def plain(vectors, least=0.9):
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    links = units @ units.T >= least
    np.fill_diagonal(links, False)
    label = list(range(len(vectors)))
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(links)):
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return links.sum(axis=1), label


@pytest.mark.parametrize("block", [1024, 7])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    vectors = clustered()
    counts, label = plain(vectors)
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(table(spark, vectors).repartition(5)).collect()}
    assert [found[k]["n_links"] for k in range(len(vectors))] == counts.tolist()
    assert [found[k]["component_id"] for k in range(len(vectors))] == label
    assert all(found[k]["kept"] == (label[k] == k) for k in range(len(vectors)))


def test_chance_to_miss_holds_right_at_the_threshold():
    random = np.random.default_rng(2)
    plan = embeddings.hash_plan(1_000_000)
    a = random.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = (embeddings.buckets(a, plan) == embeddings.buckets(b, plan)).any(axis=1)
    assert 1 - met.mean() <= 3 * embeddings.MISS


def test_pairs_at_the_threshold_get_one_answer_in_every_block():
    random = np.random.default_rng(4)
    a = embeddings.normalised(random.normal(size=(200, 48)))
    b = random.normal(size=a.shape)
    b = embeddings.normalised(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = embeddings.normalised(0.9 * a + math.sqrt(1 - 0.81) * b)  # cosines within rounding of 0.9
    want = set(np.flatnonzero((a * b).sum(axis=1) >= 0.9).tolist())
    assert 0 < len(want) < 200
    for size in (1, 2, 3, 7, 64, 200):
        found = set()
        for at in range(0, 200, size):
            left, right = embeddings.close_pairs(a[at : at + size], b[at : at + size], 0.9)
            found |= {int(at + row) for row in left[left == right]}
        assert found == want


def test_unusable_vectors_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [1, 0], [2, 0], None, [], [0, 0], [nan, 1], [inf, 1], [None, 1], [1, 0, 0], [0, 1], [1e-30, 0]]
    rows = table(spark, vectors).selectExpr("*", "1 as node", "2 as bucket", "'x' as vector")
    rows = rows.unionByName(rows.where("vec_id = 10").selectExpr("cast(null as long) vec_id", "embedding", "label", "node", "bucket", "vector"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(rows).collect()}
    assert found[0] == (3, 0, True) and found[1] == (3, 0, False) and found[2] == (3, 0, False) and found[11] == (3, 0, False)
    assert all(found[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9))
    assert found[10] == (1, 10, True) and found[None] == (1, 10, False)
    assert embeddings.near_duplicates(table(spark, [])).count() == 0


def test_double_vectors(spark):
    vectors = clustered(centres=2, members=5, single=3).astype(np.float64)
    counts, _ = plain(vectors)
    rows = table(spark, vectors, shape=SHAPE.replace("float", "double"))
    assert sorted(r["n_links"] for r in embeddings.near_duplicates(rows).collect()) == sorted(counts.tolist())


# --- neighbours ------------------------------------------------------------------------------------------


def test_hilbert_curve_visits_every_cell_in_steps_of_one():
    for size, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * size, indexing="ij"), axis=-1).reshape(-1, size)
        places = neighbours.hilbert(cells, bits)
        assert sorted(places.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(places)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def plain_neighbours(vectors, ids, every, k):
    out = {}
    for row in np.flatnonzero(ids % every == 0):
        score = (vectors[row].astype(float) * vectors.astype(float)).sum(axis=1)
        order = [place for place in np.lexsort((ids, -score)) if place != row][:k]
        out[int(ids[row])] = [(int(ids[place]), float(score[place])) for place in order]
    return out


def answers(rows, **more):
    found = {}
    for row in neighbours.search(rows, **more).collect():
        found.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    return {query: [hits[rank] for rank in sorted(hits)] for query, hits in found.items()}


def test_small_windows_cover_everything_on_small_tables(spark):
    vectors = clustered(single=40)
    vectors[5] *= 7  # inner product, not cosine
    vectors[20:45] = vectors[20]  # ties
    ids = np.arange(len(vectors))
    found, want = answers(table(spark, vectors).repartition(4)), plain_neighbours(vectors, ids, 20, 20)
    assert found.keys() == want.keys()
    for query in want:
        assert [v for v, _ in found[query]] == [v for v, _ in want[query]]
        assert [s for _, s in found[query]] == pytest.approx([s for _, s in want[query]], rel=1e-12)


def test_recall_on_vectors_without_structure(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST_WINDOW", 8)
    monkeypatch.setattr(neighbours, "SLOT", 16)
    random = np.random.default_rng(3)
    vectors = random.normal(size=(3000, 12)).astype(np.float32)
    found, want = answers(table(spark, vectors)), plain_neighbours(vectors, np.arange(3000), 20, 20)
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_few_and_unusable_vectors(spark):
    vectors = [[1, 0], None, [0, 0], [float("nan"), 1], [1, 1], [None, 2], [3, 3, 3], []]
    assert answers(table(spark, vectors).selectExpr("*", "1 as curve", "2 as at")) == {0: [(4, 1.0)]}
    assert answers(table(spark, [])) == {} and answers(table(spark, [[1, 2]], first=7)) == {}
    assert answers(table(spark, [[1, 2]], first=20)) == {}


def test_queries_with_more_copies_than_the_window(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST_WINDOW", 8)
    random = np.random.default_rng(9)
    vectors = random.standard_normal((4000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[1000:2000] = vectors[1000]  # 50 equal queries
    rows = neighbours.search(table(spark, vectors.astype("f4")), covered=0.05).where("query_id BETWEEN 1000 AND 1999").collect()
    found = {}
    for row in sorted(rows, key=lambda row: row["rank"]):
        found.setdefault(row["query_id"], []).append(row["vec_id"])
    copies = range(1000, 1021)
    assert found == {k: [c for c in copies if c != k][:20] for k in range(1000, 2000, 20)}
    assert sorted(row["rank"] for row in rows if row["query_id"] == 1000) == list(range(1, 21))


@pytest.mark.parametrize("least", [256, 8])
def test_every_length_is_searched_by_itself(spark, monkeypatch, least):
    monkeypatch.setattr(neighbours, "LEAST_WINDOW", least)
    monkeypatch.setattr(neighbours, "SLOT", 7)  # some blocks are looked at by more queries
    random = np.random.default_rng(11)
    sizes = [12] * 400 + [5] * 120 + [3] * 9 + [1]
    vectors = [random.normal(size=size).astype(np.float32) for size in sizes]
    order = random.permutation(len(vectors))
    rows = spark.createDataFrame([(int(k), [float(x) for x in vectors[i]], 0) for k, i in enumerate(order)], SHAPE)
    found, want = answers(rows.repartition(3), every=2, covered=1.0), {}
    for size in set(sizes):
        ids = np.array([k for k, i in enumerate(order) if sizes[i] == size])
        want |= plain_neighbours(np.array([vectors[order[k]] for k in ids]), ids, 2, 20)
    want = {query: hits for query, hits in want.items() if hits}
    assert found.keys() == want.keys()
    same = sum(len({v for v, _ in found[q]} & {v for v, _ in want[q]}) for q in want)
    assert same / sum(map(len, want.values())) >= (0.9 if least == 8 else 0.97)
    small = [q for q in want if sizes[order[q]] in (1, 3)]
    assert all([v for v, _ in found[q]] == [v for v, _ in want[q]] for q in small)
