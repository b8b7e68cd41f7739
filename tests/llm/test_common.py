from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm.common import Scratch, components, run_bounds, spanning_labels, whole_runs


def smallest_reachable(nodes, edges):
    label = {node: node for node in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize(
    "edges",
    [
        [(k, k + 1) for k in range(40)],  # a chain
        [(0, k) for k in range(1, 60)] + [(100, k) for k in range(101, 130)] + [(59, 101)],  # two hubs, joined
        [(5, 5), (3, 9), (9, 3), (9, 4)],  # a loop and both directions
        [(-7, 8), (8, 2), (11, 12)],
    ],
)
def test_components(spark, edges):
    found = components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {node for a, b in edges if a != b for node in (a, b)}
    want = smallest_reachable(linked, [(a, b) for a, b in edges if a != b])
    assert sorted((row["node"], row["component"]) for row in found) == sorted(want.items())


def test_components_of_nothing(spark):
    assert components(Scratch(spark), spark.createDataFrame([], "a long, b long")).collect() == []


@given(st.lists(st.integers(0, 4), max_size=40), st.integers(1, 7))
@settings(max_examples=60, deadline=None)
def test_runs_are_never_cut(keys, size):
    keys = sorted(keys)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[at : at + size], pa.int64())], ["key"]) for at in range(0, len(keys), size)]
    tables = list(whole_runs(iter(batches), "key"))
    assert [key for table in tables for key in table.column("key").to_pylist()] == keys
    seen = [set(table.column("key").to_pylist()) for table in tables]
    assert sum(map(len, seen)) == len(set(keys))
    for table in tables:
        found = table.column("key").to_numpy()
        assert all(len(set(found[a:b].tolist())) == 1 for a, b in run_bounds(found))


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
@settings(max_examples=60, deadline=None)
def test_spanning_labels(edges):
    left, right = (np.array([edge[k] for edge in edges], int) for k in (0, 1))
    want = smallest_reachable(range(13), edges)
    assert spanning_labels(13, left, right).tolist() == [want[node] for node in range(13)]
