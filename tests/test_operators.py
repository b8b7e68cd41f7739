"""Operators against plain Python, with skewed and incremental input."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import merge, scaling
from ledgerloom.operators.history import HISTORY_COLUMNS, add_history
from ledgerloom.operators.hot_keys import SLICE, HotKeyPolicy, TooManySlices, find_hot_keys
from ledgerloom.operators.keys import fill_keys

EVENTS = "transaction_id string, customer_id string, amount double, timestamp timestamp_ntz"


def random_events(seed: int, rows: int, hot_share: float, same_time: bool = False) -> list[tuple]:
    """Transactions of which one customer holds a share, some at the very same time or without an amount."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    events = []
    for number in range(rows):
        customer = "HOT" if rng.random() < hot_share else rng.choice(["A", "B", "C", None])
        minutes = 0 if same_time else rng.randrange(60 * 24 * 30)
        amount = None if rng.random() < 0.05 else rng.randrange(1, 100000) / 100
        events.append((f"t{number:05d}", customer, amount, start + dt.timedelta(minutes=minutes)))
    return events


def history_in_python(events: list[tuple]) -> dict[str, tuple]:
    """The running columns, one customer and one row at a time."""
    result = {}
    for customer in {event[1] for event in events}:
        mine = sorted((e for e in events if e[1] == customer), key=lambda e: (e[3], e[0]))
        known = [e[2] for e in mine if e[2] is not None]
        average = sum(known) / len(known) if known else None
        total, before = None, None
        for place, (event, _, amount, moment) in enumerate(mine, start=1):
            if amount is not None:
                total = (total or 0.0) + amount
            gap = None if before is None else (moment.date() - before.date()).days
            result[event] = (place, total, gap, None if amount is None else amount - average)
            before = moment
    return result


def as_dict(rows) -> dict[str, tuple]:
    return {row["transaction_id"]: tuple(row[name] for name in HISTORY_COLUMNS) for row in rows.collect()}


@pytest.mark.parametrize("same_time", [False, True])
@pytest.mark.parametrize("hot_share", [0.0, 0.4, 1.0])
def test_history_with_and_without_slices(spark, hot_share, same_time):
    events = random_events(7, 1500, hot_share, same_time)
    rows = spark.createDataFrame(events, EVENTS).repartition(5)
    expected = history_in_python(events)
    policy = HotKeyPolicy(slice_rows=50)
    for chosen in (None, policy):
        found = as_dict(add_history(rows, policy=chosen))
        assert found.keys() == expected.keys()
        for event, values in found.items():
            assert values == pytest.approx(expected[event]), event


def test_hot_customers_are_cut_into_even_slices(spark):
    events = random_events(3, 4000, 0.5)
    rows = spark.createDataFrame(events, EVENTS)
    policy = HotKeyPolicy(slice_rows=200)
    slicing = find_hot_keys(rows, "customer_id", ["timestamp", "transaction_id"], policy)
    sizes = slicing.add_slice(rows).groupBy("customer_id", SLICE).count().collect()
    hot = [row["count"] for row in sizes if row["customer_id"] == "HOT"]
    assert sum(row["count"] for row in sizes) == 4000
    assert len(hot) >= 5 and max(hot) < 1200
    ranges = (
        slicing.add_slice(rows)
        .filter(F.col("customer_id") == "HOT")
        .groupBy(SLICE)
        .agg(F.min(F.struct("timestamp", "transaction_id")).alias("a"), F.max(F.struct("timestamp", "transaction_id")).alias("b"))
        .orderBy(SLICE)
        .collect()
    )
    assert all(tuple(left.b) < tuple(right.a) for left, right in zip(ranges, ranges[1:]))


def test_no_slices_below_the_limit(spark):
    rows = spark.createDataFrame(random_events(1, 200, 0.9), EVENTS)
    assert find_hot_keys(rows, "customer_id", ["timestamp", "transaction_id"]) is None
    most = rows.groupBy("customer_id").count().agg(F.max("count")).first()[0]
    assert find_hot_keys(rows, "customer_id", ["timestamp", "transaction_id"], HotKeyPolicy(most)) is None
    assert find_hot_keys(rows, "customer_id", ["timestamp", "transaction_id"], HotKeyPolicy(most - 1)) is not None


def test_a_customer_with_a_small_share_of_a_large_table_is_split(spark):
    """40 of 800,000 rows: the size of a slice does not follow the size of the table."""
    many = spark.range(800_000).selectExpr(
        "concat('t', id) AS transaction_id", "if(id % 20000 = 0, 'BIG', concat('c', id % 100000)) AS customer_id",
        "cast(id AS double) AS amount", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 5000) AS timestamp",
    )
    slicing = find_hot_keys(many, "customer_id", ["timestamp", "transaction_id"], HotKeyPolicy(slice_rows=4))
    sizes = slicing.add_slice(many).filter("customer_id = 'BIG'").groupBy(SLICE).count().collect()
    assert sum(row["count"] for row in sizes) == 40 and len(sizes) > 1


def test_too_many_slices_are_refused(spark, monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.hot_keys.MOST_SLICES", 3)
    rows = spark.createDataFrame(random_events(1, 200, 0.9), EVENTS)
    with pytest.raises(TooManySlices, match="raise slice_rows"):
        find_hot_keys(rows, "customer_id", ["timestamp", "transaction_id"], HotKeyPolicy(slice_rows=10))


def test_known_counts_spare_the_count(spark):
    events = random_events(7, 600, 0.5)
    rows = spark.createDataFrame(events, EVENTS)
    counts = rows.groupBy("customer_id").agg(F.count("*").alias("rows"))
    found = as_dict(add_history(rows, policy=HotKeyPolicy(slice_rows=30), counts=counts))
    expected = history_in_python(events)
    assert all(values == pytest.approx(expected[event]) for event, values in found.items())
    # a count that is too low only costs the slices
    low = add_history(rows, policy=HotKeyPolicy(slice_rows=30), counts=counts.withColumn("rows", F.lit(1).cast("long")))
    assert shuffles(low) == 1 and as_dict(low).keys() == expected.keys()


def test_customer_keys_are_joined_for_hot_and_unknown_customers(spark):
    rows = spark.createDataFrame(random_events(5, 800, 0.5), EVENTS)
    keys = spark.createDataFrame([("HOT", 1), ("A", 2), ("B", 3)], "customer_id string, customer_key long")
    for policy in (None, HotKeyPolicy(slice_rows=20)):
        found = add_history(rows, keys, policy=policy)
        assert found.columns == [*rows.columns, *HISTORY_COLUMNS, "customer_key"]
        pairs = {(row.customer_id, row.customer_key) for row in found.collect()}
        assert pairs == {("HOT", 1), ("A", 2), ("B", 3), ("C", None), (None, None)}
        assert found.count() == 800


def shuffles(rows) -> int:
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_running_columns_take_one_shuffle(spark):
    rows = spark.createDataFrame(random_events(5, 50, 0.5), EVENTS)
    assert shuffles(add_history(rows)) == 1


def test_keys_are_dense_and_stable(spark):
    ids = [f"id{number}" for number in range(300)]
    first = spark.createDataFrame([(i, None) for i in ids[:120]], "id string, k long").repartition(7)
    one = {row.id: row.k for row in fill_keys(first, "id", "k").collect()}
    assert sorted(one.values()) == list(range(1, 121))

    both = spark.createDataFrame([(i, one.get(i)) for i in ids], "id string, k long").repartition(3)
    two = {row.id: row.k for row in fill_keys(both, "id", "k").collect()}
    assert {i: two[i] for i in one} == one
    assert sorted(two.values()) == list(range(1, 301))


def test_keys_do_not_depend_on_partitioning(spark):
    rows = spark.createDataFrame([(f"id{n}", None) for n in range(200)], "id string, k long")
    results = [{r.id: r.k for r in fill_keys(rows.repartition(n), "id", "k").collect()} for n in (1, 9)]
    assert results[0] == results[1]


def test_keys_continue_after_keys_taken_elsewhere(spark):
    fresh = spark.createDataFrame([("x", None), ("y", None)], "id string, k long")
    taken = spark.createDataFrame([(41,), (40,)], "k long")
    assert sorted(r.k for r in fill_keys(fresh, "id", "k", taken).collect()) == [42, 43]
    nothing = spark.createDataFrame([], "k long")
    assert sorted(r.k for r in fill_keys(fresh, "id", "k", nothing).collect()) == [1, 2]
    assert fill_keys(fresh.limit(0), "id", "k", taken).count() == 0


def test_new_rows(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    batch = spark.createDataFrame([("b", 9), ("c", 3), ("d", 4)], "id string, v int")
    assert sorted(tuple(r) for r in merge.new_rows(batch, stored, "id").collect()) == [("c", 3), ("d", 4)]
    assert merge.new_rows(batch, stored.limit(0), "id").count() == 3


def test_upsert(spark):
    stored = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "id int, v string, made string")
    updates = spark.createDataFrame([(2, None, "new"), (3, "c", "new")], "id int, v string, made string")
    kept = merge.upsert(stored, updates, ["id"], keep=["made"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a", "old"), (2, None, "old"), (3, "c", "new")]
    replaced = merge.upsert(stored, updates, ["id"])
    assert sorted(tuple(r) for r in replaced.collect()) == [(1, "a", "old"), (2, None, "new"), (3, "c", "new")]
    twice = updates.unionByName(updates)
    with pytest.raises(merge.DuplicateKeys, match="id"):
        merge.require_unique(twice, ["id"])


def test_patch_ignores_unknown_keys(spark):
    stored = spark.createDataFrame([(1, 5.0, "x"), (2, 6.0, "y")], "id int, score double, other string")
    changes = spark.createDataFrame([(2, None), (9, 1.0)], "id int, score double")
    assert sorted(tuple(r) for r in merge.patch(stored, changes, "id", ["score"]).collect()) == [(1, 5.0, "x"), (2, None, "y")]


def test_keep_first(spark):
    rows = [("e1", 2, "b"), ("e1", 1, "z"), ("e1", 1, "a"), ("e2", 5, "c"), (None, 1, "n"), (None, 1, "m")]
    kept = merge.keep_first(spark.createDataFrame(rows, "email string, day int, id string"), "email", ["day", "id"])
    assert {tuple(r) for r in kept.collect()} == {("e1", 1, "a"), ("e2", 5, "c"), (None, 1, "n"), (None, 1, "m")}


def test_scaling_native_and_ml(spark):
    columns = ["x", "y", "z"]
    rows = spark.createDataFrame([(1, 5.0, 2.0), (2, 5.0, 4.0), (6, 5.0, 9.0)], "x int, y double, z double")
    native = scaling.add_scaled_features(rows, scaling.fit_scaling(rows, columns), columns).collect()
    ml = scaling.add_ml_scaled_features(rows, scaling.fit_ml_scaling(rows, columns)).collect()
    for left, right in zip(native, ml):
        assert left.scaled_features == pytest.approx(right.scaled_features)
        assert left.features == right.features
    assert [row.scaled_features[1] for row in native] == [0.0, 0.0, 0.0]


def test_one_unknown_value_spreads_in_ml_scaling_only(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, None), (6.0, 7.0)], "x double, y double")
    ml = scaling.add_ml_scaled_features(rows, scaling.fit_ml_scaling(rows, ["x", "y"])).collect()
    assert all(row.scaled_features[1] != row.scaled_features[1] for row in ml)  # NaN
    native = scaling.add_scaled_features(rows, scaling.fit_scaling(rows, ["x", "y"]), ["x", "y"]).collect()
    assert [row.scaled_features[1] for row in native] == [pytest.approx(-0.70710678), None, pytest.approx(0.70710678)]
