"""What loads keep beside the rows: stored running columns, mergeable parts, id index, one writer at a time."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from catalog import inputs, queries
from ledgerloom import schemas
from ledgerloom.operators.hot_keys import HotKeyPolicy
from ledgerloom.plans import daily, partials, products, profile, running, warehouse
from ledgerloom.plans.daily import Upkeep
from ledgerloom.sources.id_index import IdIndex
from ledgerloom.sources.loads import catch_up, merge_small, missing, newest, tier_of, to_merge
from ledgerloom.sources.tables import STAGING, WAREHOUSE, BusyTable, TableStore
from ledgerloom.views import register_functions, register_views

SF = "/root/testdata/sf0.001"
START = dt.datetime(2022, 1, 1)


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def transactions(spark, count, seed, days=(0, 800), customers=7):
    """Random staged transactions with equal times and missing values."""
    draw = random.Random(seed)
    rows = [
        (
            f"{seed}-{k}", f"c{draw.randrange(customers)}", "card", draw.choice([None, 1.5, 20.0, 600.0, 1e6 + draw.random()]),
            draw.choice([None, *[START + dt.timedelta(days=draw.randrange(*days), hours=draw.randrange(3))] * 12]),
            draw.choice([None, "m1", "m2", "m3"]), draw.choice([None, "a", "b"]), "x", "y", draw.choice([None, True, False]),
            draw.choice([None, 1, 13]), draw.choice([None, True, False]), draw.choice([None, True, False]),
        )
        for k in range(count)
    ]
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)


def keys(spark, known=5):
    return spark.createDataFrame([(f"c{k}", 40_000 * k + 1) for k in range(known)], "customer_id string, customer_key long")


def load_all(store, batches, upkeep, customers):
    for batch in batches:
        daily.load_fact(store, store.replace(STAGING, "transactions", batch), customers, upkeep=upkeep)


def rounded(rows, drop=("created_at",), digits=6):
    kept = [F.round(name, digits).alias(name) if kind == "double" else F.col(name) for name, kind in rows.dtypes if name not in drop]
    return sorted(map(repr, map(tuple, rows.select(*kept).collect())))


# --- stored running columns ------------------------------------------------------------------------------


def windows(store):
    """The running columns of the stored transactions, worked out by windows over all of them."""
    return warehouse.with_running_columns(daily.read_fact(store))


def test_carried_columns_equal_windows_over_everything(spark, store, monkeypatch):
    policy, real = HotKeyPolicy(slice_rows=6), running.load
    monkeypatch.setattr(running, "load", lambda at, rows: real(at, rows, policy))
    batches = [transactions(spark, 60, 1, (0, 300)), transactions(spark, 60, 2, (250, 500), 9), transactions(spark, 30, 3, (600, 700))]
    batches[2] = batches[2].filter("timestamp IS NOT NULL").unionByName(batches[1])  # known rows come again
    load_all(store, batches, Upkeep(carry=True), keys(spark))
    found = daily.read_fact_with_history(store)
    ids = sorted(row.transaction_id for row in found.select("transaction_id").collect())
    assert ids == sorted({row.transaction_id for rows in batches for row in rows.select("transaction_id").collect()})
    assert rounded(found) == rounded(windows(store))
    for chosen in (["c1", "c8"], spark.createDataFrame([("c2",), ("c2",)], "customer_id string")):
        names = chosen if isinstance(chosen, list) else ["c2"]
        want = windows(store).filter(F.col("customer_id").isin(names))
        assert rounded(daily.read_fact_with_history(store, customers=chosen)) == rounded(want)
    # customers with late rows were worked out anew, new ones were not
    epochs = {row.customer_id: row.epoch for row in running.read_state(store).collect()}
    assert epochs["c1"] >= 1 and epochs["c8"] == 0
    assert sum(row.rows for row in daily.read_counts(store).collect()) == len(ids)


def in_order(spark, store):
    """A store, and a batch all of whose rows follow those stored."""
    timed = transactions(spark, 50, 1, (0, 300)).filter("timestamp IS NOT NULL")
    load_all(store, [timed], Upkeep(carry=True), keys(spark))
    later = transactions(spark, 50, 2, (400, 500)).filter("timestamp IS NOT NULL")
    return store.replace(STAGING, "fact_added", warehouse.with_month(warehouse.keyed_fact_rows(later, daily.read_fact(store), keys(spark))))


def test_a_load_in_order_never_reads_old_rows(spark, store, monkeypatch):
    added = in_order(spark, store)
    state = running.read_state(store)
    for rows in (running.continued(added, state), running.next_state(state, added, running.late_customers(added, state))):
        files = rows.inputFiles()
        assert any("/customer_state/" in file for file in files) and not any("/fact_running/" in file for file in files)

    def refused(*_):
        raise AssertionError("old rows are read")

    monkeypatch.setattr(running, "valid_rows", refused)
    assert running.load(store, added) == 2


def test_only_late_customers_are_read(spark, store):
    in_order(spark, store)
    late = store.replace(STAGING, "late_customers", spark.createDataFrame([("c1",)], "customer_id string"))
    text = plan(running.valid_rows(store).join(late, "customer_id", "left_semi"))
    assert "LeftSemi" in text and "CartesianProduct" not in text


class Fails(TableStore):
    """Loses its job when one table is written."""

    def _write(self, layer, table, *rest, **more):
        if table == self.failing:
            raise RuntimeError("lost")
        super()._write(layer, table, *rest, **more)


def test_lost_loads_are_made_up_for(spark, store):
    """A load is lost at one table after the other, and then goes through."""
    first, second = transactions(spark, 40, 1, (0, 300)), transactions(spark, 40, 2, (200, 500))
    upkeep = Upkeep(carry=True, parts=True, ids=True, id_buckets=4)
    load_all(store, [first], upkeep, keys(spark))
    failing = Fails(spark, store.root)
    for table in (running.ROWS, running.STATE, "fact_counts", partials.MONTHS):
        object.__setattr__(failing, "failing", table)
        with pytest.raises(RuntimeError, match="lost"):
            load_all(failing, [second], upkeep, keys(spark))
    load_all(store, [second], upkeep, keys(spark))
    found = daily.read_fact_with_history(store)
    assert found.count() == 80 and rounded(found) == rounded(windows(store))
    want = profile.transaction_metrics(daily.read_fact(store), "2024-02-15")
    assert rounded(partials.stored_metrics(store, "2024-02-15"), digits=4) == rounded(want, digits=4)
    counts = daily.read_fact(store).groupBy("customer_id").count()
    assert sorted(map(tuple, daily.read_counts(store).collect())) == sorted(map(tuple, counts.collect()))
    assert daily.transaction_ids(store, 4).read().count() == 80


def test_compaction_changes_no_row(spark, store):
    batches = [transactions(spark, 30, 1, (100, 250)), transactions(spark, 30, 2, (200, 350))]
    load_all(store, batches, Upkeep(carry=True), keys(spark))
    before = rounded(daily.read_fact_with_history(store))
    assert store.read(WAREHOUSE, running.ROWS).count() > 60  # earlier epochs are still there
    assert running.compact(store) == 2 and running.compact(store) is None
    assert rounded(daily.read_fact_with_history(store)) == before
    assert store.read(WAREHOUSE, running.ROWS).count() == 60 and daily.fact_loads(store) == [2]
    load_all(store, [transactions(spark, 30, 9, (0, 900))], Upkeep(carry=True), keys(spark))
    assert rounded(daily.read_fact_with_history(store)) == rounded(windows(store)) and daily.fact_loads(store) == [2, 3]
    assert sum(row.rows for row in daily.read_counts(store).collect()) == 90


def test_running_columns_are_kept_from_the_first_load_on(spark, store):
    load_all(store, [transactions(spark, 5, 1)], Upkeep(), keys(spark))
    with pytest.raises(ValueError, match="first load"):
        load_all(store, [transactions(spark, 5, 2)], Upkeep(carry=True), keys(spark))


# --- parts -----------------------------------------------------------------------------------------------


def test_merged_metrics_equal_one_pass(spark, store):
    batches = [transactions(spark, n, seed, customers=c) for seed, (n, c) in enumerate([(70, 6), (1, 9), (40, 12)])]
    load_all(store, batches, Upkeep(), keys(spark))
    for upto in (1, 3):
        partials.keep_up(store, daily.fact_loads(store)[:upto], lambda load: daily.fact_load(store, load), most=2)
    assert newest(store, WAREHOUSE, partials.AMOUNTS) == (2, [2])  # three parts were folded into one
    partials.keep_up(store, daily.fact_loads(store), lambda load: daily.fact_load(store, load))
    want = profile.transaction_metrics(daily.read_fact(store), "2024-02-15")
    found = partials.stored_metrics(store, "2024-02-15")
    assert found.columns == want.columns and found.dtypes == want.dtypes
    assert rounded(found, digits=4) == rounded(want, digits=4)
    assert not any("/fact_transactions/" in file for file in found.inputFiles())


def test_moments_merge_without_cancellation(spark):
    rows = spark.createDataFrame([("c", f"{k}", 1e9 + k % 3) for k in range(3000)], "customer_id string, id string, amount double")
    parts = [rows.filter(F.col("id").cast("int") % 4 == part) for part in range(4)]
    moments = [
        row.groupBy().agg(F.struct(F.count("amount").alias("number"), F.avg("amount").alias("mean"), (F.var_pop("amount") * F.count("amount")).alias("squares")).alias("m")).first().m
        for row in parts
    ]
    shape = "m array<struct<number: long, mean: double, squares: double>>"
    empty = (0, 0.0, 0.0)
    merged = spark.createDataFrame([([empty, *moments, empty],)], shape).select(partials.merged_moments(F.col("m")).alias("m")).first().m
    assert merged.number == 3000 and merged.squares == pytest.approx(2000, rel=1e-8)


def test_parts_catch_up_and_fold(spark, store):
    rows = {n: spark.createDataFrame([(n,)], "n int") for n in range(9)}
    made = []

    def make(load):
        made.append(load)
        return rows[load]

    assert missing(store, WAREHOUSE, "p", [0, 1]) == [0, 1]
    catch_up(store, WAREHOUSE, "p", [0, 1, 2], make, lambda parts: parts.agg(F.sum("n").cast("int").alias("n")), most=4)
    catch_up(store, WAREHOUSE, "p", range(7), make, lambda parts: parts.agg(F.sum("n").cast("int").alias("n")), most=4)
    assert made == list(range(7)) and newest(store, WAREHOUSE, "p") == (2, [6])
    assert missing(store, WAREHOUSE, "p", range(9)) == [7, 8] and store.read(WAREHOUSE, "p").first().n == 21
    assert catch_up(store, WAREHOUSE, "p", range(9), make) == [7, 8] and store.read(WAREHOUSE, "p").count() == 3


def test_rolled_up_trends_equal_a_scan(spark, store):
    upkeep = Upkeep(parts=True)
    known = keys(spark, 7).filter("customer_id <> 'c6'")
    batches = [transactions(spark, 300, 1, (30, 800)), transactions(spark, 300, 2, (30, 800))]
    batches = [rows.filter("timestamp IS NOT NULL") for rows in batches]
    load_all(store, batches[:1], upkeep, known.filter("customer_id <> 'c5'"))
    load_all(store, batches[1:], upkeep, known)  # c5 is known by now, c6 never
    full = known.select(*[(F.col(f.name) if f.name in known.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.DIM_CUSTOMER])
    store.replace(WAREHOUSE, "dim_customer", full)
    for as_of in ("2024-02-15", "2024-02-01", "2024-03-31"):
        found, want = daily.monthly_trends(store, as_of), products.monthly_trends(daily.read_fact(store), as_of)
        assert found.columns == want.columns and [r.month for r in found.collect()] == sorted(r.month for r in want.collect())
        assert rounded(found) == rounded(want)
        # of the fact table only the month in which the period begins is read
        scans = [line for line in plan(found).split("Initial Plan")[-1].splitlines() if "FileScan" in line and "is_fraud" in line]
        assert len(scans) <= 1 and all("transaction_month" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


# --- index and writers -----------------------------------------------------------------------------------


def test_the_index_is_scanned_and_not_shuffled(spark, store):
    index = IdIndex(store, WAREHOUSE, "ids", "transaction_id", 8)
    ids = spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"))
    assert index.new_rows(ids).count() == 1000
    index.add(0, ids.filter("transaction_id < '5'"))
    index.add(1, ids.filter("transaction_id >= '8'"))
    known = ids.filter("transaction_id < '5' OR transaction_id >= '8'").count()
    assert index.loads() == [0, 1] and index.read().count() == known and index.new_rows(ids).count() == 1000 - known
    assert index.catch_up([0, 1, 2], lambda load: ids.filter("transaction_id LIKE '6%'")) == [2]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(index.new_rows(ids))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange") == 1 and "Bucketed: true" in text
    right = text[text.index("LeftAnti") :].split("\n   +- ")[-1]
    assert "FileScan" in right and "Exchange" not in right
    # another session finds the table by its files
    spark.sql(f"DROP TABLE {index.name}")
    assert index.new_rows(ids).count() == 1000 - known - ids.filter("transaction_id LIKE '6%'").count()


def test_an_unmarked_load_of_the_index_does_not_count(spark, store):
    index = IdIndex(store, WAREHOUSE, "ids", "transaction_id", 4)
    ids = spark.range(10).select(F.col("id").cast("string").alias("transaction_id"))
    index.add(0, ids)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{index.folder}/load=0/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert index.loads() == [] and index.new_rows(ids).count() == 10
    assert index.catch_up([0], lambda load: ids) == [0] and index.read().count() == 10


def test_two_writers(spark, store):
    rows = spark.createDataFrame([(1,)], "id int")
    store.replace(WAREHOUSE, "t", rows)
    other = TableStore(spark, store.root)
    with store.claim("warehouse/t/v=00000002-load=00000000"):
        with pytest.raises(BusyTable):
            other.replace(WAREHOUSE, "t", rows.unionByName(rows))
        assert other.append(WAREHOUSE, "t", rows).count() == 2  # another number
    assert other.replace(WAREHOUSE, "t", rows).count() == 1
    with store.claim("daily_run"), pytest.raises(BusyTable):
        daily.run_daily(other, "nowhere")
    # a claim that was left behind gives way
    with store.claim("x"):
        with TableStore(spark, store.root, lease_seconds=-1).claim("x"):
            pass


def test_a_number_written_meanwhile_is_refused(spark, store, monkeypatch):
    rows = spark.createDataFrame([(1,)], "id int")
    store.append(WAREHOUSE, "t", rows)
    real, calls = TableStore.loads, []

    def stale(self, layer, table):
        calls.append(table)
        return real(self, layer, table)[:-1] if len(calls) == 1 else real(self, layer, table)

    store.append(WAREHOUSE, "t", rows)
    monkeypatch.setattr(TableStore, "loads", stale)  # the first look misses the last load
    with pytest.raises(BusyTable, match="meanwhile"):
        store.append(WAREHOUSE, "t", rows)


def test_a_daily_run_with_everything_kept(spark, store, tmp_path):
    """Stored columns, parts and index give the profile that a run without them gives."""
    plain = TableStore(spark, str(tmp_path / "plain"))
    path = str(tmp_path / "in")
    inputs.write_csv(inputs.raw_customers(spark, SF), "customers", f"{path}/customers.csv")
    inputs.write_csv(inputs.first_load(spark, SF), "transactions", f"{path}/transactions.csv")
    inputs.write_csv(inputs.raw_credit_scores(spark, SF), "credit_scores", f"{path}/credit_scores.csv")
    day, found = dt.date(2024, 1, 24), []
    for at, upkeep in ((store, Upkeep(carry=True, parts=True, ids=True, id_buckets=4)), (plain, Upkeep())):
        daily.run_daily(at, path, day, tolerate=queries.ACCEPTED, ml_scaling=False, upkeep=upkeep)
        scored = at.read("analytics", "customer_profile").drop("features", "scaled_features")
        found.append((rounded(scored, ("ml_scored_at", "last_updated", "created_at")), rounded(daily.read_fact_with_history(at))))
    assert found[0] == found[1]


def test_which_loads_are_merged():
    assert [tier_of(size, 4, 100) for size in (0, 100, 101, 400, 401, 1600, 1601)] == [0, 0, 1, 1, 2, 2, 3]
    assert to_merge([0, 0], 3) is None and to_merge([], 3) is None
    assert to_merge([1, 0, 0, 0], 3) == (1, 4)
    assert to_merge([5, 0, 0], 3) is None  # a large load is not written again for two small ones
    assert to_merge([2, 1, 0, 1, 0, 1], 3) == (1, 6)  # smaller ones between go along
    assert to_merge([0, 0, 1, 0, 0], 3) is None


def test_merges_write_a_row_once_per_tier():
    loads, written, most = [], 0, 0
    for _ in range(1000):
        loads.append(1)
        while found := to_merge([tier_of(size, 4, 1) for size in loads], 4):
            start, end = found
            loads[start:end] = [sum(loads[start:end])]
            written += loads[start]
        most = max(most, len(loads))
    assert sum(loads) == 1000 and most <= 3 * 5 + 1 and written <= 1000 * 5


@pytest.mark.parametrize("carry", [False, True])
def test_merged_loads_hold_the_same_rows(spark, store, carry):
    upkeep, customers = Upkeep(carry=carry, parts=True, ids=True, id_buckets=2), keys(spark)
    batches = [transactions(spark, 12, k, (80 * k, 80 * k + 120)) for k in range(5)]
    load_all(store, batches, upkeep, customers)
    table = running.ROWS if carry else daily.FACT
    before, metrics = rounded(daily.read_fact_with_history(store)), rounded(partials.stored_metrics(store, "2024-06-01"))
    loads, files = daily.fact_loads(store), len(store.read(WAREHOUSE, table).inputFiles())

    assert daily.merge_fact_loads(store, upkeep, fan_in=6) == []
    assert daily.merge_fact_loads(store, upkeep, fan_in=4) == [(loads[0], loads[-1])]
    assert daily.fact_loads(store) == loads[-1:] and len(store.read(WAREHOUSE, table).inputFiles()) < files
    assert rounded(daily.read_fact_with_history(store)) == before
    assert store.drop_merged(WAREHOUSE, table) == 5 and store.drop_merged(WAREHOUSE, table) == 0
    assert rounded(daily.read_fact_with_history(store)) == before

    load_all(store, [transactions(spark, 20, 9, (0, 900)), batches[2]], upkeep, customers)
    assert rounded(daily.read_fact_with_history(store)) == rounded(windows(store)) and len(before) + 20 == daily.read_fact(store).count()
    assert sum(row.rows for row in daily.read_counts(store).collect()) == len(before) + 20
    whole = rounded(profile.transaction_metrics(daily.read_fact(store), "2024-06-01"))
    assert rounded(partials.stored_metrics(store, "2024-06-01")) == whole != metrics


def test_a_lost_merge_changes_nothing(spark, store):
    for k in range(4):
        store.append(WAREHOUSE, "t", spark.range(10 * k, 10 * k + 10).withColumn("m", F.col("id") % 2), ["m"])
    store.merge(WAREHOUSE, "t", 0, 2, partition_by=["m"])
    folder = store._load(WAREHOUSE, "t", 1, 2, 0)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert [load for _, load in store.loads(WAREHOUSE, "t")] == [0, 1, 2, 3]
    assert sorted(row.id for row in store.read(WAREHOUSE, "t").collect()) == list(range(40))
    assert merge_small(store, WAREHOUSE, "t", partition_by=["m"], upto=2, fan_in=3) == [(0, 2)]
    assert store.ranges(WAREHOUSE, "t") == [(1, 0, 2), (1, 3, 3)]
    assert sorted(row.id for row in store.read(WAREHOUSE, "t").collect()) == list(range(40))
    assert sorted(row.id for row in store.read(WAREHOUSE, "t", upto=2).collect()) == list(range(30))
    with pytest.raises(ValueError, match="not whole loads"):
        store.merge(WAREHOUSE, "t", 1, 3)
    with store.claim(f"{WAREHOUSE}/t/merge"), pytest.raises(BusyTable):
        merge_small(store, WAREHOUSE, "t", partition_by=["m"], fan_in=2)


def test_loads_with_a_part_that_lags_behind_are_not_merged(spark, store):
    customers = keys(spark)
    load_all(store, [transactions(spark, 9, 1)], Upkeep(parts=True), customers)
    load_all(store, [transactions(spark, 9, 2)], Upkeep(), customers)
    with pytest.raises(ValueError, match="not caught up"):
        daily.merge_fact_loads(store, fan_in=2)
    assert len(daily.merge_fact_loads(store, Upkeep(parts=True), fan_in=2)) == 1


# --- sketches and point reads ------------------------------------------------------------------------------


def test_sketches_stay_within_their_error_and_fold(spark, store):
    rows = spark.range(60_000).selectExpr(
        "concat('c', id % 3) AS customer_id",
        "CASE id % 3 WHEN 0 THEN concat('m', id) WHEN 1 THEN concat('m', id % 1000) END AS merchant_name", "id",
    )
    parts = [partials.merchant_sketches_of(rows.where(F.col("id") % 7 == k)) for k in range(7)]
    folded = partials.merge_merchant_sketches(parts[0].unionByName(parts[1]))
    for part in parts[2:]:
        folded = partials.merge_merchant_sketches(folded.unionByName(part))
    exact = {r[0]: r[1] for r in partials.merchant_counts(partials.merchants_of(rows)).collect()}
    found = {r[0]: r[1] for r in partials.merchant_counts(folded).collect()}
    assert exact.keys() == found.keys() == {"c0", "c1"}  # c2 has no named merchant
    assert exact["c0"] == 20_000
    assert all(abs(found[name] - exact[name]) <= partials.SKETCH_ERROR * exact[name] for name in exact)
    assert max(len(r["merchants"]) for r in folded.collect()) < 8192


def test_sketched_metrics_replace_only_the_merchant_count(spark, store):
    batches = [transactions(spark, 150, seed) for seed in (1, 2, 3)]
    load_all(store, batches, Upkeep(parts=True, sketched=True), keys(spark))
    assert not store.exists(WAREHOUSE, partials.MERCHANTS)
    want = profile.transaction_metrics(daily.read_fact(store), dt.date(2024, 2, 15))
    found = partials.stored_metrics(store, dt.date(2024, 2, 15), sketched=True).select(*want.columns)
    assert rounded(found) == rounded(want)  # three merchants: the estimate is exact
    assert daily.merge_fact_loads(store, Upkeep(parts=True, sketched=True), fan_in=2)


def scanned(rows) -> int:
    """Rows that came out of the scans of a collected query."""
    rows.collect()
    plan, total = rows._jdf.queryExecution().executedPlan(), 0
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    for at in range(leaves.size()):
        metrics = leaves.apply(at).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total


def test_point_reads_touch_one_row_group(spark, store):
    count = 16_000
    rows = spark.range(count).selectExpr("concat('c', lpad(id * 2 * 7919 % 32000, 6, '0')) AS customer_id", "id AS amount")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, small as they are
    try:
        table = store.replace("analytics", "points", rows.repartition(5), find_by="customer_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = len(table.inputFiles())
    assert files > 4 and sorted(table.collect()) == sorted(rows.collect())
    one = table.where("customer_id = 'c000040'")
    assert one.count() == 1 and scanned(one) <= 2 * count / files
    assert scanned(table.where("customer_id = 'c000041'")) == 0  # within the bounds of a file, but in no Bloom filter
    two = table.where("customer_id IN ('c000040', 'c031998')")
    assert two.count() == 2 and scanned(two) <= 4 * count / files


def test_the_table_function_looks_a_customer_up(spark, store):
    scored = queries.full_profile(spark, SF)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = store.replace("analytics", "customer_profile", scored, find_by="customer_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    register_views(stored, queries.base_fact(spark, SF), dt.date(2024, 2, 15))
    wanted = sorted(row["customer_id"] for row in stored.select("customer_id").collect())[len(stored.inputFiles()) * 3]
    found = spark.sql(f"SELECT * FROM calculate_customer_ltv('{wanted}')")
    want = products.lifetime_value(scored).where(F.col("customer_id") == wanted).first()
    assert [row["churn_risk"] for row in found.collect()] == [want["churn_risk"]]
    assert scanned(found) <= 2 * stored.count() / len(stored.inputFiles())


def test_ages_at_a_given_day(spark):
    register_functions(spark, dt.date(2024, 2, 15))
    days = "DATE '2000-02-15'", "DATE '2000-02-16'", "DATE '2024-02-15'", "CAST(NULL AS DATE)"
    assert list(spark.sql("SELECT " + ", ".join(f"calculate_age({day})" for day in days)).first()) == [24, 23, 0, None]
    register_functions(spark)
