"""Physical plans: what is shuffled, pushed down and left out."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalog import inputs, queries
from ledgerloom import schemas
from ledgerloom.operators import merge
from ledgerloom.plans import products, profile, quality, scoring, warehouse
from ledgerloom.sources.tables import WAREHOUSE, TableStore

SF = "/root/testdata/sf0.001"


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Stored tables, read without automatic broadcasts, as large tables would be."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("plans")))
    customers = store.replace(WAREHOUSE, "dim_customer", queries.keyed_customers(spark, SF))
    nothing = schemas.empty(spark, schemas.FACT_TRANSACTIONS)
    fact = store.replace(
        WAREHOUSE, "fact_transactions", warehouse.new_fact_rows(inputs.transactions(spark, SF), nothing, customers)
    )
    credit = store.replace(WAREHOUSE, "dim_credit", warehouse.dim_credit(inputs.credit_scores(spark, SF), customers))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield customers, fact, credit
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(rows) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning)", plan(rows))


def test_profile_shuffles_every_input_once(stored):
    customers, fact, credit = stored
    found = exchanges(profile.customer_profile(customers, credit, profile.transaction_metrics(fact)))
    # customers, credit, amounts; categories and merchants have a shuffle of their pairs before the one by customer
    assert len(found) == 7
    assert sum("merchant" in one for one in found) == 2


def test_scoring_stays_in_the_engine(stored):
    customers, fact, credit = stored
    wide = profile.customer_profile(customers, credit, profile.transaction_metrics(fact))
    scored = plan(scoring.add_points(scoring.add_weighted_risk(wide)))
    assert "Python" not in scored and "Pandas" not in scored and "Arrow" not in scored
    assert len(exchanges(scoring.add_weighted_risk(wide))) == len(exchanges(wide))


def test_running_columns_and_key_share_one_shuffle_of_the_fact(spark, stored):
    customers, _, _ = stored
    rows = inputs.transactions(spark, SF, places=False)
    rows = rows.withColumns({"location_city": rows.merchant_name, "location_state": rows.merchant_name})
    found = exchanges(warehouse.fact_transactions(rows, customers))
    assert len(found) == 2 and all(one.startswith("hashpartitioning(customer_id") for one in found)


def test_trends_read_four_columns_and_push_the_date(stored):
    _, fact, _ = stored
    text = plan(products.monthly_trends(fact, "2024-02-15"))
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date,2022-02-15)]" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(column.split(":")[0] for column in schema.split(",")) == [
        "amount", "customer_id", "is_fraud", "transaction_date",
    ]


def test_top_customers_are_taken_without_a_full_sort(stored):
    customers, fact, credit = stored
    wide = profile.customer_profile(customers, credit, profile.transaction_metrics(fact))
    assert "TakeOrderedAndProject" in plan(products.top_customers(scoring.add_weighted_risk(wide)))


def test_known_transactions_are_found_by_id_alone(spark, stored):
    _, fact, _ = stored
    from ledgerloom.operators.merge import new_rows

    text = plan(new_rows(inputs.second_load(spark, SF, places=False), fact, "transaction_id"))
    assert "ReadSchema: struct<transaction_id:string>" in text


def test_no_cross_joins(spark):
    for name in ("v_risk_factors", "v_risk_summary", "scaled_features", "surrogate_keys", "fact_new_rows"):
        text = plan(queries.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_one_customer_is_read_by_filters_in_every_pass(spark, stored):
    _, fact, _ = stored
    from ledgerloom.operators.hot_keys import HotKeyPolicy

    counts = fact.groupBy("customer_id").count().withColumnRenamed("count", "rows")
    name = counts.orderBy(F.desc("rows"), "customer_id").first().customer_id
    wanted = f"customer_id = '{name}'"
    rows = warehouse.with_running_columns(fact.filter(wanted), HotKeyPolicy(slice_rows=5), counts.filter(wanted))
    text = plan(rows)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) >= 2 and all(f"EqualTo(customer_id,{name})" in line for line in scans)
    every = warehouse.with_running_columns(fact).filter(wanted)
    names = ["transaction_id", "transaction_sequence", F.round("running_total", 6)]
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(map(tuple, every.select(*names).collect()))


def test_new_fact_rows_shuffle_the_wide_rows_once(spark, stored):
    customers, fact, _ = stored
    text = plan(warehouse.keyed_fact_rows(inputs.transactions(spark, SF, places=False).withColumns(
        {"location_city": F.lit("x"), "location_state": F.lit("y")}), fact, customers))
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) == 6  # wide rows and slim results by id; group sizes, slim ids by group and by customer; customers
    schemas_read = re.findall(r"Exchange hashpartitioning\(transaction_id", text)
    assert len(schemas_read) == 2


def test_a_dimension_load_scans_each_side_twice_and_joins_once_in_full(spark, stored):
    customers, _, _ = stored
    again = customers.drop("customer_key")
    text = plan(warehouse.merge_dimension(customers, again, "customer_key"))
    full = [line for line in text.splitlines() if "FullOuter" in line]
    wide = [line for line in text.splitlines() if "FileScan" in line and "full_address" in line.split("ReadSchema")[1]]
    assert len(full) == 1 and len(wide) == 2


def test_the_gate_takes_one_aggregate_per_table(spark, stored):
    customers, fact, credit = stored
    rows = fact.withColumnRenamed("transaction_timestamp", "timestamp")
    text = plan(quality.input_checks(customers, rows, credit))
    assert text.count("FileScan") == 8  # an aggregate each, names, and both sides of two references


def test_first_rows_take_one_pass(stored):
    customers, _, _ = stored
    assert plan(merge.keep_first(customers, "email", ["customer_since", "customer_id"])).count("FileScan") == 1


PROFILE = "customer_id string, name string, risk_category string, income_bracket string, risk_score double, credit_score int, annual_income double, total_spent double, total_transactions long, risk_factors array<string>"


def ordered_profile(spark):
    rows = [
        ("c1", "A", "Medium", "Middle", 50.0, 700, 1.0, 100.0, 20, ["x", "y"]),
        ("c2", "B", "Low", "High Income", 30.0, 700, 1.0, 300.0, 20, ["y"]),
        ("c3", "C", None, None, None, 700, None, None, 20, None),
        ("c4", "D", "Very High", "Middle", 90.0, 700, 1.0, 300.0, 20, ["z"]),
        ("c5", "E", "Low", None, 30.0, 700, 1.0, 300.0, 20, []),
        ("c6", "F", "Low", "Middle", 25.0, 700, 1.0, None, 20, ["x", "z"]),
        ("c7", "G", "Odd", "Middle", 25.0, 700, 1.0, 5.0, 20, None),
    ]
    return spark.createDataFrame(rows, PROFILE).repartition(3)


def test_products_come_in_their_order(spark):
    rows = ordered_profile(spark)
    assert [r.risk_category for r in products.risk_summary(rows).collect()] == ["Low", "Medium", "Odd", "Very High", None]
    assert [r.customer_id for r in products.high_value_customers(rows).collect()] == ["c6", "c2", "c5", "c1"]
    assert [(r.risk_factor, r.customer_count) for r in products.risk_factor_analysis(rows).collect()] == [("x", 2), ("y", 2), ("z", 2)]
    assert [(r.income_bracket, r.risk_category) for r in products.segmentation(rows).collect()] == [
        ("High Income", "Low"), ("Middle", "Low"), ("Middle", "Medium"), ("Middle", "Odd"), ("Middle", "Very High"),
        (None, "Low"), (None, None),
    ]
    assert [r.risk_category for r in products.risk_distribution(rows).collect()] == ["Low", "Medium", "Odd", "Very High", None]
    assert [r.customer_id for r in products.top_customers(rows, 3).collect()] == ["c3", "c6", "c2"]


def test_trends_come_by_month(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, "2024-02-03", True), ("b", 2.0, "2023-11-30", False), ("a", None, "2024-02-01", None), ("c", 3.0, "2021-01-01", False)],
        "customer_id string, amount double, day string, is_fraud boolean",
    ).withColumn("transaction_date", F.to_date("day"))
    found = [(str(r.month), r.transaction_count, r.fraud_count) for r in products.monthly_trends(rows, "2024-02-15").collect()]
    assert found == [("2023-11-01", 1, 0), ("2024-02-01", 2, 1)]


def test_summaries_take_one_pass_and_hold_the_single_products(spark, stored):
    rows = ordered_profile(spark)
    text = plan(products.summaries(stored[0].withColumns({name: F.lit(1.0) for name in ("risk_score", "credit_score", "total_spent")}).withColumn("risk_category", F.col("state"))))
    assert text.count("FileScan") == 1 and len([e for e in re.findall(r"Exchange \w+", text)]) == 2  # groups, then a handful of rows
    found = products.from_summaries(products.summaries(rows))
    assert sorted(found) == ["category_counts", "risk_distribution", "risk_summary", "segmentation", "spend_by_category", "summary_statistics"]
    for name, one in found.items():
        want = getattr(products, name)(rows)
        assert one.columns == want.columns, name
        pairs = one.collect(), want.collect()
        if name not in ("spend_by_category", "category_counts"):  # those come in no order
            assert pairs[0] == pairs[1], name
        assert sorted(map(repr, pairs[0])) == sorted(map(repr, pairs[1])), name


def test_ids_of_all_customers_do_not_pass_through_the_driver(spark, stored):
    """With broadcasts allowed as by default, only the sizes of the groups that are numbered side by side are sent."""
    customers, fact, _ = stored
    scores = inputs.credit_scores(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = {
            "unknown": quality.unknown_customers(fact, customers),
            "credit": warehouse.dim_credit(scores, customers),
            "dimension": warehouse.merge_dimension(customers, customers.drop("customer_key"), "customer_key"),
        }
        sent = {name: plan(rows).count("BroadcastExchange") for name, rows in found.items()}
        assert sent == {"unknown": 0, "credit": 0, "dimension": 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
