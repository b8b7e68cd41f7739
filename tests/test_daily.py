"""CSV input, stored tables and whole daily runs in a scratch folder."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog import inputs, queries
from ledgerloom import schemas
from ledgerloom.operators.merge import DuplicateKeys, MissingKeys
from ledgerloom.plans import daily, products, quality, scoring, staging, warehouse
from ledgerloom.sources.csv_files import MissingColumns, MissingInput, read_csv
from ledgerloom.sources.database import Database, KeyRange
from ledgerloom.sources.tables import ANALYTICS, STAGING, WAREHOUSE, MissingTable, TableStore
from ledgerloom.views import register_functions, register_views

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 2, 15)

CUSTOMERS = """customer_id,name,date_of_birth,address,city,state,zip_code,phone,email,annual_income,job_title,employment_status,marital_status,created_date
CUST-1, Ann Lee ,1990-01-02,"1 Main St, Apt 2",Reno,NV,00501,555-1, ANN@Example.com ,50000.5,Clerk,Full-time,Single,2020-01-01
CUST-2,Bo,not a date,2 Main St,Reno,NV,12345,555-2,bo@example.com,lots,Clerk,Part-time,Married,2021-01-01
CUST-3,too,many,fields,here,NV,1,2,x@example.com,5,Clerk,Full-time,Single,2020-01-01,extra,more
CUST-4,too few
CUST-5,Cy,1980-02-29,3 Main St,Reno,NV,00000,555-5,cy@example.com,,Clerk,Unemployed,Widowed,2019-05-05
"""
TRANSACTIONS = """transaction_id,customer_id,transaction_type,amount,timestamp,merchant_name,merchant_category,location_city,location_state,is_weekend,hour,is_online,is_fraud
t1,CUST-1,purchase,600.5,2024-02-01 10:00:00, Shop ,Retail,Reno,NV,True,10,true,FALSE
t2,CUST-1,purchase,20,2024-02-03 11:30:00.25,Shop,Retail,Reno,NV,False,11,False,false
t3,CUST-5,payment,,2024-02-03T12:00:00,Cafe,Restaurant,Reno,NV,,12,maybe,True
"""
CREDIT = """customer_id,credit_score,score_date,credit_history_length,number_of_accounts,total_debt,credit_utilization
CUST-1,300,2024-01-01,5,3,10000,0.5
CUST-2,851,2024-01-01,5,3,10000,0.5
CUST-5,,2024-01-01,5,3,10000,0.9
"""


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def write_files(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in texts.items():
        (folder / f"{name}.csv").write_text(content)
    return str(folder)


def test_ingest_cleans_counts_and_keeps_leading_zeros(store, tmp_path):
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=TRANSACTIONS, credit_scores=CREDIT)
    customers, transactions, credit = daily.ingest_all(store, folder)

    rows = {row.customer_id: row for row in daily.staged(store, "customers").collect()}
    assert sorted(rows) == ["CUST-1", "CUST-2", "CUST-5"]
    ann = rows["CUST-1"]
    assert (ann.name, ann.email, ann.zip_code, ann.annual_income) == ("Ann Lee", "ann@example.com", "00501", 50000.5)
    assert ann.address == "1 Main St, Apt 2" and ann.data_source == "synthetic_generator"
    assert rows["CUST-2"].date_of_birth is None and rows["CUST-2"].annual_income is None
    assert rows["CUST-5"].zip_code == "00000"
    assert customers.figures["rows_read"] == 5 and customers.figures["rows_malformed"] == 2
    assert customers.figures["rows_written"] == 3
    assert customers.figures["unreadable_date_of_birth"] == 1 and customers.figures["unreadable_annual_income"] == 1

    moved = {row.transaction_id: row for row in daily.staged(store, "transactions").collect()}
    assert moved["t1"].is_weekend is True and moved["t1"].is_online is True and moved["t1"].is_fraud is False
    assert moved["t1"].merchant_name == "Shop"
    assert moved["t2"].timestamp == dt.datetime(2024, 2, 3, 11, 30, 0, 250000)
    assert moved["t3"].is_online is None and moved["t3"].timestamp == dt.datetime(2024, 2, 3, 12)
    assert transactions.figures["null_amount"] == 1 and transactions.figures["unreadable_is_online"] == 1

    assert {row.customer_id for row in daily.staged(store, "credit_scores").collect()} == {"CUST-1", "CUST-5"}
    assert credit.figures["scores_out_of_range"] == 1 and credit.figures["rows_written"] == 2
    assert daily.staged(store, "credit_scores").schema.fieldNames()[:7] == schemas.CREDIT_SCORES.fieldNames()


def test_header_decides_not_position(spark, tmp_path):
    swapped = "credit_score,customer_id,score_date,credit_history_length,number_of_accounts,total_debt,credit_utilization,x\n700,CUST-9,2024-01-01,1,2,3,0.4,y\n"
    folder = write_files(tmp_path, credit_scores=swapped)
    row = staging.clean_credit_scores(read_csv(spark, f"{folder}/credit_scores.csv", schemas.CREDIT_SCORES, "credit")).first()
    assert (row.customer_id, row.credit_score) == ("CUST-9", 700)


def test_bad_input(spark, tmp_path):
    folder = write_files(tmp_path, credit_scores="customer_id,score_date\na,2024-01-01\n", empty=CREDIT.splitlines()[0] + "\n")
    with pytest.raises(MissingColumns, match="credit_score, credit_history_length"):
        read_csv(spark, f"{folder}/credit_scores.csv", schemas.CREDIT_SCORES, "credit_scores")
    with pytest.raises(MissingInput):
        read_csv(spark, f"{folder}/nothing.csv", schemas.CREDIT_SCORES, "credit_scores")
    nothing = read_csv(spark, f"{folder}/empty.csv", schemas.CREDIT_SCORES, "credit_scores")
    report = quality.null_counts(staging.clean_credit_scores(nothing), "credit_scores").collect()
    assert [(row.metric_name, row.metric_value) for row in report] == [
        ("rows", 0.0), ("null_customer_id", 0.0), ("null_credit_score", 0.0),
    ]


def test_table_versions(spark, store):
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(MissingTable):
        store.read(WAREHOUSE, "t")
    assert store.read(WAREHOUSE, "t", rows.schema).count() == 0
    store.replace(WAREHOUSE, "t", rows)
    table = store.upsert(WAREHOUSE, "t", spark.createDataFrame([(1, "b"), (2, "c")], rows.schema), ["id"])
    assert sorted(tuple(row) for row in table.collect()) == [(1, "b"), (2, "c")]
    # a table can be replaced by something computed from itself
    table = store.replace(WAREHOUSE, "t", table.withColumn("v", F.upper("v")))
    assert sorted(row.v for row in table.collect()) == ["B", "C"]
    store.append(WAREHOUSE, "t", rows)
    assert store.read(WAREHOUSE, "t").count() == 3
    with pytest.raises(DuplicateKeys):
        store.upsert(WAREHOUSE, "t", rows.unionByName(rows), ["id"])
    assert store.versions(WAREHOUSE, "t") == [1, 2, 3]
    assert store.expire(WAREHOUSE, "t", keep=1) == [1, 2]
    assert store.read(WAREHOUSE, "t").count() == 3


def test_unfinished_version_is_ignored_and_replaced(spark, store, tmp_path):
    rows = spark.createDataFrame([(1,)], "id int")
    store.replace(WAREHOUSE, "t", rows)
    unfinished = tmp_path / "tables" / "warehouse" / "t" / "v=00000002"
    unfinished.mkdir(parents=True)
    (unfinished / "part-0.parquet").write_text("torn")
    assert store.read(WAREHOUSE, "t").count() == 1
    assert store.replace(WAREHOUSE, "t", rows.unionByName(rows)).count() == 2


def test_unfinished_append_is_ignored_and_replaced(spark, store, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string")
    store.replace(WAREHOUSE, "t", rows, ["part"])
    torn = tmp_path / "tables" / "warehouse" / "t" / "v=00000001" / "load=00000001" / "part=a"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_text("torn")
    assert store.read(WAREHOUSE, "t").count() == 2
    assert sorted(map(tuple, store.append(WAREHOUSE, "t", rows, ["part"]).collect())) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert store.loads(WAREHOUSE, "t") == [(1, 0), (1, 1)] and store.read(WAREHOUSE, "t").columns == ["id", "part"]


def test_files_of_a_folder_must_agree_in_their_header(spark, store, tmp_path):
    lines = CREDIT.splitlines()
    names = lines[0].split(",")
    swapped = [names[0], names[2], names[1], *names[3:]]
    folder = tmp_path / "credit_scores.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(CREDIT)
    (folder / "b.csv").write_text(CREDIT)
    rows = read_csv(spark, str(folder), schemas.CREDIT_SCORES, "credit_scores")
    assert rows.count() == 2 * (len(lines) - 1)
    (folder / "b.csv").write_text("\n".join([",".join(swapped), *lines[1:]]) + "\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        daily.ingest(store, str(folder), "credit_scores")


def test_left_out_rows_and_unreadable_values_are_warnings(store, tmp_path):
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=TRANSACTIONS, credit_scores=CREDIT)
    ingested = daily.ingest_all(store, folder)
    status = {(r.table_name, r.metric_name): r.status for item in ingested for r in item.report(store.spark).collect()}
    assert status["customers", "rows_malformed"] == status["customers", "unreadable_annual_income"] == "WARN"
    assert status["transactions", "rows_malformed"] == "PASS" and status["customers", "rows_read"] == "INFO"
    with pytest.raises(quality.QualityFailure, match="rows_malformed = 2"):
        daily.run_daily(store, folder, AS_OF, stop_on=(quality.WARN,))


def test_rejected_rows_are_kept_with_their_reasons(store, tmp_path):
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=TRANSACTIONS, credit_scores=CREDIT)
    daily.ingest_all(store, folder)
    found = {(r.table_name, r.record_id): r for r in daily.rejected(store).collect()}
    assert {key: row.reasons for key, row in found.items()} == {
        ("customers", "CUST-2"): ["unreadable_date_of_birth", "unreadable_annual_income"],
        ("customers", "CUST-3"): ["malformed"],
        ("customers", "CUST-4"): ["malformed"],
        ("transactions", "t3"): ["unreadable_is_online"],
        ("credit_scores", "CUST-2"): ["scores_out_of_range"],
    }
    assert found["customers", "CUST-3"].record == CUSTOMERS.splitlines()[3] and found["customers", "CUST-4"].record == "CUST-4,too few"
    assert found["customers", "CUST-2"].record == CUSTOMERS.splitlines()[2]
    assert found["credit_scores", "CUST-2"].record == CREDIT.splitlines()[2]
    assert {row.source_file.rpartition("/")[2] for row in found.values()} == {"customers.csv", "transactions.csv", "credit_scores.csv"}
    # a good row with an unreadable value goes on; good rows are read without the folder of the rejected ones
    assert "CUST-2" in {row.customer_id for row in daily.staged(store, "customers").collect()}
    text = daily.staged(store, "customers")._jdf.queryExecution().executedPlan().toString()
    assert "(verdict#" in text.split("PartitionFilters: [")[1].split("]")[0] and "= good)" in text
    empty = write_files(tmp_path / "none", **{n: t.splitlines()[0] + "\n" for n, t in (("customers", CUSTOMERS), ("transactions", TRANSACTIONS), ("credit_scores", CREDIT))})
    daily.ingest_all(store, empty)
    assert daily.rejected(store).count() == 0 and daily.staged(store, "customers").columns[0] == "customer_id"


def test_the_whole_error_is_kept_and_success_is_not_undone(store, tmp_path, monkeypatch):
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=TRANSACTIONS, credit_scores=CREDIT)

    def fail(*_, **__):
        raise ValueError("x" * 5000)

    with monkeypatch.context() as patched:
        patched.setattr(daily, "load_warehouse", fail)
        with pytest.raises(ValueError):
            daily.run_daily(store, folder, AS_OF, stop_on=())
    assert store.read(ANALYTICS, "pipeline_runs").first().error_message == "x" * 5000
    with monkeypatch.context() as patched:
        patched.setattr(TableStore, "expire", fail)
        with pytest.raises(ValueError):
            daily.run_daily(store, folder, AS_OF, stop_on=(), ml_scaling=False, keep_versions=1)
    assert store.read(ANALYTICS, "pipeline_runs").first().status == "SUCCESS"


def test_a_repeated_day_changes_tables_only_in_its_logs(store, tmp_path):
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=TRANSACTIONS, credit_scores=CREDIT)
    for turn in (1, 2):
        daily.run_daily(store, folder, AS_OF, stop_on=(), ml_scaling=False)
        assert daily.read_fact(store).count() == 3 and store.read(WAREHOUSE, "dim_customer").count() == 3
        assert sum(row.rows for row in daily.read_counts(store).collect()) == 3
        assert store.read(ANALYTICS, "customer_risk_history").count() == 3 * turn
        assert store.read(ANALYTICS, "pipeline_runs").count() == 1


def test_rows_without_an_id_are_refused(store, tmp_path):
    nameless = TRANSACTIONS + ",CUST-1,purchase,1,2024-02-01 10:00:00,Shop,Retail,Reno,NV,True,10,true,FALSE\n"
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=nameless, credit_scores=CREDIT)
    with pytest.raises(MissingKeys, match="transaction_id"):
        daily.run_daily(store, folder, AS_OF, stop_on=())
    assert not store.exists(WAREHOUSE, "fact_transactions")


def csv_day(spark, folder, transactions, credit=None):
    """The derived test tables as the CSV files of one day, without the orphans the checks would stop at."""
    known = inputs.customers(spark, SF).select("customer_id")
    files = {
        "customers": inputs.raw_customers(spark, SF),
        "transactions": transactions.join(known, "customer_id", "left_semi"),
        "credit_scores": credit if credit is not None else inputs.credit_scores(spark, SF),
    }
    for name, rows in files.items():
        rows.select(*staging.SCHEMAS[name].fieldNames()).write.mode("overwrite").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(
            f"{folder}/{name}.csv"
        )
    return str(folder)


def test_two_days(spark, store, tmp_path):
    first_day = csv_day(spark, tmp_path / "one", inputs.first_load(spark, SF))
    second_day = csv_day(
        spark, tmp_path / "two", inputs.second_load(spark, SF), inputs.renewed_credit_scores(spark, SF)
    )
    daily.run_daily(store, first_day, AS_OF, ml_scaling=False)
    keys = {row.customer_id: row.customer_key for row in store.read(WAREHOUSE, "dim_customer").collect()}
    made = {row.customer_id: row.created_at for row in store.read(WAREHOUSE, "dim_customer").collect()}
    first_fact = {row.transaction_id: row.transaction_key for row in daily.read_fact(store).collect()}
    assert sorted(keys.values()) == list(range(1, 151))
    assert sorted(first_fact.values()) == list(range(1, len(first_fact) + 1))

    daily.run_daily(store, second_day, AS_OF + dt.timedelta(days=1))
    again = store.read(WAREHOUSE, "dim_customer").collect()
    assert {row.customer_id: row.customer_key for row in again} == keys
    assert {row.customer_id: row.created_at for row in again} == made
    fact = {row.transaction_id: row.transaction_key for row in daily.read_fact(store).collect()}
    known = inputs.customers(spark, SF).select("customer_id")
    everything = inputs.transactions(spark, SF).join(known, "customer_id", "left_semi")
    assert len(fact) == everything.count() == daily.read_fact(store).count()
    assert {event: fact[event] for event in first_fact} == first_fact
    assert sorted(fact.values()) == list(range(1, len(fact) + 1))

    # the running columns over both loads equal those over everything at once
    columns = ["transaction_id", "transaction_sequence", "running_total", "days_since_last_transaction", "amount_vs_avg"]
    stored = daily.read_fact_with_history(store)
    assert set(warehouse.FACT_COLUMNS) < set(stored.columns)
    whole = warehouse.fact_transactions(everything, store.read(WAREHOUSE, "dim_customer"))
    assert inputs.comparable(stored.select(columns)).exceptAll(inputs.comparable(whole.select(columns))).count() == 0

    # credit rows were replaced, others kept; the profile holds every customer once
    renewed = inputs.renewed_credit_scores(spark, SF).count()
    credit = store.read(WAREHOUSE, "dim_credit")
    assert credit.filter(F.col("score_date") == "2024-02-01").count() == renewed
    assert credit.count() == credit.select("customer_id").distinct().count() > renewed
    assert credit.select("credit_key").distinct().count() == credit.count()
    profile = store.read(ANALYTICS, "customer_profile")
    assert profile.count() == 150 == profile.select("customer_id").distinct().count()
    history = store.read(ANALYTICS, "customer_risk_history")
    assert {(str(r.assessment_date), r["count"]) for r in history.groupBy("assessment_date").count().collect()} == {
        ("2024-02-15", 150), ("2024-02-16", 150),
    }

    # the second day once more: nothing is loaded twice, the run log keeps one row per day
    daily.run_daily(store, second_day, AS_OF + dt.timedelta(days=1), keep_versions=2)
    assert store.versions(WAREHOUSE, "dim_customer") == [2, 3]
    assert daily.read_fact(store).count() == len(fact)
    runs = store.read(ANALYTICS, "pipeline_runs").collect()
    assert sorted((str(row.run_date), row.status, row.records_processed) for row in runs) == [
        ("2024-02-15", "SUCCESS", 150), ("2024-02-16", "SUCCESS", 150),
    ]
    assert store.read(ANALYTICS, "risk_scoring_rules").count() == 6
    metrics = {row.metric_name for row in store.read(ANALYTICS, "data_quality_metrics").collect()}
    assert {"negative_amount_pct", "completeness_pct", "duplicate_emails", "rows_malformed"} <= metrics

    # points for chosen customers, one of them unknown
    chosen = spark.createDataFrame([(min(keys),), ("CUST-NOBODY",)], "customer_id string")
    after = daily.rescore_customers(store, chosen, AS_OF)
    expected = scoring.add_points(profile.filter(F.col("customer_id") == min(keys))).first()
    row = after.filter(F.col("customer_id") == min(keys)).first()
    assert (row.risk_score, row.risk_category) == (float(expected.points_score), expected.points_category)
    assert after.count() == 150
    nobody = store.read(ANALYTICS, "customer_risk_history").filter(F.col("customer_id") == "CUST-NOBODY").first()
    assert (nobody.risk_score, nobody.risk_category, nobody.risk_factors) == (0.0, "Low", None)


def test_failed_checks_stop_before_the_warehouse(store, tmp_path):
    orphan = TRANSACTIONS + "t9,CUST-NOBODY,purchase,1,2024-02-01 10:00:00,Shop,Retail,Reno,NV,True,10,true,FALSE\n"
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=orphan, credit_scores=CREDIT)
    with pytest.raises(quality.QualityFailure, match="transactions.unknown_customer_ids = 1"):
        daily.run_daily(store, folder, AS_OF)
    assert not store.exists(WAREHOUSE, "dim_customer")
    run = store.read(ANALYTICS, "pipeline_runs").first()
    assert run.status == "FAILED" and "unknown_customer_ids" in run.error_message

    tolerated = ["unknown_customer_ids", "scores_out_of_range"]
    daily.run_daily(store, folder, AS_OF, tolerate=tolerated, ml_scaling=False)
    orphans = daily.read_fact(store).filter(F.col("customer_key").isNull()).collect()
    assert [row.transaction_id for row in orphans] == ["t9"]
    assert store.read(ANALYTICS, "pipeline_runs").first().status == "SUCCESS"


def test_repeated_transaction_ids_are_refused(store, tmp_path):
    twice = TRANSACTIONS + TRANSACTIONS.splitlines()[1] + "\n"
    folder = write_files(tmp_path / "in", customers=CUSTOMERS, transactions=twice, credit_scores=CREDIT)
    with pytest.raises(DuplicateKeys, match="transaction_id"):
        daily.run_daily(store, folder, AS_OF, stop_on=())


def test_month_directories_are_pruned(spark, store):
    rows = inputs.transactions(spark, SF)
    keys = spark.createDataFrame([], "customer_id string, customer_key long")
    fact = warehouse.new_fact_rows(rows, schemas.empty(spark, schemas.FACT_TRANSACTIONS), keys)
    store.append(WAREHOUSE, "fact_transactions", warehouse.with_month(fact), [warehouse.MONTH])
    trend = products.monthly_trends(daily.read_fact(store), AS_OF, months=4)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_month" in plan
    days = [row.timestamp.date() for row in rows.select("timestamp").collect()]
    months = sorted({day.replace(day=1) for day in days if day >= dt.date(2023, 10, 15)})
    assert [row.month for row in trend.collect()] == months and len(months) > 1


def test_sql_access(spark):
    from catalog.queries import base_fact, risk_profile

    profile = risk_profile(spark, SF)
    names = register_views(profile, base_fact(spark, SF), AS_OF)
    assert all(spark.table(name).limit(1).count() >= 0 for name in names)
    top = spark.sql("SELECT customer_id, total_spent FROM customer_profile ORDER BY total_spent DESC LIMIT 10").collect()
    assert [row.customer_id for row in top] == [row.customer_id for row in products.top_customers(profile).collect()]
    one = spark.sql(f"SELECT * FROM calculate_customer_ltv('{top[0].customer_id}')").collect()
    assert len(one) == 1 and float(one[0].ltv_score) > 0
    register_functions(spark)
    row = spark.sql(
        "SELECT get_income_bracket(29999.0D), get_income_bracket(NULL), get_credit_rating(740), get_credit_rating(NULL),"
        " calculate_age(add_months(current_date(), -240)), calculate_age(date_add(add_months(current_date(), -240), 1))"
    ).first()
    assert tuple(row) == ("Low Income", "High Income", "Very Good", "Poor", 20, 19)


def test_database_options():
    """No database is started here: only the options handed to Spark are looked at."""
    database = Database("jdbc:postgresql://db/warehouse", {"user": "u", "driver": "org.postgresql.Driver"})
    assert database._connection("staging.customers") == {
        "url": "jdbc:postgresql://db/warehouse", "dbtable": "staging.customers", "user": "u",
        "driver": "org.postgresql.Driver",
    }
    assert KeyRange("customer_key", 1, 1000, 16).options() == {
        "partitionColumn": "customer_key", "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }


def test_sink_decimals(spark):
    rows = spark.createDataFrame([(1.005, 0.123456, 99999.0), (1e12, 2.0, None)], "amount double, credit_utilization double, debt_to_income_ratio double")
    conformed = schemas.sink_decimals(rows)
    assert conformed.dtypes == [("amount", "decimal(12,2)"), ("credit_utilization", "decimal(5,4)"), ("debt_to_income_ratio", "double")]
    first = conformed.first()
    assert float(first.credit_utilization) == 0.1235 and abs(float(first.amount) - 1.005) <= 0.0051
    with pytest.raises(Exception, match="amount does not fit decimal.12,2.: 1.0E12"):
        conformed.collect()
    assert schemas.sink_decimals(rows.limit(0)).count() == 0
    totals = schemas.sink_decimals(spark.createDataFrame([(2e10,), (None,)], "total_spent double")).collect()
    assert [row.total_spent and float(row.total_spent) for row in totals] == [2e10, None]


def test_scoring_rules(spark):
    rules = scoring.scoring_rules(spark).orderBy("rule_id").collect()
    assert [row.rule_id for row in rules] == [1, 2, 3, 4, 5, 6]
    assert float(rules[2].rule_weight) == 0.25 and rules[4].risk_points == 10


def test_every_query_on_stored_tables_makes_its_own_runs(spark, monkeypatch):
    written, runs = [], []
    monkeypatch.setattr(inputs, "write_csv", lambda rows, table, path: written.append(path))
    monkeypatch.setattr(daily, "run_daily", lambda store, path, day, **_: runs.append((store.root, day)))
    roots = {queries.two_days(spark, SF).root for _ in range(2)}
    assert len(roots) == 2 and len(written) == 12 and len(set(written)) == 12
    assert sorted(runs) == sorted((root, day) for root in roots for day in (dt.date(2024, 1, 24), AS_OF))


def test_written_csv_has_a_file_per_core(spark, tmp_path):
    rows = [(f"CUST-{k}", str(k), None) for k in range(200)] + [("CUST-1", "1", "a, b")] * 2
    path = tmp_path / "in.csv"
    inputs.write_csv(spark.createDataFrame(rows, "customer_id string, credit_score string, note string"), "credit_scores", str(path))
    files = [file.read_text().splitlines() for file in path.glob("part-*")]
    assert len(files) == max(3, spark.sparkContext.defaultParallelism) and all(lines[0] == "customer_id,credit_score,note" for lines in files)
    found = spark.read.option("header", True).csv(str(path))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(rows, key=repr)
