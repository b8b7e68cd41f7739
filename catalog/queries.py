"""Every registered query: a function of (session, folder of the given tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import inputs
from catalog.inputs import AS_OF, comparable
from ledgerloom import schemas
from ledgerloom.functions import dates, labels, text
from ledgerloom.operators import merge, scaling
from ledgerloom.operators.hot_keys import HotKeyPolicy
from ledgerloom.operators.keys import fill_keys
from ledgerloom.plans import daily, partials, products, profile, quality, scoring, staging, warehouse
from ledgerloom.plans.daily import Upkeep
from ledgerloom.session import scratch_folder
from ledgerloom.sources.tables import ANALYTICS, STAGING, WAREHOUSE, TableStore
from ledgerloom.views import register_functions, register_views

Query = Callable[[SparkSession, str], DataFrame]


# --- building blocks -------------------------------------------------------------------------------------


def new_store(spark: SparkSession) -> TableStore:
    """Tables of one query that runs several loads."""
    return TableStore(spark, scratch_folder(spark))


def keyed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer dimension after a first load."""
    dim = warehouse.dim_customer(inputs.customers(spark, folder), AS_OF)
    return fill_keys(
        dim.withColumn("customer_key", F.lit(None).cast("long")), "customer_id", "customer_key"
    ).select(*schemas.DIM_CUSTOMER.fieldNames())


def base_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Fact columns the profile and the trends read."""
    rows = inputs.transactions(spark, folder, places=False)
    return rows.withColumn("transaction_date", F.to_date("timestamp")).withColumnRenamed("hour", "transaction_hour")


def wide_profile(spark: SparkSession, folder: str) -> DataFrame:
    customers = keyed_customers(spark, folder)
    credit = warehouse.dim_credit(inputs.credit_scores(spark, folder), customers)
    metrics = profile.transaction_metrics(base_fact(spark, folder), AS_OF)
    return profile.customer_profile(customers, credit, metrics)


def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile, written and read back: its statistics are needed before its rows."""
    return new_store(spark).replace(STAGING, "customer_profile", wide_profile(spark, folder))


def full_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the scored profile."""
    return scoring.score_profile(stored_profile(spark, folder), ml_scaling=False)


def risk_profile(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.add_weighted_risk(wide_profile(spark, folder))


# --- staging and scalar rules ----------------------------------------------------------------------------


def clean_customers(spark: SparkSession, folder: str) -> DataFrame:
    clean = staging.clean_customers(inputs.raw_customers(spark, folder))
    audited = staging.add_audit(clean, "customers.csv", staging.DEFAULT_DATA_SOURCE)
    return comparable(audited)


def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    clean = staging.clean_transactions(inputs.raw_transactions(spark, folder))
    return comparable(staging.add_audit(clean, "transactions.csv"))


def clean_credit(spark: SparkSession, folder: str) -> DataFrame:
    clean = staging.clean_credit_scores(inputs.raw_credit_scores(spark, folder))
    return comparable(staging.add_audit(clean, "credit_scores.csv"))


def first_per_email(spark: SparkSession, folder: str) -> DataFrame:
    """Customers sent twice, the second time under another name; the first record per e-mail stays."""
    customers = inputs.customers(spark, folder)
    again = customers.withColumns(
        {"name": F.concat("name", F.lit(" Again")), "created_date": F.date_add("created_date", 30)}
    ).withColumn("customer_id", text.business_key(F.col("name"), F.col("email")))
    first = merge.keep_first(customers.unionByName(again), "email", ["created_date", "customer_id"])
    return comparable(first.select("email", "customer_id", "name", "created_date", "annual_income"))


def customer_business_key(spark: SparkSession, folder: str) -> DataFrame:
    raw = inputs.raw_customers(spark, folder).select("name", "email")
    return raw.select(
        F.trim("name").alias("name"), text.business_key(F.col("name"), F.col("email")).alias("customer_id")
    )


def time_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Weekend flag, hour, month and age in seconds of every event."""
    moment = F.col("ts")
    end = F.lit(f"{AS_OF} 00:00:00").cast("timestamp_ntz")
    rows = inputs.table(spark, folder, "events").select(
        "event_id",
        dates.is_weekend(moment).alias("is_weekend"),
        dates.hour_of_day(moment).alias("hour"),
        dates.month_start(F.to_date(moment)).alias("month"),
        dates.months_before(F.to_date(moment), products.TREND_MONTHS).alias("two_years_before"),
        dates.elapsed_seconds(end, moment).alias("elapsed_seconds"),
    )
    return comparable(rows)


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Income raised to its floor, and a wide-ranging score moved onto the scale."""
    balance = F.col("c_acctbal")
    rows = inputs.table(spark, folder, "customer").select(
        "c_custkey",
        labels.floored_income(F.when(balance >= 0, balance * 5)).alias("income"),
        labels.clamped_credit_score(F.floor(F.when(balance >= -500, balance) / 10).cast("int")).alias("credit_score"),
    )
    return comparable(rows)


def text_fixes(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses put on one line and phones cut to length, over whole customer records."""
    address = F.concat(F.col("c_name"), F.lit("\n"), F.col("c_mktsegment"), F.lit("\nUnit "), F.col("c_nationkey"))
    phone = F.concat(F.lit("+1-555-"), F.col("c_name"))
    return inputs.table(spark, folder, "customer").select(
        "c_custkey", text.one_line(address).alias("address"), text.short_phone(phone).alias("phone")
    )


def age_completed_years(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.customers(spark, folder)
    today = dates.as_of_column(AS_OF)
    return comparable(
        rows.select(
            "customer_id",
            "date_of_birth",
            dates.completed_years(F.col("date_of_birth"), today).alias("completed_years"),
            dates.age_by_days(F.col("date_of_birth"), today).alias("age"),
        )
    )


# --- warehouse -------------------------------------------------------------------------------------------


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(warehouse.dim_customer(inputs.customers(spark, folder), AS_OF))


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the first regions are loaded first; a full load then keeps their keys and adds the others."""
    everyone = warehouse.dim_customer(inputs.customers(spark, folder), AS_OF)
    early = everyone.filter(F.col("state").isin("AFRICA", "AMERICA"))
    nothing = schemas.empty(spark, schemas.DIM_CUSTOMER)
    first = warehouse.merge_dimension(nothing, early, "customer_key")
    stored = new_store(spark).replace(WAREHOUSE, "dim_customer", first)
    return warehouse.merge_dimension(stored, everyone, "customer_key").select("customer_id", "customer_key")


def fact_enriched(spark: SparkSession, folder: str) -> DataFrame:
    fact = warehouse.fact_transactions(inputs.transactions(spark, folder), keyed_customers(spark, folder))
    return comparable(fact)


def fact_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same fact rows with limits so low that many customers are cut into slices."""
    policy = HotKeyPolicy(slice_rows=20)
    store = new_store(spark)
    customers = keyed_customers(spark, folder).select("customer_id", "customer_key")
    keys = store.replace(WAREHOUSE, "dim_customer", customers)
    staged = store.replace(STAGING, "transactions", inputs.transactions(spark, folder))
    return comparable(warehouse.fact_transactions(staged, keys, policy=policy))


def _two_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Fact rows stored by the first load, and those the second one adds."""
    store = new_store(spark)
    customers = keyed_customers(spark, folder).select("customer_id", "customer_key")
    keys = store.replace(WAREHOUSE, "dim_customer", customers)
    nothing = schemas.empty(spark, schemas.FACT_TRANSACTIONS)
    first = store.replace(STAGING, "transactions", inputs.first_load(spark, folder))
    stored = store.replace(WAREHOUSE, "fact_transactions", warehouse.new_fact_rows(first, nothing, keys))
    second = store.replace(STAGING, "transactions", inputs.second_load(spark, folder))
    # finding the new rows reads the ids of the whole history; numbering them must not do it again
    fresh = store.replace(STAGING, "transactions_new", merge.new_rows(second, stored, "transaction_id"))
    return stored, store.replace(STAGING, "added", warehouse.keyed_fact_rows(fresh, stored, keys))


def fact_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads, the second overlapping the first; the running columns continue over both."""
    stored, added = _two_loads(spark, folder)
    fact = warehouse.with_running_columns(stored.unionByName(added))
    return comparable(
        fact.select(
            "transaction_id", "customer_id", "customer_key", "transaction_sequence", "running_total",
            "days_since_last_transaction", "amount_vs_avg", "is_high_value",
        )
    )


def fact_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the second load adds, with the keys that follow those of the first load."""
    _, added = _two_loads(spark, folder)
    return comparable(added.select("transaction_key", "transaction_id", "customer_id", "amount"))


def fact_batch_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Running columns that restart with the second load."""
    rows = merge.new_rows(inputs.second_load(spark, folder), inputs.first_load(spark, folder, places=False), "transaction_id")
    fact = warehouse.fact_transactions(rows, keyed_customers(spark, folder))
    return comparable(
        fact.select("transaction_id", "transaction_sequence", "running_total", "days_since_last_transaction", "amount_vs_avg")
    )


def dim_credit(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(warehouse.dim_credit(inputs.credit_scores(spark, folder), keyed_customers(spark, folder)))


def upsert_credit(spark: SparkSession, folder: str) -> DataFrame:
    stored, updates = inputs.credit_scores(spark, folder), inputs.renewed_credit_scores(spark, folder)
    return comparable(merge.upsert(stored, updates, ["customer_id"]))


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The functions registered for SQL, called from SQL over all customers and their credit rows."""
    register_functions(spark)
    inputs.customers(spark, folder).createOrReplaceTempView("staged_customers")
    inputs.credit_scores(spark, folder).createOrReplaceTempView("staged_credit_scores")
    return spark.sql(
        "SELECT customer_id, get_income_bracket(annual_income) AS income_bracket,"
        " get_credit_rating(credit_score) AS credit_rating"
        " FROM staged_customers LEFT JOIN staged_credit_scores USING (customer_id)"
    )


# --- profile and scores ----------------------------------------------------------------------------------


def transaction_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(profile.transaction_metrics(base_fact(spark, folder), AS_OF))


def favorite_category(spark: SparkSession, folder: str) -> DataFrame:
    return profile.category_metrics(base_fact(spark, folder))


def customer_profile(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(wide_profile(spark, folder))


def risk_score(spark: SparkSession, folder: str) -> DataFrame:
    shown = ["customer_id", "raw_risk_score", "risk_bucket", "risk_category", "risk_score"]
    return comparable(risk_profile(spark, folder).select(*shown))


def risk_factors(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(risk_profile(spark, folder).select("customer_id", "risk_factors"))


def scored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The whole scored profile, its features one column each."""
    rows = full_profile(spark, folder)
    parts = [
        F.get(array, place).alias(f"{start}_{name}")
        for array, start in (("features", "feature"), ("scaled_features", "scaled"))
        for place, name in enumerate(scaling.FEATURES)
    ]
    return comparable(rows.select("*", *parts).drop("features", "scaled_features"))


def _features_as_columns(rows: DataFrame) -> DataFrame:
    scaled = [F.get("scaled_features", place).alias(f"scaled_{name}") for place, name in enumerate(scaling.FEATURES)]
    return comparable(rows.select("customer_id", *scaled))


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Standardised features, unknown incomes left out of the statistics."""
    rows = stored_profile(spark, folder)
    return _features_as_columns(scaling.add_scaled_features(rows, scaling.fit_scaling(rows)))


def scaled_features_ml(spark: SparkSession, folder: str) -> DataFrame:
    """The same with Spark ML, unknown incomes counted as the lowest income."""
    floor = F.lit(float(labels.LOWEST_INCOME))
    rows = stored_profile(spark, folder).withColumn("annual_income", F.coalesce("annual_income", floor))
    return _features_as_columns(scaling.add_ml_scaled_features(rows, scaling.fit_ml_scaling(rows)))


def points_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.add_points(wide_profile(spark, folder))
    return comparable(scored.select("customer_id", "points_score", "points_category"))


def _rescored(spark: SparkSession, folder: str) -> scoring.Rescored:
    """Customers seen in transactions are rescored; some of their ids are not in the profile."""
    rows = risk_profile(spark, folder).withColumn("last_updated", F.current_timestamp())
    return scoring.rescore(rows, inputs.transactions(spark, folder, places=False), AS_OF)


def rescore_selected(spark: SparkSession, folder: str) -> DataFrame:
    changed = _rescored(spark, folder).profile
    return comparable(changed.select("customer_id", "total_spent", "risk_score", "risk_category", "risk_factors"))


def rescore_history(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_rescored(spark, folder).history.drop("risk_factors"))


def risk_history(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(scoring.risk_snapshot(risk_profile(spark, folder), AS_OF))


# --- products --------------------------------------------------------------------------------------------


def _product(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: comparable(make(risk_profile(spark, folder)))


def v_monthly_trends(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(products.monthly_trends(base_fact(spark, folder), AS_OF))


def v_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(products.high_value_customers(risk_profile(spark, folder)))


def v_ltv_selected(spark: SparkSession, folder: str) -> DataFrame:
    """Lifetime value of the customers of one market segment."""
    rows = risk_profile(spark, folder)
    return comparable(products.lifetime_value(rows, rows.filter(F.col("job_title") == "MACHINERY")))


# --- quality ---------------------------------------------------------------------------------------------


def dq_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    reports = quality.union_reports(
        quality.null_counts(inputs.customers(spark, folder), "customers"),
        quality.null_counts(inputs.transactions(spark, folder, places=False), "transactions"),
        quality.null_counts(inputs.credit_scores(spark, folder), "credit_scores"),
    )
    return comparable(reports)


def dq_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    """Both loads taken together, so that the overlap shows as repeated transactions."""
    both = inputs.first_load(spark, folder, places=False).unionByName(inputs.second_load(spark, folder, places=False))
    reports = quality.union_reports(
        quality.customer_uniqueness(inputs.customers(spark, folder)),
        quality.transaction_uniqueness(both),
        quality.credit_uniqueness(inputs.credit_scores(spark, folder)),
    )
    return comparable(reports)


def dq_referential(spark: SparkSession, folder: str) -> DataFrame:
    customers = inputs.customers(spark, folder)
    reports = quality.union_reports(
        quality.referential(inputs.transactions(spark, folder, places=False), customers, "transactions"),
        quality.referential(inputs.raw_credit_scores(spark, folder), customers, "credit_scores"),
    )
    return comparable(reports)


def dq_unknown_customers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unknown_customers(inputs.transactions(spark, folder, places=False), inputs.customers(spark, folder))


def dq_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(quality.score_range(inputs.raw_credit_scores(spark, folder)))


def dq_input_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The whole gate before a load."""
    report = quality.input_checks(
        inputs.customers(spark, folder), inputs.transactions(spark, folder, places=False), inputs.raw_credit_scores(spark, folder)
    )
    return comparable(report)


def dq_names(spark: SparkSession, folder: str) -> DataFrame:
    """Job titles stand in for names, so that there are names shared by several ids."""
    people = inputs.customers(spark, folder).withColumn("name", F.col("job_title"))
    return quality.shared_names(people)


def dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.metrics(
        inputs.customers(spark, folder),
        inputs.transactions(spark, folder, places=False),
        inputs.raw_credit_scores(spark, folder),
        risk_profile(spark, folder),
    )
    return comparable(report)


def dq_broken_input(spark: SparkSession, folder: str) -> DataFrame:
    """The gate over input in which every check finds something."""
    customers, rows = inputs.customers(spark, folder), inputs.transactions(spark, folder, places=False)
    k, event = F.col("zip_code").cast("int"), F.col("transaction_id").cast("long")
    customers = customers.withColumns(
        {
            "email": F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, F.lit("shared@example.com")).otherwise(F.col("email")),
            "customer_id": F.when(k % 31 == 0, F.lit(None)).when(k % 29 == 0, F.lit("X-1")).otherwise(F.col("customer_id")),
            "name": F.when(k % 13 == 0, F.lit(None)).when(k % 5 == 0, F.lit("One Name")).otherwise(F.col("name")),
        }
    )
    rows = rows.withColumns(
        {
            "transaction_id": F.when(event % 10 == 0, F.lit(None)).otherwise((event % 5000).cast("string")),
            "customer_id": F.when(event % 17 == 0, F.lit(None)).otherwise(F.col("customer_id")),
            "amount": F.when(event % 19 == 0, F.lit(None)).when(event % 3 == 0, -F.col("amount")).otherwise(F.col("amount")),
        }
    )
    credit = inputs.raw_credit_scores(spark, folder)
    credit = credit.unionByName(credit.filter("number_of_accounts = 4")).withColumns(
        {
            "customer_id": F.when(F.col("credit_history_length") == 3, F.lit(None)).otherwise(F.col("customer_id")),
            "credit_score": F.when(F.col("number_of_accounts") == 9, F.lit(None)).otherwise(F.col("credit_score")),
        }
    )
    negative = quality.run_checks(rows, "transactions", [quality.Check("negative_amounts", F.count_if(F.col("amount") < 0))])
    return comparable(quality.union_reports(quality.input_checks(customers, rows, credit), negative))


# --- files and stored tables -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Ingest:
    store: TableStore
    reports: DataFrame


def _ingested(spark: SparkSession, folder: str, *tables: str) -> Ingest:
    """Broken CSV files of all customers, transactions or credit rows, brought into staging."""
    raw = {
        "customers": inputs.raw_customers,
        "transactions": inputs.raw_transactions,
        "credit_scores": inputs.raw_credit_scores,
    }
    store, reports = new_store(spark), []
    for name in tables:
        path = f"{store.root}/in/{name}.csv"
        inputs.write_csv(raw[name](spark, folder), name, path, broken=True)
        origin = staging.DEFAULT_DATA_SOURCE if name == "customers" else None
        reports.append(daily.ingest(store, path, name, origin).report(spark))
    return Ingest(store, quality.union_reports(*reports))


def ingest_table(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(daily.staged(_ingested(spark, folder, name).store, name), drop={"source_file"})

    return query


def ingest_figures(spark: SparkSession, folder: str) -> DataFrame:
    """What was read, left out, unreadable, empty and written."""
    return comparable(_ingested(spark, folder, "customers", "transactions", "credit_scores").reports)


def ingest_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rows left out or not read in full, of all three files, and why."""
    rows = daily.rejected(_ingested(spark, folder, "customers", "transactions", "credit_scores").store)
    return comparable(rows.select("table_name", "record_id", "reasons"))


FIRST_DAY = "2024-01-24"
ACCEPTED = ["unknown_customer_ids", "scores_out_of_range"]


def two_days(spark: SparkSession, folder: str) -> TableStore:
    """Two daily runs from CSV files: all customers twice, then new transactions and renewed credit rows.

    Every query on stored tables makes its own two runs, over the tables as they are then.
    """
    store = new_store(spark)
    days = [
        (FIRST_DAY, inputs.first_load, inputs.raw_credit_scores),
        (AS_OF, inputs.second_load, inputs.renewed_credit_scores),
    ]
    for day, transactions, credit in days:
        path = f"{store.root}/in/{day}"
        inputs.write_csv(inputs.raw_customers(spark, folder), "customers", f"{path}/customers.csv")
        inputs.write_csv(transactions(spark, folder), "transactions", f"{path}/transactions.csv")
        inputs.write_csv(credit(spark, folder), "credit_scores", f"{path}/credit_scores.csv")
        daily.run_daily(store, path, dt.date.fromisoformat(day), tolerate=ACCEPTED, ml_scaling=False)
    return store


def _loaded(spark: SparkSession, folder: str, upkeep: Upkeep, batches: list[DataFrame]) -> TableStore:
    """Customers, and batches of transactions loaded one after the other; each but the first repeats known rows."""
    store = new_store(spark)
    customers = store.replace(WAREHOUSE, "dim_customer", keyed_customers(spark, folder))
    for batch in batches:
        daily.load_fact(store, store.replace(STAGING, "transactions", batch), customers, upkeep=upkeep)
    return store


def _batches(spark: SparkSession, folder: str, *days: str) -> list[DataFrame]:
    """The first load, what was delivered again or anew before each day, and the whole second load."""
    rows = inputs.delivered_transactions(spark, folder)
    again = F.col("delivered") >= F.lit(inputs.REDELIVERED).cast("timestamp_ntz")
    between = [rows.filter(again & (F.col("delivered") < F.lit(day).cast("timestamp_ntz"))).drop("delivered") for day in days]
    return [inputs.first_load(spark, folder), *between, inputs.second_load(spark, folder)]


def state_fact_carried(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table after two loads that store its running columns; many rows of the second come late."""
    store = _loaded(spark, folder, Upkeep(carry=True), _batches(spark, folder))
    return comparable(daily.read_fact_with_history(store))


def fact_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table after four loads that were merged, and a fifth after that; keys depend on the loads, so are left out."""
    days = ("2024-01-28 00:00:00", "2024-02-01 00:00:00", "2024-02-05 00:00:00")
    *before, last = _batches(spark, folder, *days)
    store = _loaded(spark, folder, Upkeep(), before)
    daily.merge_fact_loads(store, fan_in=2)
    store.drop_merged(WAREHOUSE, daily.FACT)
    daily.load_fact(store, store.replace(STAGING, "transactions", last), store.read(WAREHOUSE, "dim_customer"))
    return comparable(daily.read_fact_with_history(store).drop("transaction_key"))


def metrics_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics per customer from the parts of three loads; the fact table is not read."""
    store = _loaded(spark, folder, Upkeep(parts=True), _batches(spark, folder, "2024-02-01 00:00:00"))
    return comparable(partials.stored_metrics(store, AS_OF))


def merchants_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Merchants per customer by the sketches of three loads: whether each is within the stated error of the exact count."""
    kept = Upkeep(parts=True, sketched=True)
    store = _loaded(spark, folder, kept, _batches(spark, folder, "2024-02-01 00:00:00"))
    sketched = partials.stored_metrics(store, AS_OF, sketched=True).select("customer_id", F.col("unique_merchants").alias("estimate"))
    exact = base_fact(spark, folder).groupBy("customer_id").agg(F.count_distinct("merchant_name").alias("unique_merchants"))
    error = F.abs(F.col("estimate") - F.col("unique_merchants"))
    within = F.coalesce(error <= F.col("unique_merchants") * partials.SKETCH_ERROR, F.lit(False))
    rows = exact.join(sketched, "customer_id", "full")
    return comparable(rows.select("customer_id", "unique_merchants", within.alias("within_bound")))


def fact_new_rows_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the second load adds, known ones told by the index of ids."""
    store = _loaded(spark, folder, Upkeep(ids=True, id_buckets=16), _batches(spark, folder))
    added = daily.fact_load(store, daily.fact_loads(store)[-1])
    return comparable(added.select("transaction_key", "transaction_id", "customer_id", "amount"))


def v_monthly_trends_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly trends from the totals and customer bitmaps of two loads."""
    store = _loaded(spark, folder, Upkeep(parts=True), _batches(spark, folder))
    return comparable(daily.monthly_trends(store, AS_OF))


def state_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table with its running columns after two days."""
    return comparable(daily.read_fact_with_history(two_days(spark, folder)))


def state_fact_selected(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the customers of one market segment, cut into small slices."""
    chosen = inputs.customers(spark, folder).filter(F.col("job_title") == "MACHINERY")
    rows = daily.read_fact_with_history(two_days(spark, folder), HotKeyPolicy(slice_rows=25), chosen)
    return comparable(rows.select("transaction_id", "customer_id", "transaction_sequence", "running_total", "amount_vs_avg"))


def state_dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(two_days(spark, folder).read(WAREHOUSE, "dim_customer"))


def state_dim_credit(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(two_days(spark, folder).read(WAREHOUSE, "dim_credit"))


def state_risk_history(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(two_days(spark, folder).read(ANALYTICS, "customer_risk_history"))


def state_run_log(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(two_days(spark, folder).read(ANALYTICS, "pipeline_runs"), drop={"run_duration"})


def state_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The seeded rules, each with the customers of the second day's profile that have a factor of its name."""
    store = two_days(spark, folder)
    factors = store.read(ANALYTICS, "customer_profile").select(F.explode("risk_factors").alias("rule_name"))
    counts = factors.groupBy("rule_name").agg(F.count("*").alias("customers"))
    rules = store.read(ANALYTICS, "risk_scoring_rules").withColumns(
        {name: F.col(name).cast("double") for name in ("rule_weight", "threshold_value")}
    )
    found = rules.join(counts, "rule_name", "left").select(*rules.columns, F.coalesce("customers", F.lit(0)).alias("customers"))
    return comparable(found)


def dq_table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of all seven tables after two days, and names with several ids."""
    report = daily.check_load(two_days(spark, folder))
    return comparable(report.filter(F.col("metric_name").isin("rows", "names_with_several_ids")))


def sql_surface(spark: SparkSession, folder: str) -> DataFrame:
    """Views, scalar functions and the table function, called from SQL over the scored profile."""
    register_functions(spark)
    register_views(full_profile(spark, folder), base_fact(spark, folder), AS_OF)
    return comparable(
        spark.sql(
            "SELECT p.customer_id, calculate_age(p.date_of_birth) - calculate_age(DATE '2000-01-01') AS years_older,"
            " v.customer_tier, CAST(l.ltv_score AS DOUBLE) AS ltv_score,"
            " CAST(l.avg_monthly_spend AS DOUBLE) AS avg_monthly_spend, l.predicted_lifetime_months, l.churn_risk"
            " FROM customer_profile p LEFT JOIN v_high_value_customers v ON p.customer_id = v.customer_id"
            " JOIN LATERAL calculate_customer_ltv(p.customer_id) l"
        )
    )


QUERIES: dict[str, Query] = {
    "clean_customers": clean_customers,
    "clean_transactions": clean_transactions,
    "clean_credit": clean_credit,
    "first_per_email": first_per_email,
    "customer_business_key": customer_business_key,
    "time_parts": time_parts,
    "bounds": bounds,
    "text_fixes": text_fixes,
    "age_completed_years": age_completed_years,
    "dim_customer": dim_customer,
    "surrogate_keys": surrogate_keys,
    "fact_enriched": fact_enriched,
    "fact_sliced": fact_sliced,
    "fact_incremental": fact_incremental,
    "fact_new_rows": fact_new_rows,
    "fact_batch_restart": fact_batch_restart,
    "dim_credit": dim_credit,
    "upsert_credit": upsert_credit,
    "sql_functions": sql_functions,
    "transaction_metrics": transaction_metrics,
    "favorite_category": favorite_category,
    "customer_profile": customer_profile,
    "risk_score": risk_score,
    "risk_factors": risk_factors,
    "scaled_features": scaled_features,
    "scaled_features_ml": scaled_features_ml,
    "points_score": points_score,
    "rescore_selected": rescore_selected,
    "rescore_history": rescore_history,
    "risk_history": risk_history,
    "v_risk_summary": _product(products.risk_summary),
    "v_monthly_trends": v_monthly_trends,
    "v_high_value": v_high_value,
    "v_risk_factors": _product(products.risk_factor_analysis),
    "v_segmentation": _product(products.segmentation),
    "v_ltv": _product(products.lifetime_value),
    "v_ltv_selected": v_ltv_selected,
    "v_risk_distribution": _product(products.risk_distribution),
    "v_sample_distribution": _product(products.spend_by_category),
    "v_top_customers": _product(products.top_customers),
    "v_summary_stats": _product(products.summary_statistics),
    "v_category_counts": _product(products.category_counts),
    "v_summaries": _product(products.summaries),
    "dq_null_counts": dq_null_counts,
    "dq_uniqueness": dq_uniqueness,
    "dq_referential": dq_referential,
    "dq_unknown_customers": dq_unknown_customers,
    "dq_ranges": dq_ranges,
    "dq_input_checks": dq_input_checks,
    "dq_names": dq_names,
    "dq_metrics": dq_metrics,
    "dq_broken_input": dq_broken_input,
    "dq_table_counts": dq_table_counts,
    "scored_profile": scored_profile,
    "ingest_customers": ingest_table("customers"),
    "ingest_transactions": ingest_table("transactions"),
    "ingest_credit": ingest_table("credit_scores"),
    "ingest_figures": ingest_figures,
    "ingest_rejected": ingest_rejected,
    "state_fact": state_fact,
    "state_fact_carried": state_fact_carried,
    "fact_merged": fact_merged,
    "metrics_merged": metrics_merged,
    "merchants_sketched": merchants_sketched,
    "fact_new_rows_indexed": fact_new_rows_indexed,
    "v_monthly_trends_rollup": v_monthly_trends_rollup,
    "state_fact_selected": state_fact_selected,
    "state_dim_customer": state_dim_customer,
    "state_dim_credit": state_dim_credit,
    "state_risk_history": state_risk_history,
    "state_run_log": state_run_log,
    "state_rules": state_rules,
    "sql_surface": sql_surface,
}
