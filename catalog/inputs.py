"""Staging tables derived from the given test tables; the rules are listed in FIXTURES.md."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import dates, labels, text

AS_OF = "2024-02-15"
# Events from this moment on are the second load; the days before it, back to REDELIVERED, are sent again.
SECOND_LOAD = "2024-01-24 00:00:00"
REDELIVERED = "2024-01-22 00:00:00"

EMPLOYMENT = ["Salaried", "Contractor", "Student", "Retired"]
MARITAL = ["Alone", "Partnered", "Separated", "Not told"]
KINDS = ["card", "cash", "wire", "refund", "fee"]


# Given tables, with the columns that are read. A stated schema saves a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], number: Column) -> Column:
    return F.get(F.array(*[F.lit(value) for value in values]), (number % len(values)).cast("int"))


def _day(first: str, offset: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), offset.cast("int"))


def _email(name: Column) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as delivered: padded text, mixed-case e-mail."""
    k = F.col("c_custkey")
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    income = F.when(k % 53 != 0, F.greatest(F.round(F.col("c_acctbal") * 12, 2), F.lit(float(labels.LOWEST_INCOME))))
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            text.business_key(F.col("c_name"), _email(F.col("c_name"))).alias("customer_id"),
            F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
            _day("1950-01-01", k * 37 % 18000).alias("date_of_birth"),
            F.concat(k.cast("string"), F.lit(" Main St")).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((k % 99999).cast("string"), 5, "0").alias("zip_code"),
            F.concat(F.lit("555-"), F.lpad(k.cast("string"), 7, "0")).alias("phone"),
            F.concat(F.upper(_email(F.col("c_name"))), F.lit("  ")).alias("email"),
            income.alias("annual_income"),
            F.col("c_mktsegment").alias("job_title"),
            _pick(EMPLOYMENT, k).alias("employment_status"),
            _pick(MARITAL, k).alias("marital_status"),
            _day("2019-01-01", k * 13 % 1800).alias("created_date"),
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return raw_customers(spark, folder).withColumns({"name": F.trim("name"), "email": F.lower(F.trim("email"))})


def raw_transactions(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    """One transaction per event, with the event's own time as ``delivered``. Finding the places takes a join."""
    event, user = F.col("event_id"), F.col("user_id")
    owner = F.when(event % 200 == 0, 150 + F.floor(event / 200)).otherwise(user).cast("long")
    back = F.when(user % 3 == 1, 66 * (event % 12)).when(user % 3 == 2, 100 + 30 * (event % 4)).otherwise(0)
    moment = F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(days=back.cast("int"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("owner").cast("string"), 9, "0"))
    events = table(spark, folder, "events").withColumns({"owner": owner, "moment": moment})
    where = {}
    if places:
        homes = (
            table(spark, folder, "customer")
            .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "n_name", "r_name")
        )
        events = events.join(homes, F.col("owner") == F.col("c_custkey"), "left")
        where = {"location_city": F.concat("n_name", F.lit(" ")), "location_state": F.concat(F.lit(" "), "r_name")}
    return events.select(
        event.cast("string").alias("transaction_id"),
        F.when(event % 997 == 1, F.lit("CUST-ORPHAN"))
        .otherwise(text.business_key(name, _email(name)))
        .alias("customer_id"),
        _pick(KINDS, event).alias("transaction_type"),
        F.round(F.col("value") * (1 + user % 10), 2).alias("amount"),
        F.col("moment").alias("timestamp"),
        F.concat(F.lit(" M"), F.get_json_object("props", "$.k")).alias("merchant_name"),
        F.col("event_type").alias("merchant_category"),
        *[value.alias(name) for name, value in where.items()],
        dates.is_weekend(F.col("moment")).alias("is_weekend"),
        dates.hour_of_day(F.col("moment")).alias("hour"),
        F.col("event_type").isin("click", "view").alias("is_online"),
        ((F.col("event_type") == "error") & (event % 50 == 0)).alias("is_fraud"),
        F.col("ts").cast("timestamp_ntz").alias("delivered"),
    )


def delivered_transactions(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    padded = ["merchant_name", "location_city", "location_state"] if places else ["merchant_name"]
    return raw_transactions(spark, folder, places).withColumns({name: F.trim(name) for name in padded})


def transactions(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    return delivered_transactions(spark, folder, places).drop("delivered")


def first_load(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    """Transactions delivered before the second load."""
    rows = delivered_transactions(spark, folder, places)
    return rows.filter(F.col("delivered") < F.lit(SECOND_LOAD).cast("timestamp_ntz")).drop("delivered")


def second_load(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    """Transactions of the second load, with the last days of the first one delivered again."""
    rows = delivered_transactions(spark, folder, places)
    return rows.filter(F.col("delivered") >= F.lit(REDELIVERED).cast("timestamp_ntz")).drop("delivered")


def raw_credit_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One credit row per customer that is not overdrawn; some scores lie outside the scale."""
    k = F.col("c_custkey")
    return (
        table(spark, folder, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(
            text.business_key(F.col("c_name"), _email(F.col("c_name"))).alias("customer_id"),
            F.when(k % 97 == 5, 900).otherwise(300 + k * 7919 % 551).cast("int").alias("credit_score"),
            _day("2023-06-01", k % 200).alias("score_date"),
            (1 + k % 19).cast("int").alias("credit_history_length"),
            (1 + k % 14).cast("int").alias("number_of_accounts"),
            (k * 104729 % 60000).cast("double").alias("total_debt"),
            F.round(k * 31 % 100 / 100.0, 2).alias("credit_utilization"),
        )
    )


def credit_scores(spark: SparkSession, folder: str) -> DataFrame:
    return raw_credit_scores(spark, folder).filter(F.col("credit_score").between(300, 850))


def renewed_credit_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Newer credit rows: customers of the first regions get a raised score, overdrawn ones a first row."""
    k = F.col("c_custkey")
    score = labels.clamped_credit_score((300 + k * 7919 % 551 + 40).cast("int"))
    return (
        table(spark, folder, "customer")
        .filter((F.col("c_acctbal") < 0) | (F.col("c_nationkey") < 10))
        .select(
            text.business_key(F.col("c_name"), _email(F.col("c_name"))).alias("customer_id"),
            score.alias("credit_score"),
            F.lit("2024-02-01").cast("date").alias("score_date"),
            (1 + k % 19).cast("int").alias("credit_history_length"),
            (1 + k % 14).cast("int").alias("number_of_accounts"),
            (k * 104729 % 60000).cast("double").alias("total_debt"),
            F.round(k * 31 % 100 / 100.0, 2).alias("credit_utilization"),
        )
    )


# --- the same rows as CSV files, some of them broken -----------------------------------------------------

# Rows with too many fields, and texts in the place of a date, a number or a time: (column, condition, text).
MALFORMED = {
    "customers": "zip_code % 53 = 7",
    "transactions": "transaction_id % 97 = 5",
    "credit_scores": "credit_history_length = 7 AND number_of_accounts = 3",
}
UNREADABLE = {
    "customers": [("annual_income", "zip_code % 41 = 3", "n/a"), ("date_of_birth", "zip_code % 59 = 11", "someday")],
    "transactions": [("amount", "transaction_id % 89 = 4", "lots"), ("timestamp", "transaction_id % 83 = 6", "yesterday")],
    "credit_scores": [("score_date", "credit_history_length = 11 AND number_of_accounts = 5", "soon")],
}
CSV_FILES = 3  # at least; one per core where there are more


def write_csv(rows: DataFrame, table: str, path: str, broken: bool = False) -> None:
    """Write rows as several CSV files with a header each; with ``broken`` some rows cannot be read."""
    names = [name for name in rows.columns if name != "delivered"]
    values = {name: F.col(name).cast("string") for name in names}
    if broken:
        for name, where, told in UNREADABLE[table]:
            values[name] = F.when(F.expr(where), F.lit(told)).otherwise(values[name])
    line = F.to_csv(F.struct(*[value.alias(name) for name, value in values.items()]))
    if broken:
        line = F.when(F.expr(MALFORMED[table]), F.concat(line, F.lit(",one,more"))).otherwise(line)
    header = ",".join(names)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["line"])
        yield from batches

    files = max(CSV_FILES, rows.sparkSession.sparkContext.defaultParallelism)
    # dealt by the line: dealing in turn would sort all lines first
    rows.select(line.alias("line")).repartition(files, "line").mapInArrow(with_header, "line string").write.text(path)


# Added before rounding: an exact half goes up whatever order the engine summed in.
_HALF_UP = 3e-9
_NOT_COMPARED = {"created_at", "updated_at", "last_updated", "ml_scored_at", "ingestion_timestamp"}


def comparable(rows: DataFrame, digits: int = 4, drop: set[str] | None = None) -> DataFrame:
    """The rows in a form two engines agree on: rounded doubles, dates and times as text, no wall clock."""
    columns = []
    for name, kind in rows.dtypes:
        if name in _NOT_COMPARED or name in (drop or set()):
            continue
        value = F.col(name)
        if kind in ("double", "float"):
            value = F.round(value + F.lit(_HALF_UP), digits) + F.lit(0.0)
        elif kind == "date":
            value = value.cast("string")
        elif kind.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "array<string>":
            value = F.array_join(value, "; ")
        columns.append(value.alias(name))
    return rows.select(*columns)
