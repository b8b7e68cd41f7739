"""One wide row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, labels


def _rows_with(flag: str) -> Column:
    """Share of a group's rows with the flag set; an unknown flag counts as not set."""
    return F.count_if(F.col(flag)) / F.count("*")


def amount_metrics(fact: DataFrame, as_of: dates.AsOf = None) -> DataFrame:
    """Counts, sums and averages per customer, all of them pre-aggregated before the one shuffle."""
    last = F.max("transaction_date")
    high_value = labels.exceeds(F.col("amount"), labels.HIGH_VALUE_AMOUNT)
    return fact.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("total_spent"),
        F.avg("amount").alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
        F.min("amount").alias("min_transaction_amount"),
        F.stddev_samp("amount").alias("transaction_amount_stddev"),
        F.min("transaction_date").alias("first_transaction_date"),
        last.alias("last_transaction_date"),
        dates.days_between(dates.as_of_column(as_of), last).alias("days_since_last_transaction"),
        _rows_with("is_online").alias("online_transaction_pct"),
        _rows_with("is_weekend").alias("weekend_transaction_pct"),
        F.count_if("is_fraud").alias("fraud_count"),
        F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(0.0)).alias("fraud_amount"),
        F.avg("transaction_hour").alias("avg_transaction_hour"),
        F.count_if(high_value).alias("high_value_transaction_count"),
    )


def category_metrics(fact: DataFrame) -> DataFrame:
    """Number of merchant categories per customer and the most frequent one, ties broken by name."""
    per_category = fact.groupBy("customer_id", "merchant_category").agg(F.count("*").alias("uses"))
    named = F.when(F.col("merchant_category").isNotNull(), F.struct(-F.col("uses"), "merchant_category"))
    return per_category.groupBy("customer_id").agg(
        F.min_by("merchant_category", named).alias("favorite_merchant_category"),
        F.count("merchant_category").alias("unique_merchant_categories"),
    )


def merchant_metrics(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.count_distinct("merchant_name").alias("unique_merchants"))


METRIC_COLUMNS = [
    "total_transactions", "total_spent", "avg_transaction_amount", "max_transaction_amount",
    "min_transaction_amount", "transaction_amount_stddev", "first_transaction_date", "last_transaction_date",
    "days_since_last_transaction", "favorite_merchant_category", "unique_merchant_categories",
    "unique_merchants", "online_transaction_pct", "weekend_transaction_pct", "fraud_count", "fraud_amount",
    "avg_transaction_hour", "high_value_transaction_count",
]


def transaction_metrics(fact: DataFrame, as_of: dates.AsOf = None) -> DataFrame:
    """Behaviour of every customer in the fact table.

    Three aggregates joined on the customer. In a single one, the two distinct counts would make Spark
    triple every wide row before it can aggregate; here each scan reads only its own columns, and all three
    end up partitioned by customer, so that the joins move nothing. Fact rows always name a customer.
    """
    return (
        amount_metrics(fact, as_of)
        .join(category_metrics(fact), "customer_id", "left")
        .join(merchant_metrics(fact), "customer_id", "left")
        .select("customer_id", *METRIC_COLUMNS)
    )


PERSON_COLUMNS = [
    "customer_key", "customer_id", "name", "date_of_birth", "age", "city", "state", "annual_income",
    "income_bracket", "job_title", "employment_status", "marital_status", "customer_tenure_days",
]
CREDIT_COLUMNS = [
    "credit_score", "credit_rating", "credit_history_length", "total_debt", "credit_utilization",
    "debt_to_income_ratio",
]
PROFILE_COLUMNS = [
    *PERSON_COLUMNS,
    *[name for name in METRIC_COLUMNS if name != "avg_transaction_hour"],
    *CREDIT_COLUMNS,
]

# What a customer without transactions or without a credit row gets. Columns not named stay null.
DEFAULTS = {
    "total_transactions": 0,
    "total_spent": 0.0,
    "avg_transaction_amount": 0.0,
    "max_transaction_amount": 0.0,
    "min_transaction_amount": 0.0,
    "transaction_amount_stddev": 0.0,
    "days_since_last_transaction": 9999,
    "unique_merchant_categories": 0,
    "unique_merchants": 0,
    "online_transaction_pct": 0.0,
    "weekend_transaction_pct": 0.0,
    "fraud_count": 0,
    "fraud_amount": 0.0,
    "high_value_transaction_count": 0,
    "credit_score": 300,
    "credit_rating": "Poor",
    "credit_history_length": 0,
    "total_debt": 0.0,
    "credit_utilization": 0.0,
    "debt_to_income_ratio": 0.0,
}


def customer_profile(customers: DataFrame, credit: DataFrame, metrics: DataFrame) -> DataFrame:
    """Customer dimension, credit dimension and behaviour in one row per customer.

    All joins are on customer_id, so that every input is shuffled at most once. Credit rows are one per
    customer and carry the customer's key, so this equals a join on the key.
    """
    wide = (
        customers.select(*PERSON_COLUMNS)
        .join(credit.filter(F.col("customer_key").isNotNull()).select("customer_id", *CREDIT_COLUMNS), "customer_id", "left")
        .join(metrics, "customer_id", "left")
    )

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(DEFAULTS[name])).alias(name) if name in DEFAULTS else F.col(name)

    return wide.select(*[filled(name) for name in PROFILE_COLUMNS])
