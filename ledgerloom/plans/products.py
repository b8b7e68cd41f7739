"""What users read: summaries, trends, tiers, lifetime value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions import dates, labels
from ledgerloom.operators.shares import RISK_ORDER, add_share, listed_first, percentage
from ledgerloom.plans.warehouse import since

TREND_MONTHS = 24
# Categories and activity of customers that count as high-value candidates.
HIGH_VALUE_CATEGORIES = ["Low", "Medium"]
HIGH_VALUE_MIN_TRANSACTIONS = 10


def risk_summary(profile: DataFrame, order: Sequence[str] = RISK_ORDER) -> DataFrame:
    """Customers and averages per risk category, with the category's share of all customers."""
    groups = profile.groupBy("risk_category").agg(
        F.count("*").alias("customer_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("annual_income").alias("avg_income"),
        F.avg("total_spent").alias("avg_total_spent"),
    )
    averages = [name for name in groups.columns if name.startswith("avg_")]
    shared = add_share(groups, "customer_count", "percentage", 2)
    return shared.select("risk_category", "customer_count", "percentage", *averages).orderBy(
        listed_first(F.col("risk_category"), order), F.col("risk_category").asc_nulls_last()
    )


def monthly_trends(fact: DataFrame, as_of: dates.AsOf = None, months: int = TREND_MONTHS) -> DataFrame:
    """Volume, customers and fraud per month over the trailing months, first day included."""
    first_day = dates.months_before(dates.as_of_column(as_of), months)
    return (
        since(fact, first_day)
        .groupBy(dates.month_start(F.col("transaction_date")).alias("month"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_volume"),
            F.avg("amount").alias("avg_transaction_amount"),
            F.count_distinct("customer_id").alias("active_customers"),
            F.count_if("is_fraud").alias("fraud_count"),
        )
        .orderBy("month")
    )


def high_value_customers(
    profile: DataFrame,
    categories: Sequence[str] = HIGH_VALUE_CATEGORIES,
    more_than: int = HIGH_VALUE_MIN_TRANSACTIONS,
) -> DataFrame:
    """Whole profile rows of low-risk, active customers with their tier, largest spenders first."""
    candidates = profile.filter(F.col("risk_category").isin(*categories) & (F.col("total_transactions") > more_than))
    tier = labels.customer_tier(F.col("total_spent"), F.col("credit_score"))
    return candidates.withColumn("customer_tier", tier).orderBy(F.col("total_spent").desc_nulls_first(), "customer_id")


def risk_factor_analysis(profile: DataFrame) -> DataFrame:
    """Customers per risk factor and the factor's share of all customers.

    Every customer also counts once under the null factor. That gives the total in the same aggregate.
    """
    factors = F.coalesce("risk_factors", F.array().cast("array<string>"))
    exploded = profile.select(F.explode(F.array_append(factors, F.lit(None).cast("string"))).alias("risk_factor"))
    counts = exploded.groupBy("risk_factor").agg(F.count("*").alias("customer_count"))
    # a handful of rows from here on
    everyone = F.max(F.when(F.col("risk_factor").isNull(), F.col("customer_count"))).over(Window.partitionBy(F.lit(1)))
    return (
        counts.withColumn("percentage_of_total", percentage(F.col("customer_count"), everyone, 2))
        .filter(F.col("risk_factor").isNotNull())
        .orderBy(F.col("customer_count").desc(), "risk_factor")
    )


def segmentation(profile: DataFrame) -> DataFrame:
    """Customers and averages per income bracket and risk category."""
    keys = ["income_bracket", "risk_category"]
    return (
        profile.groupBy(*keys)
        .agg(
            F.count("*").alias("customer_count"),
            F.avg("credit_score").alias("avg_credit_score"),
            F.avg("total_spent").alias("avg_total_spent"),
            F.avg("risk_score").alias("avg_risk_score"),
        )
        .orderBy(*[F.col(key).asc_nulls_last() for key in keys])
    )


def lifetime_value(
    profile: DataFrame, chosen: DataFrame | None = None, months: Mapping[str, int] | None = None
) -> DataFrame:
    """Value, monthly spend, expected stay and churn risk of all customers or of those in ``chosen``."""
    selected = profile if chosen is None else profile.join(chosen.select("customer_id"), "customer_id", "left_semi")
    days = dates.days_between(F.col("last_transaction_date"), F.col("first_transaction_date"))
    monthly = F.col("total_spent") / F.greatest(days, F.lit(30)) * 30
    stay = labels.lifetime_months(F.col("risk_category"), months)
    return selected.select(
        "customer_id",
        (monthly * stay).alias("ltv_score"),
        monthly.alias("avg_monthly_spend"),
        stay.alias("predicted_lifetime_months"),
        labels.churn_risk(F.col("days_since_last_transaction")).alias("churn_risk"),
    )


def risk_distribution(profile: DataFrame, digits: int = 1) -> DataFrame:
    """Customers per risk category with their share."""
    groups = profile.groupBy("risk_category").agg(F.count("*").alias("count"))
    return add_share(groups, "count", "percentage", digits).orderBy(F.col("risk_category").asc_nulls_last())


def spend_by_category(profile: DataFrame) -> DataFrame:
    return profile.groupBy("risk_category").agg(
        F.count("*").alias("customer_count"), F.avg("total_spent").alias("avg_total_spent")
    )


def top_customers(profile: DataFrame, limit: int = 10) -> DataFrame:
    """Largest spenders, ties broken by id. Each task keeps only its own best rows."""
    ranked = profile.select("customer_id", "name", "total_spent", "risk_score")
    return ranked.orderBy(F.col("total_spent").desc_nulls_first(), "customer_id").limit(limit)


def summary_statistics(profile: DataFrame) -> DataFrame:
    """One row of overall figures."""
    return profile.agg(
        F.count("*").alias("total_customers"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("annual_income").alias("avg_income"),
        F.avg("total_spent").alias("avg_spent"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def category_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("risk_category").agg(F.count("*").alias("customer_count"))


# --- several products from one pass ----------------------------------------------------------------------

BY_CATEGORY, BY_SEGMENT, OVERALL = "risk_category", "segment", "all"


def summaries(profile: DataFrame) -> DataFrame:
    """Counts and averages per risk category, per income bracket and category, and over all, in one pass.

    One aggregate with grouping sets reads the profile once and shuffles its few groups once. ``level`` tells which
    set a row belongs to, so that an unknown category is not taken for a total. Store the result, and take the
    single products from it with ``from_summaries``.
    """
    sets = [[F.col("risk_category")], [F.col("income_bracket"), F.col("risk_category")], []]
    groups = profile.groupingSets(sets, "income_bracket", "risk_category").agg(
        F.when(F.grouping_id() == 0, BY_SEGMENT).when(F.grouping_id() == 2, BY_CATEGORY).otherwise(OVERALL).alias("level"),
        F.count("*").alias("customer_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("annual_income").alias("avg_income"),
        F.avg("total_spent").alias("avg_total_spent"),
    )
    # a handful of rows from here on
    everyone = F.max(F.when(F.col("level") == OVERALL, F.col("customer_count"))).over(Window.partitionBy(F.lit(1)))
    part = F.when(F.col("level") == BY_CATEGORY, F.col("customer_count"))
    averages = [name for name in groups.columns if name.startswith("avg_")]
    return groups.withColumns({"percentage": percentage(part, everyone, 2), "share": percentage(part, everyone, 1)}).select(
        "level", "income_bracket", "risk_category", "customer_count", "percentage", "share", *averages
    )


def from_summaries(rows: DataFrame, order: Sequence[str] = RISK_ORDER) -> dict[str, DataFrame]:
    """The products that ``summaries`` holds, by the name of their function, each as that function gives it."""
    category = rows.filter(F.col("level") == BY_CATEGORY)
    by_name = F.col("risk_category").asc_nulls_last()
    averages = ["avg_risk_score", "avg_credit_score", "avg_income", "avg_total_spent"]
    return {
        "risk_summary": category.select("risk_category", "customer_count", "percentage", *averages).orderBy(
            listed_first(F.col("risk_category"), order), by_name
        ),
        "risk_distribution": category.select(
            "risk_category", F.col("customer_count").alias("count"), F.col("share").alias("percentage")
        ).orderBy(by_name),
        "spend_by_category": category.select("risk_category", "customer_count", "avg_total_spent"),
        "category_counts": category.select("risk_category", "customer_count"),
        "segmentation": rows.filter(F.col("level") == BY_SEGMENT)
        .select("income_bracket", "risk_category", "customer_count", "avg_credit_score", "avg_total_spent", "avg_risk_score")
        .orderBy(F.col("income_bracket").asc_nulls_last(), by_name),
        "summary_statistics": rows.filter(F.col("level") == OVERALL).select(
            F.col("customer_count").alias("total_customers"),
            "avg_credit_score",
            "avg_income",
            F.col("avg_total_spent").alias("avg_spent"),
            "avg_risk_score",
        ),
    }
