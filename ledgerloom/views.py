"""SQL access: temporary views of the products, and the scalar and table functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import dates, labels
from ledgerloom.functions.bands import ladder_sql
from ledgerloom.plans import products, quality


def register_functions(spark: SparkSession, as_of: dt.date | None = None) -> None:
    """Scalar functions ``calculate_age``, ``get_income_bracket`` and ``get_credit_rating``.

    Ages are those at the day ``as_of``, or at the day of the query.
    """
    today = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    bracket = ladder_sql("income", "<", labels.INCOME_BRACKETS, labels.TOP_INCOME_BRACKET)
    rating = ladder_sql("score", ">=", labels.CREDIT_RATINGS, labels.LOWEST_CREDIT_RATING)
    not_yet = (
        f"CASE WHEN month({today}) * 100 + day({today}) < month(birth_date) * 100 + day(birth_date)"
        " THEN 1 ELSE 0 END"
    )
    bodies = [
        ("calculate_age(birth_date DATE) RETURNS INT", f"year({today}) - year(birth_date) - {not_yet}"),
        ("get_income_bracket(income DOUBLE) RETURNS STRING", bracket),
        ("get_credit_rating(score INT) RETURNS STRING", rating),
    ]
    for head, body in bodies:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def register_views(
    profile: DataFrame, fact: DataFrame, as_of: dates.AsOf = None, history: DataFrame | None = None
) -> list[str]:
    """Temporary views of the profile, the fact table and everything derived from them; returns their names.

    The table function ``calculate_customer_ltv(id)`` looks one customer up in ``v_customer_ltv``.
    """
    views = {
        "customer_profile": profile,
        "fact_transactions": fact,
        "v_customer_risk_summary": products.risk_summary(profile),
        "v_monthly_transaction_trends": products.monthly_trends(fact, as_of),
        "v_high_value_customers": products.high_value_customers(profile),
        "v_risk_factor_analysis": products.risk_factor_analysis(profile),
        "v_customer_segmentation": products.segmentation(profile),
        "v_customer_ltv": products.lifetime_value(profile),
        "v_risk_distribution": products.risk_distribution(profile),
        "v_shared_names": quality.shared_names(profile),
    }
    if history is not None:
        views["customer_risk_history"] = history
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    profile.sparkSession.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_customer_ltv(wanted STRING) RETURNS TABLE("
        "customer_id STRING, ltv_score DECIMAL(18, 2), avg_monthly_spend DECIMAL(18, 2),"
        " predicted_lifetime_months INT, churn_risk STRING) RETURN"
        " SELECT customer_id, CAST(ltv_score AS DECIMAL(18, 2)), CAST(avg_monthly_spend AS DECIMAL(18, 2)),"
        " predicted_lifetime_months, churn_risk FROM v_customer_ltv WHERE customer_id = wanted"
    )
    return list(views)
