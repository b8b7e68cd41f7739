"""Risk scores, factors and their history."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import schemas
from ledgerloom.functions import dates, scoring
from ledgerloom.operators import scaling
from ledgerloom.operators.merge import patch

# The seeded scoring rules (name, description, weight, threshold, points).
RULES = [
    ("Low Credit Score", "Credit score below 600", "0.3", "600", 30),
    ("High Credit Utilization", "Credit utilization above 80%", "0.2", "0.8", 20),
    ("High Debt to Income", "Debt to income ratio above 40%", "0.25", "0.4", 25),
    ("High Transaction Volume", "Monthly spending above $5000", "0.1", "5000", 10),
    ("Low Income", "Annual income below $30,000", "0.1", "30000", 10),
    ("Fraud History", "Previous fraudulent transactions", "0.05", "1", 5),
]


def _now(at: Column | None) -> Column:
    return F.current_timestamp() if at is None else at


def scoring_rules(spark) -> DataFrame:
    """The rules as reference data for readers; the scores themselves do not depend on them."""
    text = "rule_name string, rule_description string, rule_weight string, threshold_value string, risk_points int"
    rules = spark.createDataFrame(RULES, text).withColumn("is_active", F.lit(True))
    number = F.array_position(F.array(*[F.lit(rule[0]) for rule in RULES]), F.col("rule_name"))
    return schemas.conform(rules.withColumn("rule_id", number), schemas.SCORING_RULES)


def add_weighted_risk(profile: DataFrame) -> DataFrame:
    """Weighted score, its bucket and category, and the factors behind it."""
    raw = scoring.weighted_score(
        F.col("credit_score"),
        F.col("credit_utilization"),
        F.col("debt_to_income_ratio"),
        F.col("days_since_last_transaction"),
        F.col("transaction_amount_stddev"),
    )
    return profile.withColumn("raw_risk_score", raw).withColumns(
        {
            "risk_bucket": scoring.risk_bucket(F.col("raw_risk_score")),
            "risk_category": scoring.risk_category(F.col("raw_risk_score")),
            "risk_score": F.col("raw_risk_score"),
            "risk_factors": scoring.risk_factors(),
        }
    )


def score_profile(profile: DataFrame, at: Column | None = None, ml_scaling: bool = True) -> DataFrame:
    """The profile with features, risk columns and scoring details.

    Scaling needs statistics of the whole profile, so this runs one aggregate over it; give it a stored or
    cached profile. With ``ml_scaling`` one unknown income makes the scaled incomes NaN for everyone, as in
    the source system; without it, unknown values are left out.
    """
    if ml_scaling:
        featured = scaling.add_ml_scaled_features(profile, scaling.fit_ml_scaling(profile))
    else:
        featured = scaling.add_scaled_features(profile, scaling.fit_scaling(profile))
    return add_weighted_risk(featured).withColumns(
        {
            "ml_scored_at": _now(at),
            "scoring_model_version": F.lit(scoring.MODEL_VERSION),
            "last_updated": _now(at),
        }
    )


def risk_snapshot(profile: DataFrame, as_of: dates.AsOf = None, at: Column | None = None) -> DataFrame:
    """Score of every customer on one day, for the risk history."""
    return profile.select(
        "customer_id",
        "risk_score",
        "risk_category",
        "risk_factors",
        dates.as_of_column(as_of).alias("assessment_date"),
        _now(at).alias("created_at"),
    )


def add_points(profile: DataFrame) -> DataFrame:
    """Rule points and their category for every row."""
    return profile.withColumn("points_score", scoring.points_score()).withColumn(
        "points_category", scoring.points_category(F.col("points_score"))
    )


class Rescored(NamedTuple):
    """``profile`` with the chosen customers rescored, and the ``history`` rows to append."""

    profile: DataFrame
    history: DataFrame


def rescore(profile: DataFrame, chosen: DataFrame, as_of: dates.AsOf = None, at: Column | None = None) -> Rescored:
    """Replace score and category of the customers in ``chosen`` (customer_id) by the rule points.

    An id the profile does not have changes no profile row but leaves a history row with no points.
    """
    ids = chosen.select("customer_id").distinct()
    inputs = [*scoring.POINTS_BELOW, *scoring.POINTS_ABOVE]
    scored = add_points(ids.join(profile.select("customer_id", *inputs), "customer_id", "left")).select(
        "customer_id",
        F.col("points_score").cast("double").alias("risk_score"),
        F.col("points_category").alias("risk_category"),
        _now(at).alias("last_updated"),
    )
    changed = patch(profile, scored, "customer_id", ["risk_score", "risk_category", "last_updated"])
    history = scored.select(
        "customer_id",
        "risk_score",
        "risk_category",
        F.lit(None).cast("array<string>").alias("risk_factors"),
        dates.as_of_column(as_of).alias("assessment_date"),
        F.col("last_updated").alias("created_at"),
    )
    return Rescored(changed, history)
