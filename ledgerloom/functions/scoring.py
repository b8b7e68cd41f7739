"""The two risk scorings, as native expressions.

``weighted_score`` grades a customer from 0 to 100 in five categories. ``points_score`` adds up rule points
and knows three categories. They share column names in the profile but are never mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ledgerloom.functions import bands

# Weights, scales and fallbacks of the weighted score.
SCORE_WEIGHT, UTILIZATION_WEIGHT, DEBT_WEIGHT, VOLATILITY_WEIGHT, INACTIVITY_WEIGHT = 40, 20, 25, 10, 5
BEST_CREDIT_SCORE = 850
FULL_DEBT_RATIO = 0.5
FULL_VOLATILITY = 1000
FULL_INACTIVITY_DAYS = 180
CREDIT_SCORE_FALLBACK = 600.0
UTILIZATION_FALLBACK = 0.5
DEBT_FALLBACK = 0.2
INACTIVITY_FALLBACK = 0.0
VOLATILITY_FALLBACK = 100.0

# Upper ends of the risk buckets and their names. The last one includes its end.
RISK_BUCKETS = [(20, "Very Low"), (40, "Low"), (60, "Medium"), (80, "High"), (100, "Very High")]
MODEL_VERSION = "Spark ML Pipeline v1.0"


@dataclass(frozen=True)
class Factor:
    """One risk factor: its label and the condition on a profile column."""

    label: str
    column: str
    operator: str
    limit: float

    def holds(self) -> Column:
        value = F.col(self.column)
        return value < self.limit if self.operator == "<" else value > self.limit


# The risk factors in the order they are listed.
RISK_FACTORS = [
    Factor("Low Credit Score", "credit_score", "<", 600),
    Factor("High Credit Utilization", "credit_utilization", ">", 0.8),
    Factor("High Debt to Income", "debt_to_income_ratio", ">", 0.4),
    Factor("High Spending Volume", "total_spent", ">", 10000),
    Factor("Low Income", "annual_income", "<", 30000),
    Factor("Inactive Customer", "days_since_last_transaction", ">", 90),
    Factor("Fraud History", "fraud_count", ">", 0),
    Factor("High Transaction Volatility", "transaction_amount_stddev", ">", 500),
]

# Points of the rule-based score.
POINTS_BELOW = {
    "credit_score": [(580, 30), (620, 20), (670, 10)],
    "annual_income": [(30000, 10), (50000, 5)],
}
POINTS_ABOVE = {
    "credit_utilization": [(0.8, 20), (0.6, 15), (0.4, 10)],
    "debt_to_income_ratio": [(0.4, 25), (0.3, 15), (0.2, 10)],
    "total_spent": [(10000, 10), (5000, 5)],
    "days_since_last_transaction": [(90, 5), (30, 2)],
}
POINTS_CATEGORIES = [(60, "High"), (30, "Medium")]
LOWEST_POINTS_CATEGORY = "Low"


def _or_fallback(value: Column, fallback: float) -> Column:
    """The value as a double; null and zero both count as not given."""
    number = value.cast("double")
    return F.when(number != 0, number).otherwise(F.lit(fallback))


def _part(value: Column, full: float, weight: float) -> Column:
    """Share of the weight the value has used up, at most all of it."""
    return F.least(value / full, F.lit(1.0)) * weight


def weighted_score(
    credit_score: Column,
    credit_utilization: Column,
    debt_to_income: Column,
    days_inactive: Column,
    volatility: Column,
) -> Column:
    """Risk from 0 (none) to 100, the sum of five weighted parts."""
    score = _or_fallback(credit_score, CREDIT_SCORE_FALLBACK)
    total = (
        (BEST_CREDIT_SCORE - score) / BEST_CREDIT_SCORE * SCORE_WEIGHT
        + _part(_or_fallback(credit_utilization, UTILIZATION_FALLBACK), 1.0, UTILIZATION_WEIGHT)
        + _part(_or_fallback(debt_to_income, DEBT_FALLBACK), FULL_DEBT_RATIO, DEBT_WEIGHT)
        + _part(_or_fallback(volatility, VOLATILITY_FALLBACK), FULL_VOLATILITY, VOLATILITY_WEIGHT)
        + _part(_or_fallback(days_inactive, INACTIVITY_FALLBACK), FULL_INACTIVITY_DAYS, INACTIVITY_WEIGHT)
    )
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(100.0))


def risk_bucket(score: Column) -> Column:
    """Number of the bucket from 0.0; null for a null score, an error outside 0 to 100."""
    last = float(len(RISK_BUCKETS) - 1)
    numbered = [(upper, float(number)) for number, (upper, _) in enumerate(RISK_BUCKETS)]
    outside = F.isnan(score) | (score < 0) | (score > RISK_BUCKETS[-1][0])
    return (
        F.when(score.isNull(), F.lit(None).cast("double"))
        .when(outside, F.raise_error(F.concat(F.lit("risk score outside 0 to 100: "), score.cast("string"))))
        .otherwise(bands.below(score, numbered, last))
    )


def risk_category(score: Column) -> Column:
    """Name of the bucket; null for a null score."""
    return F.when(score.isNotNull(), bands.below(score, RISK_BUCKETS[:-1], RISK_BUCKETS[-1][1]))


def risk_factors() -> Column:
    """Labels of all factors that hold for a profile row, in fixed order."""
    return F.array_compact(F.array(*[F.when(factor.holds(), F.lit(factor.label)) for factor in RISK_FACTORS]))


def points_score() -> Column:
    """Rule points of a profile row; a rule on an unknown value adds nothing."""
    parts = [bands.below(F.col(name), ladder, 0) for name, ladder in POINTS_BELOW.items()]
    parts += [bands.above(F.col(name), ladder, 0) for name, ladder in POINTS_ABOVE.items()]
    return sum(parts[1:], parts[0])


def points_category(points: Column) -> Column:
    return bands.at_least(points, POINTS_CATEGORIES, LOWEST_POINTS_CATEGORY)
