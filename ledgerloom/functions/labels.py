"""Business labels of customers, credit rows and transactions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions import bands

# Income brackets, by the income they end below.
INCOME_BRACKETS = [
    (30000, "Low Income"),
    (50000, "Lower Middle"),
    (75000, "Middle"),
    (100000, "Upper Middle"),
]
TOP_INCOME_BRACKET = "High Income"

# Credit ratings, by the score they begin at.
CREDIT_RATINGS = [
    (800, "Excellent"),
    (740, "Very Good"),
    (670, "Good"),
    (580, "Fair"),
]
LOWEST_CREDIT_RATING = "Poor"

# Levels of credit utilization above a share, and churn risks above days without a transaction.
UTILIZATION_LEVELS = [(0.8, "High"), (0.5, "Medium")]
LOWEST_UTILIZATION_LEVEL = "Low"

CHURN_RISKS = [(90, "High"), (30, "Medium")]
LOWEST_CHURN_RISK = "Low"

# Tier, spent more than, credit score above.
CUSTOMER_TIERS = [
    ("Premium", 20000, 700),
    ("Gold", 10000, 650),
    ("Silver", 5000, 600),
]
LOWEST_CUSTOMER_TIER = "Bronze"

# Expected months per risk category, and limits.
LIFETIME_MONTHS = {"Low": 36, "Medium": 24}
OTHER_LIFETIME_MONTHS = 12

HIGH_VALUE_AMOUNT = 500
HIGH_DEBT_RATIO = 0.4
LOWEST_CREDIT_SCORE = 300
HIGHEST_CREDIT_SCORE = 850
LOWEST_INCOME = 15000


def income_bracket(income: Column) -> Column:
    """Bracket of a yearly income; an unknown income lands in the top bracket, as in the source system."""
    return bands.below(income, INCOME_BRACKETS, TOP_INCOME_BRACKET)


def credit_rating(score: Column) -> Column:
    """Rating of a credit score; an unknown score is rated lowest."""
    return bands.at_least(score, CREDIT_RATINGS, LOWEST_CREDIT_RATING)


def utilization_level(utilization: Column) -> Column:
    return bands.above(utilization, UTILIZATION_LEVELS, LOWEST_UTILIZATION_LEVEL)


def churn_risk(days_inactive: Column) -> Column:
    return bands.above(days_inactive, CHURN_RISKS, LOWEST_CHURN_RISK)


def customer_tier(total_spent: Column, credit_score: Column) -> Column:
    tier = F.lit(LOWEST_CUSTOMER_TIER)
    for name, spent, score in reversed(CUSTOMER_TIERS):
        tier = F.when((total_spent > spent) & (credit_score > score), F.lit(name)).otherwise(tier)
    return tier


def lifetime_months(risk_category: Column, months: dict[str, int] | None = None) -> Column:
    """Months a customer is expected to stay; categories not listed get the shortest stay."""
    expected = F.lit(OTHER_LIFETIME_MONTHS)
    for category, stay in (LIFETIME_MONTHS if months is None else months).items():
        expected = F.when(risk_category == category, F.lit(stay)).otherwise(expected)
    return expected


def debt_to_income(total_debt: Column, annual_income: Column) -> Column:
    """Debt divided by income, kept as a double; null when the income is zero or unknown."""
    return F.try_divide(total_debt.cast("double"), annual_income.cast("double"))


def exceeds(value: Column, limit: float) -> Column:
    """Whether the value is above the limit; false when it is unknown."""
    return F.coalesce(value > limit, F.lit(False))


def valid_credit_score(score: Column) -> Column:
    """True inside the scale, false outside, null when there is no score."""
    return score.between(LOWEST_CREDIT_SCORE, HIGHEST_CREDIT_SCORE)


def floored_income(income: Column) -> Column:
    """Income raised to the lowest accepted one; ``greatest`` alone would turn null into the bound."""
    return F.when(income.isNotNull(), F.greatest(income, F.lit(LOWEST_INCOME).cast("double")))


def clamped_credit_score(score: Column) -> Column:
    """Score moved to the nearer end of the scale when it lies outside."""
    inside = F.least(F.greatest(score, F.lit(LOWEST_CREDIT_SCORE)), F.lit(HIGHEST_CREDIT_SCORE))
    return F.when(score.isNotNull(), inside)
