"""Scalar rules at, below and above every limit, and on null."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions import dates, labels, scoring, text
from ledgerloom.operators.shares import listed_first, percentage



def labelled(spark, rule, values, kind="double"):
    rows = spark.createDataFrame([(value,) for value in values], f"x {kind}")
    return [row[0] for row in rows.select(rule(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "rule, kind, expected",
    [
        (labels.income_bracket, "double", {
            29999.99: "Low Income", 30000.0: "Lower Middle", 49999.99: "Lower Middle", 50000.0: "Middle",
            74999.99: "Middle", 75000.0: "Upper Middle", 99999.99: "Upper Middle", 100000.0: "High Income",
            None: "High Income",
        }),
        (labels.credit_rating, "int", {
            850: "Excellent", 800: "Excellent", 799: "Very Good", 740: "Very Good", 739: "Good", 670: "Good",
            669: "Fair", 580: "Fair", 579: "Poor", None: "Poor",
        }),
        (labels.utilization_level, "double", {
            0.81: "High", 0.8: "Medium", 0.51: "Medium", 0.5: "Low", 0.0: "Low", None: "Low",
        }),
        (labels.churn_risk, "int", {91: "High", 90: "Medium", 31: "Medium", 30: "Low", 0: "Low", None: "Low"}),
        (lambda x: labels.exceeds(x, 500), "double", {500.01: True, 500.0: False, -1.0: False, None: False}),
        (labels.valid_credit_score, "int", {299: False, 300: True, 850: True, 851: False, None: None}),
        (labels.floored_income, "double", {14999.99: 15000.0, 15000.0: 15000.0, 15000.01: 15000.01, None: None}),
        (labels.clamped_credit_score, "int", {299: 300, 300: 300, 850: 850, 851: 850, None: None}),
        (labels.lifetime_months, "string", {"Low": 36, "Medium": 24, "High": 12, "Very Low": 12, None: 12}),
        (scoring.points_category, "int", {60: "High", 59: "Medium", 30: "Medium", 29: "Low", 0: "Low"}),
        (scoring.risk_category, "double", {
            0.0: "Very Low", 19.99: "Very Low", 20.0: "Low", 39.99: "Low", 40.0: "Medium", 59.99: "Medium",
            60.0: "High", 79.99: "High", 80.0: "Very High", 100.0: "Very High", None: None,
        }),
        (scoring.risk_bucket, "double", {0.0: 0.0, 20.0: 1.0, 59.9: 2.0, 60.0: 3.0, 80.0: 4.0, 100.0: 4.0, None: None}),
    ],
)
def test_ladders(spark, rule, kind, expected):
    assert labelled(spark, rule, list(expected), kind) == list(expected.values())


@pytest.mark.parametrize("score", [-0.1, 100.1, float("nan")])
def test_scores_outside_the_scale_are_refused(spark, score):
    with pytest.raises(PySparkException, match="outside 0 to 100"):
        labelled(spark, scoring.risk_bucket, [score])


def test_customer_tier(spark):
    cases = {
        (20000.01, 701): "Premium", (20000.01, 700): "Gold", (20000.0, 701): "Gold", (10000.01, 650): "Silver",
        (10000.0, 651): "Silver", (5000.01, 601): "Silver", (5000.01, 600): "Bronze", (5000.0, 800): "Bronze",
        (None, 800): "Bronze", (30000.0, None): "Bronze",
    }
    rows = spark.createDataFrame(list(cases), "spent double, score int")
    tiers = rows.select(labels.customer_tier(F.col("spent"), F.col("score"))).collect()
    assert [row[0] for row in tiers] == list(cases.values())


def test_debt_to_income(spark):
    rows = spark.createDataFrame([(150000.0, 15000.0), (1.0, 0.0), (None, 5.0), (5.0, None)], "debt double, income double")
    ratios = [row[0] for row in rows.select(labels.debt_to_income(F.col("debt"), F.col("income"))).collect()]
    assert ratios == [10.0, None, None, None]


def postgres_age_years(born: dt.date, today: dt.date) -> int:
    if born > today:
        return -postgres_age_years(today, born)
    return today.year - born.year - ((today.month, today.day) < (born.month, born.day))


def test_ages(spark):
    pairs = [
        (dt.date(2000, 2, 29), dt.date(2023, 2, 28)), (dt.date(2000, 2, 29), dt.date(2023, 3, 1)),
        (dt.date(2000, 2, 29), dt.date(2024, 2, 29)), (dt.date(1990, 6, 15), dt.date(2024, 6, 14)),
        (dt.date(1990, 6, 15), dt.date(2024, 6, 15)), (dt.date(2024, 6, 1), dt.date(2024, 1, 1)),
        (dt.date(2026, 6, 1), dt.date(2024, 1, 1)),
    ]
    rows = spark.createDataFrame([*pairs, (None, dt.date(2024, 1, 1))], "born date, today date")
    found = rows.select(
        dates.completed_years(F.col("born"), F.col("today")), dates.age_by_days(F.col("born"), F.col("today"))
    ).collect()
    assert [row[0] for row in found] == [postgres_age_years(*pair) for pair in pairs] + [None]
    assert [row[1] for row in found] == [int((b - a).days // 365.25) for a, b in pairs] + [None]


def test_the_two_ages_differ_around_a_birthday(spark, one):
    born, today = F.lit("2001-03-01").cast("date"), F.lit("2019-03-01").cast("date")
    assert one(dates.completed_years(born, today)) == 18
    assert one(dates.age_by_days(born, today)) == 17


def test_dates_and_times(one):
    saturday = F.lit("2024-02-17 23:59:59.5").cast("timestamp_ntz")
    assert one(dates.is_weekend(saturday)) is True
    assert one(dates.is_weekend(F.lit("2024-02-19").cast("date"))) is False
    assert one(dates.hour_of_day(saturday)) == 23
    assert one(dates.month_start(F.to_date(saturday))) == dt.date(2024, 2, 1)
    assert one(dates.months_before(F.lit("2024-02-29").cast("date"), 24)) == dt.date(2022, 2, 28)
    assert one(dates.elapsed_seconds(saturday, F.lit("2024-02-17 23:59:00").cast("timestamp_ntz"))) == 59.5
    assert one(dates.as_of_column(dt.date(2024, 2, 15))) == dt.date(2024, 2, 15)


@pytest.mark.parametrize(
    "name, email",
    [
        ("Ann Lee", "ann@example.com"), ("  Ann LEE\t", "\nANN@Example.com "), (" Zoë  ", "z@e.org"),
        ("Ann  Lee", "ann@example.com"), ("", ""),
    ],
)
def test_business_key_is_the_prefixed_digest(one, name, email):
    identity = f"{name.lower().strip()}|{email.lower().strip()}"
    expected = "CUST-" + hashlib.md5(identity.encode()).hexdigest()[:16].upper()
    assert one(text.business_key(F.col("name"), F.col("email")), name=name, email=email) == expected


def test_texts(one):
    assert one(text.business_key(F.lit(None).cast("string"), F.lit("a"))) is None
    assert one(text.joined_address(F.lit("1 Main St"), F.lit(None), F.lit("TX"), F.lit("00501"))) == "1 Main St, TX, 00501"
    assert one(text.one_line(F.lit("1 Main St\nSpringfield"))) == "1 Main St, Springfield"
    assert one(text.short_phone(F.lit("001-555-1234567890x12345"))) == "001-555-1234567890x1"


def python_score(score, utilization, ratio, days, volatility):
    """The weighted score, worked out one customer at a time."""
    score, utilization, ratio = score or 600.0, utilization or 0.5, ratio or 0.2
    days, volatility = days or 0.0, volatility or 100.0
    parts = [
        (850 - score) / 850 * 40,
        min(utilization, 1.0) * 20,
        min(ratio / 0.5, 1.0) * 25,
        min(volatility / 1000, 1.0) * 10,
        min(days / 180, 1.0) * 5,
    ]
    return min(max(sum(parts), 0.0), 100.0)


def test_weighted_score(spark):
    cases = [
        (300, 1.0, 0.5, 180, 1000.0), (300, 2.0, 9.0, 9999, 5000.0), (850, 0.05, 0.01, 1, 1.0), (None, None, None, None, None),
        (0, 0.0, 0.0, 0, 0.0), (720, 0.3, 0.25, 45, 220.5), (900, 0.01, 0.001, 0, 0.5), (300, 0.0, 0.0, 9999, 0.0),
        (2000, 0.01, 0.01, 0, 0.1), (-5000, 1.0, 1.0, 180, 1000.0),
    ]
    rows = spark.createDataFrame(cases, "score int, utilization double, ratio double, days int, volatility double")
    columns = [F.col(name) for name in rows.columns]
    found = [row[0] for row in rows.select(scoring.weighted_score(*columns)).collect()]
    assert found == pytest.approx([python_score(*case) for case in cases])
    assert found[0] == pytest.approx(85.88235294)  # the highest score a valid customer can reach


PROFILE = "credit_score int, credit_utilization double, debt_to_income_ratio double, total_spent double, " \
    "annual_income double, days_since_last_transaction int, fraud_count long, transaction_amount_stddev double"


def test_risk_factors(spark):
    cases = [
        (599, 0.81, 0.41, 10000.01, 29999.99, 91, 1, 500.01),
        (600, 0.8, 0.4, 10000.0, 30000.0, 90, 0, 500.0),
        (None,) * 8,
        (700, 0.1, 0.1, 0.0, 20000.0, 5, 2, 0.0),
    ]
    rows = spark.createDataFrame(cases, PROFILE)
    found = [row[0] for row in rows.select(scoring.risk_factors()).collect()]
    assert found == [[factor.label for factor in scoring.RISK_FACTORS], [], [], ["Low Income", "Fraud History"]]


def test_points(spark):
    cases = {
        (579, 0.81, 0.41, 10000.01, 29999.99, 91): 100,
        (580, 0.8, 0.4, 10000.0, 30000.0, 90): 20 + 15 + 15 + 5 + 5 + 2,
        (620, 0.6, 0.3, 5000.0, 50000.0, 30): 10 + 10 + 10,
        (670, 0.4, 0.2, 0.0, 90000.0, 0): 0,
        (None,) * 6: 0,
    }
    rows = spark.createDataFrame([(*case, None, None) for case in cases], PROFILE)
    assert [row[0] for row in rows.select(scoring.points_score()).collect()] == list(cases.values())


def test_order_and_percentage(spark, one):
    rows = spark.createDataFrame([("High",), ("Very Low",), ("Low",), (None,), ("Medium",)], "c string")
    ordered = [row[0] for row in rows.orderBy(listed_first(F.col("c")), F.col("c").asc_nulls_last()).collect()]
    assert ordered == ["Low", "Medium", "High", "Very Low", None]
    assert one(percentage(F.lit(1), F.lit(3), 2)) == 33.33
    assert one(percentage(F.lit(1), F.lit(8), 1)) == 12.5
