"""The registered queries in SQL, written apart from the library: rules and constants are spelled out again.

The statements run on the given tables. Doubles are rounded and dates and times turned to text on both sides;
the small amount added before rounding makes exact halves go up whatever the order of summation.
"""

from __future__ import annotations

import re

# Common table expressions, each with the ones it needs before it.
_CTES = {
    "people": """
        SELECT c_custkey AS k, c_name AS name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               'CUST-' || upper(substr(md5(lower(c_name) || '|' || lower(replace(c_name, '#', '.')) || '@example.com'), 1, 16))
                 AS customer_id,
               c_acctbal, c_mktsegment, c_nationkey
        FROM customer""",
    "customers": """
        SELECT customer_id, name, DATE '1950-01-01' + CAST(k * 37 % 18000 AS INTEGER) AS date_of_birth,
               k || ' Main St' AS address, n_name AS city, r_name AS state,
               lpad(CAST(k % 99999 AS VARCHAR), 5, '0') AS zip_code,
               '555-' || lpad(CAST(k AS VARCHAR), 7, '0') AS phone, email,
               CASE WHEN k % 53 <> 0 THEN greatest(round(c_acctbal * 12, 2), 15000.0::DOUBLE) END AS annual_income,
               c_mktsegment AS job_title,
               ['Salaried', 'Contractor', 'Student', 'Retired'][k % 4 + 1] AS employment_status,
               ['Alone', 'Partnered', 'Separated', 'Not told'][k % 4 + 1] AS marital_status,
               DATE '2019-01-01' + CAST(k * 13 % 1800 AS INTEGER) AS created_date
        FROM people LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "owned": """
        SELECT *, CAST(CASE WHEN event_id % 200 = 0 THEN 150 + event_id // 200 ELSE user_id END AS BIGINT) AS owner,
               ts - to_days(CAST(CASE user_id % 3 WHEN 1 THEN 66 * (event_id % 12) WHEN 2 THEN 100 + 30 * (event_id % 4)
                                 ELSE 0 END AS INTEGER)) AS moment
        FROM events""",
    "delivered": """
        SELECT CAST(event_id AS VARCHAR) AS transaction_id,
               CASE WHEN event_id % 997 = 1 THEN 'CUST-ORPHAN'
                    ELSE 'CUST-' || upper(substr(md5('customer#' || lpad(CAST(owner AS VARCHAR), 9, '0') || '|customer.'
                         || lpad(CAST(owner AS VARCHAR), 9, '0') || '@example.com'), 1, 16)) END AS customer_id,
               ['card', 'cash', 'wire', 'refund', 'fee'][event_id % 5 + 1] AS transaction_type,
               round(value * (1 + user_id % 10), 2) AS amount, moment AS timestamp,
               'M' || json_extract_string(props, '$.k') AS merchant_name, event_type AS merchant_category,
               n_name AS location_city, r_name AS location_state,
               isodow(moment) >= 6 AS is_weekend, CAST(hour(moment) AS INTEGER) AS hour,
               event_type IN ('click', 'view') AS is_online,
               event_type = 'error' AND event_id % 50 = 0 AS is_fraud, ts AS delivered
        FROM owned LEFT JOIN customer ON owner = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "transactions": "SELECT * EXCLUDE (delivered), CAST(timestamp AS DATE) AS transaction_date FROM delivered",
    "first_load": "SELECT * FROM delivered WHERE delivered < TIMESTAMP '2024-01-24 00:00:00'",
    "second_load": "SELECT * FROM delivered WHERE delivered >= TIMESTAMP '2024-01-22 00:00:00'",
    "all_credit": """
        SELECT customer_id, CAST(CASE WHEN k % 97 = 5 THEN 900 ELSE 300 + k * 7919 % 551 END AS INTEGER) AS credit_score,
               DATE '2023-06-01' + CAST(k % 200 AS INTEGER) AS score_date,
               CAST(1 + k % 19 AS INTEGER) AS credit_history_length, CAST(1 + k % 14 AS INTEGER) AS number_of_accounts,
               CAST(k * 104729 % 60000 AS DOUBLE) AS total_debt, round((k * 31 % 100) / 100.0, 2)::DOUBLE AS credit_utilization
        FROM people WHERE c_acctbal >= 0""",
    "credit": "SELECT * FROM all_credit WHERE credit_score BETWEEN 300 AND 850",
    "renewed": """
        SELECT customer_id, CAST(least(greatest(340 + k * 7919 % 551, 300), 850) AS INTEGER) AS credit_score,
               DATE '2024-02-01' AS score_date,
               CAST(1 + k % 19 AS INTEGER) AS credit_history_length, CAST(1 + k % 14 AS INTEGER) AS number_of_accounts,
               CAST(k * 104729 % 60000 AS DOUBLE) AS total_debt, round((k * 31 % 100) / 100.0, 2)::DOUBLE AS credit_utilization
        FROM people WHERE c_acctbal < 0 OR c_nationkey < 10""",
    "dim": """
        SELECT customer_id, name, date_of_birth,
               CAST(floor(date_diff('day', date_of_birth, DATE '2024-02-15') / 365.25) AS INTEGER) AS age,
               concat_ws(', ', address, city, state, zip_code) AS full_address, city, state, zip_code, phone, email,
               annual_income,
               CASE WHEN annual_income < 30000 THEN 'Low Income' WHEN annual_income < 50000 THEN 'Lower Middle'
                    WHEN annual_income < 75000 THEN 'Middle' WHEN annual_income < 100000 THEN 'Upper Middle'
                    ELSE 'High Income' END AS income_bracket,
               job_title, employment_status, marital_status, created_date AS customer_since,
               CAST(date_diff('day', created_date, DATE '2024-02-15') AS INTEGER) AS customer_tenure_days,
               email IS NOT NULL AND name IS NOT NULL AND customer_id IS NOT NULL AS is_complete_record,
               TRUE AS is_active
        FROM customers""",
    "keyed": """
        SELECT row_number() OVER (ORDER BY substr(md5(customer_id), 1, 4), customer_id) AS customer_key, * FROM dim""",
    "rated": """
        SELECT customer_key, c.customer_id, credit_score,
               CASE WHEN credit_score >= 800 THEN 'Excellent' WHEN credit_score >= 740 THEN 'Very Good'
                    WHEN credit_score >= 670 THEN 'Good' WHEN credit_score >= 580 THEN 'Fair' ELSE 'Poor' END AS credit_rating,
               score_date, credit_history_length, number_of_accounts, total_debt, credit_utilization,
               total_debt / annual_income AS debt_to_income_ratio,
               CASE WHEN credit_utilization > 0.8::DOUBLE THEN 'High' WHEN credit_utilization > 0.5::DOUBLE THEN 'Medium' ELSE 'Low' END
                 AS utilization_risk_level,
               coalesce(total_debt / annual_income > 0.4::DOUBLE, FALSE) AS high_debt_burden
        FROM credit c LEFT JOIN keyed USING (customer_id)""",
    "favorites": """
        SELECT customer_id, min(merchant_category) FILTER (place = 1) AS favorite_merchant_category,
               count(*) AS unique_merchant_categories
        FROM (SELECT customer_id, merchant_category,
                     row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, merchant_category) AS place
              FROM transactions GROUP BY customer_id, merchant_category)
        GROUP BY customer_id""",
    "metrics": """
        SELECT t.customer_id, count(transaction_id) AS total_transactions, sum(amount) AS total_spent,
               avg(amount) AS avg_transaction_amount, max(amount) AS max_transaction_amount,
               min(amount) AS min_transaction_amount, stddev_samp(amount) AS transaction_amount_stddev,
               min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
               CAST(date_diff('day', max(transaction_date), DATE '2024-02-15') AS INTEGER) AS days_since_last_transaction,
               any_value(favorite_merchant_category) AS favorite_merchant_category,
               any_value(unique_merchant_categories) AS unique_merchant_categories,
               count(DISTINCT merchant_name) AS unique_merchants,
               sum(CASE WHEN is_online THEN 1 ELSE 0 END) / count(*) AS online_transaction_pct,
               sum(CASE WHEN is_weekend THEN 1 ELSE 0 END) / count(*) AS weekend_transaction_pct,
               CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
               sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS fraud_amount,
               avg(hour) AS avg_transaction_hour,
               CAST(sum(CASE WHEN amount > 500 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_transaction_count
        FROM transactions t LEFT JOIN favorites f ON t.customer_id = f.customer_id GROUP BY t.customer_id""",
    "profile": """
        SELECT d.customer_key, d.customer_id, name, date_of_birth, age, city, state, annual_income, income_bracket, job_title,
               employment_status, marital_status, customer_tenure_days,
               coalesce(total_transactions, 0) AS total_transactions, coalesce(total_spent, 0) AS total_spent,
               coalesce(avg_transaction_amount, 0) AS avg_transaction_amount,
               coalesce(max_transaction_amount, 0) AS max_transaction_amount,
               coalesce(min_transaction_amount, 0) AS min_transaction_amount,
               coalesce(transaction_amount_stddev, 0) AS transaction_amount_stddev,
               first_transaction_date, last_transaction_date,
               coalesce(days_since_last_transaction, 9999) AS days_since_last_transaction, favorite_merchant_category,
               coalesce(unique_merchant_categories, 0) AS unique_merchant_categories,
               coalesce(unique_merchants, 0) AS unique_merchants,
               coalesce(online_transaction_pct, 0) AS online_transaction_pct,
               coalesce(weekend_transaction_pct, 0) AS weekend_transaction_pct,
               coalesce(fraud_count, 0) AS fraud_count, coalesce(fraud_amount, 0) AS fraud_amount,
               coalesce(high_value_transaction_count, 0) AS high_value_transaction_count,
               coalesce(credit_score, 300) AS credit_score, coalesce(credit_rating, 'Poor') AS credit_rating,
               coalesce(credit_history_length, 0) AS credit_history_length, coalesce(total_debt, 0) AS total_debt,
               coalesce(credit_utilization, 0) AS credit_utilization,
               coalesce(debt_to_income_ratio, 0) AS debt_to_income_ratio
        FROM keyed d LEFT JOIN rated r ON d.customer_key = r.customer_key LEFT JOIN metrics m ON d.customer_id = m.customer_id""",
    "scored": """
        SELECT *, CASE WHEN raw_risk_score < 20 THEN 0.0::DOUBLE WHEN raw_risk_score < 40 THEN 1.0::DOUBLE
                       WHEN raw_risk_score < 60 THEN 2.0::DOUBLE WHEN raw_risk_score < 80 THEN 3.0::DOUBLE ELSE 4.0::DOUBLE END
                    AS risk_bucket,
               CASE WHEN raw_risk_score < 20 THEN 'Very Low' WHEN raw_risk_score < 40 THEN 'Low'
                    WHEN raw_risk_score < 60 THEN 'Medium' WHEN raw_risk_score < 80 THEN 'High' ELSE 'Very High' END AS risk_category,
               raw_risk_score AS risk_score,
               list_filter([CASE WHEN credit_score < 600 THEN 'Low Credit Score' END,
                            CASE WHEN credit_utilization > 0.8::DOUBLE THEN 'High Credit Utilization' END,
                            CASE WHEN debt_to_income_ratio > 0.4::DOUBLE THEN 'High Debt to Income' END,
                            CASE WHEN total_spent > 10000 THEN 'High Spending Volume' END,
                            CASE WHEN annual_income < 30000 THEN 'Low Income' END,
                            CASE WHEN days_since_last_transaction > 90 THEN 'Inactive Customer' END,
                            CASE WHEN fraud_count > 0 THEN 'Fraud History' END,
                            CASE WHEN transaction_amount_stddev > 500 THEN 'High Transaction Volatility' END],
                           lambda factor : factor IS NOT NULL) AS risk_factors
        FROM (SELECT *, least(greatest(
                  (850 - coalesce(nullif(credit_score, 0), 600)) / 850 * 40
                  + least(coalesce(nullif(credit_utilization, 0), 0.5::DOUBLE), 1.0::DOUBLE) * 20
                  + least(coalesce(nullif(debt_to_income_ratio, 0), 0.2::DOUBLE) / 0.5::DOUBLE, 1.0::DOUBLE) * 25
                  + least(coalesce(nullif(transaction_amount_stddev, 0), 100.0::DOUBLE) / 1000, 1.0::DOUBLE) * 10
                  + least(coalesce(days_since_last_transaction, 0) / 180, 1.0::DOUBLE) * 5, 0), 100) AS raw_risk_score
              FROM profile)""",
    "points": """
        SELECT *, CASE WHEN points_score >= 60 THEN 'High' WHEN points_score >= 30 THEN 'Medium' ELSE 'Low' END AS points_category
        FROM (SELECT *, CAST(
                  CASE WHEN credit_score < 580 THEN 30 WHEN credit_score < 620 THEN 20 WHEN credit_score < 670 THEN 10 ELSE 0 END
                  + CASE WHEN credit_utilization > 0.8::DOUBLE THEN 20 WHEN credit_utilization > 0.6::DOUBLE THEN 15
                         WHEN credit_utilization > 0.4::DOUBLE THEN 10 ELSE 0 END
                  + CASE WHEN debt_to_income_ratio > 0.4::DOUBLE THEN 25 WHEN debt_to_income_ratio > 0.3::DOUBLE THEN 15
                         WHEN debt_to_income_ratio > 0.2::DOUBLE THEN 10 ELSE 0 END
                  + CASE WHEN total_spent > 10000 THEN 10 WHEN total_spent > 5000 THEN 5 ELSE 0 END
                  + CASE WHEN annual_income < 30000 THEN 10 WHEN annual_income < 50000 THEN 5 ELSE 0 END
                  + CASE WHEN days_since_last_transaction > 90 THEN 5 WHEN days_since_last_transaction > 30 THEN 2 ELSE 0 END
                  AS INTEGER) AS points_score FROM scored)""",
    "fact": """
        SELECT transaction_id, customer_key, t.customer_id, transaction_type, amount, transaction_date,
               timestamp AS transaction_timestamp, merchant_name, merchant_category, location_city, location_state, is_weekend,
               hour AS transaction_hour, is_online, is_fraud,
               row_number() OVER ordered AS transaction_sequence,
               sum(amount) OVER (ordered ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total,
               CAST(date_diff('day', lag(timestamp) OVER ordered, timestamp) AS INTEGER) AS days_since_last_transaction,
               amount - avg(amount) OVER (PARTITION BY t.customer_id) AS amount_vs_avg,
               coalesce(amount > 500, FALSE) AS is_high_value
        FROM transactions t LEFT JOIN keyed k ON t.customer_id = k.customer_id
        WINDOW ordered AS (PARTITION BY t.customer_id ORDER BY timestamp, transaction_id)""",
    "fresh": "SELECT * FROM second_load WHERE transaction_id NOT IN (SELECT transaction_id FROM first_load)",
    "both_loads": "SELECT * FROM first_load UNION ALL SELECT * FROM second_load",
}

# Every rule that the second day's credit rows replace, and the rows of both days.
_CTES["merged_credit"] = "SELECT * FROM credit WHERE customer_id NOT IN (SELECT customer_id FROM renewed) UNION ALL SELECT * FROM renewed"
_CTES["first_day"] = "SELECT * EXCLUDE (delivered), CAST(timestamp AS DATE) AS transaction_date FROM first_load"


def _variant(suffix: str, **replaced: str) -> dict[str, str]:
    """The statements from the dimension to the scores over other rows, or as of another day."""
    names = ["dim", "keyed", "rated", "favorites", "metrics", "profile", "scored"]
    found = {}
    for name in names:
        body = _CTES[name]
        for old, new in replaced.items():
            body = body.replace("2024-02-15", new) if old == "day" else re.sub(rf"\bFROM {old}\b", f"FROM {new}", body)
        for own in names:
            body = re.sub(rf"\b(FROM|JOIN) {own}\b", rf"\1 {own}{suffix}", body)
        found[name + suffix] = body
    return found


_CTES |= _variant("_1", transactions="first_day", day="2024-01-24") | _variant("_2", credit="merged_credit")

_NEEDS = {
    "customers": ["people"],
    "delivered": ["owned"],
    "transactions": ["delivered"],
    "first_load": ["delivered"],
    "second_load": ["delivered"],
    "all_credit": ["people"],
    "credit": ["all_credit"],
    "renewed": ["people"],
    "dim": ["customers"],
    "keyed": ["dim"],
    "rated": ["credit", "keyed"],
    "favorites": ["transactions"],
    "metrics": ["transactions", "favorites"],
    "profile": ["keyed", "rated", "metrics"],
    "scored": ["profile"],
    "points": ["scored"],
    "fact": ["transactions", "keyed"],
    "fresh": ["first_load", "second_load"],
    "both_loads": ["first_load", "second_load"],
    "merged_credit": ["credit", "renewed"],
    "first_day": ["first_load"],
}
for _suffix in ("_1", "_2"):
    for _name in ("dim", "keyed", "rated", "favorites", "metrics", "profile", "scored"):
        _other = {"transactions": "first_day"} if _suffix == "_1" else {"credit": "merged_credit"}
        _own = ("dim", "keyed", "rated", "favorites", "metrics", "profile", "scored")
        _NEEDS[_name + _suffix] = [n + _suffix if n in _own else _other.get(n, n) for n in _NEEDS[_name]]


def _with(select: str, *ctes: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    bodies = ",\n".join(f"{name} AS ({_CTES[name]})" for name in ordered)
    return (f"WITH {bodies}\n" if bodies else "") + _rounded(select)


def _rounded(select: str) -> str:
    """Shorthand in the statements below: ``~x`` is x rounded, ``@x`` a date and ``@@x`` a time as text."""
    select = re.sub(r"@@([\w.]+)", r"strftime(\1, '%Y-%m-%d %H:%M:%S.%f') AS \1", select)
    select = re.sub(r"@([\w.]+)", r"CAST(\1 AS VARCHAR) AS \1", select)
    return re.sub(r"~([\w.]+)", r"round(\1::DOUBLE + 3e-9, 4) + 0.0::DOUBLE AS \1", select)


def _report(*checks: tuple[str, str, str, str | None, str, str]) -> str:
    """Report rows from (table, metric, value, limit, status when kept, status when not)."""
    rows = []
    for table, metric, value, limit, kept, broken in checks:
        bound = "NULL" if limit is None else limit
        test = "TRUE" if limit is None else (f"v >= {limit}" if limit == "95" else f"v <= {limit}")
        rows.append(
            f"SELECT '{table}' AS table_name, '{metric}' AS metric_name, round(v + 3e-9, 4) + 0.0::DOUBLE AS metric_value, "
            f"CAST({bound} AS DOUBLE) AS threshold_value, CASE WHEN {test} THEN '{kept}' ELSE '{broken}' END AS status "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v)"
        )
    return "\nUNION ALL ".join(rows)


def _count(of: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {of} WHERE {where})"


_PERSON = """customer_id, name, @date_of_birth, age, city, state, ~annual_income, income_bracket, job_title,
    employment_status, marital_status, customer_tenure_days"""
_BEHAVIOUR = """total_transactions, ~total_spent, ~avg_transaction_amount, ~max_transaction_amount,
    ~min_transaction_amount, ~transaction_amount_stddev, @first_transaction_date, @last_transaction_date,
    days_since_last_transaction, favorite_merchant_category, unique_merchant_categories, unique_merchants,
    ~online_transaction_pct, ~weekend_transaction_pct, fraud_count, ~fraud_amount, high_value_transaction_count"""
_CREDIT = """credit_score, credit_rating, credit_history_length, ~total_debt, ~credit_utilization, ~debt_to_income_ratio"""
_RISK = """~raw_risk_score, ~risk_bucket, risk_category, ~risk_score, array_to_string(risk_factors, '; ') AS risk_factors"""
_LTV = """
    SELECT customer_id, round(monthly * stay + 3e-9, 4) + 0.0::DOUBLE AS ltv_score, round(monthly + 3e-9, 4) + 0.0::DOUBLE AS avg_monthly_spend,
           stay AS predicted_lifetime_months,
           CASE WHEN days_since_last_transaction > 90 THEN 'High' WHEN days_since_last_transaction > 30 THEN 'Medium'
                ELSE 'Low' END AS churn_risk
    FROM (SELECT *, total_spent / greatest(coalesce(date_diff('day', first_transaction_date, last_transaction_date), 30), 30) * 30
                      AS monthly,
                 CASE risk_category WHEN 'Low' THEN 36 WHEN 'Medium' THEN 24 ELSE 12 END AS stay FROM scored)"""
_RUNNING = """
    SELECT transaction_id, row_number() OVER ordered AS transaction_sequence,
           round(sum(amount) OVER (ordered ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 3e-9, 4) + 0.0::DOUBLE AS running_total,
           CAST(date_diff('day', lag(timestamp) OVER ordered, timestamp) AS INTEGER) AS days_since_last_transaction,
           round(amount - avg(amount) OVER (PARTITION BY customer_id) + 3e-9, 4) + 0.0::DOUBLE AS amount_vs_avg
    FROM fresh WINDOW ordered AS (PARTITION BY customer_id ORDER BY timestamp, transaction_id)"""
_FEATURES = [
    "credit_score", "credit_utilization", "debt_to_income_ratio", "total_spent", "annual_income",
    "days_since_last_transaction", "transaction_amount_stddev", "total_transactions",
]
_SCALED = "SELECT customer_id, " + ", ".join(
    f"round(({name} - avg({name}) OVER ()) / stddev_samp({name}) OVER () + 3e-9, 4) + 0.0::DOUBLE AS scaled_{name}"
    for name in _FEATURES
)
_AVERAGES = """round(avg(credit_score) + 3e-9, 4) + 0.0::DOUBLE AS avg_credit_score,
    round(avg(total_spent) + 3e-9, 4) + 0.0::DOUBLE AS avg_total_spent, round(avg(risk_score) + 3e-9, 4) + 0.0::DOUBLE AS avg_risk_score"""
_REPORT_KEYS = "(SELECT DISTINCT customer_id FROM {0} EXCEPT SELECT customer_id FROM customers)"
_COMPLETE = " AND ".join(
    f"{name} IS NOT NULL"
    for name in ["customer_key", "customer_id", "name", "date_of_birth", "annual_income", "risk_score", "risk_category"]
)

_FACT = _with(
    """SELECT transaction_id, customer_key, customer_id, transaction_type, ~amount, @transaction_date,
           @@transaction_timestamp, merchant_name, merchant_category, location_city, location_state, is_weekend,
           transaction_hour, is_online, is_fraud, transaction_sequence, ~running_total, days_since_last_transaction,
           ~amount_vs_avg, is_high_value FROM fact""",
    "fact",
)

ORACLES: dict[str, str] = {
    "clean_customers": _with(
        """SELECT customer_id, name, @date_of_birth, address, city, state, zip_code, phone, email, ~annual_income, job_title,
               employment_status, marital_status, @created_date, 'customers.csv' AS source_file,
               'synthetic_generator' AS data_source FROM customers""",
        "customers",
    ),
    "clean_transactions": _with(
        """SELECT transaction_id, customer_id, transaction_type, ~amount, @@timestamp, merchant_name, merchant_category,
               location_city, location_state, is_weekend, hour, is_online, is_fraud, 'transactions.csv' AS source_file
           FROM transactions""",
        "transactions",
    ),
    "clean_credit": _with(
        """SELECT customer_id, credit_score, @score_date, credit_history_length, number_of_accounts, ~total_debt,
               ~credit_utilization, 'credit_scores.csv' AS source_file FROM credit""",
        "credit",
    ),
    "first_per_email": _with(
        "SELECT email, customer_id, name, @created_date, ~annual_income FROM customers", "customers"
    ),
    "customer_business_key": _with("SELECT name, customer_id FROM people", "people"),
    "time_parts": """
        SELECT event_id, isodow(ts) >= 6 AS is_weekend, CAST(hour(ts) AS INTEGER) AS hour,
               CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month,
               CAST(CAST(CAST(ts AS DATE) - INTERVAL 24 MONTH AS DATE) AS VARCHAR) AS two_years_before,
               round((epoch_us(TIMESTAMP '2024-02-15 00:00:00') - epoch_us(ts)) / 1000000.0::DOUBLE + 3e-9, 4) + 0.0::DOUBLE
                 AS elapsed_seconds
        FROM events""",
    "bounds": """
        SELECT c_custkey,
               CASE WHEN c_acctbal >= 0 THEN round(greatest(c_acctbal * 5, 15000.0::DOUBLE) + 3e-9, 4) + 0.0::DOUBLE END AS income,
               CASE WHEN c_acctbal >= -500 THEN CAST(least(greatest(floor(c_acctbal / 10), 300), 850) AS INTEGER) END
                 AS credit_score
        FROM customer""",
    "text_fixes": """
        SELECT c_custkey, c_name || ', ' || c_mktsegment || ', Unit ' || c_nationkey AS address,
               substr('+1-555-' || c_name, 1, 20) AS phone
        FROM customer""",
    "age_completed_years": _with(
        """SELECT customer_id, @date_of_birth,
               CAST(2024 - year(date_of_birth)
                    - CASE WHEN month(date_of_birth) * 100 + day(date_of_birth) > 215 THEN 1 ELSE 0 END AS INTEGER)
                 AS completed_years, age
           FROM dim""",
        "dim",
    ),
    "dim_customer": _with(
        """SELECT customer_id, name, @date_of_birth, age, full_address, city, state, zip_code, phone, email, ~annual_income,
               income_bracket, job_title, employment_status, marital_status, @customer_since, customer_tenure_days,
               is_complete_record, is_active FROM dim""",
        "dim",
    ),
    "surrogate_keys": _with(
        """SELECT customer_id, row_number() OVER (ORDER BY state NOT IN ('AFRICA', 'AMERICA'), substr(md5(customer_id), 1, 4),
               customer_id) AS customer_key FROM dim""",
        "dim",
    ),
    "fact_enriched": _FACT,
    "fact_sliced": _FACT,
    "fact_incremental": _with(
        """SELECT transaction_id, customer_id, customer_key, transaction_sequence, ~running_total,
               days_since_last_transaction, ~amount_vs_avg, is_high_value FROM fact""",
        "fact",
    ),
    "fact_new_rows": _with(
        """SELECT (SELECT count(*) FROM first_load)
                  + row_number() OVER (ORDER BY substr(md5(transaction_id), 1, 4), transaction_id) AS transaction_key,
               transaction_id, customer_id, ~amount FROM fresh""",
        "fresh",
    ),
    "fact_batch_restart": _with(_RUNNING, "fresh"),
    "dim_credit": _with(
        """SELECT customer_key, customer_id, credit_score, credit_rating, @score_date, credit_history_length,
               number_of_accounts, ~total_debt, ~credit_utilization, ~debt_to_income_ratio, utilization_risk_level,
               high_debt_burden FROM rated""",
        "rated",
    ),
    "upsert_credit": _with(
        """SELECT customer_id, credit_score, @score_date, credit_history_length, number_of_accounts, ~total_debt,
               ~credit_utilization
           FROM (SELECT * FROM credit WHERE customer_id NOT IN (SELECT customer_id FROM renewed)
                 UNION ALL SELECT * FROM renewed)""",
        "credit", "renewed",
    ),
    "sql_functions": _with(
        """SELECT customer_id, income_bracket,
               CASE WHEN credit_score >= 800 THEN 'Excellent' WHEN credit_score >= 740 THEN 'Very Good'
                    WHEN credit_score >= 670 THEN 'Good' WHEN credit_score >= 580 THEN 'Fair' ELSE 'Poor' END AS credit_rating
           FROM dim LEFT JOIN credit USING (customer_id)""",
        "dim", "credit",
    ),
    "transaction_metrics": _with(f"SELECT customer_id, {_BEHAVIOUR}, ~avg_transaction_hour FROM metrics", "metrics"),
    "favorite_category": _with("SELECT * FROM favorites", "favorites"),
    "customer_profile": _with(f"SELECT customer_key, {_PERSON}, {_BEHAVIOUR}, {_CREDIT} FROM profile", "profile"),
    "risk_score": _with(
        "SELECT customer_id, ~raw_risk_score, ~risk_bucket, risk_category, ~risk_score FROM scored", "scored"
    ),
    "risk_factors": _with(
        "SELECT customer_id, array_to_string(risk_factors, '; ') AS risk_factors FROM scored", "scored"
    ),
    "scaled_features": _with(f"{_SCALED} FROM profile", "profile"),
    "scaled_features_ml": _with(
        f"{_SCALED} FROM (SELECT * REPLACE (coalesce(annual_income, 15000) AS annual_income) FROM profile)", "profile"
    ),
    "points_score": _with("SELECT customer_id, points_score, points_category FROM points", "points"),
    "rescore_selected": _with(
        """SELECT customer_id, ~total_spent,
               round(CASE WHEN chosen THEN points_score ELSE risk_score END + 3e-9, 4) + 0.0::DOUBLE AS risk_score,
               CASE WHEN chosen THEN points_category ELSE risk_category END AS risk_category,
               array_to_string(risk_factors, '; ') AS risk_factors
           FROM (SELECT *, customer_id IN (SELECT customer_id FROM transactions) AS chosen FROM points)""",
        "points",
    ),
    "rescore_history": _with(
        """SELECT t.customer_id, coalesce(points_score, 0)::DOUBLE AS risk_score, coalesce(points_category, 'Low') AS risk_category,
               '2024-02-15' AS assessment_date
           FROM (SELECT DISTINCT customer_id FROM transactions) t LEFT JOIN points p ON t.customer_id = p.customer_id""",
        "points",
    ),
    "risk_history": _with(
        """SELECT customer_id, ~risk_score, risk_category, array_to_string(risk_factors, '; ') AS risk_factors,
               '2024-02-15' AS assessment_date FROM scored""",
        "scored",
    ),
    "v_risk_summary": _with(
        f"""SELECT risk_category, count(*) AS customer_count,
               round(round(count(*) / sum(count(*)) OVER () * 100, 2) + 3e-9, 4) + 0.0::DOUBLE AS percentage, {_AVERAGES},
               round(avg(annual_income) + 3e-9, 4) + 0.0::DOUBLE AS avg_income
            FROM scored GROUP BY risk_category""",
        "scored",
    ),
    "v_monthly_trends": _with(
        """SELECT CAST(CAST(date_trunc('month', transaction_date) AS DATE) AS VARCHAR) AS month,
               count(*) AS transaction_count, round(sum(amount) + 3e-9, 4) + 0.0::DOUBLE AS total_volume,
               round(avg(amount) + 3e-9, 4) + 0.0::DOUBLE AS avg_transaction_amount,
               count(DISTINCT customer_id) AS active_customers, CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count
           FROM transactions WHERE transaction_date >= DATE '2022-02-15' GROUP BY date_trunc('month', transaction_date)""",
        "transactions",
    ),
    "v_high_value": _with(
        f"""SELECT customer_key, {_PERSON}, {_BEHAVIOUR}, {_CREDIT}, {_RISK},
               CASE WHEN total_spent > 20000 AND credit_score > 700 THEN 'Premium'
                    WHEN total_spent > 10000 AND credit_score > 650 THEN 'Gold'
                    WHEN total_spent > 5000 AND credit_score > 600 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
            FROM scored WHERE risk_category IN ('Low', 'Medium') AND total_transactions > 10""",
        "scored",
    ),
    "v_risk_factors": _with(
        """SELECT risk_factor, count(*) AS customer_count,
               round(round(count(*) / (SELECT count(*) FROM scored) * 100, 2) + 3e-9, 4) + 0.0::DOUBLE AS percentage_of_total
           FROM (SELECT unnest(risk_factors) AS risk_factor FROM scored) GROUP BY risk_factor""",
        "scored",
    ),
    "v_segmentation": _with(
        f"""SELECT income_bracket, risk_category, count(*) AS customer_count, {_AVERAGES}
            FROM scored GROUP BY income_bracket, risk_category""",
        "scored",
    ),
    "v_ltv": _with(_LTV, "scored"),
    "v_ltv_selected": _with(f"{_LTV} WHERE job_title = 'MACHINERY'", "scored"),
    "v_risk_distribution": _with(
        """SELECT risk_category, count(*) AS count,
               round(round(count(*) / sum(count(*)) OVER () * 100, 1) + 3e-9, 4) + 0.0::DOUBLE AS percentage
           FROM scored GROUP BY risk_category""",
        "scored",
    ),
    "v_sample_distribution": _with(
        """SELECT risk_category, count(*) AS customer_count, round(avg(total_spent) + 3e-9, 4) + 0.0::DOUBLE AS avg_total_spent
           FROM scored GROUP BY risk_category""",
        "scored",
    ),
    "v_top_customers": _with(
        """SELECT customer_id, name, ~total_spent, ~risk_score
           FROM (SELECT * FROM scored ORDER BY total_spent DESC, customer_id LIMIT 10)""",
        "scored",
    ),
    "v_summary_stats": _with(
        """SELECT count(*) AS total_customers, round(avg(credit_score) + 3e-9, 4) + 0.0::DOUBLE AS avg_credit_score,
               round(avg(annual_income) + 3e-9, 4) + 0.0::DOUBLE AS avg_income, round(avg(total_spent) + 3e-9, 4) + 0.0::DOUBLE AS avg_spent,
               round(avg(risk_score) + 3e-9, 4) + 0.0::DOUBLE AS avg_risk_score FROM scored""",
        "scored",
    ),
    "v_category_counts": _with(
        "SELECT risk_category, count(*) AS customer_count FROM scored GROUP BY risk_category", "scored"
    ),
    "dq_null_counts": _with(
        _report(
            ("customers", "rows", _count("customers"), None, "INFO", ""),
            ("customers", "null_customer_id", _count("customers", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("customers", "null_name", _count("customers", "name IS NULL"), "0", "PASS", "WARN"),
            ("customers", "null_email", _count("customers", "email IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "rows", _count("transactions"), None, "INFO", ""),
            ("transactions", "null_transaction_id", _count("transactions", "transaction_id IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "null_customer_id", _count("transactions", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "null_amount", _count("transactions", "amount IS NULL"), "0", "PASS", "WARN"),
            ("credit_scores", "rows", _count("credit"), None, "INFO", ""),
            ("credit_scores", "null_customer_id", _count("credit", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("credit_scores", "null_credit_score", _count("credit", "credit_score IS NULL"), "0", "PASS", "WARN"),
        ),
        "customers", "transactions", "credit",
    ),
    "dq_uniqueness": _with(
        _report(
            ("customers", "duplicate_emails", "(SELECT count(*) - count(DISTINCT email) FROM customers)", "0", "PASS", "FAIL"),
            ("customers", "null_emails", _count("customers", "email IS NULL"), "0", "PASS", "FAIL"),
            ("customers", "null_customer_ids", _count("customers", "customer_id IS NULL"), "0", "PASS", "FAIL"),
            ("customers", "duplicate_customer_ids", "(SELECT count(*) FROM customers) - (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM customers))", "0", "PASS", "FAIL"),
            ("customers", "malformed_customer_ids", _count("customers", "NOT starts_with(customer_id, 'CUST-')"), "0", "PASS", "FAIL"),
            ("transactions", "duplicate_transaction_ids", "(SELECT count(*) - count(DISTINCT transaction_id) FROM both_loads)", "0", "PASS", "FAIL"),
            ("credit_scores", "duplicate_customer_ids", "(SELECT count(*) - count(DISTINCT customer_id) FROM credit)", "0", "PASS", "FAIL"),
        ),
        "customers", "both_loads", "credit",
    ),
    "dq_referential": _with(
        _report(
            ("transactions", "unknown_customer_ids", _count(_REPORT_KEYS.format("transactions")), "0", "PASS", "FAIL"),
            ("credit_scores", "unknown_customer_ids", _count(_REPORT_KEYS.format("all_credit")), "0", "PASS", "FAIL"),
        ),
        "customers", "transactions", "all_credit",
    ),
    "dq_unknown_customers": _with(
        "SELECT DISTINCT customer_id FROM transactions WHERE customer_id NOT IN (SELECT customer_id FROM customers)",
        "customers", "transactions",
    ),
    "dq_ranges": _with(
        _report(("credit_scores", "scores_out_of_range", _count("all_credit", "credit_score NOT BETWEEN 300 AND 850"), "0", "PASS", "FAIL")),
        "all_credit",
    ),
    "dq_input_checks": _with(
        _report(
            ("customers", "rows", _count("customers"), None, "INFO", ""),
            ("customers", "null_customer_id", _count("customers", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("customers", "null_name", _count("customers", "name IS NULL"), "0", "PASS", "WARN"),
            ("customers", "null_email", _count("customers", "email IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "rows", _count("transactions"), None, "INFO", ""),
            ("transactions", "null_transaction_id", _count("transactions", "transaction_id IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "null_customer_id", _count("transactions", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("transactions", "null_amount", _count("transactions", "amount IS NULL"), "0", "PASS", "WARN"),
            ("credit_scores", "rows", _count("all_credit"), None, "INFO", ""),
            ("credit_scores", "null_customer_id", _count("all_credit", "customer_id IS NULL"), "0", "PASS", "WARN"),
            ("credit_scores", "null_credit_score", _count("all_credit", "credit_score IS NULL"), "0", "PASS", "WARN"),
            ("customers", "duplicate_emails", "(SELECT count(*) - count(DISTINCT email) FROM customers)", "0", "PASS", "FAIL"),
            ("customers", "null_emails", _count("customers", "email IS NULL"), "0", "PASS", "FAIL"),
            ("customers", "null_customer_ids", _count("customers", "customer_id IS NULL"), "0", "PASS", "FAIL"),
            ("customers", "duplicate_customer_ids", "(SELECT count(*) FROM customers) - (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM customers))", "0", "PASS", "FAIL"),
            ("customers", "malformed_customer_ids", _count("customers", "NOT starts_with(customer_id, 'CUST-')"), "0", "PASS", "FAIL"),
            ("customers", "names_with_several_ids",
             "(SELECT count(*) FROM (SELECT name FROM customers GROUP BY name HAVING count(DISTINCT customer_id) > 1))",
             "0", "PASS", "WARN"),
            ("transactions", "unknown_customer_ids", _count(_REPORT_KEYS.format("transactions")), "0", "PASS", "FAIL"),
            ("transactions", "duplicate_transaction_ids", "(SELECT count(*) - count(DISTINCT transaction_id) FROM transactions)", "0", "PASS", "FAIL"),
            ("credit_scores", "duplicate_customer_ids", "(SELECT count(*) - count(DISTINCT customer_id) FROM all_credit)", "0", "PASS", "FAIL"),
            ("credit_scores", "unknown_customer_ids", _count(_REPORT_KEYS.format("all_credit")), "0", "PASS", "FAIL"),
            ("credit_scores", "scores_out_of_range", _count("all_credit", "credit_score NOT BETWEEN 300 AND 850"), "0", "PASS", "FAIL"),
        ),
        "customers", "transactions", "all_credit",
    ),
    "dq_names": _with(
        """SELECT job_title AS name, count(DISTINCT customer_id) AS unique_customer_ids, count(*) AS total_records
           FROM customers GROUP BY job_title HAVING count(DISTINCT customer_id) > 1""",
        "customers",
    ),
    "dq_metrics": _with(
        _report(
            ("customers", "null_customer_id_pct", "(SELECT 100.0 * count(*) FILTER (customer_id IS NULL) / count(*) FROM customers)", "0", "PASS", "FAIL"),
            ("transactions", "negative_amount_pct", "(SELECT 100.0 * count(*) FILTER (amount < 0) / count(*) FROM transactions)", "0", "PASS", "FAIL"),
            ("credit_scores", "invalid_score_pct", "(SELECT 100.0 * count(*) FILTER (credit_score NOT BETWEEN 300 AND 850) / count(*) FROM all_credit)", "0", "PASS", "FAIL"),
            ("customer_profile", "completeness_pct", f"(SELECT 100.0 * count(*) FILTER ({_COMPLETE}) / count(*) FROM scored)", "95", "PASS", "FAIL"),
        ),
        "scored", "all_credit",
    ),
    "dq_table_counts": _with(
        _report(
            ("staging.customers", "rows", _count("customers"), None, "INFO", ""),
            ("staging.transactions", "rows", _count("second_load"), None, "INFO", ""),
            ("staging.credit_scores", "rows", _count("renewed"), None, "INFO", ""),
            ("warehouse.dim_customer", "rows", _count("customers"), None, "INFO", ""),
            ("warehouse.fact_transactions", "rows", _count("transactions"), None, "INFO", ""),
            ("warehouse.dim_credit", "rows", _count("merged_credit"), None, "INFO", ""),
            ("analytics.customer_profile", "rows", _count("customers"), None, "INFO", ""),
            ("customer_profile", "names_with_several_ids",
             "(SELECT count(*) FROM (SELECT name FROM customers GROUP BY name HAVING count(DISTINCT customer_id) > 1))",
             "0", "PASS", "WARN"),
        ),
        "customers", "second_load", "transactions", "merged_credit",
    ),
}


# --- the scored profile, files and stored tables ---------------------------------------------------------

ORACLES["scored_profile"] = _with(
    f"""SELECT customer_key, {_PERSON}, {_BEHAVIOUR}, {_CREDIT}, {_RISK}, 'Spark ML Pipeline v1.0' AS scoring_model_version, """
    + ", ".join(f"round({name}::DOUBLE + 3e-9, 4) + 0.0::DOUBLE AS feature_{name}" for name in _FEATURES)
    + ", "
    + _SCALED.removeprefix("SELECT customer_id, ")
    + " FROM scored",
    "scored",
)

_KEPT = {
    "customers": "CAST(zip_code AS INTEGER) % 53 <> 7",
    "transactions": "CAST(transaction_id AS BIGINT) % 97 <> 5",
    "all_credit": "NOT (credit_history_length = 7 AND number_of_accounts = 3)",
}
ORACLES["ingest_customers"] = _with(
    f"""SELECT customer_id, name, @date_of_birth, address, city, state, zip_code, phone, email, ~annual_income, job_title,
            employment_status, marital_status, @created_date, 'synthetic_generator' AS data_source
        FROM (SELECT * REPLACE (CASE WHEN CAST(zip_code AS INTEGER) % 41 <> 3 THEN annual_income END AS annual_income,
                                CASE WHEN CAST(zip_code AS INTEGER) % 59 <> 11 THEN date_of_birth END AS date_of_birth)
              FROM customers WHERE {_KEPT["customers"]})""",
    "customers",
)
ORACLES["ingest_transactions"] = _with(
    f"""SELECT transaction_id, customer_id, transaction_type, ~amount, @@timestamp, merchant_name, merchant_category,
            location_city, location_state, is_weekend, hour, is_online, is_fraud
        FROM (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 89 <> 4 THEN amount END AS amount,
                                CASE WHEN CAST(transaction_id AS BIGINT) % 83 <> 6 THEN timestamp END AS timestamp)
              FROM transactions WHERE {_KEPT["transactions"]})""",
    "transactions",
)
ORACLES["ingest_credit"] = _with(
    f"""SELECT customer_id, credit_score, @score_date, credit_history_length, number_of_accounts, ~total_debt, ~credit_utilization
        FROM (SELECT * REPLACE (CASE WHEN NOT (credit_history_length = 11 AND number_of_accounts = 5) THEN score_date END AS score_date)
              FROM all_credit WHERE {_KEPT["all_credit"]} AND credit_score BETWEEN 300 AND 850)""",
    "all_credit",
)


def _figures(table: str, of: str, unreadable: dict[str, str], clean: list[str], empty: list[tuple[str, str, str]], written: str) -> list:
    kept = _KEPT[of]
    return [
        (table, "rows_read", _count(of), None, "INFO", ""),
        (table, "rows_malformed", _count(of, f"NOT ({kept})"), "0", "PASS", "WARN"),
        *[(table, f"unreadable_{name}", _count(of, f"{kept} AND {test}"), "0", "PASS", "WARN") for name, test in unreadable.items()],
        *[(table, f"unreadable_{name}", "0", "0", "PASS", "WARN") for name in clean],
        *[(table, name, _count(of, f"{kept} AND ({test})"), "0", "PASS", broken) for name, test, broken in empty],
        (table, "rows_written", _count(of, f"{kept} AND {written}"), None, "INFO", ""),
    ]


ORACLES["ingest_figures"] = _with(
    _report(
        *_figures(
            "customers", "customers",
            {"annual_income": "CAST(zip_code AS INTEGER) % 41 = 3", "date_of_birth": "CAST(zip_code AS INTEGER) % 59 = 11"},
            ["created_date"],
            [("null_customer_id", "customer_id IS NULL", "FAIL"), ("null_name", "name IS NULL", "FAIL"), ("null_email", "email IS NULL", "FAIL")],
            "TRUE",
        ),
        *_figures(
            "transactions", "transactions",
            {"amount": "CAST(transaction_id AS BIGINT) % 89 = 4", "timestamp": "CAST(transaction_id AS BIGINT) % 83 = 6"},
            ["is_weekend", "hour", "is_online", "is_fraud"],
            [("null_transaction_id", "transaction_id IS NULL", "FAIL"), ("null_customer_id", "customer_id IS NULL", "FAIL"),
             ("null_amount", "amount IS NULL OR CAST(transaction_id AS BIGINT) % 89 = 4", "WARN")],
            "TRUE",
        ),
        *_figures(
            "credit_scores", "all_credit",
            {"score_date": "credit_history_length = 11 AND number_of_accounts = 5"},
            ["credit_score", "credit_history_length", "number_of_accounts", "total_debt", "credit_utilization"],
            [("null_customer_id", "customer_id IS NULL", "FAIL"), ("null_credit_score", "credit_score IS NULL", "WARN"),
             ("scores_out_of_range", "credit_score NOT BETWEEN 300 AND 850", "FAIL")],
            "credit_score BETWEEN 300 AND 850",
        ),
    ),
    "customers", "transactions", "all_credit",
)

_LOADED = """
    SELECT transaction_id, row_number() OVER (ORDER BY later, substr(md5(transaction_id), 1, 4), transaction_id) AS transaction_key
    FROM (SELECT transaction_id, FALSE AS later FROM first_load UNION ALL SELECT transaction_id, TRUE FROM fresh)"""
ORACLES["state_fact"] = _with(
    f"""SELECT transaction_key, f.transaction_id, customer_key, customer_id, transaction_type, ~amount, @transaction_date,
           @@transaction_timestamp, merchant_name, merchant_category, location_city, location_state, is_weekend,
           transaction_hour, is_online, is_fraud, transaction_sequence, ~running_total, days_since_last_transaction,
           ~amount_vs_avg, is_high_value FROM fact f JOIN ({_LOADED}) l ON f.transaction_id = l.transaction_id""",
    "fact", "fresh",
)
ORACLES["state_fact_selected"] = _with(
    """SELECT transaction_id, customer_id, transaction_sequence, ~running_total, ~amount_vs_avg
       FROM fact WHERE customer_id IN (SELECT customer_id FROM customers WHERE job_title = 'MACHINERY')""",
    "fact", "customers",
)
ORACLES["state_dim_customer"] = _with(
    """SELECT customer_key, customer_id, name, @date_of_birth, age, full_address, city, state, zip_code, phone, email,
           ~annual_income, income_bracket, job_title, employment_status, marital_status, @customer_since,
           customer_tenure_days, is_complete_record, is_active FROM keyed""",
    "keyed",
)
ORACLES["state_dim_credit"] = _with(
    """SELECT row_number() OVER (ORDER BY customer_id NOT IN (SELECT customer_id FROM credit), substr(md5(customer_id), 1, 4),
               customer_id) AS credit_key,
           customer_key, customer_id, credit_score, credit_rating, @score_date, credit_history_length,
           number_of_accounts, ~total_debt, ~credit_utilization, ~debt_to_income_ratio, utilization_risk_level,
           high_debt_burden FROM rated_2""",
    "rated_2", "credit",
)
_SNAPSHOT = """SELECT customer_id, ~risk_score, risk_category, array_to_string(risk_factors, '; ') AS risk_factors,
    '{1}' AS assessment_date FROM scored{0}"""
ORACLES["state_risk_history"] = _with(
    f"{_SNAPSHOT.format('_1', '2024-01-24')} UNION ALL {_SNAPSHOT.format('_2', '2024-02-15')}", "scored_1", "scored_2"
)
ORACLES["state_run_log"] = _with(
    """SELECT run_date, 'daily_risk_run' AS pipeline_name, 'SUCCESS' AS status, (SELECT count(*) FROM customers) AS records_processed,
           CAST(NULL AS VARCHAR) AS error_message
       FROM (VALUES ('2024-01-24'), ('2024-02-15')) days(run_date)""",
    "customers",
)
ORACLES["state_rules"] = _with(
    """SELECT rule_id, rule_name, rule_description, ~rule_weight, ~threshold_value, risk_points, TRUE AS is_active,
           (SELECT count(*) FROM scored_2 WHERE list_contains(risk_factors, rule_name)) AS customers
       FROM (VALUES (1, 'Low Credit Score', 'Credit score below 600', 0.3, 600, 30),
                    (2, 'High Credit Utilization', 'Credit utilization above 80%', 0.2, 0.8, 20),
                    (3, 'High Debt to Income', 'Debt to income ratio above 40%', 0.25, 0.4, 25),
                    (4, 'High Transaction Volume', 'Monthly spending above $5000', 0.1, 5000, 10),
                    (5, 'Low Income', 'Annual income below $30,000', 0.1, 30000, 10),
                    (6, 'Fraud History', 'Previous fraudulent transactions', 0.05, 1, 5))
            rules(rule_id, rule_name, rule_description, rule_weight, threshold_value, risk_points)""",
    "scored_2",
)
ORACLES["sql_surface"] = _with(
    """SELECT customer_id,
           CAST(year(current_date) - year(date_of_birth) - CAST(strftime(current_date, '%m%d') < strftime(date_of_birth, '%m%d') AS INTEGER)
                - (year(current_date) - 2000) AS INTEGER) AS years_older,
           CASE WHEN risk_category IN ('Low', 'Medium') AND total_transactions > 10 THEN
                CASE WHEN total_spent > 20000 AND credit_score > 700 THEN 'Premium'
                     WHEN total_spent > 10000 AND credit_score > 650 THEN 'Gold'
                     WHEN total_spent > 5000 AND credit_score > 600 THEN 'Silver' ELSE 'Bronze' END END AS customer_tier,
           round(monthly * stay + 3e-9, 2) + 0.0::DOUBLE AS ltv_score, round(monthly + 3e-9, 2) + 0.0::DOUBLE AS avg_monthly_spend,
           stay AS predicted_lifetime_months,
           CASE WHEN days_since_last_transaction > 90 THEN 'High' WHEN days_since_last_transaction > 30 THEN 'Medium'
                ELSE 'Low' END AS churn_risk
    FROM (SELECT *, total_spent / greatest(coalesce(date_diff('day', first_transaction_date, last_transaction_date), 30), 30) * 30
                      AS monthly,
                 CASE risk_category WHEN 'Low' THEN 36 WHEN 'Medium' THEN 24 ELSE 12 END AS stay FROM scored)""",
    "scored",
)

_BROKEN = {
    "broken_people": """
        SELECT CASE WHEN z % 31 = 0 THEN NULL WHEN z % 29 = 0 THEN 'X-1' ELSE customer_id END AS customer_id,
               CASE WHEN z % 13 = 0 THEN NULL WHEN z % 5 = 0 THEN 'One Name' ELSE name END AS name,
               CASE WHEN z % 11 = 0 THEN NULL WHEN z % 7 = 0 THEN 'shared@example.com' ELSE email END AS email
        FROM (SELECT *, CAST(zip_code AS INTEGER) AS z FROM customers)""",
    "broken_rows": """
        SELECT CASE WHEN e % 10 = 0 THEN NULL ELSE CAST(e % 5000 AS VARCHAR) END AS transaction_id,
               CASE WHEN e % 17 = 0 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN e % 19 = 0 THEN NULL WHEN e % 3 = 0 THEN -amount ELSE amount END AS amount
        FROM (SELECT *, CAST(transaction_id AS BIGINT) AS e FROM transactions)""",
    "broken_credit": """
        SELECT CASE WHEN credit_history_length = 3 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN number_of_accounts = 9 THEN NULL ELSE credit_score END AS credit_score
        FROM (SELECT * FROM all_credit UNION ALL SELECT * FROM all_credit WHERE number_of_accounts = 4)""",
}
_CTES |= _BROKEN
_NEEDS |= {"broken_people": ["customers"], "broken_rows": ["transactions"], "broken_credit": ["all_credit"]}
_UNKNOWN = "(SELECT DISTINCT customer_id FROM {0} r WHERE NOT EXISTS (SELECT 1 FROM broken_people p WHERE p.customer_id = r.customer_id))"
ORACLES["dq_broken_input"] = _with(
    _report(
        ("customers", "rows", _count("broken_people"), None, "INFO", ""),
        ("customers", "null_customer_id", _count("broken_people", "customer_id IS NULL"), "0", "PASS", "WARN"),
        ("customers", "null_name", _count("broken_people", "name IS NULL"), "0", "PASS", "WARN"),
        ("customers", "null_email", _count("broken_people", "email IS NULL"), "0", "PASS", "WARN"),
        ("transactions", "rows", _count("broken_rows"), None, "INFO", ""),
        ("transactions", "null_transaction_id", _count("broken_rows", "transaction_id IS NULL"), "0", "PASS", "WARN"),
        ("transactions", "null_customer_id", _count("broken_rows", "customer_id IS NULL"), "0", "PASS", "WARN"),
        ("transactions", "null_amount", _count("broken_rows", "amount IS NULL"), "0", "PASS", "WARN"),
        ("credit_scores", "rows", _count("broken_credit"), None, "INFO", ""),
        ("credit_scores", "null_customer_id", _count("broken_credit", "customer_id IS NULL"), "0", "PASS", "WARN"),
        ("credit_scores", "null_credit_score", _count("broken_credit", "credit_score IS NULL"), "0", "PASS", "WARN"),
        ("customers", "duplicate_emails", "(SELECT count(*) - count(DISTINCT email) FROM broken_people)", "0", "PASS", "FAIL"),
        ("customers", "null_emails", _count("broken_people", "email IS NULL"), "0", "PASS", "FAIL"),
        ("customers", "null_customer_ids", _count("broken_people", "customer_id IS NULL"), "0", "PASS", "FAIL"),
        ("customers", "duplicate_customer_ids", "(SELECT count(*) FROM broken_people) - (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM broken_people))", "0", "PASS", "FAIL"),
        ("customers", "malformed_customer_ids", _count("broken_people", "NOT starts_with(customer_id, 'CUST-')"), "0", "PASS", "FAIL"),
        ("customers", "names_with_several_ids",
         "(SELECT count(*) FROM (SELECT name FROM broken_people WHERE name IS NOT NULL GROUP BY name HAVING count(DISTINCT customer_id) > 1))",
         "0", "PASS", "WARN"),
        ("transactions", "unknown_customer_ids", _count(_UNKNOWN.format("broken_rows")), "0", "PASS", "FAIL"),
        ("transactions", "duplicate_transaction_ids", "(SELECT count(*) - count(DISTINCT transaction_id) FROM broken_rows)", "0", "PASS", "FAIL"),
        ("transactions", "negative_amounts", _count("broken_rows", "amount < 0"), "0", "PASS", "FAIL"),
        ("credit_scores", "duplicate_customer_ids", "(SELECT count(*) - count(DISTINCT customer_id) FROM broken_credit)", "0", "PASS", "FAIL"),
        ("credit_scores", "unknown_customer_ids", _count(_UNKNOWN.format("broken_credit")), "0", "PASS", "FAIL"),
        ("credit_scores", "scores_out_of_range", _count("broken_credit", "credit_score NOT BETWEEN 300 AND 850"), "0", "PASS", "FAIL"),
    ),
    "broken_people", "broken_rows", "broken_credit",
)


def _summary(level: str, bracket: str, category: str, share: str, group: str) -> str:
    return f"""SELECT '{level}' AS level, {bracket} AS income_bracket, {category} AS risk_category, count(*) AS customer_count,
        {share.format(2)} AS percentage, {share.format(1)} AS share, {_AVERAGES},
        round(avg(annual_income) + 3e-9, 4) + 0.0::DOUBLE AS avg_income FROM scored {group}"""


_SHARE, _NO_SHARE = "round(round(count(*) / sum(count(*)) OVER () * 100, {0}) + 3e-9, 4) + 0.0::DOUBLE", "NULL::DOUBLE"
ORACLES["v_summaries"] = _with(
    " UNION ALL ".join(
        [
            _summary("risk_category", "NULL", "risk_category", _SHARE, "GROUP BY risk_category"),
            _summary("segment", "income_bracket", "risk_category", _NO_SHARE, "GROUP BY income_bracket, risk_category"),
            _summary("all", "NULL", "NULL", _NO_SHARE, ""),
        ]
    ),
    "scored",
)


def _rejected(table: str, of: str, record: str, tests: dict[str, str]) -> str:
    reasons = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in tests.items())
    return f"""SELECT '{table}' AS table_name, {record} AS record_id,
        CASE WHEN NOT ({_KEPT[of]}) THEN 'malformed' ELSE concat_ws('; ', {reasons}) END AS reasons FROM {of}"""


ORACLES["ingest_rejected"] = _with(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _rejected("customers", "customers", "customer_id", {
                "unreadable_date_of_birth": "CAST(zip_code AS INTEGER) % 59 = 11",
                "unreadable_annual_income": "CAST(zip_code AS INTEGER) % 41 = 3",
            }),
            _rejected("transactions", "transactions", "transaction_id", {
                "unreadable_amount": "CAST(transaction_id AS BIGINT) % 89 = 4",
                "unreadable_timestamp": "CAST(transaction_id AS BIGINT) % 83 = 6",
            }),
            _rejected("credit_scores", "all_credit", "customer_id", {
                "unreadable_score_date": "credit_history_length = 11 AND number_of_accounts = 5",
                "scores_out_of_range": "credit_score NOT BETWEEN 300 AND 850",
            }),
        ]
    )
    + ") WHERE reasons <> ''",
    "customers", "transactions", "all_credit",
)


# --- the same results by other ways ----------------------------------------------------------------------

for _name, _same in {
    "state_fact_carried": "state_fact",
    "metrics_merged": "transaction_metrics",
    "fact_new_rows_indexed": "fact_new_rows",
    "v_monthly_trends_rollup": "v_monthly_trends",
}.items():
    ORACLES[_name] = ORACLES[_same]
ORACLES["fact_merged"] = f"SELECT * EXCLUDE (transaction_key) FROM ({ORACLES['state_fact']})"
ORACLES["merchants_sketched"] = _with("SELECT customer_id, unique_merchants, TRUE AS within_bound FROM metrics", "metrics")
