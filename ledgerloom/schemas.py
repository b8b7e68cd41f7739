"""Columns and types of every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, DAY, MOMENT, FLAG = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()
NUMBER, KEY, WHOLE = T.DoubleType(), T.LongType(), T.IntegerType()
# when a row was written, as opposed to when something happened
WRITTEN = T.TimestampType()

CUSTOMERS = _table(
    customer_id=TEXT, name=TEXT, date_of_birth=DAY, address=TEXT, city=TEXT, state=TEXT, zip_code=TEXT,
    phone=TEXT, email=TEXT, annual_income=NUMBER, job_title=TEXT, employment_status=TEXT, marital_status=TEXT,
    created_date=DAY,
)
TRANSACTIONS = _table(
    transaction_id=TEXT, customer_id=TEXT, transaction_type=TEXT, amount=NUMBER, timestamp=MOMENT,
    merchant_name=TEXT, merchant_category=TEXT, location_city=TEXT, location_state=TEXT, is_weekend=FLAG,
    hour=WHOLE, is_online=FLAG, is_fraud=FLAG,
)
CREDIT_SCORES = _table(
    customer_id=TEXT, credit_score=WHOLE, score_date=DAY, credit_history_length=WHOLE,
    number_of_accounts=WHOLE, total_debt=NUMBER, credit_utilization=NUMBER,
)

DIM_CUSTOMER = _table(
    customer_key=KEY, customer_id=TEXT, name=TEXT, date_of_birth=DAY, age=WHOLE, full_address=TEXT, city=TEXT,
    state=TEXT, zip_code=TEXT, phone=TEXT, email=TEXT, annual_income=NUMBER, income_bracket=TEXT,
    job_title=TEXT, employment_status=TEXT, marital_status=TEXT, customer_since=DAY,
    customer_tenure_days=WHOLE, is_complete_record=FLAG, is_active=FLAG, created_at=WRITTEN,
    updated_at=WRITTEN,
)
# Stored part of the fact table. The running columns are added on reading, see plans.warehouse.
FACT_TRANSACTIONS = _table(
    transaction_key=KEY, transaction_id=TEXT, customer_key=KEY, customer_id=TEXT, transaction_type=TEXT,
    amount=NUMBER, transaction_date=DAY, transaction_timestamp=MOMENT, merchant_name=TEXT,
    merchant_category=TEXT, location_city=TEXT, location_state=TEXT, is_weekend=FLAG, transaction_hour=WHOLE,
    is_online=FLAG, is_fraud=FLAG, is_high_value=FLAG, created_at=WRITTEN,
)
# Fact rows per customer, kept by the loads. They decide where very large customers are cut, never a result.
FACT_COUNTS = _table(customer_id=TEXT, rows=KEY)
# The same with stored running columns. ``epoch`` counts how often the customer's rows were worked out anew, and
# ``repeated`` marks rows that an earlier load has brought.
RUNNING = _table(
    transaction_sequence=KEY, running_total=NUMBER, days_since_last_transaction=WHOLE, epoch=WHOLE, repeated=FLAG,
)
FACT_RUNNING = T.StructType([*FACT_TRANSACTIONS.fields, *RUNNING.fields, T.StructField("transaction_month", DAY)])
# What a load has to know of a customer's earlier transactions.
CUSTOMER_STATE = _table(
    customer_id=TEXT, rows=KEY, total=NUMBER, amounts=KEY, last_moment=MOMENT, last_transaction=TEXT, epoch=WHOLE,
)
DIM_CREDIT = _table(
    credit_key=KEY, customer_key=KEY, customer_id=TEXT, credit_score=WHOLE, credit_rating=TEXT,
    score_date=DAY, credit_history_length=WHOLE, number_of_accounts=WHOLE, total_debt=NUMBER,
    credit_utilization=NUMBER, debt_to_income_ratio=NUMBER, utilization_risk_level=TEXT,
    high_debt_burden=FLAG, created_at=WRITTEN, updated_at=WRITTEN,
)
RISK_HISTORY = _table(
    customer_id=TEXT, risk_score=NUMBER, risk_category=TEXT, risk_factors=T.ArrayType(TEXT),
    assessment_date=DAY, created_at=WRITTEN,
)
PIPELINE_RUNS = _table(
    run_date=DAY, pipeline_name=TEXT, status=TEXT, records_processed=KEY, run_duration=T.DecimalType(12, 2),
    error_message=TEXT, created_at=WRITTEN,
)
SCORING_RULES = _table(
    rule_id=WHOLE, rule_name=TEXT, rule_description=TEXT, rule_weight=T.DecimalType(5, 4),
    threshold_value=T.DecimalType(12, 2), risk_points=WHOLE, is_active=FLAG,
)
QUALITY = _table(
    table_name=TEXT, metric_name=TEXT, metric_value=NUMBER, threshold_value=NUMBER, status=TEXT,
)

# Decimal forms of money and shares for sinks that declare them; totals of a customer are wider than single
# amounts. The debt ratio has no bound and stays double.
SINK_DECIMALS = {
    "amount": T.DecimalType(12, 2),
    "annual_income": T.DecimalType(12, 2),
    "total_debt": T.DecimalType(12, 2),
    "total_spent": T.DecimalType(18, 2),
    "avg_transaction_amount": T.DecimalType(12, 2),
    "max_transaction_amount": T.DecimalType(12, 2),
    "credit_utilization": T.DecimalType(5, 4),
    "online_transaction_pct": T.DecimalType(5, 4),
    "weekend_transaction_pct": T.DecimalType(5, 4),
    "risk_score": T.DecimalType(5, 2),
}


def conformed(schema: T.StructType) -> list[Column]:
    """The schema's columns in its order and types; a value that does not fit its type becomes null."""
    return [F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema]


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*conformed(schema))


def sink_decimals(rows: DataFrame) -> DataFrame:
    """Money and bounded shares as the decimals a database sink declares; a value that does not fit is an error."""

    def exact(name: str, kind: T.DecimalType) -> Column:
        value = F.col(name)
        fitted = value.try_cast(kind)
        message = F.concat(F.lit(f"{name} does not fit {kind.simpleString()}: "), value.cast("string"))
        return F.when(value.isNotNull() & fitted.isNull(), F.raise_error(message)).otherwise(fitted)

    return rows.withColumns({name: exact(name, kind) for name, kind in SINK_DECIMALS.items() if name in rows.columns})


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known as such to the optimizer, which then drops joins with them."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*columns).filter(F.lit(False))
