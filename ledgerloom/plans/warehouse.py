"""Staging tables to the star schema: two dimensions and one fact table.

Dimensions join all ids of a table, by merge joins. Left to itself Spark broadcasts a stored table by its size on disk,
which is a small part of that in memory, so that all ids would pass through the driver. Fact rows leave the choice to
Spark for the customer keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import schemas
from ledgerloom.functions import dates, labels, text
from ledgerloom.operators.history import add_history
from ledgerloom.operators.hot_keys import HotKeyPolicy
from ledgerloom.operators.keys import number_ids
from ledgerloom.operators.merge import new_rows, upsert

# Partition column of the stored fact table and of queries limited to recent months.
MONTH = "transaction_month"


def _now(at: Column | None) -> Column:
    return F.current_timestamp() if at is None else at


def dim_customer(customers: DataFrame, as_of: dates.AsOf = None, at: Column | None = None) -> DataFrame:
    """Customer dimension without its key: one row per staged customer."""
    today = dates.as_of_column(as_of)
    complete = F.col("email").isNotNull() & F.col("name").isNotNull() & F.col("customer_id").isNotNull()
    derived = customers.withColumns(
        {
            "age": dates.age_by_days(F.col("date_of_birth"), today),
            "full_address": text.joined_address(*[F.col(part) for part in ("address", "city", "state", "zip_code")]),
            "income_bracket": labels.income_bracket(F.col("annual_income")),
            "customer_since": F.col("created_date"),
            "customer_tenure_days": dates.days_between(today, F.col("created_date")),
            "is_complete_record": complete,
            "is_active": F.lit(True),
            "created_at": _now(at),
            "updated_at": _now(at),
        }
    )
    return derived.select(*[name for name in schemas.DIM_CUSTOMER.fieldNames() if name != "customer_key"])


def dim_credit(
    credit: DataFrame, customers: DataFrame, at: Column | None = None
) -> DataFrame:
    """Credit dimension without its key. ``customers`` has customer_id, customer_key and annual_income."""
    who = customers.select("customer_id", "customer_key", "annual_income")
    ratio = labels.debt_to_income(F.col("total_debt"), F.col("annual_income"))
    derived = (
        credit.join(who.hint("merge"), "customer_id", "left")
        .withColumn("debt_to_income_ratio", ratio)
        .withColumns(
            {
                "credit_rating": labels.credit_rating(F.col("credit_score")),
                "utilization_risk_level": labels.utilization_level(F.col("credit_utilization")),
                "high_debt_burden": labels.exceeds(F.col("debt_to_income_ratio"), labels.HIGH_DEBT_RATIO),
                "created_at": _now(at),
                "updated_at": _now(at),
            }
        )
    )
    return derived.select(*[name for name in schemas.DIM_CREDIT.fieldNames() if name != "credit_key"])


def merge_dimension(stored: DataFrame, rows: DataFrame, key_column: str) -> DataFrame:
    """Next state of a dimension: known customers replaced, new ones added and numbered.

    Known rows keep their key and their creation time. ``rows`` has one row per customer_id. Only ids that are
    new are numbered, from slim columns; the rows themselves meet in one full outer join.
    """
    fresh = rows.select("customer_id").join(stored.select("customer_id").hint("merge"), "customer_id", "left_anti")
    numbers = number_ids(fresh, "customer_id", key_column, stored)
    keyed = rows.join(numbers.hint("merge"), "customer_id", "left").select(*stored.columns)
    return upsert(stored, keyed, ["customer_id"], keep=[key_column, "created_at"])


def _fact_columns(transactions: DataFrame, at: Column | None) -> DataFrame:
    return transactions.withColumns(
        {
            "transaction_date": F.to_date("timestamp"),
            "is_high_value": labels.exceeds(F.col("amount"), labels.HIGH_VALUE_AMOUNT),
            "created_at": _now(at),
        }
    ).withColumnsRenamed({"timestamp": "transaction_timestamp", "hour": "transaction_hour"})


# Projection of the fact table as it is read, running columns included.
FACT_COLUMNS = [
    "transaction_id", "customer_key", "customer_id", "transaction_type", "amount", "transaction_date",
    "transaction_timestamp", "merchant_name", "merchant_category", "location_city", "location_state",
    "is_weekend", "transaction_hour", "is_online", "is_fraud", "transaction_sequence", "running_total",
    "days_since_last_transaction", "amount_vs_avg", "is_high_value", "created_at",
]


def fact_transactions(
    transactions: DataFrame, keys: DataFrame, at: Column | None = None, policy: HotKeyPolicy | None = None
) -> DataFrame:
    """Fact rows of staged transactions with customer key and running columns over exactly these rows.

    Given one batch, the running columns restart with it.
    """
    enriched = add_history(transactions, keys.select("customer_id", "customer_key"), policy=policy)
    return _fact_columns(enriched, at).select(*FACT_COLUMNS)


def keyed_fact_rows(fresh: DataFrame, stored: DataFrame, keys: DataFrame, at: Column | None = None) -> DataFrame:
    """Staged transactions as rows to append to the stored fact table, numbered and with their customer key.

    Numbers and customer keys are found on the two id columns alone; the wide rows are shuffled once, to join
    them. ``fresh`` is read for the ids and for the rows; give it a stored table when finding the fresh rows was
    expensive. Transactions of unknown customers stay, with a null customer key.
    """
    ids = number_ids(fresh.select("transaction_id", "customer_id"), "transaction_id", "transaction_key", stored)
    known = ids.join(keys.select("customer_id", "customer_key"), "customer_id", "left").drop("customer_id")
    keyed = _fact_columns(fresh, at).join(known, "transaction_id", "left")
    return keyed.select(*schemas.FACT_TRANSACTIONS.fieldNames())


def new_fact_rows(
    transactions: DataFrame, stored: DataFrame, keys: DataFrame, at: Column | None = None
) -> DataFrame:
    """Rows to append to the stored fact table for those staged transactions it does not hold yet."""
    return keyed_fact_rows(new_rows(transactions, stored, "transaction_id"), stored, keys, at)


def with_running_columns(
    stored_fact: DataFrame, policy: HotKeyPolicy | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """The stored fact table as users read it, running columns continued over the whole history.

    The columns of a customer depend on that customer's rows alone, so rows of some customers give theirs.

    They are worked out on reading and not stored: one late transaction changes the numbers of all later ones
    and the average of all, and storing them would mean to rewrite the table with every load.
    """
    enriched = add_history(stored_fact, time="transaction_timestamp", policy=policy, counts=counts)
    return enriched.select("transaction_key", *FACT_COLUMNS)


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, dates.month_start(F.col("transaction_date")))


def since(fact: DataFrame, first_day: Column) -> DataFrame:
    """Rows from a day on; skips whole month directories when the table has them."""
    recent = fact.filter(F.col("transaction_date") >= first_day)
    return recent.filter(F.col(MONTH) >= dates.month_start(first_day)) if MONTH in fact.columns else recent

