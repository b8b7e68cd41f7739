"""Quality checks that return their findings as rows.

Every check yields one row (table_name, metric_name, metric_value, threshold_value, status). Checks that are
aggregates over one table share one pass over it; references and shared names are grouped passes of their own
over the columns they need. Nothing but the finished report, a few dozen rows, ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import schemas
from ledgerloom.functions import labels, text

PASS, FAIL, WARN, INFO = "PASS", "FAIL", "WARN", "INFO"

# Columns that should be filled, and thresholds of the percentages.
REQUIRED = {
    "customers": ["customer_id", "name", "email"],
    "transactions": ["transaction_id", "customer_id", "amount"],
    "credit_scores": ["customer_id", "credit_score"],
}
COMPLETENESS_THRESHOLD = 95.0
PROFILE_REQUIRED = ["customer_key", "customer_id", "name", "date_of_birth", "annual_income", "risk_score", "risk_category"]


class QualityFailure(ValueError):
    """At least one check failed."""


@dataclass(frozen=True)
class Check:
    """One aggregate and its limit. ``otherwise`` is the status when the limit is not kept."""

    metric: str
    value: Column
    limit: float | None = 0.0
    at_least: bool = False
    otherwise: str = FAIL

    def status(self) -> Column:
        if self.limit is None:
            return F.lit(INFO)
        value = F.col(self.metric)
        kept = value >= self.limit if self.at_least else value <= self.limit
        return F.when(kept, F.lit(PASS)).otherwise(F.lit(self.otherwise))


def run_checks(rows: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks in one aggregate, one report row each."""
    values = rows.agg(*[check.value.cast("double").alias(check.metric) for check in checks])
    report = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check.metric).alias("metric_name"),
            F.col(check.metric).alias("metric_value"),
            F.lit(check.limit).cast("double").alias("threshold_value"),
            check.status().alias("status"),
        )
        for check in checks
    ]
    return values.select(F.inline(F.array(*report)))


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _repeats(column: str) -> Column:
    """Rows beyond the first of every value, null being a value like any other."""
    return F.count("*") - F.count_distinct(column) - F.least(_missing(column), F.lit(1))


def _not_unique(column: str) -> Column:
    """Rows that a count of distinct known values falls short of."""
    return F.count("*") - F.count_distinct(column)


def _percent(condition: Column) -> Column:
    """Share of rows in percent; an empty table has no such rows."""
    return F.coalesce(F.try_divide(F.count_if(condition) * F.lit(100.0), F.count("*")), F.lit(0.0))


def null_counts(rows: DataFrame, table: str) -> DataFrame:
    """Rows read and empty required columns; empty ones are a warning only."""
    return run_checks(rows, table, _null_checks(table))


def _null_checks(table: str) -> list[Check]:
    checks = [Check("rows", F.count("*"), limit=None)]
    return checks + [Check(f"null_{name}", _missing(name), otherwise=WARN) for name in REQUIRED[table]]


def _customer_id_checks() -> list[Check]:
    return [
        Check("duplicate_emails", _not_unique("email")),
        Check("null_emails", _missing("email")),
        Check("null_customer_ids", _missing("customer_id")),
        Check("duplicate_customer_ids", _repeats("customer_id")),
        Check("malformed_customer_ids", F.count_if(~text.has_customer_id_form(F.col("customer_id")))),
    ]


def _transaction_id_checks() -> list[Check]:
    return [Check("duplicate_transaction_ids", _not_unique("transaction_id"))]


def _credit_id_checks() -> list[Check]:
    return [Check("duplicate_customer_ids", _not_unique("customer_id"))]


def customer_uniqueness(customers: DataFrame) -> DataFrame:
    return run_checks(customers, "customers", _customer_id_checks())


def transaction_uniqueness(transactions: DataFrame) -> DataFrame:
    return run_checks(transactions, "transactions", _transaction_id_checks())


def credit_uniqueness(credit: DataFrame) -> DataFrame:
    return run_checks(credit, "credit_scores", _credit_id_checks())


def unknown_customers(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customer ids that no customer has. Ids are made distinct first, so a frequent id costs little.

    The ids of all customers are merged and not sent through the driver: a stored table is small on disk only.
    """
    ids = rows.select("customer_id").distinct()
    return ids.join(customers.select("customer_id").hint("merge"), "customer_id", "left_anti")


def referential(rows: DataFrame, customers: DataFrame, table: str) -> DataFrame:
    return run_checks(unknown_customers(rows, customers), table, [Check("unknown_customer_ids", F.count("*"))])


def _range_checks() -> list[Check]:
    return [Check("scores_out_of_range", F.count_if(~labels.valid_credit_score(F.col("credit_score"))))]


def score_range(credit: DataFrame) -> DataFrame:
    return run_checks(credit, "credit_scores", _range_checks())


def shared_names(customers: DataFrame) -> DataFrame:
    """Names with more than one customer id, with their number of ids and of rows."""
    return (
        customers.groupBy("name")
        .agg(F.count_distinct("customer_id").alias("unique_customer_ids"), F.count("*").alias("total_records"))
        .filter(F.col("unique_customer_ids") > 1)
    )


def name_consistency(customers: DataFrame, table: str) -> DataFrame:
    """Two people can share a name, so this is a warning; a caller that disagrees can stop on it."""
    named = shared_names(customers.filter(F.col("name").isNotNull()))
    return run_checks(named, table, [Check("names_with_several_ids", F.count("*"), otherwise=WARN)])


def relation_checks(customers: DataFrame, transactions: DataFrame, credit: DataFrame) -> DataFrame:
    """Uniqueness and references between the tables."""
    return union_reports(
        customer_uniqueness(customers),
        name_consistency(customers, "customers"),
        referential(transactions, customers, "transactions"),
        transaction_uniqueness(transactions),
        credit_uniqueness(credit),
        referential(credit, customers, "credit_scores"),
    )


def input_checks(customers: DataFrame, transactions: DataFrame, credit: DataFrame) -> DataFrame:
    """Everything that is checked before a load. ``credit`` still holds scores outside the scale.

    One aggregate per table, and three grouped passes over ids and names.
    """
    return union_reports(
        run_checks(customers, "customers", _null_checks("customers") + _customer_id_checks()),
        run_checks(transactions, "transactions", _null_checks("transactions") + _transaction_id_checks()),
        run_checks(credit, "credit_scores", _null_checks("credit_scores") + _credit_id_checks() + _range_checks()),
        name_consistency(customers, "customers"),
        referential(transactions, customers, "transactions"),
        referential(credit, customers, "credit_scores"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return union_reports(*[run_checks(rows, name, [Check("rows", F.count("*"), limit=None)]) for name, rows in tables.items()])


def load_checks(tables: Mapping[str, DataFrame], profile: DataFrame) -> DataFrame:
    """Everything that is checked after a load: row counts, and one customer id per name in the profile."""
    return union_reports(table_counts(tables), name_consistency(profile, "customer_profile"))


def metrics(customers: DataFrame, transactions: DataFrame, credit: DataFrame, profile: DataFrame) -> DataFrame:
    """The four tracked percentages."""
    complete = reduce(lambda left, right: left & right, [F.col(name).isNotNull() for name in PROFILE_REQUIRED])
    completeness = Check("completeness_pct", _percent(complete), limit=COMPLETENESS_THRESHOLD, at_least=True)
    invalid_score = ~labels.valid_credit_score(F.col("credit_score"))
    return union_reports(
        run_checks(customers, "customers", [Check("null_customer_id_pct", _percent(F.col("customer_id").isNull()))]),
        run_checks(transactions, "transactions", [Check("negative_amount_pct", _percent(F.col("amount") < 0))]),
        run_checks(credit, "credit_scores", [Check("invalid_score_pct", _percent(invalid_score))]),
        run_checks(profile, "customer_profile", [completeness]),
    )


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports).select(*schemas.QUALITY.fieldNames())


def raise_on_fail(report: DataFrame, stop_on: Sequence[str] = (FAIL,), tolerate: Sequence[str] = ()) -> None:
    """Stop when a check has one of the given statuses, unless its metric is tolerated."""
    failed = report.filter(F.col("status").isin(*stop_on) & ~F.col("metric_name").isin(*tolerate)).collect()
    if failed:
        raise QualityFailure("; ".join(f"{r.table_name}.{r.metric_name} = {r.metric_value:g}" for r in failed))


def all_pass(report: DataFrame, metric_names: Sequence[str]) -> bool:
    """Whether the report holds these checks and all of them passed."""
    found = report.filter(F.col("metric_name").isin(*metric_names)).select("metric_name", "status").collect()
    return {row.metric_name for row in found} == set(metric_names) and all(row.status == PASS for row in found)
