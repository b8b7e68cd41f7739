"""Running columns over each customer's transactions.

Four columns per transaction: its number in the customer's history, the total so far, the days since the one
before and the distance from the customer's average amount. Ties in time are broken by transaction id.

Applied to the whole history the columns continue over all loads, with late rows in their right place;
applied to one batch they start again with the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.hot_keys import SLICE, HotKeyPolicy, Slicing, find_hot_keys

CUSTOMER = "customer_id"
AMOUNT = "amount"
HISTORY_COLUMNS = ["transaction_sequence", "running_total", "days_since_last_transaction", "amount_vs_avg"]


def add_history(
    transactions: DataFrame,
    keys: DataFrame | None = None,
    *,
    time: str = "timestamp",
    unique: str = "transaction_id",
    policy: HotKeyPolicy | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Append the running columns and, when ``keys`` (customer_id, customer_key) are given, the customer key.

    The windows and the join need the rows by customer, so all of it shares one shuffle of the transactions.
    Transactions of unknown customers stay, with a null key. ``counts`` (customer_id, rows) spare the count that
    looks for very large customers.
    """
    columns = [*transactions.columns, *HISTORY_COLUMNS]
    if keys is not None:
        columns += [name for name in keys.columns if name != CUSTOMER]
    slicing = find_hot_keys(transactions, CUSTOMER, [time, unique], policy, counts)
    if slicing is None:
        enriched = _running_columns(transactions, [CUSTOMER], time, unique)
        return (enriched if keys is None else enriched.join(keys, CUSTOMER, "left")).select(*columns)

    carry = _carry_between_slices(transactions, slicing, time)
    sliced = slicing.add_slice(transactions)
    local = _running_columns(sliced, [CUSTOMER, SLICE], time, unique)
    enriched = _continue_slices(local, F.broadcast(carry), transactions.columns, time)
    if keys is not None:
        slices = carry.groupBy(CUSTOMER).agg(F.collect_set(SLICE).alias("_slices"))
        enriched = enriched.join(_keys_per_slice(keys, F.broadcast(slices)), [CUSTOMER, SLICE], "left")
    return enriched.select(*columns)


def _running_columns(rows: DataFrame, group: list[str], time: str, unique: str) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(time, unique)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    return rows.withColumns(
        {
            "transaction_sequence": F.row_number().over(ordered).cast("long"),
            "running_total": F.sum(AMOUNT).over(so_far),
            "days_since_last_transaction": F.datediff(F.col(time), F.lag(time).over(ordered)),
            "amount_vs_avg": F.col(AMOUNT) - F.avg(AMOUNT).over(whole),
        }
    )


def _carry_between_slices(transactions: DataFrame, slicing: Slicing, time: str) -> DataFrame:
    """One row per slice of a hot customer: what happened before the slice, and the customer's average."""
    per_slice = (
        slicing.add_slice(slicing.hot_rows(transactions.select(CUSTOMER, AMOUNT, *slicing.order)))
        .groupBy(CUSTOMER, SLICE)
        .agg(
            F.count("*").alias("_rows"),
            F.sum(AMOUNT).alias("_total"),
            F.count(AMOUNT).alias("_amounts"),
            F.max(time).alias("_last"),
        )
    )
    by_slice = Window.partitionBy(CUSTOMER).orderBy(SLICE)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(CUSTOMER)
    return per_slice.select(
        CUSTOMER,
        SLICE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_total").over(before).alias("_total_before"),
        F.lag("_last").over(by_slice).alias("_last_before"),
        (F.sum("_total").over(everything) / F.sum("_amounts").over(everything)).alias("_average"),
    )


def sum_of_known(left: Column, right: Column) -> Column:
    """Sum that skips nulls, as SQL sums do."""
    return F.coalesce(left + right, left, right)


def _continue_slices(local: DataFrame, carry: DataFrame, columns: list[str], time: str) -> DataFrame:
    carry = carry.withColumnsRenamed({CUSTOMER: "_carry_customer", SLICE: "_carry_slice"})
    same_slice = F.col(CUSTOMER).eqNullSafe(F.col("_carry_customer")) & (F.col(SLICE) == F.col("_carry_slice"))
    first_in_slice = F.col("transaction_sequence") == 1
    is_hot = F.col("_carry_slice").isNotNull()
    return local.join(carry, same_slice, "left").select(
        *columns,
        SLICE,
        (F.col("transaction_sequence") + F.coalesce("_rows_before", F.lit(0))).alias("transaction_sequence"),
        sum_of_known(F.col("_total_before"), F.col("running_total")).alias("running_total"),
        F.when(first_in_slice & is_hot, F.datediff(F.col(time), F.col("_last_before")))
        .otherwise(F.col("days_since_last_transaction"))
        .alias("days_since_last_transaction"),
        F.when(is_hot, F.col(AMOUNT) - F.col("_average")).otherwise(F.col("amount_vs_avg")).alias("amount_vs_avg"),
    )


def _keys_per_slice(keys: DataFrame, slices: DataFrame) -> DataFrame:
    """Customer keys repeated for every slice, so that the join spreads a hot customer like the windows do."""
    every_slice = F.explode(F.coalesce("_slices", F.array(F.lit(0))))
    return keys.join(slices, CUSTOMER, "left").withColumn(SLICE, every_slice).drop("_slices")
