"""A fact table whose running columns are stored, and continued by every load.

Beside the rows one small table keeps what a load must know of every customer: number of rows, total, number of
amounts, and the last transaction. A load whose rows all follow those stored works out its own columns from the
batch and that state; no old row is read. A customer with a late row - one that belongs before a stored one - is
worked out anew: only that customer's rows are read, and written again under the next epoch. Rows of an earlier
epoch than the state's are no longer valid and are left out on reading. The distance from the average depends on
later rows too, so it is never stored but follows from the state.

The state commits the load. Rows are written as load number n first, then the state as version n; readers take the
state's version and no later load. A job lost between the two leaves rows nobody reads, which the next run
overwrites.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import schemas
from ledgerloom.operators.history import AMOUNT, CUSTOMER, add_history, sum_of_known
from ledgerloom.operators.hot_keys import HotKeyPolicy
from ledgerloom.plans.warehouse import FACT_COLUMNS, MONTH
from ledgerloom.sources.tables import STAGING, WAREHOUSE, TableStore

ROWS, STATE = "fact_running", "customer_state"
TIME, UNIQUE = "transaction_timestamp", "transaction_id"
STORED = [*schemas.FACT_TRANSACTIONS.fieldNames(), MONTH]


def _moment() -> Column:
    return F.struct(F.col(TIME).alias("last_moment"), F.col(UNIQUE).alias("last_transaction"))


def read_state(store: TableStore) -> DataFrame:
    return store.read(WAREHOUSE, STATE, schemas.CUSTOMER_STATE)


def committed(store: TableStore) -> int:
    """Number of the last load that counts, 0 before the first."""
    versions = store.versions(WAREHOUSE, STATE)
    return versions[-1] if versions else 0


def valid_rows(store: TableStore) -> DataFrame:
    """Every transaction once, in its latest epoch, with the stored running columns."""
    rows = store.read(WAREHOUSE, ROWS, schemas.FACT_RUNNING, upto=committed(store))
    redone = read_state(store).filter("epoch > 0").select(F.col(CUSTOMER).alias("_redone"), F.col("epoch").alias("_now"))
    return rows.join(redone, (F.col(CUSTOMER) == F.col("_redone")) & (F.col("epoch") < F.col("_now")), "left_anti")


def late_customers(fresh: DataFrame, state: DataFrame) -> DataFrame:
    """Customers of whom a fresh row belongs before the last stored one; a row without a time comes first."""
    earliest = fresh.groupBy(CUSTOMER).agg(F.min(_moment()).alias("_earliest"))
    last = F.struct("last_moment", "last_transaction")
    return earliest.join(state, CUSTOMER).filter(F.col("_earliest") < last).select(CUSTOMER)


def continued(fresh: DataFrame, state: DataFrame, policy: HotKeyPolicy | None = None) -> DataFrame:
    """Running columns of rows that all follow the stored ones, carried on from the state."""
    before = state.select(
        CUSTOMER, F.col("rows").alias("_rows"), F.col("total").alias("_total"), F.col("last_moment").alias("_last"), F.col("epoch").alias("_epoch")
    )
    local = add_history(fresh, before, time=TIME, unique=UNIQUE, policy=policy)
    first = (F.col("transaction_sequence") == 1) & F.col("_rows").isNotNull()
    days = F.when(first, F.datediff(F.col(TIME), F.col("_last"))).otherwise(F.col("days_since_last_transaction"))
    return local.select(
        *STORED,
        (F.col("transaction_sequence") + F.coalesce("_rows", F.lit(0))).alias("transaction_sequence"),
        sum_of_known(F.col("_total"), F.col("running_total")).alias("running_total"),
        days.alias("days_since_last_transaction"),
        F.coalesce("_epoch", F.lit(0)).alias("epoch"),
        F.lit(False).alias("repeated"),
    )


def redone(old: DataFrame, fresh: DataFrame, state: DataFrame, policy: HotKeyPolicy | None = None) -> DataFrame:
    """All rows of customers with a late row, worked out anew under their next epoch."""
    every = old.select(*STORED).withColumn("repeated", F.lit(True)).unionByName(
        fresh.select(*STORED).withColumn("repeated", F.lit(False))
    )
    epochs = state.select(CUSTOMER, (F.col("epoch") + 1).alias("epoch"))
    rows = add_history(every, epochs, time=TIME, unique=UNIQUE, policy=policy)
    return rows.select(*STORED, *schemas.RUNNING.fieldNames())


def next_state(state: DataFrame, fresh: DataFrame, late: DataFrame) -> DataFrame:
    """The state after a load: counts and totals add up, late rows or not."""
    batch = fresh.groupBy(CUSTOMER).agg(
        F.count("*").alias("_rows"), F.sum(AMOUNT).alias("_total"), F.count(AMOUNT).alias("_amounts"), F.max(_moment()).alias("_last")
    )
    late = late.withColumn("_late", F.lit(1))
    last = F.greatest(F.when(F.col("rows").isNotNull(), F.struct("last_moment", "last_transaction")), F.col("_last"))
    return state.join(batch.join(late, CUSTOMER, "left"), CUSTOMER, "full").select(
        CUSTOMER,
        (F.coalesce("rows", F.lit(0)) + F.coalesce("_rows", F.lit(0))).alias("rows"),
        sum_of_known(F.col("total"), F.col("_total")).alias("total"),
        (F.coalesce("amounts", F.lit(0)) + F.coalesce("_amounts", F.lit(0))).alias("amounts"),
        last["last_moment"].alias("last_moment"),
        last["last_transaction"].alias("last_transaction"),
        (F.coalesce("epoch", F.lit(0)) + F.coalesce("_late", F.lit(0))).cast("int").alias("epoch"),
    )


def load(store: TableStore, fresh: DataFrame, policy: HotKeyPolicy | None = None) -> int:
    """Add fact rows not stored yet (with their month), and return the number of the load.

    ``fresh`` is read several times: give it a stored table.
    """
    number, state = committed(store) + 1, read_state(store)
    late = store.replace(STAGING, "late_customers", late_customers(fresh, state))
    if late.isEmpty():
        rows = continued(fresh, state, policy)
    else:
        old = valid_rows(store).join(late, CUSTOMER, "left_semi")
        rows = continued(fresh.join(late, CUSTOMER, "left_anti"), state, policy).unionByName(
            redone(old, fresh.join(late, CUSTOMER, "left_semi"), state, policy)
        )
    store.append(WAREHOUSE, ROWS, rows.hint("rebalance", MONTH), [MONTH], load=number)
    store.replace(WAREHOUSE, STATE, next_state(state, fresh, late))
    return number


def read(store: TableStore, customers: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The fact table as users read it. No window runs; the average comes with the state, one row per customer."""
    rows, state = valid_rows(store), read_state(store)
    if isinstance(customers, DataFrame):
        ids = customers.select(CUSTOMER).distinct()
        rows, state = (side.join(ids, CUSTOMER, "left_semi") for side in (rows, state))
    elif customers is not None:
        rows, state = (side.filter(F.col(CUSTOMER).isin(*customers)) for side in (rows, state))
    average = state.select(CUSTOMER, (F.col("total") / F.when(F.col("amounts") > 0, F.col("amounts"))).alias("_average"))
    known = rows.join(average, CUSTOMER, "left").withColumn("amount_vs_avg", F.col(AMOUNT) - F.col("_average"))
    return known.select("transaction_key", *FACT_COLUMNS)


def compact(store: TableStore) -> int | None:
    """Write the valid rows as one load of a new version; earlier epochs are gone. None when there is nothing to do.

    Parts of the table that are kept per load must have been caught up before. A compaction that is lost half way
    changes nothing.
    """
    number = committed(store)
    if len([load for load in store.loads(WAREHOUSE, ROWS) if load[0] == store.versions(WAREHOUSE, ROWS)[-1]]) < 2:
        return None
    rows = valid_rows(store).withColumn("repeated", F.lit(True))
    store.replace(WAREHOUSE, ROWS, rows.hint("rebalance", MONTH), [MONTH], load=number)
    return number
