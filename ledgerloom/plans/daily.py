"""The daily run: CSV files to staging, warehouse, profile, history and run log.

Every stage reads stored tables and writes stored tables, so that a lost executor costs at most the stage it
was working on, and a run can be repeated: transactions already loaded are skipped, dimensions and profile
end up the same, and the run log keeps one row per day. Risk history and quality metrics are logs: every run
appends its own snapshot to them, a repeated day too; ``created_at`` tells the snapshots apart.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ledgerloom import schemas
from ledgerloom.functions import dates, labels
from ledgerloom.operators.hot_keys import HotKeyPolicy
from ledgerloom.operators.merge import new_rows, require_unique
from ledgerloom.plans import partials, products, profile, quality, running, scoring, staging, warehouse
from ledgerloom.sources.csv_files import MALFORMED, read_csv
from ledgerloom.sources.id_index import BUCKETS, IdIndex
from ledgerloom.sources.loads import FAN_IN, SMALL_BYTES, catch_up, merge_small, missing, newest
from ledgerloom.sources.tables import ANALYTICS, STAGING, WAREHOUSE, TableStore

RUN_NAME = "daily_risk_run"
FACT = "fact_transactions"
FACT_STORED = T.StructType([*schemas.FACT_TRANSACTIONS.fields, T.StructField(warehouse.MONTH, schemas.DAY)])
SUCCESS, FAILED = "SUCCESS", "FAILED"
OUT_OF_RANGE = staging.OUT_OF_RANGE
# Tables of which every run writes a new version.
REPLACED = [
    (STAGING, "customers"), (STAGING, "transactions"), (STAGING, "credit_scores"), (STAGING, "transactions_new"),
    (STAGING, "customer_profile"), (WAREHOUSE, "dim_customer"), (WAREHOUSE, "dim_credit"),
    (WAREHOUSE, running.STATE), (ANALYTICS, "customer_profile"), (ANALYTICS, "pipeline_runs"),
]
# Checks that show that every staged row has an id of its own.
UNIQUE_IDS = ["duplicate_customer_ids", "duplicate_transaction_ids", "null_customer_id", "null_transaction_id"]
# Columns without which a row cannot be stored; other required columns only cause a warning when empty.
NOT_NULL = {
    "customers": ["customer_id", "name", "email"],
    "transactions": ["transaction_id", "customer_id"],
    "credit_scores": ["customer_id"],
}
CLEANERS = {
    "customers": staging.clean_customers,
    "transactions": staging.clean_transactions,
    "credit_scores": staging.type_credit_scores,
}


@dataclass(frozen=True)
class Upkeep:
    """What a load keeps beside the rows, so that later loads and reports need not read the history.

    ``carry`` stores the running columns (``plans.running``), ``parts`` the parts metrics and trends are merged from
    (``plans.partials``), with ``sketched`` the merchants of a customer as a sketch, ``ids`` an index of the transaction ids in ``id_buckets`` buckets, a number that never
    changes. Parts and index catch up when they are switched on later, stored running columns do not.
    """

    carry: bool = False
    parts: bool = False
    ids: bool = False
    id_buckets: int = BUCKETS
    sketched: bool = False


@dataclass(frozen=True)
class Ingested:
    """What one file brought: rows read, rows written, and what was rejected on the way."""

    table: str
    figures: dict[str, int] = field(default_factory=dict)

    def report(self, spark) -> DataFrame:
        """The counts as report rows: empty keys and invalid scores fail. Rows left out as malformed, values that
        could not be read and other empty columns are a warning."""
        fatal = {OUT_OF_RANGE, *[f"null_{name}" for name in NOT_NULL[self.table]]}

        def row(name: str, count: int) -> tuple:
            if name in ("rows_read", "rows_written"):
                return self.table, name, float(count), None, quality.INFO
            broken = quality.FAIL if name in fatal else quality.WARN
            return self.table, name, float(count), 0.0, broken if count else quality.PASS

        return spark.createDataFrame([row(name, count) for name, count in self.figures.items()], schemas.QUALITY)


def ingest(
    store: TableStore,
    path: str,
    table: str,
    data_source: str | None = None,
    at: Column | None = None,
) -> Ingested:
    """Replace one staging table by a CSV file.

    One pass and one write: rows are split by verdict into the folders of good and of rejected ones, and all counts
    ride along. Rows with the wrong number of fields and scores out of range are rejected; single values that cannot
    be read become null in the good row, and the row is kept among the rejected too, with its record as delivered.
    """
    schema = staging.SCHEMAS[table]
    raw = staging.note_rejections(read_csv(store.spark, path, schema, table), schema)
    sound = ~F.col(MALFORMED)
    read = Observation(f"{table} read")
    counts = [F.count("*").alias("rows_read"), F.count_if(MALFORMED).alias("rows_malformed")]
    raw = raw.observe(read, *counts, *staging.unreadable_values(schema, sound))

    clean = CLEANERS[table](raw)
    typed = Observation(f"{table} typed")
    checks = [F.count_if(sound & F.col(name).isNull()).alias(f"null_{name}") for name in quality.REQUIRED[table]]
    if table == "credit_scores":
        checks.append(F.count_if(sound & ~labels.valid_credit_score(F.col("credit_score"))).alias(OUT_OF_RANGE))
    split = staging.split_by_verdict(clean.observe(typed, *checks), table)

    written = Observation(f"{table} written")
    audited = staging.add_audit(split, path, data_source, at)
    audited = audited.observe(written, F.count_if(F.col(staging.VERDICT) == staging.GOOD).alias("rows_written"))
    store.replace(STAGING, table, audited, [staging.VERDICT])
    figures = {**read.get, **typed.get, **written.get}
    if not figures["rows_read"]:
        store.replace(STAGING, table, audited)  # without folders, so that an empty table keeps its columns
    return Ingested(table, figures)


def staged(store: TableStore, table: str) -> DataFrame:
    """The rows of a staging table that go on."""
    return staging.good_rows(store.read(STAGING, table))


def rejected(store: TableStore) -> DataFrame:
    """What the last ingestion rejected or could not read in full, of all three tables."""
    tables = [staging.rejected_rows(store.read(STAGING, name), name) for name in CLEANERS if store.exists(STAGING, name)]
    return reduce(DataFrame.unionByName, tables)


def ingest_all(store: TableStore, data_dir: str, at: Column | None = None) -> list[Ingested]:
    """Replace the three staging tables by the files of a directory."""
    folder = data_dir.rstrip("/")
    return [
        ingest(store, f"{folder}/customers.csv", "customers", staging.DEFAULT_DATA_SOURCE, at),
        ingest(store, f"{folder}/transactions.csv", "transactions", at=at),
        ingest(store, f"{folder}/credit_scores.csv", "credit_scores", at=at),
    ]


def check_input(store: TableStore, ingested: list[Ingested]) -> DataFrame:
    """Quality report of the staged input, before anything reaches the warehouse.

    Counts that were taken while staging was written are not taken again.
    """
    tables = [staged(store, name) for name in CLEANERS]
    return quality.union_reports(quality.relation_checks(*tables), *[item.report(store.spark) for item in ingested])


def load_warehouse(
    store: TableStore,
    as_of: dates.AsOf = None,
    at: Column | None = None,
    known_unique: bool = False,
    upkeep: Upkeep = Upkeep(),
) -> None:
    """Bring dimensions and fact table up to date with staging.

    Every id must be staged, and once only. That is checked first, unless the caller has just done so: a row
    without an id matches no stored row and would be loaded again with every run.
    """
    people = staged(store, "customers")
    if not known_unique:
        require_unique(people, ["customer_id"])
        require_unique(staged(store, "transactions"), ["transaction_id"])
        require_unique(staged(store, "credit_scores"), ["customer_id"])
    incoming = warehouse.dim_customer(people, as_of, at)
    stored = store.read(WAREHOUSE, "dim_customer", schemas.DIM_CUSTOMER)
    customers = store.replace(
        WAREHOUSE, "dim_customer", warehouse.merge_dimension(stored, incoming, "customer_key")
    )
    load_fact(store, staged(store, "transactions"), customers, at, upkeep)

    scores = warehouse.dim_credit(staged(store, "credit_scores"), customers, at)
    credit = store.read(WAREHOUSE, "dim_credit", schemas.DIM_CREDIT)
    store.replace(WAREHOUSE, "dim_credit", warehouse.merge_dimension(credit, scores, "credit_key"))


def load_fact(
    store: TableStore, batch: DataFrame, customers: DataFrame, at: Column | None = None, upkeep: Upkeep = Upkeep()
) -> None:
    """Add those transactions of a stored batch that the fact table does not hold yet.

    Everything kept per load is caught up before and after: before, because a lost run may have left the last
    load without its part.
    """
    carry = upkeep.carry or store.exists(WAREHOUSE, running.ROWS)
    if carry and store.exists(WAREHOUSE, FACT):
        raise ValueError("running columns are stored from the first load of a store on, or not at all")
    keep_up(store, upkeep)
    fact, fresh = read_fact(store), batch
    if fact_loads(store):
        # stored, because telling new rows from known ones reads the ids of the whole history
        fresh = transaction_ids(store, upkeep.id_buckets).new_rows(batch) if upkeep.ids else new_rows(batch, fact, "transaction_id")
        fresh = store.replace(STAGING, "transactions_new", fresh)
    added = warehouse.with_month(warehouse.keyed_fact_rows(fresh, fact, customers, at))
    if carry:
        running.load(store, store.replace(STAGING, "fact_added", added))
    else:
        # rows of a month go to as few files as their size allows; adaptive execution splits a large month
        store.append(WAREHOUSE, FACT, added.hint("rebalance", warehouse.MONTH), [warehouse.MONTH])
    keep_up(store, upkeep)


def transaction_ids(store: TableStore, buckets: int = BUCKETS) -> IdIndex:
    return IdIndex(store, WAREHOUSE, "transaction_ids", "transaction_id", buckets)


def keep_up(store: TableStore, upkeep: Upkeep = Upkeep()) -> None:
    """Work out what is kept per fact load wherever it is missing."""
    loads = fact_loads(store)

    def counts_of(load: int) -> DataFrame:
        return fact_load(store, load).groupBy("customer_id").agg(F.count("*").alias("rows"))

    catch_up(store, WAREHOUSE, "fact_counts", loads, counts_of, _merged_counts)
    if upkeep.parts:
        partials.keep_up(store, loads, lambda load: fact_load(store, load), sketched=upkeep.sketched)
    if upkeep.ids:
        transaction_ids(store, upkeep.id_buckets).catch_up(loads, lambda load: fact_load(store, load).select("transaction_id"))


def merge_fact_loads(
    store: TableStore, upkeep: Upkeep = Upkeep(), fan_in: int = FAN_IN, small_bytes: int = SMALL_BYTES
) -> list[tuple[int, int]]:
    """Merge small neighbouring loads of the fact table, with or without stored running columns.

    What is kept per load is caught up first. A part that lags behind because ``upkeep`` names it no longer is refused:
    it could not be told afterwards which rows of a merged load it holds.
    """
    keep_up(store, upkeep)
    loads = fact_loads(store)
    kept = ["fact_counts", *partials.PARTS, "transaction_ids"]
    behind = [name for name in kept if store.exists(WAREHOUSE, name) and missing(store, WAREHOUSE, name, loads)]
    if behind:
        raise ValueError(f"not caught up with the fact table: {', '.join(behind)}")
    if store.exists(WAREHOUSE, running.ROWS):
        table, schema, upto = running.ROWS, schemas.FACT_RUNNING, running.committed(store)
    else:
        table, schema, upto = FACT, FACT_STORED, None
    return merge_small(store, WAREHOUSE, table, schema, [warehouse.MONTH], upto, fan_in, small_bytes)


def fact_loads(store: TableStore) -> list[int]:
    """Numbers of the committed loads of the fact table."""
    if store.exists(WAREHOUSE, running.ROWS):
        return [load for load in newest(store, WAREHOUSE, running.ROWS)[1] if load <= running.committed(store)]
    return newest(store, WAREHOUSE, FACT)[1]


def fact_load(store: TableStore, load: int) -> DataFrame:
    """Rows that one load has brought, with their month."""
    if store.exists(WAREHOUSE, running.ROWS):
        rows = store.read(WAREHOUSE, running.ROWS, schemas.FACT_RUNNING, only=[load])
        return rows.filter(~F.col("repeated")).select(*running.STORED)
    return store.read(WAREHOUSE, FACT, FACT_STORED, only=[load])


def read_fact(store: TableStore) -> DataFrame:
    """Stored fact rows with their month; empty before the first load."""
    if store.exists(WAREHOUSE, running.ROWS):
        return running.valid_rows(store).select(*running.STORED)
    return store.read(WAREHOUSE, FACT, FACT_STORED)


def read_counts(store: TableStore) -> DataFrame:
    """Fact rows per customer; empty before the first load."""
    return _merged_counts(store.read(WAREHOUSE, "fact_counts", schemas.FACT_COUNTS))


def _merged_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("customer_id").agg(F.sum("rows").alias("rows"))


def read_fact_with_history(
    store: TableStore, policy: HotKeyPolicy | None = None, customers: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """The fact table as users read it, running columns included; of some customers only, if they are named.

    ``customers`` are ids or a table with a ``customer_id``. They limit every scan of the fact table, which a
    filter on the result would not. Very large customers are known from the stored counts. A store that keeps its
    running columns needs no window.
    """
    if store.exists(WAREHOUSE, running.ROWS):
        return running.read(store, customers)
    fact, counts = read_fact(store), read_counts(store)
    if isinstance(customers, DataFrame):
        ids = customers.select("customer_id").distinct()
        fact, counts = (rows.join(ids, "customer_id", "left_semi") for rows in (fact, counts))
    elif customers is not None:
        fact, counts = (rows.filter(F.col("customer_id").isin(*customers)) for rows in (fact, counts))
    return warehouse.with_running_columns(fact, policy, counts)


def score_customers(
    store: TableStore, as_of: dates.AsOf = None, at: Column | None = None, ml_scaling: bool = True, upkeep: Upkeep = Upkeep()
) -> DataFrame:
    """Replace the customer profile, and append its scores to the risk history.

    With parts kept per load the metrics are merged from them, and the fact table is not read.
    """
    if upkeep.parts:
        metrics = partials.stored_metrics(store, as_of)
    else:
        metrics = profile.transaction_metrics(read_fact(store), as_of)
    wide = profile.customer_profile(
        store.read(WAREHOUSE, "dim_customer"), store.read(WAREHOUSE, "dim_credit"), metrics
    )
    # written once and read back: scaling needs the statistics of all rows before the first row can be scored
    unscored = store.replace(STAGING, "customer_profile", wide)
    scored = store.replace(ANALYTICS, "customer_profile", scoring.score_profile(unscored, at, ml_scaling), find_by="customer_id")
    append_history(store, scoring.risk_snapshot(scored, as_of, at))
    return scored


def monthly_trends(store: TableStore, as_of: dates.AsOf = None, months: int = products.TREND_MONTHS) -> DataFrame:
    """``products.monthly_trends`` of a store that keeps parts per load."""
    parts = [store.read(WAREHOUSE, name) for name in (partials.MONTHS, partials.MONTH_CUSTOMERS, partials.MONTH_UNKNOWN)]
    keys = store.read(WAREHOUSE, "dim_customer", schemas.DIM_CUSTOMER)
    return partials.monthly_trends_from(*parts, keys, read_fact(store), as_of, months)


def append_history(store: TableStore, rows: DataFrame) -> DataFrame:
    return store.append(ANALYTICS, "customer_risk_history", rows, ["assessment_date"])


def rescore_customers(store: TableStore, chosen: DataFrame, as_of: dates.AsOf = None, at: Column | None = None) -> DataFrame:
    """Rescore chosen customers by points: patch the stored profile and append to the history."""
    before = store.read(ANALYTICS, "customer_profile")
    result = scoring.rescore(before, chosen, as_of, at)
    after = store.replace(ANALYTICS, "customer_profile", result.profile, find_by="customer_id")
    append_history(store, result.history)
    return after


def check_load(store: TableStore) -> DataFrame:
    """Row counts of all tables, name consistency and the tracked percentages after a load."""
    customers, transactions, credit = (staged(store, name) for name in CLEANERS)
    scored = store.read(ANALYTICS, "customer_profile")
    tables = {
        "staging.customers": customers,
        "staging.transactions": transactions,
        "staging.credit_scores": credit,
        "warehouse.dim_customer": store.read(WAREHOUSE, "dim_customer"),
        "warehouse.fact_transactions": read_fact(store),
        "warehouse.dim_credit": store.read(WAREHOUSE, "dim_credit"),
        "analytics.customer_profile": scored,
    }
    return quality.union_reports(
        quality.load_checks(tables, scored), quality.metrics(customers, transactions, credit, scored)
    )


def record_run(
    store: TableStore,
    run_date: dt.date,
    status: str,
    records: int | None,
    seconds: float,
    error: str | None = None,
    name: str = RUN_NAME,
) -> DataFrame:
    """Put one row per day and run name into the run log."""
    row = store.spark.range(1).select(
        F.lit(str(run_date)).alias("run_date"),
        F.lit(name).alias("pipeline_name"),
        F.lit(status).alias("status"),
        F.lit(records).alias("records_processed"),
        F.round(F.lit(float(seconds)), 2).alias("run_duration"),
        F.lit(error).alias("error_message"),
        F.current_timestamp().alias("created_at"),
    )
    updates = schemas.conform(row, schemas.PIPELINE_RUNS)
    return store.upsert(ANALYTICS, "pipeline_runs", updates, ["run_date", "pipeline_name"])


def run_daily(
    store: TableStore,
    data_dir: str,
    as_of: dt.date | None = None,
    stop_on: Sequence[str] = (quality.FAIL,),
    tolerate: Sequence[str] = (),
    ml_scaling: bool = True,
    keep_versions: int | None = None,
    upkeep: Upkeep = Upkeep(),
) -> DataFrame:
    """The whole chain for one day; returns the risk distribution of the new profile.

    Staging is replaced before the checks run, so that the CSV files are read once and the checks scan
    columns; nothing reaches the warehouse when a check fails. Checks named in ``tolerate`` are reported only:
    for instance scores out of range, whose rows are left out of staging. Reports are stored. With
    ``keep_versions`` older versions of the replaced tables are deleted after a successful run. A second run on the
    same store is refused while one is under way.
    """
    with store.claim("daily_run"):
        return _run_daily(store, data_dir, as_of or dt.date.today(), stop_on, tolerate, ml_scaling, keep_versions, upkeep)


def _run_daily(
    store: TableStore,
    data_dir: str,
    as_of: dt.date,
    stop_on: Sequence[str],
    tolerate: Sequence[str],
    ml_scaling: bool,
    keep_versions: int | None,
    upkeep: Upkeep,
) -> DataFrame:
    started = time.monotonic()
    try:
        ingested = ingest_all(store, data_dir)
        before = save_report(store, check_input(store, ingested), as_of)
        quality.raise_on_fail(before, stop_on, tolerate)
        load_warehouse(store, as_of, known_unique=quality.all_pass(before, UNIQUE_IDS), upkeep=upkeep)
        scored = score_customers(store, as_of, ml_scaling=ml_scaling, upkeep=upkeep)
        save_report(store, check_load(store), as_of)
        save_rules(store)
        records = scored.count()
    except Exception as error:
        record_run(store, as_of, FAILED, None, time.monotonic() - started, str(error))
        raise
    record_run(store, as_of, SUCCESS, records, time.monotonic() - started)
    # the day is loaded whatever happens to the old versions
    for layer, table in REPLACED if keep_versions else []:
        store.expire(layer, table, keep_versions)
    return products.risk_distribution(scored)


def save_report(store: TableStore, report: DataFrame, as_of: dates.AsOf) -> DataFrame:
    """Append a quality report, and return the stored rows of this report only."""
    dated = report.withColumn("check_date", dates.as_of_column(as_of)).coalesce(1)
    taken = store.spark.createDataFrame(dated.collect(), dated.schema)  # a few dozen rows
    store.append(ANALYTICS, "data_quality_metrics", taken)
    return taken


def save_rules(store: TableStore) -> None:
    """Store the seeded scoring rules once."""
    if not store.exists(ANALYTICS, "risk_scoring_rules"):
        store.replace(ANALYTICS, "risk_scoring_rules", scoring.scoring_rules(store.spark))
