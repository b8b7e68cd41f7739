"""Metrics and monthly figures kept as one mergeable part per load, so that no report reads the history again.

* Amounts per customer: counts, sums, extremes, and the moments of the amounts (number, mean, sum of squared
  distances), which merge by the parallel formula for variances.
* Uses per customer and category, and the distinct merchants of a customer: sums and distinct pairs. Instead of the
  pairs, which grow with the merchants, a HyperLogLog sketch per customer can be kept; then the count is an estimate.
* Totals per month; the customers of a month as bitmaps over their dense keys, which merge by OR, and the ids of
  transactions whose customer was unknown when they were loaded.

Every merge gives parts of the same form, so parts can be folded at any time (``sources.loads``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, labels
from ledgerloom.plans.profile import METRIC_COLUMNS
from ledgerloom.plans.warehouse import MONTH
from ledgerloom.sources.loads import catch_up
from ledgerloom.sources.tables import WAREHOUSE, TableStore

AMOUNTS, CATEGORIES, MERCHANTS = "part_amounts", "part_categories", "part_merchants"
MERCHANT_SKETCHES = "part_merchant_sketches"
#: 2**12 registers, at most about 4 KB a customer, far less for few merchants; four standard errors of the estimate
SKETCH_LOG_SIZE = 12
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH_LOG_SIZE / 2)
MONTHS, MONTH_CUSTOMERS, MONTH_UNKNOWN = "part_months", "part_month_customers", "part_month_unknown"
SUMS = [
    "transactions", "rows", "total", "online", "weekend", "frauds", "fraud_amount", "hours", "hour_total", "high_values",
]


def _flagged(flag: str | Column) -> Column:
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)


# --- customers -------------------------------------------------------------------------------------------


def amounts_of(fact: DataFrame) -> DataFrame:
    """What one load adds to the amounts of its customers."""
    number = F.count("amount")
    return fact.groupBy("customer_id").agg(
        F.count("transaction_id").alias("transactions"),
        F.count("*").alias("rows"),
        F.sum("amount").alias("total"),
        F.max("amount").alias("highest"),
        F.min("amount").alias("lowest"),
        F.struct(
            number.alias("number"),
            F.coalesce(F.avg("amount"), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop("amount") * number, F.lit(0.0)).alias("squares"),
        ).alias("moments"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
        _flagged("is_online").alias("online"),
        _flagged("is_weekend").alias("weekend"),
        _flagged("is_fraud").alias("frauds"),
        F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(0.0)).alias("fraud_amount"),
        F.count("transaction_hour").alias("hours"),
        F.sum("transaction_hour").alias("hour_total"),
        _flagged(labels.exceeds(F.col("amount"), labels.HIGH_VALUE_AMOUNT)).alias("high_values"),
    )


def merged_moments(moments: Column) -> Column:
    """Number, mean and squared distances of all parts of a list; an empty part changes nothing."""
    nothing = F.struct(F.lit(0).cast("long").alias("number"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def merge(left: Column, right: Column) -> Column:
        number = left["number"] + right["number"]
        share = F.when(number > 0, right["number"] / number).otherwise(0.0)
        apart = right["mean"] - left["mean"]
        return F.struct(
            number.alias("number"),
            (left["mean"] + apart * share).alias("mean"),
            (left["squares"] + right["squares"] + apart * apart * left["number"] * share).alias("squares"),
        )

    return F.aggregate(F.sort_array(moments), nothing, merge)


def merge_amounts(parts: DataFrame) -> DataFrame:
    """One row per customer, of the same form as the parts. A list holds one entry per part, of which there are few."""
    sums = {name: F.sum(name).alias(name) for name in SUMS}
    merged = parts.groupBy("customer_id").agg(
        *sums.values(),
        F.max("highest").alias("highest"),
        F.min("lowest").alias("lowest"),
        F.collect_list("moments").alias("moments"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    return merged.withColumn("moments", merged_moments(F.col("moments"))).select(*parts.columns)


def categories_of(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id", "merchant_category").agg(F.count("*").alias("uses"))


def merge_categories(parts: DataFrame) -> DataFrame:
    return parts.groupBy("customer_id", "merchant_category").agg(F.sum("uses").alias("uses"))


def merchants_of(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("merchant_name").isNotNull()).select("customer_id", "merchant_name").distinct()


def merchant_sketches_of(fact: DataFrame) -> DataFrame:
    """Sketches are built on the map side, so a hot customer is one small row per task."""
    named = fact.filter(F.col("merchant_name").isNotNull())
    return named.groupBy("customer_id").agg(F.hll_sketch_agg("merchant_name", F.lit(SKETCH_LOG_SIZE)).alias("merchants"))


def merge_merchant_sketches(parts: DataFrame) -> DataFrame:
    return parts.groupBy("customer_id").agg(F.hll_union_agg("merchants").alias("merchants"))


def merchant_counts(merchants: DataFrame) -> DataFrame:
    """Distinct merchants per customer, from pairs exactly, from sketches as an estimate."""
    if "merchant_name" in merchants.columns:
        return merchants.distinct().groupBy("customer_id").agg(F.count("*").alias("unique_merchants"))
    estimate = F.hll_sketch_estimate("merchants").alias("unique_merchants")
    return merge_merchant_sketches(merchants).select("customer_id", estimate)


def metrics_from(amounts: DataFrame, categories: DataFrame, merchants: DataFrame, as_of: dates.AsOf = None) -> DataFrame:
    """The metrics of ``profile.transaction_metrics`` from parts; nothing here depends on the number of transactions.

    ``merchants`` are distinct pairs or sketches.
    """
    moments = F.col("moments")
    number = moments["number"]
    spread = F.when(number > 1, F.sqrt(moments["squares"] / F.when(number > 1, number - 1)))
    named = F.when(F.col("merchant_category").isNotNull(), F.struct(-F.col("uses"), "merchant_category"))
    favorite = merge_categories(categories).groupBy("customer_id").agg(
        F.min_by("merchant_category", named).alias("favorite_merchant_category"),
        F.count("merchant_category").alias("unique_merchant_categories"),
    )
    known = merge_amounts(amounts).join(favorite, "customer_id", "left")
    known = known.join(merchant_counts(merchants), "customer_id", "left")
    values = {
        "total_transactions": F.col("transactions"),
        "total_spent": F.col("total"),
        "avg_transaction_amount": F.col("total") / F.when(number > 0, number),
        "max_transaction_amount": F.col("highest"),
        "min_transaction_amount": F.col("lowest"),
        "transaction_amount_stddev": spread,
        "first_transaction_date": F.col("first_date"),
        "last_transaction_date": F.col("last_date"),
        "days_since_last_transaction": dates.days_between(dates.as_of_column(as_of), F.col("last_date")),
        "unique_merchants": F.coalesce("unique_merchants", F.lit(0)),
        "online_transaction_pct": F.col("online") / F.col("rows"),
        "weekend_transaction_pct": F.col("weekend") / F.col("rows"),
        "fraud_count": F.col("frauds"),
        "avg_transaction_hour": F.col("hour_total") / F.when(F.col("hours") > 0, F.col("hours")),
        "high_value_transaction_count": F.col("high_values"),
    }
    return known.select("customer_id", *[values.get(name, F.col(name)).alias(name) for name in METRIC_COLUMNS])


# --- months ----------------------------------------------------------------------------------------------


def months_of(fact: DataFrame) -> DataFrame:
    return fact.groupBy(MONTH).agg(
        F.count("*").alias("rows"), F.sum("amount").alias("total"), F.count("amount").alias("amounts"), _flagged("is_fraud").alias("frauds")
    )


def merge_months(parts: DataFrame) -> DataFrame:
    return parts.groupBy(MONTH).agg(*[F.sum(name).alias(name) for name in ("rows", "total", "amounts", "frauds")])


def bitmaps_of(keys: DataFrame) -> DataFrame:
    """Bitmaps of (month, customer_key): one row per month and 32,768 keys, however many transactions."""
    key = F.col("customer_key")
    bucket, place = F.bitmap_bucket_number(key), F.bitmap_bit_position(key)
    rows = keys.filter(key.isNotNull()).select(MONTH, bucket.alias("bucket"), place.alias("place"))
    return rows.groupBy(MONTH, "bucket").agg(F.bitmap_construct_agg("place").alias("customers"))


def merge_bitmaps(parts: DataFrame) -> DataFrame:
    return parts.groupBy(MONTH, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))


def unknown_of(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("customer_key").isNull()).select(MONTH, "customer_id").distinct()


def monthly_trends_from(
    months: DataFrame, customers: DataFrame, unknown: DataFrame, keys: DataFrame, fact: DataFrame, as_of: dates.AsOf, trailing: int
) -> DataFrame:
    """``products.monthly_trends`` from parts; only the month in which the period begins is read from ``fact``.

    ``keys`` (customer_id, customer_key) tell who of the unknown has become known since: the same customer may
    stand under an id in one load and under a key in a later one.
    """
    first_day = dates.months_before(dates.as_of_column(as_of), trailing)
    begin = dates.month_start(first_day)
    whole = F.when(first_day == begin, F.col(MONTH) >= begin).otherwise(F.col(MONTH) > begin)
    named = unknown.filter(whole).distinct().join(keys.select("customer_id", "customer_key"), "customer_id", "left")
    bitmaps = merge_bitmaps(customers.filter(whole).unionByName(bitmaps_of(named)))
    known = bitmaps.groupBy(MONTH).agg(F.sum(F.bitmap_count("customers")).alias("known"))
    others = named.filter(F.col("customer_key").isNull()).groupBy(MONTH).agg(F.count("*").alias("others"))
    rolled = merge_months(months.filter(whole)).join(known, MONTH, "left").join(others, MONTH, "left")
    rolled = rolled.withColumn("active", F.coalesce("known", F.lit(0)) + F.coalesce("others", F.lit(0)))

    edge = fact.filter((F.col(MONTH) == begin) & (F.col("transaction_date") >= first_day) & (first_day > begin))
    edge = edge.groupBy(MONTH).agg(
        F.count("*").alias("rows"), F.sum("amount").alias("total"), F.count("amount").alias("amounts"),
        _flagged("is_fraud").alias("frauds"), F.count_distinct("customer_id").alias("active"),
    )
    rows = rolled.select(*edge.columns).unionByName(edge)
    return rows.select(
        F.col(MONTH).alias("month"),
        F.col("rows").alias("transaction_count"),
        F.col("total").alias("total_volume"),
        (F.col("total") / F.when(F.col("amounts") > 0, F.col("amounts"))).alias("avg_transaction_amount"),
        F.col("active").alias("active_customers"),
        F.col("frauds").alias("fraud_count"),
    ).orderBy("month")


# --- stored parts ----------------------------------------------------------------------------------------

PARTS = {
    AMOUNTS: (amounts_of, merge_amounts),
    CATEGORIES: (categories_of, merge_categories),
    MERCHANTS: (merchants_of, DataFrame.distinct),
    MERCHANT_SKETCHES: (merchant_sketches_of, merge_merchant_sketches),
    MONTHS: (months_of, merge_months),
    MONTH_CUSTOMERS: (bitmaps_of, merge_bitmaps),
    MONTH_UNKNOWN: (unknown_of, DataFrame.distinct),
}


def keep_up(store: TableStore, loads: list[int], fact_load, most: int | None = None, sketched: bool = False) -> None:
    """Work out the parts that fact loads still lack. ``fact_load`` gives the rows a load has brought; merchants are
    kept as pairs, or ``sketched``."""
    left_out = MERCHANTS if sketched else MERCHANT_SKETCHES
    for table, (make, merge) in PARTS.items():
        if table == left_out:
            continue
        more = {} if most is None else {"most": most}
        catch_up(store, WAREHOUSE, table, loads, lambda load, make=make: make(fact_load(load)), merge, **more)


def stored_metrics(store: TableStore, as_of: dates.AsOf = None, sketched: bool = False) -> DataFrame:
    merchants = MERCHANT_SKETCHES if sketched else MERCHANTS
    return metrics_from(*[store.read(WAREHOUSE, table) for table in (AMOUNTS, CATEGORIES, merchants)], as_of)
