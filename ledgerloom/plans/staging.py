"""Raw input to clean staging tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom import schemas
from ledgerloom.functions import labels
from ledgerloom.sources.csv_files import MALFORMED, RECORD

REASONS, VERDICT = "_reasons", "verdict"
GOOD, REJECTED = "good", "rejected"
OUT_OF_RANGE = "scores_out_of_range"
TRIMMED = {
    "customers": ["name", "address", "city", "state", "email", "job_title"],
    "transactions": ["merchant_name", "location_city", "location_state"],
    "credit_scores": [],
}
SCHEMAS = {
    "customers": schemas.CUSTOMERS,
    "transactions": schemas.TRANSACTIONS,
    "credit_scores": schemas.CREDIT_SCORES,
}
# Fixed value: the name recorded for the origin of customer rows.
DEFAULT_DATA_SOURCE = "synthetic_generator"


def _clean(raw: DataFrame, table: str, changed: Mapping[str, Column]) -> DataFrame:
    values = {name: F.trim(F.col(name)) for name in TRIMMED[table]} | dict(changed)
    tidy = raw.withColumns(values) if values else raw
    marks = [F.col(name) for name in raw.columns if name.startswith("_")]  # what was noted about a row stays with it
    return tidy.select(*schemas.conformed(SCHEMAS[table]), *marks)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Trimmed text, lower-case e-mail, dates and income with their types; a value that cannot be read is null."""
    return _clean(raw, "customers", {"email": F.lower(F.trim("email"))})


def clean_transactions(raw: DataFrame) -> DataFrame:
    return _clean(raw, "transactions", {})


def type_credit_scores(raw: DataFrame) -> DataFrame:
    """Credit rows with their types, scores outside the scale still included."""
    return _clean(raw, "credit_scores", {})


def keep_valid_scores(credit: DataFrame) -> DataFrame:
    """Rows whose score lies on the scale or is unknown."""
    return credit.filter(F.coalesce(labels.valid_credit_score(F.col("credit_score")), F.lit(True)))


def clean_credit_scores(raw: DataFrame) -> DataFrame:
    return keep_valid_scores(type_credit_scores(raw))


def add_audit(rows: DataFrame, source_file: str, data_source: str | None = None, at: Column | None = None) -> DataFrame:
    """When and from where the rows came."""
    audit = {"ingestion_timestamp": F.current_timestamp() if at is None else at, "source_file": F.lit(source_file)}
    if data_source is not None:
        audit["data_source"] = F.lit(data_source)
    return rows.withColumns(audit)


def _unreadable(schema: T.StructType) -> dict[str, Column]:
    """Per typed column whether the text of a raw row cannot be read."""
    return {
        field.name: F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()
        for field in schema
        if field.dataType != T.StringType()
    }


def unreadable_values(schema: T.StructType, of: Column) -> list[Column]:
    """Per typed column the number of texts that could not be read, as aggregates over the raw rows for which ``of`` holds."""
    return [F.count_if(of & test).alias(f"unreadable_{name}") for name, test in _unreadable(schema).items()]


def note_rejections(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw rows with the reasons against them, and the record of those that have any.

    The record is the line as delivered where it is malformed, else its fields written as CSV again.
    """
    tests = [F.when(test, F.lit(f"unreadable_{name}")) for name, test in _unreadable(schema).items()]
    found = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    reasons = F.when(F.col(MALFORMED), F.array(F.lit("malformed"))).otherwise(found)
    line = F.coalesce(RECORD, F.to_csv(F.struct(*schema.fieldNames())))
    return raw.withColumn(REASONS, reasons).withColumn(RECORD, line)


def split_by_verdict(typed: DataFrame, table: str) -> DataFrame:
    """A row goes on as good, is kept as rejected, or both: a value that cannot be read is null in the good row.

    Malformed rows and scores outside the scale are rejected only.
    """
    reasons = F.col(REASONS)
    sound = ~F.col(MALFORMED)
    if table == "credit_scores":
        valid = F.coalesce(labels.valid_credit_score(F.col("credit_score")), F.lit(True))
        off_scale = F.when(sound & ~valid, F.array(F.lit(OUT_OF_RANGE))).otherwise(F.array().cast("array<string>"))
        reasons, sound = F.concat(reasons, off_scale), sound & valid
    verdicts = F.array_compact(F.array(F.when(sound, F.lit(GOOD)), F.when(F.size(reasons) > 0, F.lit(REJECTED))))
    rows = typed.withColumn(REASONS, reasons).withColumn(VERDICT, F.explode(verdicts))
    rejected = F.col(VERDICT) == REJECTED
    return rows.withColumns({name: F.when(rejected, F.col(name)) for name in (REASONS, RECORD)}).drop(MALFORMED)


def good_rows(staged: DataFrame) -> DataFrame:
    """Staged rows that go on; reads their folder only."""
    return staged.filter(F.col(VERDICT) == GOOD).drop(VERDICT, REASONS, RECORD) if VERDICT in staged.columns else staged


def rejected_rows(staged: DataFrame, table: str) -> DataFrame:
    """Rows with something against them: their id as far as it could be read, the reasons, the record and its file."""
    rows = staged.filter(F.col(VERDICT) == REJECTED)
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col(SCHEMAS[table].fieldNames()[0]).alias("record_id"),
        F.col(REASONS).alias("reasons"),
        F.col(RECORD).alias("record"),
        "source_file",
        "ingestion_timestamp",
    )
