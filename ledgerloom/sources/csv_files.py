"""CSV input with a header."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MALFORMED, RECORD = "_malformed", "_record"


class MissingInput(FileNotFoundError):
    """The input path does not exist."""


class MissingColumns(ValueError):
    """The input lacks columns the table needs."""


def require_columns(columns: list[str], schema: T.StructType, table: str) -> None:
    missing = [name for name in schema.fieldNames() if name not in columns]
    if missing:
        raise MissingColumns(f"{table} lacks the columns {', '.join(missing)}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, table: str) -> DataFrame:
    """All columns of ``schema`` as text, found by header name, plus the flag ``_malformed`` and the text of a
    malformed line as ``_record``.

    The files of a folder must agree in their header: Spark compares each file's with the first one's and stops
    with an error naming the file when columns are missing, added or in another order.

    Nothing is inferred: inference would read the file twice and turn zip codes into numbers. A row with too
    many or too few fields is flagged and not dropped here, so that the rows can be counted; values are given
    their types by the staging plan.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    try:
        header = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"no input for {table}: {path}") from error
        raise
    require_columns(header, schema, table)

    as_text = T.StructType([T.StructField(name, T.StringType()) for name in [*header, "_corrupt_record"]])
    rows = (
        reader.schema(as_text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("columnPruning", False)  # a pruned row is never found to be malformed
        .option("enforceSchema", False)  # compare the header of every file
        .csv(path)
    )
    broken = F.col("_corrupt_record")
    return rows.select(*schema.fieldNames(), broken.isNotNull().alias(MALFORMED), broken.alias(RECORD))
