"""Five stages from raw documents to packed training sequences.

Every stage is one operator, works on all rows its predecessor kept, and is written as Parquet before the next
one reads it. All but the last return the columns of ``documents``:

1. toxicity: documents that score 0.5 or more go;
2. line dedup: boilerplate lines go from the texts (``n_chars`` follows where a text changed);
3. SimHash near-dedup: of every group the document with the smallest id stays;
4. mixing: documents are repeated or left out so that sources come near their target weights;
5. packing: every document that is left, a repeated one each time, is packed into sequences.

Every stage does what its operator's docstring says of odd rows. So a null text passes the first stage with the
score of an empty one, keeps its nulls, and is one group with all texts without words, of which the smallest id stays;
a null id is a document like others, but its label is never found and it comes last in its group; rows are one group; very long texts pass whole and are only cut by the packing; an empty table gives an empty
result; further columns of any name pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import line_dedup, mixing, packing, simhash, toxicity
from ledgerloom.llm.common import Scratch
from ledgerloom.llm.queries import table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.cleaned(docs)
    chars = F.when(F.col("removed_lines") > 0, F.length("row.text").cast("long")).otherwise(F.col("row.n_chars"))
    return rows.select(F.col("row").withField("n_chars", chars).alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Trees, tokenizers and SimHash have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; returns the packed pieces."""
    scratch = Scratch(spark)
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = scratch.store(stage(spark, rows, sf_dir), name.split()[0])
    return rows
