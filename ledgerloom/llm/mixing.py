"""Mixing sources to target weights: whole copies by rate plus one hash-seeded copy for the fraction.

Sizes are summed per source, each source gets a target, and target / size is the repetition rate of its
documents: floor(rate) copies each, and one more where a hash of the document falls below the fraction.
Everything is built-in expressions; the documents are read twice, once for the sums.

* null text has size 0; an empty source has target 0 and keeps none of its documents;
* a null source is a source of its own, the last one;
* the draw depends on the seed and ``doc_id`` (a null id: on the text) alone, so reruns and partitioning
  agree, and repeated rows of one document are drawn alike;
* an empty table gives an empty result; other columns of any name pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20
DRAWN_BITS = 52  # 13 hex digits, exact in a double


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, cycle: Sequence[int] = CYCLE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Target of every row of ``sizes`` (source, source_size; one row per source).

    Sources in code-point order take the weights of ``cycle`` in turn and share the whole size. No target goes
    beyond ``max_repeats`` times its source; what is cut off goes to the others by weight. Ordered by the
    size a unit of weight can take, the sources that stop come first, so one running sum finds them. The
    windows run over one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(int(weight)) for weight in cycle])
    rows = sizes.select(
        "source",
        "source_size",
        F.get(weights, place % len(cycle)).alias("weight"),
        (F.col("source_size") * max_repeats).alias("most"),
    )
    by_room = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    stopped = F.coalesce(F.sum("most").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select(
        "*",
        F.row_number().over(by_room).alias("place"),
        (F.sum("source_size").over(everything) - stopped).alias("left"),
        F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)).alias("weight_left"),
    )
    shares = F.col("left") / F.col("weight_left") <= F.col("most") / F.col("weight")
    first = F.min(F.when(shares, F.struct("place", "left", "weight_left"))).over(everything)
    rows = rows.withColumn("first", first)
    target = F.when(
        F.col("place") < F.col("first.place"), F.col("most").cast("double")
    ).otherwise(F.col("weight") * F.col("first.left") / F.col("first.weight_left"))
    return rows.select("source", "source_size", F.least(target, F.col("most").cast("double")).alias("target"))


def _draw(key: Column, seed: int) -> Column:
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key)), 1, DRAWN_BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / float(1 << DRAWN_BITS)


def plan(
    docs: DataFrame,
    cycle: Sequence[int] = CYCLE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    *,
    carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target and the number of ``copies``.

    With ``carry`` the whole row follows as struct ``row``. The rates are stored, one row per source, so that
    Spark knows their size and sends them to the documents where they are small; beyond that it joins by
    source and splits a hot one.
    """
    scratch = Scratch(docs.sparkSession)
    whole = [F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")] if carry else []
    key = F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"], F.lit(""))))
    rows = docs.select(
        docs["doc_id"], docs["source"], word_count(docs["text"]).alias("size"), _draw(key, seed).alias("drawn"), *whole
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = scratch.store(targets(sizes, cycle, max_repeats).withColumnRenamed("source", "of"), "rates")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    copies = F.floor(rate) + (F.col("drawn") < rate - F.floor(rate)).cast("long")
    return rows.join(rates, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "size", "source", "source_size", "target", copies.alias("copies"), *[name for name in ["row"] if carry]
    )


def mix(
    docs: DataFrame, cycle: Sequence[int] = CYCLE, max_repeats: int = MAX_REPEATS, seed: int = SEED
) -> DataFrame:
    """The mixed documents: every row as often as the plan says, with the columns of ``docs``."""
    rows = plan(docs, cycle, max_repeats, seed, carry=True).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
