"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate and go.

A line is known by two 64-bit hashes. Lines that occur often enough get a HyperLogLog sketch of their sites,
merged by aggregation; where the estimate is near the threshold the distinct sites are counted exactly.
Lines on ``MIN_SITES`` sites or more are removed from every document, however short they are and however much of it
they make up.

A document copied to many sites is no boilerplate; it is for the document operators to judge. With ``every_copy`` each
copy speaks for its own site, and only lines that stand in one text and its copies alone are spared. Without, equal
texts speak for one site together, the first by code point: then a line in several copied texts can count fewer sites
than it stands on.

* lines are compared without blanks around them; empty lines are not looked at and stay;
* a null site counts as one site; null text stays null, empty texts stay as they are; a text all
  of whose lines are spread becomes empty;
* the decision depends on the text alone, so repeated rows and null or repeated ids are treated alike;
* very long texts are cut into lines row by row; an empty table gives an empty result; other columns of any
  name pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import Scratch

MIN_SITES = 8
LG_SKETCH = 12  # 4,096 registers: a standard error of 1.6 %
NEAR = 0.1


def _hashes(text: Column, name: str) -> list[Column]:
    return [F.xxhash64(text).alias(f"{name}_a"), F.xxhash64(text, F.lit(name)).alias(f"{name}_b")]


def lines_of(docs: DataFrame, site: str) -> DataFrame:
    """(text_a, text_b, site, place, line_a, line_b): every line that is not empty, by hash, once per text and site."""
    named = F.coalesce(F.concat(F.lit("="), docs[site].cast("string")), F.lit("null")).alias("site")
    lines = docs.where(docs["text"].isNotNull()).select(
        *_hashes(docs["text"], "text"), named, F.posexplode(F.split(docs["text"], "\n")).alias("place", "line")
    )
    line = F.trim("line", F.lit(" \t\r"))
    return lines.where(line != "").select("text_a", "text_b", "site", "place", *_hashes(line, "line"))


def spread_lines(scratch: Scratch, lines: DataFrame, min_sites: int, every_copy: bool) -> tuple[DataFrame, DataFrame]:
    """Places of the lines that occur ``min_sites`` times or more, and the hashes of those on so many sites."""
    key = ["line_a", "line_b"]
    often = lines.groupBy(*key).agg(F.count("*").alias("times")).where(F.col("times") >= min_sites)
    often = scratch.store(often.select(*key), "often")
    places = scratch.store(lines.join(often, key, "left_semi").distinct(), "places")  # copies on one site once
    text = F.struct("text_a", "text_b")
    voices = places
    if not every_copy:
        first = F.min("site").alias("site")  # null only where all are: "=" comes before "null"
        voices = scratch.store(places.groupBy(*key, "text_a", "text_b").agg(first), "voices")
    sketches = voices.groupBy(*key).agg(
        F.hll_sketch_agg("site", F.lit(LG_SKETCH)).alias("sketch"), F.min(text).alias("first"), F.max(text).alias("last")
    )
    estimate = F.hll_sketch_estimate("sketch")
    band = max(1, round(NEAR * min_sites))
    if every_copy:
        sketches = sketches.where(F.col("first") != F.col("last"))
    judged = sketches.select(*key, estimate.alias("sites"))
    judged = scratch.store(judged.where(F.col("sites") >= min_sites - band), "judged")
    near = judged.where(F.col("sites") <= min_sites + band).select(*key)
    seen = voices.select(*key, "site").join(near, key, "left_semi").distinct()
    exact = seen.groupBy(*key).agg(F.count("*").alias("sites"))
    spread = judged.where(F.col("sites") > min_sites + band).select(*key).unionByName(
        exact.where(F.col("sites") >= min_sites).select(*key)
    )
    return places, scratch.store(spread, "spread")


def cleaned(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, every_copy: bool = False) -> DataFrame:
    """(row, removed_lines): every row of ``docs`` as one struct without its spread lines, and how many those were.

    The count stands beside the row, so that it clashes with no column of it.
    """
    scratch = Scratch(docs.sparkSession)
    places, spread = spread_lines(scratch, lines_of(docs, site), min_sites, every_copy)
    found = places.join(spread, ["line_a", "line_b"], "left_semi")
    removed = scratch.store(found.groupBy("text_a", "text_b").agg(F.collect_set("place").alias("places")), "removed")
    whole = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    rows = docs.select(whole, *_hashes(docs["text"], "text")).join(removed, ["text_a", "text_b"], "left")
    taken = F.col("places").isNotNull() & F.col("row.text").isNotNull()

    def without_places(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("places"))
        return F.array_join(F.transform(kept, lambda place: F.get(lines, place)), "\n")

    # bound as a lambda's variable, a text is split once and not anew for every line of it
    text = F.get(F.transform(F.array(F.split("row.text", "\n")), without_places), F.lit(0))
    text = F.when(taken, text).otherwise(F.col("row.text"))
    columns = [(text if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns]
    return rows.select(F.struct(*columns).alias("row"), F.when(taken, F.size("places")).otherwise(0).alias("removed_lines"))


def clean(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, every_copy: bool = False) -> DataFrame:
    """``docs`` with the spread lines taken out of ``text``."""
    return cleaned(docs, site, min_sites, every_copy).select("row.*")
