"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablemill.llm.arrow_text import WORD
from tablemill.llm.staged import stage

PREFIX = 3


def word_count(text: str) -> Column:
    """The number of words: each becomes one letter, and white space goes."""
    marks = F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\f\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, total: Column, epochs: float) -> DataFrame:
    """``sizes`` (source, weight, source_size) with each source's ``target``.

    Sources share ``total`` by weight; none gets more than ``epochs`` times its size, and what that
    leaves goes to the others by weight, until none is above.  The level at which this ends is found
    directly: by size for its weight, the sources at their limit come first, so the level that the rest
    would have is compared with each source in turn.  One row per source is ordered here, not per document.
    """
    limit = F.col("source_size") * F.lit(float(epochs))
    line = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rest = line.rowsBetween(0, Window.unboundedFollowing)
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = sizes.withColumn("_limit", limit).withColumn(
        "_level", (total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    )
    # the first source that its level does not fill, and all after it, stand at that level
    free = F.when(F.col("_limit") > F.col("weight") * F.col("_level"), F.col("_level"))
    shared = levels.withColumn("_shared", F.first(free, ignorenulls=True).over(every))
    target = F.when(F.col("_shared").isNull(), F.col("_limit")).otherwise(
        F.least(F.col("_limit"), F.col("weight") * F.col("_shared"))
    )
    return shared.select("source", "source_size", target.alias("target"))


def weigh(sources: DataFrame, weights: list[int]) -> DataFrame:
    """Sources by code point, NULL last, with the weights in turn."""
    line = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(line) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))


def mix(df: DataFrame, size: str, weights: list[int], share: float, epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """Every row of ``df`` (doc_id, source, the size column and any others) with ``_source_size``, ``_target`` and ``_times``.

    A source whose target is r times its size gets every document floor(r) times and, once more, the
    documents that come first in a seeded order until the fraction left is filled.  The order is by
    MD5 of seed and doc_id.  Running sums go over the documents of one source and one prefix of that
    digest, added to the sums of the prefixes before, so no source is ordered by one task.  A document
    at the edge is taken if its middle lies inside, so a source misses its target by half a document
    at most.  A source without words has target 0 and its documents are not taken.  A NULL source is a
    source, a NULL doc_id a value like others, rows with equal ids follow each other by size.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    drawn = df.withColumn("_draw", digest)
    prefix = F.substring("_draw", 1, PREFIX)
    shelves = stage(drawn.groupBy("source", prefix.alias("_shelf")).agg(F.sum(size).alias("_words")), "mix-shelves")
    sizes = shelves.groupBy("source").agg(F.sum("_words").alias("source_size"))
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * F.lit(share)
    targets = water_fill(weigh(sizes, weights).withColumn("_total", total), F.col("_total"), epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    quota = F.col("target") - F.floor(rate) * F.col("source_size")
    up_to = Window.partitionBy("source").orderBy("_shelf").rowsBetween(Window.unboundedPreceding, -1)
    places = shelves.withColumn("_before", F.coalesce(F.sum("_words").over(up_to), F.lit(0)))
    known = stage(
        places.join(targets, places["source"].eqNullSafe(targets["source"])).select(
            places["source"].alias("_of"), F.col("_shelf").alias("_on"), "_before",
            F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
            F.floor(rate).cast("int").alias("_whole"), quota.alias("_quota"),
        ),
        "mix-places",
    )
    inside = Window.partitionBy("source", "_shelf").orderBy("_draw", "doc_id", size).rowsBetween(Window.unboundedPreceding, -1)
    ordered = drawn.withColumn("_shelf", prefix).withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    met = ordered.join(known, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_shelf") == F.col("_on")))
    middle = F.col("_before") + F.col("_inside") + F.col(size) / F.lit(2.0)
    times = F.col("_whole") + F.when((F.col(size) > 0) & (middle <= F.col("_quota")), 1).otherwise(0)
    return met.withColumn("_times", times.cast("int")).drop("_draw", "_shelf", "_inside", "_of", "_on", "_before", "_whole", "_quota")


def mixed_rows(df: DataFrame, size: Column, weights: list[int], share: float, epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """The rows of ``df`` (doc_id, source and any other columns of any names), each as often as ``mix`` takes it."""
    row = F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])
    taken = mix(df.select("doc_id", "source", size.alias("_size"), row.alias("_row")), "_size", weights, share, epochs, seed)
    times = F.explode(F.array_repeat(F.lit(0), F.col("_times")))
    return taken.where("_times > 0").select("_row", times.alias("_copy")).select("_row.*")
