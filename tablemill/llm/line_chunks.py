"""Removal of chunks of lines that repeat across the corpus, with content-defined boundaries.

Only built-in functions are used.  A rolling hash over the hashes of two neighbouring lines decides where
a chunk may end, so an inserted or missing line moves the boundaries near it and no others.  A text is
cut by several such hashes, since a passage of few lines has few boundaries of its own in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablemill.llm.repeats import NO_ID
from tablemill.llm.staged import stage

# The rolling hashes: a base each, modulo a prime that neither divides a base nor the number after it, so that
# lines that are equal do not cancel out.  All values but one in ONE_IN allow a boundary.
BASES, PRIME, ONE_IN = (1_000_003, 15_485_863, 179_424_673), (1 << 31) - 1, 3
# A chunk has at least so many lines but at the start or end of a text, and at most so many.
LEAST_LINES, MOST_LINES = 2, 8


def lines_of(text: Column) -> Column:
    """The lines of a text; NULL and empty texts have none."""
    return F.when(F.length(text) > 0, F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>"))


def _cut(df: DataFrame, base: int, name: str) -> DataFrame:
    """``df`` (_lines, _hashes) with the chunks of one rolling hash as column ``name``.

    Lines after which the hash allows a boundary and that follow each other make a run, and every second of a
    run, from its first on, ends a chunk.  What is longer than the longest chunk is cut after every MOST_LINES.
    """
    number = F.size("_hashes")

    def allowed(at: Column) -> Column:
        rolling = F.lit(base) * F.coalesce(F.get("_hashes", at - 1), F.lit(0)) + F.get("_hashes", at)
        return rolling % PRIME % ONE_IN != 0

    def pieces(no: Column) -> Column:
        first = F.when(no == 0, 0).otherwise(F.get("_ends", no - 1) + 1)
        end = F.get("_ends", no)
        cuts = F.sequence(first, end, F.lit(MOST_LINES))
        return F.transform(cuts, lambda at: F.struct(at.alias("first"), F.least(F.lit(MOST_LINES), end - at + 1).alias("n")))

    none = F.array().cast("array<int>")
    return (
        df.withColumn("_may", F.when(number > 1, F.filter(F.sequence(F.lit(0), number - 2), allowed)).otherwise(none))
        .withColumn("_from", F.filter("_may", lambda at, k: (k == 0) | (F.get("_may", k - 1) != at - 1)))
        .withColumn("_to", F.filter("_may", lambda at, k: (k == F.size("_may") - 1) | (F.get("_may", k + 1) != at + 1)))
        .withColumn("_inner", F.flatten(F.zip_with("_from", "_to", lambda a, b: F.sequence(a, b, F.lit(2)))))
        .withColumn("_ends", F.when(number > 0, F.concat("_inner", F.array(number - 1))).otherwise(none))
        .withColumn("_nos", F.when(number > 0, F.sequence(F.lit(0), F.size("_ends") - 1)).otherwise(none))
        .withColumn(name, F.flatten(F.transform("_nos", pieces)))
        .drop("_may", "_from", "_to", "_inner", "_ends", "_nos")
    )


def with_chunks(df: DataFrame) -> DataFrame:
    """``df`` (text and others) with ``_lines`` and ``_chunks``, the different chunks (first line, lines) of all cuts."""
    line_hash = F.transform("_lines", lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long"))
    cut = df.withColumn("_lines", lines_of(F.col("text"))).withColumn("_hashes", line_hash)
    names = [f"_cut_{no}" for no in range(len(BASES))]
    for base, name in zip(BASES, names):
        cut = _cut(cut, base, name)
    return cut.withColumn("_chunks", F.array_distinct(F.concat(*names))).drop("_hashes", *names)


def chunk_text(chunk: Column) -> Column:
    return F.array_join(F.slice("_lines", chunk["first"] + 1, chunk["n"]), "\n")


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(_d, _h, first, n) of chunks of several lines that equal an earlier one, by doc_id and first line.

    Chunks whose hash stands alone are left out first, then those that share one are compared by their
    bytes: they are grouped by, and joined on, hash and text.
    """
    several = F.filter("_chunks", lambda chunk: chunk["n"] >= LEAST_LINES)
    hashed = with_chunks(rows.select("_d", "_h", "text")).select(
        "_d", "_h",
        F.explode(F.transform(several, lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), F.xxhash64(chunk_text(c)).alias("key")))).alias("c"),
    ).select("_d", "_h", "c.*")
    hashed = stage(hashed, "chunk-hashes")
    shared = stage(hashed.groupBy("key").count().where("count > 1").select("key"), "shared-chunks")
    wanted = stage(
        hashed.join(shared, "key").groupBy("_d", "_h").agg(F.collect_set(F.struct("first", "n")).alias("wanted")), "wanted-chunks"
    )
    # the hint keeps one way of joining at every size
    read = rows.select("_d", "_h", lines_of(F.col("text")).alias("_lines")).join(wanted.hint("merge"), ["_d", "_h"])
    contents = F.transform("wanted", lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), chunk_text(c).alias("content")))
    texts = stage(
        read.select("_d", "_h", F.explode(contents).alias("c")).select("_d", "_h", "c.*", F.xxhash64("c.content").alias("key")),
        "chunk-texts",
    )
    firsts = stage(
        texts.groupBy("key", "content").agg(F.min(F.struct("_d", "first")).alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1")
        .select("key", "content", F.col("least._d").alias("first_d"), F.col("least.first").alias("first_line")),
        "first-chunks",
    )
    later = texts.join(firsts, ["key", "content"]).where("_d > first_d OR _d = first_d AND first > first_line")
    return later.select("_d", "_h", "first", "n")


def remove_repeated_chunks(df: DataFrame) -> DataFrame:
    """Every row of ``df`` (doc_id, text) with n_lines, n_chunks, n_removed (lines) and kept_text.

    A line goes if a chunk of two lines or more that holds it has the same bytes as a chunk that comes earlier: in
    a smaller doc_id, or further ahead in the same document.  So the earliest copy of each line stays.  n_chunks counts
    the different chunks of all cuts.  The lines left are joined by line feeds.  NULL and
    empty texts have no lines and an empty kept_text; a NULL doc_id comes last; rows that share a doc_id are
    at the same place, where neither is earlier.  An empty frame gives no rows; other columns are ignored.
    """
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"), F.xxhash64("text").alias("_h"),
    )
    gone = repeated_chunks(rows).groupBy("_d", "_h").agg(F.collect_set(F.struct("first", "n")).alias("_gone"))
    met = with_chunks(rows.join(gone.hint("merge"), ["_d", "_h"], "left")).select(
        "doc_id", "_lines", F.size("_chunks").cast("long").alias("n_chunks"),
        F.flatten(F.transform("_gone", lambda c: F.sequence(c["first"], c["first"] + c["n"] - 1))).alias("_out"),
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_out")
    kept = met.withColumn(
        "_kept", F.when(F.col("_out").isNull(), F.col("_lines")).otherwise(F.transform(left, lambda at: F.get("_lines", at)))
    )
    return kept.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"), "n_chunks",
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_removed"), F.array_join("_kept", "\n").alias("kept_text"),
    )
