"""Write a frame as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablemill.functions.values import column_named, csv_text


def export_csv(
    df: DataFrame | None,
    path: str,
    *,
    single_file: bool = False,
    rows_per_file: int = 1_000_000,
) -> str:
    """Replace ``path`` with the frame as CSV: header, UTF-8, missing and empty text as an
    empty field, quotes doubled, values in the form of
    :func:`tablemill.functions.values.csv_text`.

    The result is a folder of files written in parallel, none above ``rows_per_file`` rows,
    so that texts with line breaks still read back by many tasks.  ``single_file`` writes one
    file of any size, by one task: it takes as long as one disk needs, so it is for small results.
    """
    if df is None:
        raise ValueError("there is no frame to export")
    rows = csv_text(df)
    # An empty field alone on its line would be a blank line, which readers skip.
    lone = len(rows.columns) == 1
    if lone:
        name = rows.columns[0]
        rows = rows.select(F.coalesce(column_named(name).cast("string"), F.lit("")).alias(name))
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").options(
        header=True,
        quote='"',
        escape='"',
        encoding="UTF-8",
        nullValue="",
        emptyValue='""' if lone else "",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=0 if single_file else rows_per_file,
    ).csv(path)
    return path
