"""Join one row per key to a side in which a key may hold any share of the rows.

AQE splits skewed partitions only where both join inputs come straight from a shuffle.  An
aggregate as one input rules that out, so frequent keys are treated apart here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tablemill.functions.values import column_named
from tablemill.operators.combine import join_on
from tablemill.operators.numbering import ROWS_PER_TASK, SHORT_BYTES, GroupSizes, columns, group_sizes, is_short

# What is broadcast must be known to stay below this.
BROADCAST_BYTES = 32 * 1024 * 1024


def row_bytes(df: DataFrame, keys: Sequence[str], sizes: GroupSizes) -> int | None:
    """An upper bound on the bytes of a row with one key, None if there is no such bound.

    Texts are measured, in one pass over the frame; nested values have no bound.
    """
    values = [field for field in df.schema.fields if field.name not in keys]
    texts = [f for f in values if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if not all(is_short(f.dataType) or f in texts for f in values):
        return None
    longest = df.agg(*[F.max(F.octet_length(column_named(f.name))) for f in texts]).first() if texts else ()
    return sizes.key_bytes + SHORT_BYTES * (len(values) - len(texts)) + sum(width or 0 for width in longest)


def frequent_keys(
    df: DataFrame, keys: Sequence[str], sizes: GroupSizes, bytes_each: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The keys with too many rows for a task, few enough to broadcast.

    Fewer than total/t keys can have more than t rows each, so raising t bounds their number.
    """
    threshold = max(rows_per_task, math.ceil(sizes.total * bytes_each / BROADCAST_BYTES))
    counts = df.groupBy(*columns(keys)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > threshold).drop("_n")


def look_up(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Left join to a frame with at most one row per key; NULL keys match each other.

    Rows with frequent keys meet a broadcast of those keys' rows and are not shuffled; all
    others go through an ordinary join.
    """
    keys = list(keys)
    sizes = group_sizes(df, keys)
    bytes_each = row_bytes(lookup, keys, sizes)
    if sizes.largest <= rows_per_task or bytes_each is None:
        return join_on(df, lookup, keys, "left")
    frequent = F.broadcast(frequent_keys(df, keys, sizes, bytes_each, rows_per_task))
    hot = join_on(
        join_on(df, frequent, keys, "left_semi"), F.broadcast(join_on(lookup, frequent, keys, "left_semi")), keys, "left"
    )
    return hot.unionByName(join_on(join_on(df, frequent, keys, "left_anti"), lookup, keys, "left"))
