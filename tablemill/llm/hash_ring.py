"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells.  Every shard stands at ``NODES`` cells (its virtual nodes),
and a row belongs to the first node clockwise from the cell of its key.  A shard has room for its
even part of the rows and no more: rows beyond go on clockwise to the next node whose shard has
room.  Only the rows per cell reach the driver, a bounded table whatever the input; the plan that
comes back says which ranks of a cell go to which shard.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

CELLS = 1 << 14
NODES = 128


def ring(n_shards: int, nodes: int = NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise.

    A node's cell depends on its shard and number alone, so a further shard moves no other node.
    Nodes that meet in a cell stay there in an order of their own.
    """
    points = []
    for shard in range(n_shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=16).digest()
            points.append((int.from_bytes(digest[:8], "big") % cells, digest, shard))
    return [(cell, shard) for cell, _, shard in sorted(points)]


def capacities(n_rows: int, n_shards: int) -> list[int]:
    """Even parts: the first ``n_rows % n_shards`` shards hold one row more."""
    return [n_rows // n_shards + (shard < n_rows % n_shards) for shard in range(n_shards)]


def plan(counts: dict[int, int], n_shards: int, nodes: int = NODES, cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first rank), covering every row once.

    Shards first take rows of their own arcs, as many as they have room for; what is left then goes on
    clockwise, cell by cell.
    """
    points = ring(n_shards, nodes, cells)
    room = capacities(sum(counts.values()), n_shards)
    used = [0] * n_shards
    pieces, rest = [], []

    def put(cell: int, start: int, end: int, shard: int) -> int:
        taken = min(end - start, room[shard] - used[shard])
        if taken:
            pieces.append((cell, start, start + taken, shard, used[shard]))
            used[shard] += taken
        return start + taken

    for cell in sorted(counts):
        at = bisect_left(points, (cell, -1)) % len(points)
        left = put(cell, 0, counts[cell], points[at][1])
        if left < counts[cell]:
            rest.append((cell, left, counts[cell]))
    live = [point for point in points if used[point[1]] < room[point[1]]]
    for cell, start, end in rest:
        while start < end:
            shard = live[bisect_left(live, (cell, -1)) % len(live)][1]
            start = put(cell, start, end, shard)
            if used[shard] == room[shard]:
                live = [point for point in live if point[1] != shard]
    return pieces


def assign_shards(
    df: DataFrame, keys: list[str], n_shards: int, shard: str = "shard", slot: str = "slot",
    nodes: int = NODES, cells: int = CELLS,
) -> DataFrame:
    """Every row with its ``shard`` and its gapless ``slot`` there; counts differ by one at most.

    ``keys`` decide the place on the ring and the order of rows that meet there.  NULL is a key like any
    other.  Rows equal in all keys are interchangeable if these are all columns; they take neighbouring
    slots.  An empty frame gives no rows.  Columns of the frame that are named like a new one are
    replaced.  The frame is evaluated twice, so it must give the same rows each time.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    spark = df.sparkSession
    kept = df.drop(shard, slot)
    place = F.xxhash64(*[F.col(f"`{key}`") for key in keys])
    cell = F.shiftrightunsigned(place, 32) % F.lit(cells)
    placed = kept.select(F.struct("*").alias("_row"), place.alias("_place"), cell.cast("int").alias("_cell"))
    counts = {row["_cell"]: row["count"] for row in placed.groupBy("_cell").count().collect()}
    pieces = spark.createDataFrame(
        plan(counts, n_shards, nodes, cells), f"_at int, _from long, _end long, _shard int, _slot long"
    )
    order = Window.partitionBy("_cell").orderBy("_place", *[f"_row.`{key}`" for key in keys])
    ranked = placed.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    # the plan has a bounded number of rows: cells and nodes together
    met = ranked.join(
        F.broadcast(pieces),
        (F.col("_cell") == F.col("_at")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_end")),
    )
    return met.select(
        "_row.*", F.col("_shard").alias(shard), (F.col("_slot") + F.col("_rank") - F.col("_from")).alias(slot)
    )
