"""Shards of near-equal bytes from a k-d tree over metadata, in DataFrame functions only.

All rows begin in one cell. A cell that has to become n shards is cut along the dimension in which it
is widest, at the value below which the share floor(n/2)/n of its bytes lies, until each cell is one
shard. The cut is a weighted quantile, found on the cluster: bytes are summed in bins of the cell's
range, the bin that holds the quantile is divided into bins again. Rows that still lie in one bin then,
such as rows equal in everything, are cut by a number dealt to each row. The driver sees one row per cell.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import stage

# Bins of one round, and rounds: a cut is exact to 2 ** -36 of a cell's width.
BINS, ROUNDS = 4096, 3
# Rows that one task numbers within a shard.
ROWS_PER_RUN = 1_000_000


@dataclass
class Cell:
    """A node of the tree: the shards it becomes, and its cut once it has one."""

    first: int
    shards: int
    dim: int = 0
    ranges: list[tuple[float, float]] = field(default_factory=list)  # what each round divides into bins
    bins: list[int] = field(default_factory=list)  # the bin of each round that holds the quantile
    below: int = 0  # bytes before that bin
    goal: float = 0.0
    cut: float | None = None  # of the rows in the last bin: those whose dealt number is less go left
    left: int = -1
    right: int = -1

    def divide(self, low: float, high: float) -> None:
        self.ranges.append((low, max(high, math.nextafter(low, math.inf))))


def _lookup(values: list, kind: str, node: Column) -> Column:
    return F.get(F.lit(values).cast(f"array<{kind}>"), node)


def _bin(cells: list[Cell], r: int) -> Column:
    """A row's bin of round ``r``."""
    node = F.col("_cell")
    range_of = lambda c: c.ranges[r] if r < len(c.ranges) else (0.0, 1.0)
    low, high = (_lookup([range_of(c)[k] for c in cells], "double", node) for k in (0, 1))
    at = F.get("_at", _lookup([c.dim for c in cells], "int", node))
    return F.least(F.greatest(F.floor((at - low) / (high - low) * BINS), F.lit(0)), F.lit(BINS - 1))


def _chosen(cells: list[Cell], r: int) -> Column:
    return _lookup([c.bins[r] if r < len(c.bins) else 0 for c in cells], "bigint", F.col("_cell"))


def _step(df: DataFrame, cells: list[Cell]) -> DataFrame:
    """Rows moved from cells that have a cut to their parts."""
    node = F.col("_cell")
    left = _lookup([c.left if c.cut is not None else i for i, c in enumerate(cells)], "int", node)
    right = _lookup([c.right if c.cut is not None else i for i, c in enumerate(cells)], "int", node)
    # Bins of whole rounds before the chosen one, then the dealt number.
    side = F.when(F.col("_salt") < _lookup([c.cut or 0.0 for c in cells], "double", node), left).otherwise(right)
    for r in reversed(range(ROUNDS)):
        own, chosen = _bin(cells, r), _chosen(cells, r)
        side = F.when(own < chosen, left).when(own > chosen, right).otherwise(side)
    return df.withColumn("_cell", side)


def _quantiles(df: DataFrame, cells: list[Cell], live: list[int], place: Column, rounds: int) -> list:
    """For each live cell the first bin (of its rows in the chosen bins so far) that reaches its goal, the sum up to it, and its own."""
    node = F.col("_cell")
    inside = node.isin(live)
    for r in range(rounds):
        inside = inside & (_bin(cells, r) == _chosen(cells, r))
    sums = df.where(inside).withColumn("_bin", place).groupBy("_cell", "_bin").agg(F.sum("_weight").alias("w"))
    run = F.sum("w").over(Window.partitionBy("_cell").orderBy("_bin"))
    short = _lookup([c.goal - c.below for c in cells], "double", node)
    reached = sums.withColumn("run", run).where(F.col("run") >= short)
    return reached.groupBy("_cell").agg(F.min(F.struct("_bin", "run", "w")).alias("b")).select("_cell", "b.*").collect()


def _cut(df: DataFrame, cells: list[Cell], live: list[int]) -> None:
    """Set the cut of the live cells: their weighted quantile on their widest dimension."""
    for r in range(ROUNDS):
        for row in _quantiles(df, cells, live, _bin(cells, r), r):
            cell = cells[row["_cell"]]
            low, high = cell.ranges[r]
            width = (high - low) / BINS
            cell.bins.append(row["_bin"])
            cell.below += row["run"] - row["w"]
            cell.divide(low + row["_bin"] * width, low + (row["_bin"] + 1) * width)
    for row in _quantiles(df, cells, live, F.floor(F.col("_salt") * BINS), ROUNDS):
        cell = cells[row["_cell"]]
        under, over = cell.below + row["run"] - row["w"], cell.below + row["run"]
        cell.cut = (row["_bin"] + (0 if cell.goal - under < over - cell.goal else 1)) / BINS


def kd_shards(df: DataFrame, weight: Column, dims: list[Column], tie: list[Column], shards: int) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``weight``: bytes of a row. ``dims``: numeric columns; NULL counts as the least value. Rows of equal
    value are told apart by a hash of the columns ``tie``, so a value that a third of all rows share is
    cut like any other; rows equal in these columns too are dealt out by a number of their own (which of
    such equal rows goes where depends on the files). Shards differ by about the size of the rows at the
    cuts; with fewer rows than shards some stay empty. Existing columns ``shard`` and ``slot`` are
    replaced; other columns pass whatever their names. An empty table gives an empty result.
    """
    names = [f"`{c}`" for c in df.columns if c not in ("shard", "slot")]
    # The number is drawn once, as the table is written.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 32)) / F.lit(float(1 << 32))
    plain = df.select(F.struct(*names).alias("_row"), weight.cast("long").alias("_weight"), F.array(*[d.cast("double") for d in dims]).alias("_raw"), F.xxhash64(*tie).alias("_tie"), salt.alias("_salt"))
    rows = stage(plain, "shard-rows")
    ends = rows.agg(F.count(F.lit(1)).alias("n"), *[f(F.col("_raw")[i]).alias(f"{f.__name__}{i}") for i in range(len(dims)) for f in (F.min, F.max)]).first()
    total = ends["n"]
    scaled, room = [], []
    for i in range(len(dims)):
        least, most = ends[f"min{i}"] or 0.0, ends[f"max{i}"] or 0.0
        room.append(1.0 / (most - least + 1.0))
        # Whole values keep their distance; the hash spreads equal ones over the room to the next.
        inside = F.pmod(F.xxhash64("_tie", F.lit(i)), F.lit(1 << 32)) / F.lit(float(1 << 32))
        scaled.append((F.coalesce(F.col("_raw")[i], F.lit(least)) - F.lit(least) + inside) / F.lit(most - least + 1.0))
    placed = rows.select("_row", "_weight", "_tie", "_salt", F.array(*scaled).alias("_at"), F.lit(0).alias("_cell"))

    cells = [Cell(0, shards)]
    live = [0]
    while live and total:
        sides = [F.max(F.col("_at")[i]) for i in range(len(dims))] + [F.min(F.col("_at")[i]) for i in range(len(dims))]
        stats = placed.where(F.col("_cell").isin(live)).groupBy("_cell").agg(F.sum("_weight"), *sides).collect()
        for row in stats:
            cell, (weight_all, *edges) = cells[row[0]], row[1:]
            widths = [edges[i] - edges[len(dims) + i] for i in range(len(dims))]
            # The room of one value is not width: a cell of one source is not cut by source.
            cell.dim = max(range(len(dims)), key=lambda i: (max(widths[i] - room[i], 0.0), widths[i], -i))
            cell.divide(edges[len(dims) + cell.dim], edges[cell.dim])
            cell.goal = weight_all * (cell.shards // 2) / cell.shards
        live = [row[0] for row in stats]
        if live:
            _cut(placed, cells, live)
        parts = []
        for i in live:
            cell = cells[i]
            if cell.cut is None:
                continue
            half = cell.shards // 2
            cell.left, cell.right = len(cells), len(cells) + 1
            cells += [Cell(cell.first, half), Cell(cell.first + half, cell.shards - half)]
            parts += [i for i in (cell.left, cell.right) if cells[i].shards > 1]
        # A table for each level: plans stay as small as the first one, however deep the tree.
        placed = stage(_step(placed, cells), "shard-cells")
        for cell in cells:
            cell.cut = None
        live = parts
    shard = _lookup([c.first for c in cells], "int", F.col("_cell"))
    runs = 1 + total // ROWS_PER_RUN
    dealt = placed.withColumn("shard", shard).withColumn("_run", F.pmod(F.xxhash64("_tie", "_salt"), F.lit(runs)).cast("int"))
    return _slots(dealt).select("_row.*", "shard", "slot")


def _slots(df: DataFrame) -> DataFrame:
    """Number the rows of each shard: within runs of bounded size, plus the rows of the runs before.

    The table of runs has one row per shard and ``ROWS_PER_RUN`` rows, so it can be broadcast.
    """
    runs = df.groupBy("shard", "_run").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_run")) - F.col("n")
    starts = runs.select("shard", "_run", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_run").orderBy("_tie", "_weight", "_salt")) - 1
    numbered = df.withColumn("_within", within)
    return numbered.join(F.broadcast(starts), ["shard", "_run"]).withColumn("slot", (F.col("_before") + F.col("_within")).cast("long")).drop("_before", "_within")
