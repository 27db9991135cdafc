"""Joins that plain equality or plain hashing does not serve well."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the rows, so there are
# never more than _HOT_SHARES hot keys to broadcast.
_HOT_SHARES = 256
# One task takes this many rows of one key without trouble.
_HARMLESS = 1_000_000


def skew_join(
    big: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    rows: str,
    spread: Column,
    how: str = "inner",
    harmless: int = _HARMLESS,
) -> DataFrame:
    """Join `big` to `keyed`, which has one row per key, whatever a key's share of `big`.

    `keyed` is a stored table; `keyed[rows]` says how many rows of `big` carry
    the key and is dropped. Where some key is hot, its rows are dealt over
    salts by the hash of `spread`, and the one row of `keyed` that they need is
    repeated once per salt.
    """
    on = list(on)
    size = keyed.agg(F.sum(rows).alias("total"), F.max(rows).alias("most")).first()
    if size.total is None or size.most <= harmless or size.most * _HOT_SHARES <= size.total:
        return big.join(keyed.drop(rows), on, how)
    is_hot = F.col(rows) * F.lit(_HOT_SHARES) > F.lit(size.total)
    # Fewer than _HOT_SHARES keys can each hold more than 1 / _HOT_SHARES of the rows.
    hot = F.broadcast(keyed.filter(is_hot).select(*on, F.lit(True).alias("__hot")))
    salt = F.pmod(F.xxhash64(spread), F.lit(_HOT_SHARES)).cast("int")
    salted = (
        big.join(hot, on, "left")
        .withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0)))
        .drop("__hot")
    )
    every = F.sequence(F.lit(0), F.lit(_HOT_SHARES - 1))
    repeated = keyed.withColumn(
        "__salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    ).drop(rows)
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")


@dataclass(frozen=True)
class Grid:
    """How rows meet near neighbours: cells of the given width, refined where crowded."""

    width: float
    crowd: int = 4096
    """Rows of the right side that may share a cell before it is split further."""
    dims_per_level: int = 3


def near_pairs(
    left: DataFrame,
    right: DataFrame,
    left_coords: Sequence[Column],
    right_coords: Sequence[Column],
    grid: Grid,
    right_key: str,
    scratch,
) -> DataFrame:
    """All (left, right) rows whose coordinates differ by at most `grid.width` in every dimension.

    The result also holds pairs farther apart; callers filter by their own
    distance. No pair occurs twice. Column names of the sides must not clash.

    A right row lives in one cell, a left row visits the cells around its own,
    and the two meet by equality of the cell. Cells use the first few
    dimensions. A cell with more than `crowd` right rows is split along the
    next ones, cell by cell; once no dimension is left, its right rows are
    dealt over salts and its visitors are repeated per salt. So no task holds
    a crowded cell whole and no row is dropped.
    """
    levels = [
        range(i, min(i + grid.dims_per_level, len(right_coords)))
        for i in range(0, len(right_coords), grid.dims_per_level)
    ]
    width = F.lit(float(grid.width))

    def index(coord: Column) -> Column:
        return F.floor(coord / width)

    home = right.withColumn("__cell", F.array(*[index(right_coords[d]) for d in levels[0]]))
    visit = _visit(left.withColumn("__cell", F.array().cast("array<bigint>")), left_coords, levels[0], index)
    for depth, _ in enumerate(levels):
        crowded = scratch.write(
            home.groupBy("__cell").agg(F.count("*").alias("__rows")).filter(F.col("__rows") > grid.crowd),
            "crowded",
        )
        if crowded.isEmpty():
            return home.join(_spread(visit, "__cell"), "__cell").drop("__cell")
        if depth + 1 == len(levels):
            break
        dims = levels[depth + 1]
        # Cells split before have one more entry per dimension, so cells of
        # different depth never equal each other.
        split = crowded.select("__cell", F.lit(True).alias("__split"))
        deeper = F.concat("__cell", F.array(*[index(right_coords[d]) for d in dims]))
        home = (
            home.join(split, "__cell", "left")
            .withColumn("__cell", F.when(F.col("__split"), deeper).otherwise(F.col("__cell")))
            .drop("__split")
        )
        marked = visit.join(split, "__cell", "left")
        visit = (
            marked.filter(F.col("__split").isNull())
            .drop("__split")
            .unionByName(_visit(marked.filter("__split").drop("__split"), left_coords, dims, index))
        )
        home, visit = scratch.write(home, "home"), scratch.write(visit, "visit")

    salts = crowded.select("__cell", F.ceil(F.col("__rows") / F.lit(grid.crowd)).cast("int").alias("__salts"))
    one = F.coalesce("__salts", F.lit(1))
    home = (
        home.join(salts, "__cell", "left")
        .withColumn("__salt", F.pmod(F.xxhash64(right_key), one).cast("int"))
        .drop("__salts")
    )
    visit = (
        visit.join(salts, "__cell", "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), one - 1)))
        .drop("__salts")
    )
    return home.join(_spread(visit, "__cell", "__salt"), ["__cell", "__salt"]).drop("__cell", "__salt")


def _spread(visit: DataFrame, *by: str) -> DataFrame:
    """Keep the comparisons on all tasks: their cost is in the pairs, which byte sizes do not show."""
    return visit.repartition(int(visit.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _visit(left: DataFrame, coords: Sequence[Column], dims: Sequence[int], index) -> DataFrame:
    """Append to each row's cell the three neighbouring indices along every given dimension."""
    out = left
    for d in dims:
        at = index(coords[d])
        out = out.withColumn("__at", F.explode(F.array(at - 1, at, at + 1)))
        out = out.withColumn("__cell", F.concat("__cell", F.array("__at"))).drop("__at")
    return out


def join_clusters(labels: DataFrame, clusters: DataFrame, key: str = "id") -> DataFrame:
    """Labels with the component of their point, null where the point is in no cluster."""
    return labels.join(clusters.withColumnRenamed("point", key), key, "left")
