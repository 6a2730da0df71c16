"""Squares that adapt to the rows: a quadtree refined where either side of a join is dense.

Both sides are counted once on a fine grid over the box they can share. A square
is split into its quarters while it holds too many rows of either side. A point
lies in one leaf; a box is followed from the root down to the leaves it reaches.
A leaf that is still too full at the finest grid (many rows in one place) is dealt
to several tasks, on whichever side is full.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.runtime import checkpoint

#: Halvings from the root to the finest square: at most 4 ** FINEST leaves, whatever the tables hold.
FINEST = 9
#: Rows of one side, and pairs of rows, that a square should hold at most.
SQUARE_ROWS, SQUARE_PAIRS = 50_000, 1_000_000
#: Halvings beyond those that evenly spread rows would need.
_BEYOND = 4
LEAF = ["_depth", "_qx", "_qy"]


class Quadtree:
    """Leaves over the box (x0, y0, x1, y1) for points (x, y) and boxes.

    `nodes` has a row (depth, qx, qy, split) per square with rows, `places` one (fx, fy, depth) per occupied cell of the finest grid.
    """

    def __init__(self, extent: tuple[float, float, float, float], points: DataFrame, xy: tuple[Column, Column], boxes: DataFrame, corners: list[Column],
                 square_rows: int = SQUARE_ROWS, square_pairs: int = SQUARE_PAIRS):
        x0, y0, x1, y1 = extent
        self.origin, self.side, self.finest = (x0, y0), max(x1 - x0, y1 - y0) or 1.0, FINEST
        middle = [(corners[0] + corners[2]) / 2, (corners[1] + corners[3]) / 2]
        counted = [df.select(*self._cells(*at)).groupBy("_fx", "_fy").agg(F.count(F.lit(1)).alias("n")).withColumn("left", F.lit(side))
                   for df, at, side in ((points, xy, True), (boxes, middle, False))]
        fine = checkpoint(counted[0].unionByName(counted[1]))
        held = {r.left: r.n for r in fine.groupBy("left").agg(F.sum("n").alias("n")).collect()}
        most = max(*(held.get(side, 0) / square_rows for side in (True, False)), math.sqrt(held.get(True, 0) * held.get(False, 0) / square_pairs), 1.0)
        self.finest = finest = min(FINEST, math.ceil(math.log(most, 4)) + _BEYOND)
        # The same cells as a grid of that depth gives: a coarser cell is the shifted number of a finer one.
        fine = fine.groupBy(F.shiftright("_fx", FINEST - finest).alias("_fx"), F.shiftright("_fy", FINEST - finest).alias("_fy"), "left").agg(F.sum("n").alias("n"))
        depths = fine.withColumn("_depth", F.explode(F.sequence(F.lit(0), F.lit(finest))))
        sizes = depths.groupBy("_depth", F.expr(f"shiftright(_fx, {finest} - _depth)").alias("_qx"), F.expr(f"shiftright(_fy, {finest} - _depth)").alias("_qy")).agg(
            F.sum(F.when(F.col("left"), F.col("n")).otherwise(0)).alias("n_left"), F.sum(F.when(F.col("left"), 0).otherwise(F.col("n"))).alias("n_right"))
        dense = (F.greatest("n_left", "n_right") > square_rows) | (F.col("n_left") * F.col("n_right") > square_pairs)
        full = dense & (F.col("_depth") < finest)
        self.nodes = checkpoint(sizes.select("_depth", "_qx", "_qy", "n_left", full.alias("_split")))
        self.deepest = self.nodes.filter("_split").agg(F.max("_depth")).first()[0]
        # Splits are nested: a square is as full as each of its quarters, so the leaf's depth is the number of split squares above.
        cells = fine.select("_fx", "_fy").distinct().withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(finest - 1))))
        ancestors = cells.select("_fx", "_fy", F.col("_at").alias("_depth"), F.expr(f"shiftright(_fx, {finest} - _at)").alias("_qx"), F.expr(f"shiftright(_fy, {finest} - _at)").alias("_qy"))
        split = self.nodes.filter("_split").select("_depth", "_qx", "_qy", F.lit(1).alias("_one"))
        self.places = checkpoint(ancestors.join(F.broadcast(split), LEAF, "left").groupBy("_fx", "_fy").agg(F.coalesce(F.sum("_one"), F.lit(0)).cast("int").alias("_depth")))

    def _cells(self, x: Column, y: Column) -> list[Column]:
        """Cell of the finest grid, the last one for the far edge."""
        most = (1 << self.finest) - 1

        def cell(v: Column, lo: float) -> Column:
            return F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(self.side) * float(1 << self.finest)), F.lit(0)), F.lit(most)).cast("int")

        return [cell(x, self.origin[0]).alias("_fx"), cell(y, self.origin[1]).alias("_fy")]

    def of_points(self, points: DataFrame, x: Column, y: Column) -> DataFrame:
        """The points with their leaf."""
        fx, fy = self._cells(x, y)
        placed = points.withColumns({"_fx": fx, "_fy": fy}).join(F.broadcast(self.places), ["_fx", "_fy"])
        return placed.withColumns({"_qx": F.expr(f"shiftright(_fx, {self.finest} - _depth)"), "_qy": F.expr(f"shiftright(_fy, {self.finest} - _depth)")}).drop("_fx", "_fy")

    def of_boxes(self, boxes: DataFrame, corners: list[Column]) -> DataFrame:
        """The boxes once for each leaf they reach. From the root down, only split squares are followed."""
        low, high = self._cells(corners[0], corners[1]), self._cells(corners[2], corners[3])
        rows = boxes.withColumns({"_lx": low[0], "_ly": low[1], "_hx": high[0], "_hy": high[1], "_depth": F.lit(0), "_qx": F.lit(0), "_qy": F.lit(0)})
        split = F.broadcast(self.nodes.filter("_split").select(*LEAF, F.lit(True).alias("_inner")))
        for depth in range(0 if self.deepest is None else self.deepest + 1):
            shift = self.finest - depth - 1

            def quarters(axis: str, lo: str, hi: str, shift=shift) -> Column:
                return F.filter(F.array(F.col(axis) * 2, F.col(axis) * 2 + 1), lambda q: (F.shiftright(F.col(lo), shift) <= q) & (q <= F.shiftright(F.col(hi), shift)))

            down = F.flatten(F.transform(quarters("_qx", "_lx", "_hx"), lambda x: F.transform(quarters("_qy", "_ly", "_hy"), lambda y: F.struct(
                F.lit(depth + 1).alias("_depth"), x.alias("_qx"), y.alias("_qy")))))
            here = F.array(F.struct("_depth", "_qx", "_qy"))
            inner = F.coalesce(F.col("_inner"), F.lit(False)) & (F.col("_depth") == depth)
            rows = rows.join(split, LEAF, "left").withColumn("_next", F.explode(F.when(inner, down).otherwise(here))).drop("_inner", *LEAF).select("*", "_next.*").drop("_next")
        return rows.drop("_lx", "_ly", "_hx", "_hy")


def dealt(tree: Quadtree, left: DataFrame, right: DataFrame, spread_left: list[str], spread_right: list[str], square_rows: int = SQUARE_ROWS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the keys to join on. In a leaf with too many rows each row of the full side goes to one of its parts and the other side's rows to all of them.

    The points of a leaf were counted when the tree was built; only the thin rows of the boxes are counted here.
    """
    points = tree.nodes.filter("NOT _split").select(*LEAF, F.ceil(F.col("n_left") / square_rows).cast("int").alias("_salt_parts"))
    boxes = right.groupBy(*LEAF).agg(F.ceil(F.count(F.lit(1)) / square_rows).cast("int").alias("_salt_right_parts"))
    parts = checkpoint(points.join(boxes, LEAF).filter("_salt_parts > 1 OR _salt_right_parts > 1"))
    # At most a row per leaf of the finest grid and full leaf above it.
    parts = F.broadcast(parts)

    def side(df: DataFrame, own: str, other: str, spread: list[str]) -> DataFrame:
        n, copies = F.coalesce(F.col(f"{own}_parts"), F.lit(1)), F.coalesce(F.col(f"{other}_parts"), F.lit(1))
        mine = F.pmod(F.xxhash64(*spread), n).cast("int")
        return df.join(parts, LEAF, "left").withColumns({own: mine, other: F.explode(F.sequence(F.lit(0), copies - 1))}).drop("_salt_parts", "_salt_right_parts")

    return side(left, "_salt", "_salt_right", spread_left), side(right, "_salt_right", "_salt", spread_right), [*LEAF, "_salt", "_salt_right"]
