"""Nearest-neighbour baseline, exact.

Rows that share item, route, day period and passenger class share one feature point, so the search
runs over distinct points with a row count each. Known points lie in the cells of a k-d tree, each
with the box around its points. A point is searched in its own cell first; what it finds there is a
bound, and of the other cells only those whose box is not farther are searched. No nearer
point can be elsewhere, so the result is that of all pairs. Cells and their slices are searched inside
tasks with numpy and give at most k neighbours per point. Ties are settled alike everywhere, so neither
cells nor slices show in the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygalley.config import ForecastConfig
from skygalley.forecast.encoding import CategoryMeans, weighted_points
from skygalley.session import new_table_root
from skygalley.sources.sinks import overwrite

ENCODED = ("item_id", "route", "day_period")
# Points per slice: two slices of features and one block of distances fit any executor.
SLICE_POINTS = 20_000
# Distances held at once, as doubles.
BLOCK = 8_000_000
# Known points of a cell, unless that makes more cells than the largest number, whose boxes every task holds.
CELL_POINTS = 512
MOST_CELLS = 4096
# Points from which the borders of the cells are taken; any borders give the same result.
BORDER_POINTS = 20_000

_FOUND = "point array<double>, distance double, n bigint, total double"


def _bin_rank(cfg: ForecastConfig) -> Column:
    out = F.lit(None).cast("double")
    for rank, label in enumerate(cfg.pax_labels):
        out = F.when(F.col("pax_bin") == label, F.lit(float(rank))).otherwise(out)
    return out


def _usable(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Rows with an average and a passenger class; a distance needs every feature."""
    return df.withColumn("bin_rank", _bin_rank(cfg)).where(F.col("hist_avg").isNotNull() & F.col("bin_rank").isNotNull())


@dataclass(frozen=True)
class PointEncoding:
    """Mean target of items, routes and day periods, and mean and deviation of every feature."""

    means: CategoryMeans
    scale: dict[str, tuple[float, float]]


FEATURES = ("hist_avg", "bin_rank", *[f"{c}_mean" for c in ENCODED])


def fit_encoding(train: DataFrame, cfg: ForecastConfig) -> PointEncoding:
    """Target means of the categories, the rank of the passenger class, all scaled by the training rows."""
    rows = _usable(train, cfg).withColumn("label", F.col(cfg.target).cast("double")).where("label is not null")
    root = new_table_root(train.sparkSession)
    points = overwrite(weighted_points(rows, ["hist_avg", "bin_rank", *ENCODED], "label"), f"{root}/points")
    means = CategoryMeans.fit(points, ENCODED, "label", f"{root}/means")
    every = means.join(_usable(train, cfg), ENCODED)
    found = every.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in FEATURES for f in (F.avg, F.stddev_samp)]).first()
    scale = {c: (found[f"avg_{c}"] or 0.0, found[f"stddev_samp_{c}"] or 0.0) for c in FEATURES}
    return PointEncoding(means, scale)


def with_points(df: DataFrame, encoding: PointEncoding, cfg: ForecastConfig) -> DataFrame:
    out = encoding.means.join(_usable(df, cfg), ENCODED)
    # nine decimals: equal categories give equal points whatever the order of summation
    scaled = [
        F.round((F.col(c) - mean) / deviation, 9) + 0.0 if deviation else F.lit(0.0)
        for c, (mean, deviation) in encoding.scale.items()
    ]
    return out.select(*df.columns, F.array(*scaled).alias("point"))


# --- cells ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cells:
    """A k-d tree: inner node i splits at ``border[i]`` of ``axis[i]`` into nodes 2 i + 1 and 2 i + 2; and the leaves' boxes."""

    axis: np.ndarray
    border: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def borders(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Medians along the widest feature of each node's points, level by level."""
        axis, border = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        parts = [sample]
        for node in range(2**depth - 1):
            points = parts[node]
            if len(points):
                axis[node] = int(np.ptp(points, axis=0).argmax())
                border[node] = float(np.median(points[:, axis[node]]))
            below = points[:, axis[node]] <= border[node]
            parts += [points[below], points[~below]]
        return axis, border

    @staticmethod
    def leaf(axis: np.ndarray, border: np.ndarray, points: np.ndarray) -> np.ndarray:
        node, row = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(int(len(axis) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[row, axis[node]] > border[node])
        return node - len(axis)

    def bounds(self, points: np.ndarray) -> np.ndarray:
        """No point of a cell (column) is nearer to a point (row) than this; infinite for empty cells."""
        squares = np.zeros((len(points), len(self.low)))
        for j in range(points.shape[1]):
            x = points[:, j, None]
            squares += np.maximum(np.maximum(self.low[None, :, j] - x, x - self.high[None, :, j]), 0.0) ** 2
        return np.sqrt(squares)


def _with_cell(points: DataFrame, axis: np.ndarray, border: np.ndarray) -> DataFrame:
    @F.pandas_udf("int")
    def cell(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype="int32")
        return pd.Series(Cells.leaf(axis, border, np.stack(column.to_numpy()).astype(float)).astype("int32"))

    return points.withColumn("cell", cell("point"))


def build_cells(known: DataFrame) -> tuple[DataFrame, Cells]:
    """Known points with their cell, and the cells."""
    n = known.count()
    depth = min(max(0, (-(-n // CELL_POINTS) - 1).bit_length()), MOST_CELLS.bit_length() - 1)
    share = min(1.0, BORDER_POINTS / max(n, 1))
    taken = F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    sample = [r["point"] for r in known.where(taken).select("point").limit(2 * BORDER_POINTS).collect()] if depth else []
    width = len((known.select("point").first() or [[]])[0])
    axis, border = Cells.borders(np.array(sample, float).reshape(-1, width), depth) if depth else (np.zeros(0, np.int64), np.zeros(0))
    placed = overwrite(_with_cell(known, axis, border), f"{new_table_root(known.sparkSession)}/cells")
    sides = [f(F.col("point")[j]).alias(f"{f.__name__}_{j}") for j in range(width) for f in (F.min, F.max)]
    low, high = np.full((2**depth, width), np.inf), np.full((2**depth, width), -np.inf)
    for row in placed.groupBy("cell").agg(F.count("*").alias("n"), *sides).collect():  # a row per cell
        low[row["cell"]] = [row[f"min_{j}"] for j in range(width)]
        high[row["cell"]] = [row[f"max_{j}"] for j in range(width)]
    return placed, Cells(axis, border, low, high)


def _first_smallest(values: np.ndarray, take: int) -> np.ndarray:
    """Columns of the ``take`` smallest values of each row; of equal values the first ones count."""
    last = np.partition(values, take - 1, axis=1)[:, take - 1 : take]
    below, equal = values < last, values == last
    room = take - below.sum(axis=1, keepdims=True)
    chosen = below | (equal & (np.cumsum(equal, axis=1) <= room))
    return np.nonzero(chosen)[1].reshape(len(values), take)


def _search(k: int):
    def run(test: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
        columns = ["point", "distance", "n", "total"]
        if test.empty or train.empty:
            return pd.DataFrame(columns=columns)
        known = np.stack(train["point"].to_numpy()).astype(float)
        asked = np.stack(test["point"].to_numpy()).astype(float)
        take = min(k, len(known))
        n, total = train["n"].to_numpy(), train["total"].to_numpy()
        # the order among equally far points, the same in every slice
        order = np.lexsort((-total, -n))
        known, n, total = known[order], n[order], total[order]
        rows = max(1, BLOCK // len(known))
        found = []
        for start in range(0, len(asked), rows):
            block = asked[start : start + rows]
            # by feature, so that a block of distances is the largest array there is
            squares = np.zeros((len(block), len(known)))
            for j in range(known.shape[1]):
                squares += (block[:, j, None] - known[None, :, j]) ** 2
            near = _first_smallest(squares, take)
            picked = np.take_along_axis(squares, near, axis=1)
            found.append(
                pd.DataFrame(
                    {
                        "point": [list(p) for p in np.repeat(block, take, axis=0)],
                        "distance": np.sqrt(picked).ravel(),
                        "n": n[near].ravel(),
                        "total": total[near].ravel(),
                    }
                )
            )
        return pd.concat(found)[columns]

    return run


def _most(points: DataFrame) -> int:
    """Slices for the largest cell."""
    largest = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, -(-largest // SLICE_POINTS))


def _sliced(points: DataFrame, mine: str, n_mine: int, other: str, n_other: int) -> DataFrame:
    """Each point in its own slice of the cell, met by every slice of the other side."""
    others = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    return points.withColumn(mine, F.pmod(F.xxhash64("point"), F.lit(n_mine)).cast("int")).withColumn(
        other, others
    )


def _search_cells(asked: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """The k nearest known points in the cell that each asked point is paired with."""
    n_asked, n_known = _most(asked), _most(placed)
    at = ["cell", "s_asked", "s_known"]
    left = _sliced(asked, "s_asked", n_asked, "s_known", n_known).groupBy(*at)
    right = _sliced(placed, "s_known", n_known, "s_asked", n_asked).groupBy(*at)
    return left.cogroup(right).applyInPandas(_search(k), _FOUND)


def _other_cells(asked: DataFrame, cells: Cells) -> DataFrame:
    """(point, cell): the other cells whose box lies within ``bound``, or all where no bound is known."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 1024):
                part = frame.iloc[at : at + 1024]
                points = np.stack(part["point"].to_numpy()).astype(float)
                bounds = cells.bounds(points)
                near = bounds <= part["bound"].fillna(np.inf).to_numpy()[:, None]
                near &= np.isfinite(cells.low[:, 0])[None, :]
                near[np.arange(len(part)), part["cell"].to_numpy()] = False
                row, cell = np.nonzero(near)
                if len(row):
                    yield pd.DataFrame({"point": [list(p) for p in points[row]], "cell": cell.astype("int32")})

    return asked.select("point", "cell", "bound").mapInPandas(run, "point array<double>, cell int")


def nearest_points(known: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Per asked point at least its k nearest known points (point, n, total), as (point, distance, n, total).

    Both sides hold distinct points.
    """
    root = new_table_root(known.sparkSession)
    placed, cells = build_cells(known)
    own = _with_cell(asked, cells.axis, cells.border)
    first = overwrite(_search_cells(own, placed, k), f"{root}/own_cell")
    # slices of one cell may give more than k
    place = F.row_number().over(Window.partitionBy("point").orderBy("distance"))
    bound = first.withColumn("place", place).where(F.col("place") == k)
    bound = bound.select(F.col("point").alias("of"), F.col("distance").alias("bound"))
    bounded = own.join(bound, F.col("point") == F.col("of"), "left").drop("of")
    pairs = overwrite(_other_cells(bounded, cells), f"{root}/other_cells")
    return first.unionByName(_search_cells(pairs, placed, k))


def nearest_means(train: DataFrame, test: DataFrame, ks: Sequence[int], target: str) -> DataFrame:
    """Per distinct test point, the mean target of its k nearest training rows, as ``knn_<k>``.

    One search for the largest k serves all. Points at the rim that hold more rows than are still
    needed count with their mean; of equally far points the one with more rows comes first.
    """
    known = train.where(F.col(target).isNotNull()).groupBy("point")
    known = known.agg(F.count(target).alias("n"), F.sum(F.col(target).cast("double")).alias("total"))
    asked = test.select("point").distinct()
    near = nearest_points(known, asked, max(ks))
    # at most k rows per searched cell, slice and point reach this window
    order = Window.partitionBy("point").orderBy("distance", F.desc("n"), F.desc("total"))
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = near.withColumn("before", before)

    def mean(k: int) -> Column:
        used = F.greatest(F.least(F.col("n"), F.lit(k) - F.col("before")), F.lit(0))
        return F.sum(used * F.col("total") / F.col("n")) / F.sum(used)

    return counted.groupBy("point").agg(*[mean(k).alias(f"knn_{k}") for k in ks])


def predict_neighbours(
    train: DataFrame, test: DataFrame, cfg: ForecastConfig, ks: Sequence[int] = (3, 5, 7)
) -> DataFrame:
    """The test rows with a raw prediction ``knn_<k>`` for each number of neighbours."""
    encoding = fit_encoding(train, cfg)
    known, asked = with_points(train, encoding, cfg), with_points(test, encoding, cfg)
    return asked.join(nearest_means(known, asked, ks, cfg.target), "point", "left").drop("point")
