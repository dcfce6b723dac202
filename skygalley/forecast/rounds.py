"""The loss after each round of boosting, without the jobs of a fit: one task grows all trees over cells that are added up.

The trees are those of Spark's boosting (variance gain over weighted bins, the first of equal splits, log loss or squared
error, the first tree unshrunk), to the rounding of sums. All that a cell adds to a histogram are three sums for the rows to
learn from and three for those held back, so its labels need no rows of their own. Cells are as many as the thresholds
leave combinations of bins, however many rows there are; callers fit with Spark where that is too many for a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells of one task: some 200 bytes each while trees grow.
MOST_TASK_CELLS = 1_000_000
_SUMS = ("n", "y", "yy")
_PARTS = {"early": "not held_back", "late": "held_back"}


def cell_sums(cells: DataFrame, bins: Sequence[str], label: str) -> DataFrame:
    """One row per combination of bins: weight and weighted sums of label and squared label, of rows not held back and held back."""
    y = F.col(label)
    sums = [
        F.coalesce(F.sum(F.when(F.expr(part), F.col("weight") * value)), F.lit(0.0)).alias(f"{name}_{s}")
        for name, part in _PARTS.items()
        for s, value in zip(_SUMS, (F.lit(1.0), y, y * y))
    ]
    return cells.groupBy(*[F.col(b).cast("int").alias(b) for b in bins]).agg(*sums)


def grow(x: np.ndarray, weight: np.ndarray, target: np.ndarray, depth: int, bins: int) -> np.ndarray:
    """The values that one tree gives to cells with bins ``x``; ``target`` is the weighted sum of what it learns."""
    count, features = x.shape
    value = np.full(count, target.sum() / weight.sum())
    node, nodes = np.zeros(count, np.int64), 1
    cells = np.arange(count)
    for _ in range(depth):
        best = np.zeros(nodes)
        feature, cut = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        left, right = np.zeros(nodes), np.zeros(nodes)
        every = np.arange(nodes)
        # closed cells are numbered ``nodes``: their histogram is cut off
        first, size = node * bins, (nodes + 1) * bins
        for f in range(features):
            at = first + x[:, f]
            n = np.bincount(at, weight, size)[: nodes * bins].reshape(nodes, bins).cumsum(axis=1)
            s = np.bincount(at, target, size)[: nodes * bins].reshape(nodes, bins).cumsum(axis=1)
            n_left, s_left = n[:, :-1], s[:, :-1]
            n_right, s_right = n[:, -1:] - n_left, s[:, -1:] - s_left
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = s_left**2 / n_left + s_right**2 / n_right - s[:, -1:] ** 2 / n[:, -1:]
            gain[(n_left <= 0) | (n_right <= 0)] = -np.inf
            k = gain.argmax(axis=1)
            won = gain[every, k] > best
            at_k = k[won]
            best[won], feature[won], cut[won] = gain[won, at_k], f, at_k
            left[won] = s_left[won, at_k] / n_left[won, at_k]
            right[won] = s_right[won, at_k] / n_right[won, at_k]
        split = np.append(best > 0, False)
        if not split.any():
            break
        opened = 2 * int(split.sum())
        child = np.where(split, 2 * split.cumsum() - 2, opened)
        feature, cut = np.append(feature, 0), np.append(cut, 0)
        goes_on = split[node]
        to_right = goes_on & (x[cells, feature[node]] > cut[node])
        new = np.where(to_right, np.append(right, 0.0)[node], np.append(left, 0.0)[node])
        value = np.where(goes_on, new, value)
        node, nodes = child[node] + to_right, opened
    return value


def losses(
    x: np.ndarray, sums: np.ndarray, classifies: bool, rate: float, depth: int, done: Callable[[list[float]], bool]
) -> list[float]:
    """The mean loss of the held-back rows after each round, until it is ``done``."""
    n, y, _, late_n, late_y, late_yy = sums
    late, bins, found = late_n.sum(), max(int(x.max(initial=0)) + 1, 2), []
    score = np.zeros(len(n))
    while not done(found):
        if classifies:  # labels 0 and 1 are -1 and 1 to the loss
            yes, no = y, n - y
            if not found:
                target = yes - no
            else:
                target = 4 * (yes / (1 + np.exp(2 * score)) - no / (1 + np.exp(-2 * score)))
        else:
            target = y if not found else 2 * (y - n * score)
        tree = grow(x, n, target, depth, bins)
        score = score + (rate if found else 1.0) * tree
        if classifies:
            loss = 2 * (late_y * np.logaddexp(0, -2 * score) + (late_n - late_y) * np.logaddexp(0, 2 * score))
        else:
            loss = late_yy - 2 * score * late_y + score**2 * late_n
        found.append(float(loss.sum() / late))
    return found


def _task(
    batches: Iterator[pa.RecordBatch], bins: Sequence[str], number: int, classifies: bool, rate: float, depth: int, done
) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches))
    x = np.column_stack([table[b].to_numpy() for b in bins]).astype(np.int32)
    sums = np.array([table[f"{part}_{s}"].to_numpy() for part in _PARTS for s in _SUMS])
    # cells in one order, so that sums round alike wherever the rows lay
    order = np.lexsort(x.T)
    found = losses(x[order], sums[:, order], classifies, rate, depth, done)
    rows = [np.full(len(found), number, np.int32), np.arange(1, len(found) + 1, dtype=np.int32), np.array(found)]
    yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["number", "round", "loss"])


def losses_by_round(sums: DataFrame, bins: Sequence[str], number: int, classifies: bool, rate: float, depth: int, done) -> DataFrame:
    """Rows (number, round, loss) of one setting: a plan of one task that holds the cells. ``done`` is asked with the losses so far."""
    task = partial(_task, bins=list(bins), number=number, classifies=classifies, rate=rate, depth=depth, done=done)
    return sums.coalesce(1).mapInArrow(task, "number int, round int, loss double")
