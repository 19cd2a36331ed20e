"""Feature rows as sorted (index, value) pairs: zeros are left out, so the width costs nothing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "struct<at:array<int>,x:array<double>>"


def sparse(values: Column) -> Column:
    """An array of doubles as ``ROW``."""
    pairs = F.filter(
        F.transform(values, lambda x, i: F.struct(i.cast("int").alias("at"), x.cast("double").alias("x"))),
        lambda p: p["x"] != 0,
    )
    return F.struct(pairs["at"].alias("at"), pairs["x"].alias("x"))


def is_sparse(df: DataFrame, column: str = "features") -> bool:
    return dict(df.dtypes)[column].startswith("struct")


def value_at(df: DataFrame, index: int, column: str = "features") -> Column:
    """One feature of a row, in either form."""
    if not is_sparse(df, column):
        return F.get(F.col(column), F.lit(index))
    place = F.array_position(F.col(f"{column}.at"), F.lit(index)).cast("int") - 1
    return F.coalesce(F.get(F.col(f"{column}.x"), place), F.lit(0.0))


@dataclass(frozen=True)
class Rows:
    """The non-zero entries (row, at, x) of ``n`` rows, in the order of rows and indices; row i has ptr[i]..ptr[i+1]."""

    n: int
    ptr: np.ndarray
    at: np.ndarray
    x: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> "Rows":
        """From an Arrow column of ``ROW`` structs, or of equally long lists."""
        n = len(column)
        if pa.types.is_struct(column.type):
            at, x = column.field("at"), column.field("x")
            sizes = np.asarray(at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            ptr = np.r_[0, np.cumsum(sizes)]
            return Rows(n, ptr, at.flatten().to_numpy(zero_copy_only=False), x.flatten().to_numpy(zero_copy_only=False))
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))
        row, at = np.nonzero(values)
        return Rows(n, np.r_[0, np.cumsum(np.bincount(row, minlength=n))], at.astype(np.int32), values[row, at])

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.ptr))

    def columns(self, features: np.ndarray) -> np.ndarray:
        """The values of some features (sorted, distinct), one column each."""
        out = np.zeros((self.n, len(features)))
        if len(features):
            to = np.minimum(np.searchsorted(features, self.at), len(features) - 1)
            hit = features[to] == self.at
            out[self.row[hit], to[hit]] = self.x[hit]
        return out

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, entry) of every entry of the given rows."""
        size = self.ptr[rows + 1] - self.ptr[rows]
        place = np.repeat(np.arange(len(rows)), size)
        return place, np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.ptr[rows], size)

    def take(self, rows: np.ndarray) -> "Rows":
        """The given rows alone."""
        _, entry = self.entries(rows)
        return Rows(len(rows), np.r_[0, np.cumsum(self.ptr[rows + 1] - self.ptr[rows])], self.at[entry], self.x[entry])


#: Rows that walk down the trees together: few enough for their values to stay in a processor's cache.
WALKED = 2048


class Walk:
    """Trees as padded arrays, one row per tree (feature -1: a leaf), for finding the leaves of many rows.

    Every row takes as many steps as its tree is deep, a leaf leading to itself: to sort out
    the rows that have arrived costs more than to move them.
    """

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray):
        node = np.broadcast_to(np.arange(feature.shape[1] if feature.size else 0), feature.shape)
        inner = feature >= 0
        # Places as small numbers: a model is sent to every worker.
        self.feature, self.threshold = np.where(inner, feature, 0).astype(np.int32), threshold
        # Per node its right child and then its left one, as a comparison numbers them.
        self.next = np.stack([np.where(inner, right, node), np.where(inner, left, node)], axis=-1).astype(np.int32)
        self.next = self.next.reshape(len(feature), -1)
        self.depth = np.zeros(len(feature), np.int64)
        at = np.zeros((len(feature), 1), np.int64)
        while at.size and (going := np.take_along_axis(inner, at, axis=1)).any():
            self.depth += going.any(axis=1)
            # The inner nodes of a level come first; those of the widest tree are the columns.
            at = np.take_along_axis(at, np.argsort(~going, axis=1, kind="stable")[:, : going.sum(axis=1).max()], axis=1)
            at = np.take_along_axis(self.next, np.hstack([2 * at, 2 * at + 1]), axis=1)

    def leaves(self, x: np.ndarray) -> Iterator[tuple[slice, int, np.ndarray]]:
        """(some rows, tree, the node at which each of them ends) for all rows of a matrix and all trees, in order."""
        for first in range(0, len(x), WALKED):
            rows = slice(first, min(first + WALKED, len(x)))
            part = np.ascontiguousarray(x[rows])
            base, flat = np.arange(len(part)) * part.shape[1], part.ravel()
            for t in range(len(self.feature)):
                feature, threshold, following = self.feature[t], self.threshold[t], self.next[t]
                at = np.zeros(len(part), np.int64)
                for _ in range(self.depth[t]):
                    goes = flat.take(base + feature.take(at)) <= threshold.take(at)
                    at = following.take(2 * at + goes)
                yield rows, t, at


def lists(values: np.ndarray, known: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists, at the places that ``known`` marks; null elsewhere."""
    offsets = np.r_[0, np.cumsum(np.where(known, values.shape[1], 0))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(~known))
