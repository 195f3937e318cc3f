"""Whittaker smoothing of pixel series.

A series is put on a daily axis; observed days weigh 1 (or as given), the others
0; the smooth series z minimises the weighted misfit plus beta times the squared
third differences, that is, it solves (W + beta D'D) z = W y. The matrix has
seven diagonals and is factorised as L diag(d) L' for all series of a batch at
once that share their days.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import bands_of

ORDER = 3


def penalty(m: int, beta: float) -> np.ndarray:
    """beta D'D by diagonals: row ORDER + k has diagonal k; D takes third differences."""
    if m <= ORDER:
        return np.zeros((2 * ORDER + 1, m))
    d = np.array([-1.0, 3.0, -3.0, 1.0])
    out = np.zeros((2 * ORDER + 1, m))
    for k in range(-ORDER, ORDER + 1):
        i = np.arange(m)
        j = i + k
        for r0 in range(ORDER + 1):  # D'D[i, j] is the sum over rows r of D[r, i] D[r, j]
            r = i - r0
            c = j - r
            ok = (j >= 0) & (j < m) & (r >= 0) & (r < m - ORDER) & (c >= 0) & (c <= ORDER)
            out[ORDER + k, ok] += d[r0] * d[c[ok]]
    return beta * out


def solve(y: np.ndarray, w: np.ndarray, beta: float) -> np.ndarray:
    """z of each row of ``y`` [series, days] with weights ``w``; a row with fewer points than a parabola needs comes back as it is."""
    n, m = y.shape
    if m <= ORDER:
        return y.copy()
    band = penalty(m, beta)
    few = (w > 0).sum(1) < ORDER  # there the matrix is singular
    w = np.ascontiguousarray(np.where(few[:, None], 1.0, w).T)  # days first: each step works on all series side by side
    low, diag = np.zeros((ORDER, m, n)), np.empty((m, n))
    for j in range(m):
        for k in range(min(ORDER, j), 0, -1):
            v = np.full(n, band[ORDER - k, j])
            for q in range(k + 1, min(ORDER, j) + 1):
                v -= low[q - 1, j] * low[q - k - 1, j - k] * diag[j - q]
            low[k - 1, j] = v / diag[j - k]
        diag[j] = w[j] + band[ORDER, j]
        for k in range(1, min(ORDER, j) + 1):
            diag[j] -= low[k - 1, j] ** 2 * diag[j - k]
    z = np.where(w > 0, w * np.nan_to_num(y.T), 0.0)
    for j in range(m):
        for k in range(1, min(ORDER, j) + 1):
            z[j] -= low[k - 1, j] * z[j - k]
    z /= diag
    for j in range(m - 2, -1, -1):
        for k in range(1, min(ORDER, m - 1 - j) + 1):
            z[j] -= low[k - 1, j + k] * z[j + k]
    out = z.T.copy()
    out[few] = y[few]
    return out


STEP, CELLS = 32, 1 << 19


def smooth_rows(series: np.ndarray, day: np.ndarray, given: np.ndarray, values: np.ndarray, beta: float) -> np.ndarray:
    """Smoothed ``values`` of rows sorted by series (numbers from 0) and day.

    Series are solved side by side, padded to a common length: days without
    weight behind the last one cost nothing, since the curve goes on there.
    """
    first = np.flatnonzero(np.concatenate([[True], series[1:] != series[:-1]])) if len(series) else np.zeros(0, np.int64)
    at = day - day[first][series] if len(series) else day
    last = np.append(first[1:], len(series)) - 1
    size = -(-(at[last] + 1) // STEP) * STEP
    out = np.empty(len(values))
    for m in np.unique(size).tolist():
        some = np.flatnonzero(size == m)
        for lo in range(0, len(some), max(1, CELLS // m)):
            own = some[lo : lo + max(1, CELLS // m)]
            count = last[own] - first[own] + 1
            rows = np.repeat(first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            place = np.repeat(np.arange(len(own)), count), at[rows]
            y, w = np.full((len(own), m), np.nan), np.zeros((len(own), m))
            y[place], w[place] = values[rows], np.where(np.isnan(values[rows]), 0.0, given[rows])
            z = solve(y, w, beta)
            # a series without a weight stays as it is
            out[rows] = np.where(np.repeat(w.any(1), count), z[place], values[rows])
    return out


def smooth(df: DataFrame, beta: float = 1e4, weights: dict | None = None, bands: list[str] | None = None, series: tuple[str, ...] = ("y", "x"), time: str = "time") -> DataFrame:
    """Smoothed bands, one row for each series and observed day (``time`` becomes its midnight).

    ``weights`` gives days (ISO text) other weights than 1. Series are sorted into
    partitions, thousands of them are solved at once; rows of one day are averaged first.
    """
    names = bands or bands_of(df.drop(*series))
    daily = df.groupBy(*series, F.to_date(time).alias("day")).agg(*(F.avg(b).cast("double").alias(b) for b in names))
    known = np.array(sorted((np.datetime64(k, "D").astype(int), float(v)) for k, v in (weights or {}).items())).reshape(-1, 2)

    def run(batches):
        held: list[pa.RecordBatch] = []
        count = 0

        def solved(table: pa.Table) -> pa.Table:
            new = np.zeros(table.num_rows, bool)
            for s in series:
                c = table.column(s).to_pandas().to_numpy()
                gone = pd.isnull(c)
                new[1:] |= (c[1:] != c[:-1]) & ~(gone[1:] & gone[:-1])
            day = table.column("day").cast(pa.int32()).to_numpy().astype(np.int64)
            given = np.ones(len(day))
            if len(known):
                place = np.minimum(np.searchsorted(known[:, 0], day), len(known) - 1)
                given = np.where(known[place, 0] == day, known[place, 1], 1.0)
            for b in names:
                values = table.column(b).to_numpy()
                out = smooth_rows(np.cumsum(new), day, given, values, beta)
                table = table.set_column(table.schema.get_field_index(b), b, pa.array(out, pa.float64(), from_pandas=True))
            return table

        def whole(last: bool):
            """What is held, without its last series if that may go on."""
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            stop = table.num_rows
            if not last:
                tail = [table.column(s)[stop - 1].as_py() for s in series]
                lo = stop - 1
                while lo and all(table.column(s)[lo - 1].as_py() == t for s, t in zip(series, tail, strict=True)):
                    lo -= 1
                stop = lo
            held = table.slice(stop).to_batches()
            return solved(table.slice(0, stop)).to_batches() if stop else []

        for b in batches:
            if b.num_rows:
                held.append(b)
                count += b.num_rows
                if count * 4 > CELLS // 8:
                    yield from whole(False)
                    count = sum(x.num_rows for x in held)
        if held:
            yield from whole(True)

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{s}` {kinds[s]}" for s in series), "day date", *(f"`{b}` double" for b in names)])
    return daily.repartition(*series).sortWithinPartitions(*series, "day").mapInArrow(run, schema)
