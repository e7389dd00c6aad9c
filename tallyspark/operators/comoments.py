"""Pairwise-complete correlation of thousands of series.

Series are dealt to tiles.  Each (time block, tile) becomes one dense matrix with NaN for
what is missing; for two tiles, six matrix products with the presence masks give, for all
their pairs at once, the number of common rows and the sums that a correlation needs.
Sums of the time blocks are added per pair.  Memory of a task is two matrices of
``BLOCK`` x ``TILE`` numbers and the products, whatever the table holds, and no plan grows
with the number of series.

Rank correlations need a pair's whole common history in one place: Spearman ranks the
common rows (average ranks for ties), Kendall's tau-b counts inversions by merging.  There
the time block is the whole range and a tile holds ``RANK_TILE`` series.

A pair without common rows gives no row; one of which a side does not vary gives NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE, RANK_TILE = 256, 32
FEW = 32  # series that a plain join by time serves: at most FEW x FEW rows a time
BLOCK = 1024  # distinct times of a block: days since 1970 over this number
_SUMS = ["n", "sa", "sb", "saa", "sbb", "sab"]


def pair_sums(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Per column of ``x`` and column of ``y``: common rows, sums, sums of squares, sum of products."""
    here, there = ~np.isnan(x), ~np.isnan(y)
    mx, my = here.astype(float), there.astype(float)
    x, y = np.where(here, x, 0.0), np.where(there, y, 0.0)
    return [mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y]


def inversions(values: np.ndarray) -> int:
    """Pairs i < j with values[i] > values[j], counted while runs of doubling length are merged."""
    ranks = np.unique(values, return_inverse=True)[1].astype(np.int64)
    n, span, total, width = len(ranks), int(ranks.max(initial=0)) + 1, 0, 1
    at = np.arange(n)
    while width < n:
        run = at // (2 * width)
        left = (at // width) % 2 == 0
        keys = run * span + ranks  # sorted within each run half, and runs ascend
        lefts, rights = keys[left], keys[~left]
        starts = np.searchsorted(run[left], run[~left], side="right")  # lefts up to the end of the right's own run
        total += int((starts - np.searchsorted(lefts, rights, side="right")).sum())
        ranks = ranks[np.argsort(keys, kind="stable")]
        width *= 2
    return total


def kendall_tau_b(x: np.ndarray, y: np.ndarray) -> float:
    """Concordant less discordant pairs over the root of the pairs untied in x times those untied in y; NaN if a side is constant."""
    n = len(x)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    tied = lambda *cols: sum(c * (c - 1) // 2 for c in np.unique(np.stack(cols), axis=1, return_counts=True)[1].tolist())
    pairs, in_x, in_y, in_both = n * (n - 1) // 2, tied(x), tied(y), tied(x, y)
    if pairs in (in_x, in_y):
        return math.nan
    # ordered by (x, y), a pair tied in x or y is no inversion of y
    discordant = inversions(y)
    concordant = pairs - in_x - in_y + in_both - discordant
    return (concordant - discordant) / math.sqrt((pairs - in_x) * (pairs - in_y))


def average_ranks(x: np.ndarray) -> np.ndarray:
    _, at, counts = np.unique(x, return_inverse=True, return_counts=True)
    last = np.cumsum(counts)
    return (last - (counts - 1) / 2.0)[at]


def _rank_correlation(x: np.ndarray, y: np.ndarray, method: str) -> float:
    if method == "kendall":
        return kendall_tau_b(x, y)
    x, y = average_ranks(x), average_ranks(y)
    x, y = x - x.mean(), y - y.mean()
    spread = math.sqrt((x @ x) * (y @ y))
    return float(x @ y) / spread if spread else math.nan


def _pearson() -> Column:
    """The correlation from the sums of a pair; NULL where a side does not vary beyond rounding."""
    def spread(s: str, ss: str) -> Column:
        left = F.col(ss) - F.col(s) * F.col(s) / F.col("n")
        return F.when(left > F.col(ss) * 1e-12, left)

    r = (F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / F.sqrt(spread("sa", "saa") * spread("sb", "sbb"))
    return F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)


def _matrices(rows: pd.DataFrame) -> tuple[list, list]:
    """The names and aligned matrices of the one or two tiles of a group."""
    times = [np.asarray(t, np.int64) for t in rows["times"]]
    names = [list(n) for n in rows["names"]]
    dense = [np.frombuffer(v, "<f8").reshape(len(t), len(n)) for v, t, n in zip(rows["cells"], times, names)]
    if len(dense) == 2:
        _, i, j = np.intersect1d(times[0], times[1], assume_unique=True, return_indices=True)
        dense = [dense[0][i], dense[1][j]]
    return names, dense


def _tiles(long: DataFrame, series: str, time: str, value: str, tile: int, block: int | None) -> tuple[DataFrame, int]:
    """(block, tile, names, times, cells): one dense matrix per time block and tile of series."""
    n = long.select(series).distinct().count()
    n_tiles = max(1, math.ceil(n / tile))
    number = F.unix_date(F.col(time).cast("date")).cast("long") if dict(long.dtypes)[time] in ("date", "timestamp", "timestamp_ntz") \
        else F.col(time).cast("long")
    cells = long.select(
        F.col(series).alias("s"), number.alias("t"), F.col(value).cast("double").alias("v"),
        F.pmod(F.xxhash64(F.col(series).cast("string")), F.lit(n_tiles)).cast("int").alias("tile"),
        (F.floor(number / block) if block else F.lit(0).cast("long")).alias("block"))

    def dense(rows: pd.DataFrame) -> pd.DataFrame:
        names, col = np.unique(rows["s"].to_numpy(str), return_inverse=True)
        times, line = np.unique(rows["t"].to_numpy(np.int64), return_inverse=True)
        m = np.full((len(times), len(names)), np.nan)
        m[line, col] = rows["v"].to_numpy(float)
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "tile": [rows["tile"].iloc[0]], "names": [list(names)],
                             "times": [times], "cells": [m.astype("<f8").tobytes()]})

    return cells.groupBy("block", "tile").applyInPandas(
        dense, "block long, tile int, names array<string>, times array<bigint>, cells binary"), n_tiles


def _tile_pairs(tiles: DataFrame, n_tiles: int) -> DataFrame:
    """Every tile with every partner of its block, keyed by the pair, smaller tile first."""
    other = F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("other")
    return tiles.select("*", other).withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).drop("other")


def _listed(names: list, is_own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the pairs of a product, each unordered pair once."""
    if is_own:
        return np.triu_indices(len(names[0]))
    i, j = np.indices((len(names[0]), len(names[1])))
    return i.ravel(), j.ravel()


def _joined_sums(shifted: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """The sums of every pair of at most ``FEW`` series, by joining each time's few rows."""
    side = lambda s, v: shifted.select(F.col(time).alias("t"), F.col(series).cast("string").alias(s), F.col(value).alias(v))
    u, w = F.col("u"), F.col("w")
    return side("x", "u").join(side("y", "w"), "t").where("x <= y").groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum(u).alias("sa"), F.sum(w).alias("sb"), F.sum(u * u).alias("saa"),
        F.sum(w * w).alias("sbb"), F.sum(u * w).alias("sab"))


def _tiled_sums(shifted: DataFrame, series: str, time: str, value: str, tile: int, block: int) -> DataFrame:
    """The sums of every pair of any number of series, by products of tiles."""
    tiles, n_tiles = _tiles(shifted, series, time, value, tile, block)
    schema = "x string, y string, " + ", ".join(f"{c} double" for c in _SUMS)

    def products(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["a"].iloc[0] == rows["b"].iloc[0]
        if not own and len(rows) < 2:
            return pd.DataFrame({"x": pd.Series([], dtype=object), "y": pd.Series([], dtype=object),
                                 **{c: pd.Series([], dtype=float) for c in _SUMS}})
        names, dense = _matrices(rows)
        i, j = _listed(names, own)
        sums = pair_sums(dense[0], dense[-1])
        x, y = (pd.Series(np.array(nm, object)[at], dtype=object) for nm, at in ((names[0], i), (names[-1], j)))
        out = pd.DataFrame({"x": x, "y": y, **{c: s[i, j] for c, s in zip(_SUMS, sums)}})
        return out[out["n"] > 0]

    sums = _tile_pairs(tiles, n_tiles).groupBy("block", "a", "b").applyInPandas(products, schema)
    # of two tiles either may come first: one order of the names, so that blocks add up
    swap = F.col("x") > F.col("y")
    pick = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    return sums.select(pick("x", "y").alias("x"), pick("y", "x").alias("y"), "n", pick("sa", "sb").alias("sa"),
                        pick("sb", "sa").alias("sb"), pick("saa", "sbb").alias("saa"), pick("sbb", "saa").alias("sbb"),
                        "sab").groupBy("x", "y").agg(*[F.sum(c).alias(c) for c in _SUMS])


def pair_correlations(long: DataFrame, series: str, time: str, value: str, method: str = "pearson", tile: int | None = None,
                      block: int = BLOCK) -> DataFrame:
    """(a, b, n, correlation) of all ordered pairs of series of ``long``, the diagonal included.

    (series, time) must be unique.  NULL and NaN values count as missing.
    """
    long = long.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(series).isNotNull())
    if method == "pearson":
        # a shift per series keeps the sums small next to their differences; it changes no correlation
        centre = long.groupBy(F.col(series).alias("_s")).agg(F.avg(F.col(value).cast("double")).alias("_mu"))
        shifted = long.join(centre, F.col(series) == F.col("_s")).select(
            F.col(series), F.col(time), (F.col(value).cast("double") - F.col("_mu")).alias(value))
        few = tile is None and shifted.select(series).distinct().limit(FEW + 1).count() <= FEW
        total = _joined_sums(shifted, series, time, value) if few else _tiled_sums(shifted, series, time, value, tile or TILE, block)
        half = total.select("x", "y", F.col("n").cast("long").alias("n"), _pearson().alias("r"))
    elif method in ("spearman", "kendall"):
        tiles, n_tiles = _tiles(long, series, time, value, tile or RANK_TILE, None)

        def ranked(rows: pd.DataFrame) -> pd.DataFrame:
            own, out = rows["a"].iloc[0] == rows["b"].iloc[0], []
            if own or len(rows) == 2:
                names, dense = _matrices(rows)
                for i, j in zip(*_listed(names, own)):
                    x, y = dense[0][:, i], dense[-1][:, j]
                    both = ~(np.isnan(x) | np.isnan(y))
                    if both.any():
                        out.append((names[0][i], names[-1][j], int(both.sum()), _rank_correlation(x[both], y[both], method)))
            return pd.DataFrame(out, columns=["x", "y", "n", "r"], dtype=object)

        half = _tile_pairs(tiles, n_tiles).groupBy("block", "a", "b").applyInPandas(ranked, "x string, y string, n long, r double")
        half = half.withColumn("r", F.when(~F.isnan("r"), F.col("r")))
    else:
        raise ValueError("method must be pearson, spearman or kendall")
    sides = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")))).otherwise(
        F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")), F.struct(F.col("y").alias("a"), F.col("x").alias("b"))))
    return half.select(F.inline(sides), "n", F.col("r").alias("correlation"))


def column_correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, n, correlation) of all ordered pairs of numeric columns, pairwise complete.

    Rows stay where they are: each task multiplies its batches and puts out one row per
    pair of columns.
    """
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    means = df.agg(*[F.avg(F.when(~F.isnan(x[c]), x[c])).alias(f"m{i}") for i, c in enumerate(cols)]).first()  # one row
    shift = np.array([m or 0.0 for m in means])
    wide = df.select(*[x[c].alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            m = batch.to_numpy(float) - shift
            sums = np.array(pair_sums(m, m))
            total = sums if total is None else total + sums
        if total is not None:
            i, j = np.indices(total.shape[1:])
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), **{c: s.ravel() for c, s in zip(_SUMS, total)}})

    sums = wide.mapInPandas(run, "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS)) \
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS]).where("n > 0")
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.col("n").cast("long").alias("n"),
                       _pearson().alias("correlation"))
