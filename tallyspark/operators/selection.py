"""Exact order statistics by radix selection: no task ever orders values.

A first pass counts the rows of all columns and groups by sign and binary exponent, one
partial aggregate.  Each further round cuts the range that holds a wanted rank into equal
sub-ranges, counts the rows in them and descends into one.  Only counts leave a task, at
most ``MAX_ROWS`` of them in all, whatever the number of rows.  A range whose smallest and
largest value agree is the answer, so a value that a third of the rows hold ends its
search; distinct values need about log2(rows) / 13 rounds, at most five (a binary exponent
leaves 52 bits).  Ranges that together hold no more than ``MAX_ROWS`` rows are fetched.

Any function that never decreases may cut a range, so rounding in the cut moves a value to
a neighbouring sub-range at worst, and never past another one.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ranking import range_quantiles

#: Counts, or values, that a round may bring to the driver.
MAX_ROWS = 1 << 16
MAX_CELLS = 1 << 13  # sub-ranges of one range


def exponent_cell(x: Column) -> Column:
    """Sign and binary exponent as an int that never decreases with the value; 0 for zero, NaN last."""
    exponent = F.floor(F.least(F.log2(F.abs(x)), F.lit(1100.0))) + 1100  # at least 25
    return F.when(F.isnan(x), 9999).when(x == 0, 0).otherwise(F.signum(x) * exponent).cast("int")


class _Range:
    """Rows of one group between two values: what a rank is looked for in."""

    def __init__(self, group: tuple, cell: int, lo: float, hi: float, count: int):
        self.group, self.cell, self.lo, self.hi, self.count = group, cell, lo, hi, count
        self.ranks: list[tuple[int, int]] = []  # (rank in the group, rank in the range)

    def is_one_value(self) -> bool:
        return self.lo == self.hi or self.lo != self.lo


def _placed(parts: list[_Range], ranks: Iterable[tuple[int, int]]) -> list[_Range]:
    """The ranges, ascending, that hold a rank, with the ranks counted from their start."""
    starts = [0, *accumulate(p.count for p in parts)]
    for name, left in ranks:
        at = bisect_right(starts, left) - 1
        parts[at].ranks.append((name, left - starts[at]))
    return [p for p in parts if p.ranks]


def select_ranks(long: DataFrame, keys: list[str], value: str, ranks: Callable[[tuple, int, int], Iterable[int]]
                 ) -> tuple[dict[tuple, tuple[int, int]], dict[tuple, float]] | None:
    """Order statistics of ``value`` per group of ``keys``.

    ``ranks(group, n, n_null)`` names the ranks wanted, from 0; those outside the group's
    values are left out.  Returns {group: (n, n_null)} and {(group, rank): value}, or None
    if the groups are too many for their counts to be fetched.
    """
    spark = long.sparkSession
    data = long.select(*keys, F.col(value).cast("double").alias("_x")).withColumn("_cell", exponent_cell(F.col("_x")))
    found = [F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    rows = data.groupBy(*keys, "_cell").agg(*found).limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        return None
    sizes, parts, values = {}, {}, {}
    for r in sorted(rows, key=lambda r: (r._cell is not None, r._cell)):
        group = tuple(r[k] for k in keys)
        n, m = sizes.get(group, (0, 0))
        sizes[group] = (n, m + r._c) if r._cell is None else (n + r._c, m)
        if r._cell is not None:
            parts.setdefault(group, []).append(_Range(group, r._cell, r._lo, r._hi, r._c))
    open_ = []
    for group, (n, m) in sizes.items():
        wanted = sorted({int(r) for r in ranks(group, n, m) if 0 <= r < n})
        open_ += _placed(parts.get(group, []), [(r, r) for r in wanted])
    schema = long.select(*keys).schema.add("_cell2", "integer").add("_lo", "double").add("_hi", "double").add("_id", "integer")
    while True:
        for p in open_:
            if p.is_one_value():
                values.update({(p.group, name): p.lo for name, _ in p.ranks})
        open_ = [p for p in open_ if not p.is_one_value()]
        if not open_:
            return sizes, values
        table = spark.createDataFrame([(*p.group, p.cell, p.lo, p.hi, i) for i, p in enumerate(open_)], schema)
        table = table.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], "_cell2", "_lo", "_hi", "_id")
        on = (F.col("_cell") == F.col("_cell2")) & F.col("_x").between(F.col("_lo"), F.col("_hi"))
        for i, k in enumerate(keys):
            on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
        inside = data.join(F.broadcast(table), on)  # at most MAX_ROWS / 16 ranges
        if sum(p.count for p in open_) <= MAX_ROWS:
            held: dict[int, list] = {}
            for r in inside.groupBy("_id", "_x").agg(F.count(F.lit(1)).alias("_c")).collect():
                held.setdefault(r._id, []).append(_Range((), 0, r._x, r._x, r._c))
            open_ = [_regrouped(q, p) for i, p in enumerate(open_)
                     for q in _placed(sorted(held[i], key=lambda q: q.lo), p.ranks)]
            continue
        cells = max(16, min(MAX_CELLS, MAX_ROWS // len(open_)))
        sub = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * cells)
        hist: dict[int, list] = {}
        for r in inside.groupBy("_id", sub.alias("_sub")).agg(*found).collect():
            hist.setdefault(r._id, []).append((r._sub, _Range((), 0, r._lo, r._hi, r._c)))
        open_ = [_regrouped(q, p) for i, p in enumerate(open_)
                 for q in _placed([q for _, q in sorted(hist[i], key=lambda x: x[0])], p.ranks)]


def _regrouped(part: _Range, of: _Range) -> _Range:
    part.group, part.cell = of.group, of.cell
    return part


def exact_quantiles(df: DataFrame, value: str, qs: Iterable[float], keys: Iterable[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles (PERCENTILE_CONT) of ``value`` per group of ``keys``, or of all rows.

    Returns (keys..., q, quantile); NULL values do not count, and groups of them alone
    give no row.  Groups too many to be counted on the driver take the range pass.
    """
    keys, qs, spark = list(keys), [float(q) for q in qs], df.sparkSession
    got = select_ranks(df, keys, value, lambda g, n, m: [r for q in qs for r in quantile_ends(n, q)])
    if got is None:
        return range_quantiles(df, value, qs, keys=keys)
    sizes, values = got
    rows = [(*g, q, interpolate(lambda r, g=g: values[g, r], n, q)) for g, (n, _) in sizes.items() for q in qs if n]
    return spark.createDataFrame(rows, df.select(*keys).schema.add("q", "double").add("quantile", "double"))


def column_ranks(df: DataFrame, cols: list[str], ranks: Callable[[str, int, int], Iterable[int]]) -> tuple[dict, dict]:
    """Order statistics of several columns in shared passes over the wide table.

    ``ranks(column, n, n_null)`` names the ranks wanted.  Returns {column: (n, n_null)}
    and {(column, rank): value}: as many numbers as were asked for.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])))
    sizes, values = select_ranks(long, ["column"], "v", lambda g, n, m: ranks(g[0], n, m))
    counts = {c: sizes.get((c,), (0, 0)) for c in cols}
    return counts, {(g[0], r): v for (g, r), v in values.items()}


def interpolate(at: Callable[[int], float], n: int, q: float) -> float | None:
    """The quantile ``q`` of ``n`` values of which ``at`` gives one by rank."""
    if not n:
        return None
    h = (n - 1) * q
    lo, hi = at(math.floor(h)), at(math.ceil(h))
    return lo + (hi - lo) * (h - math.floor(h))


def quantile_ends(n: int, q: float) -> list[int]:
    h = (n - 1) * q
    return [math.floor(h), math.ceil(h)] if n else []


def exact_quantiles_wide(df: DataFrame, cols: list[str], qs: Iterable[float]) -> DataFrame:
    """Quantiles of many columns at once, (column, q, quantile); a column without values gives no row."""
    qs = [float(q) for q in qs]
    counts, values = column_ranks(df, cols, lambda c, n, m: [r for q in qs for r in quantile_ends(n, q)])
    rows = [(c, q, interpolate(lambda r, c=c: values[c, r], counts[c][0], q)) for c in cols for q in qs if counts[c][0]]
    return df.sparkSession.createDataFrame(rows, "column string, q double, quantile double")


def medians_and_clips(df: DataFrame, impute: list[str], clip: list[str], lower: float, upper: float) -> tuple[dict, dict]:
    """Medians of ``impute`` and the [lower, upper] quantiles of ``clip`` as they are after imputation, in one selection.

    Placing m copies of the median M into a sorted column moves no value past another:
    the value at rank r is then the old one at r if that is below M, the old one at
    r - m if that is above M, and M otherwise.  So the bounds after imputation need
    only old ranks, and no pass over the imputed table.
    """
    def wanted(c: str, n: int, m: int) -> list[int]:
        ranks = quantile_ends(n, 0.5) if c in impute else []
        if c in clip:
            added = m if c in impute else 0
            for q in (lower, upper):
                for r in quantile_ends(n + added, q):
                    ranks += [r, r - added]
        return ranks

    counts, values = column_ranks(df, list(dict.fromkeys([*impute, *clip])), wanted)
    medians = {c: interpolate(lambda r, c=c: values[c, r], counts[c][0], 0.5) for c in impute}

    def bound(c: str, q: float) -> float | None:
        n, m = counts[c]
        if c not in impute:
            return interpolate(lambda r: values[c, r], n, q)

        def at(r: int) -> float:
            if r < n and values[c, r] < medians[c]:
                return values[c, r]
            return values[c, r - m] if r >= m and values[c, r - m] > medians[c] else medians[c]

        return interpolate(at, n + m if n else 0, q)

    return medians, {c: (bound(c, lower), bound(c, upper)) for c in clip}
