"""Profiling and sampling operators.

Whole-table statistics are single aggregates; histograms are one ``groupBy`` on a
computed bin; samples are deterministic functions of a key hash (never of
physical row order); the top-n sample ranks rows with the distributed cumulative
counts, the stratified split takes each class's cut by counts of sub-ranges, instead of
a driver-side or single-task sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.operators.ranking import cumulative_before
from tallyspark.operators.selection import exact_quantiles
from tallyspark.session import materialize

HASH_HEX_DIGITS = 15  # 60 bits of the md5 digest: order-equivalent to the hex text


def key_hash(key, salt: str = "") -> Column:
    """md5(key || salt) as a non-negative 60-bit integer (same order as the hex digest)."""
    k = F.col(key) if isinstance(key, str) else key
    txt = F.concat(k.cast("string"), F.lit(salt)) if salt else k.cast("string")
    return F.conv(F.substring(F.md5(txt), 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def missing_pct(df: DataFrame, top_n: int | None = None, digits: int = 4) -> DataFrame:
    """Percent NULL per column, only > 0, sorted descending (one aggregate)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}")
                                                  for i, c in enumerate(cols)])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)])
    long = row.select("_n", F.inline(items)).where(F.col("missing") > 0)
    out = long.select("column", F.round(F.col("missing") * 100.0 / F.col("_n"), digits).alias("missing_pct"))
    out = out.orderBy(F.desc("missing_pct"), "column")
    return out.limit(top_n) if top_n else out


def inventory(datasets: dict[str, DataFrame], digits: int = 4) -> DataFrame:
    """Rows, columns, dtype and percent missing per (dataset, column)."""
    parts = []
    for name, df in datasets.items():
        cols = df.columns
        types = dict(df.dtypes)
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}")
                                                      for i, c in enumerate(cols)])
        items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"m{i}").alias("missing"))
                          for i, c in enumerate(cols)])
        parts.append(row.select("_n", F.inline(items)).select(
            F.lit(name).alias("dataset"), F.col("_n").cast("bigint").alias("n_rows"),
            F.lit(len(cols)).cast("bigint").alias("n_columns"), "column", "dtype",
            F.round(F.col("missing") * 100.0 / F.col("_n"), digits).alias("missing_pct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, std, min, quartiles (exact, interpolated), max per column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("_s")).select("_s.column", "_s.v")
    base = long.groupBy("column").agg(F.count("v").cast("bigint").alias("count"), F.avg("v").alias("mean"),
                                      F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(long, "v", [0.25, 0.5, 0.75], keys=["column"])
    qw = q.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    qw = qw.select("column", *[F.col(f"`{c}`").alias(n) for c, n in (("0.25", "p25"), ("0.5", "p50"), ("0.75", "p75"))])
    out = base.join(qw, "column")
    return out.select("column", "count", *[F.round(c, digits).alias(c) for c in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


def summary_stats(df: DataFrame, col: str, q: float = 0.99, digits: int = 6) -> DataFrame:
    """Median, mean, p99, max, share of zeros, share exactly at the max (cap)."""
    x = F.col(col).cast("double")
    qs = exact_quantiles(df.select(x.alias("_x")), "_x", [0.5, q])
    qrow = qs.agg(F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("median"),
                  F.max(F.when(F.col("q") == q, F.col("quantile"))).alias("p99"))
    base = df.agg(F.avg(x).alias("mean"), F.max(x).alias("max"), F.count(x).alias("_n"),
                  F.count_if(x == 0).alias("_z"))
    at_cap = df.crossJoin(F.broadcast(base.select(F.col("max").alias("_mx")))).agg(
        F.count_if(x == F.col("_mx")).alias("_c"))
    j = base.crossJoin(qrow).crossJoin(at_cap)
    return j.select(F.round("median", digits).alias("median"), F.round("mean", digits).alias("mean"),
                    F.round("p99", digits).alias("p99"), F.round("max", digits).alias("max"),
                    F.round(F.col("_z") * 100.0 / F.col("_n"), digits).alias("zero_pct"),
                    F.round(F.col("_c") * 100.0 / F.col("_n"), digits).alias("at_cap_pct"))


def histogram(df: DataFrame, col: str, bins: int = 20, log_scale: bool = False, digits: int = 10) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), counts and density.

    ``log_scale`` bins log10(x) over x > 0.  Two passes: a one-row min/max, then
    one ``groupBy`` on the bin index.
    """
    x = F.col(col).cast("double")
    src = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    if log_scale:
        src = src.where(F.col("_x") > 0).select(F.log10("_x").alias("_x"))
    mm = src.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_N"))
    j = src.crossJoin(F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    g = j.groupBy(b.alias("bin"), "_lo", "_hi", "_N").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return g.select("bin", F.round(F.col("_lo") + F.col("bin") * w, digits).alias("bin_start"),
                    F.round(F.col("_lo") + (F.col("bin") + 1) * w, digits).alias("bin_end"), "n",
                    F.round(F.when(w > 0, F.col("n") / (F.col("_N") * w)), digits).alias("density"))


def block_sample(df: DataFrame, key: str, pct: float, salt: str = "") -> DataFrame:
    """L4: reproducible percent sample: keep rows whose key hash falls below pct%."""
    return df.where(key_hash(key, salt) < F.lit(int((pct / 100.0) * (16 ** HASH_HEX_DIGITS))))


def hash_top_n(df: DataFrame, key: str, n: int, salt: str = "") -> DataFrame:
    """The n rows with the smallest md5(key) (min(n, N) rows), distributed.

    Equivalent to ``ORDER BY md5(key) LIMIT n`` but ranks rows with cumulative
    counts over the hash values instead of merging n rows in one place.
    """
    h = df.withColumn("_h", key_hash(key, salt))
    counts = h.groupBy("_h").agg(F.count(F.lit(1)).cast("bigint").alias("_cnt"))
    cum = cumulative_before(counts, "_h", ["_cnt"])
    keep = cum.where(F.col("_cnt_before") < n).select("_h")
    return h.join(keep, "_h", "left_semi").drop("_h")


def class_cuts(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, salt: str = "42") -> DataFrame:
    """(label, _cut): the round(f * n_class)-th smallest key hash of each class, exactly.

    Hashes are not ranked: four aggregates over the hash and the label alone count equal
    sub-ranges, each within the one that the last chose (at most 2^15 counts a class).
    Rows without a key come first.  A class of which no keyed row is to be taken has no cut.
    """
    h = materialize(df.where(F.col(label).isNotNull()).select(label, key_hash(key, salt).alias("_h")))
    w = Window.partitionBy(label)
    cuts, width = None, HASH_HEX_DIGITS
    for shift in range(3 * width, -1, -width):
        digit = F.shiftright("_h", shift).bitwiseAND(F.lit((1 << width) - 1)).alias("_digit")
        within = h.withColumn("_cut", F.lit(0)) if cuts is None else h.join(cuts, label).where(
            F.shiftright("_h", shift + width) == F.col("_cut"))
        counts = within.groupBy(label, "_cut", digit).agg(F.count(F.lit(1)).cast("bigint").alias("_cnt"))
        counts = counts.withColumn("_upto", F.sum("_cnt").over(w.orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)))
        if cuts is None:
            counts = counts.withColumn("_nth", F.round(F.sum("_cnt").over(w) * test_fraction).cast("bigint"))
        else:
            counts = counts.join(cuts.select(label, "_nth"), label)
        found = counts.where((F.col("_nth") <= F.col("_upto")) & (F.col("_nth") > F.col("_upto") - F.col("_cnt")))
        cuts = materialize(found.select(label, (F.shiftleft(F.col("_cut").cast("bigint"), width) + F.col("_digit")).alias("_cut"),
                                        (F.col("_nth") - F.col("_upto") + F.col("_cnt")).alias("_nth")))  # one row per class
    return cuts.drop("_nth")


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, salt: str = "42",
                     cuts: DataFrame | None = None) -> DataFrame:
    """Exact per-class test share: the round(f * n_class) rows of each class with the
    smallest key hash are 'test', the rest 'train'.  Rows are told by their class's cut
    (``class_cuts``, taken here unless given), so they are not shuffled."""
    if cuts is None:
        cuts = class_cuts(df, key, label, test_fraction, salt)
    h = df.withColumn("_h", key_hash(key, salt)).where(F.col(label).isNotNull() & F.col("_h").isNotNull())
    taken = F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))
    return h.join(cuts, label, "left").withColumn("split", F.when(taken, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_cut")


def bounded_values(df: DataFrame, column: str, max_values: int = 1000) -> list:
    """The distinct non-NULL values of a category column, sorted, on the driver.

    At most ``max_values`` may exist; more raise an error instead of filling the driver.
    """
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(max_values + 1).collect()
    if len(found) > max_values:
        raise ValueError(f"{column} has more than {max_values} values")
    return sorted(r[0] for r in found)
