"""Distributed order statistics without a single-partition sort.

``percent_rank() OVER (ORDER BY x)`` and ``ORDER BY ... LIMIT`` over a whole table
plan as ``Exchange SinglePartition``: every row goes through one task.  The
helpers here get the same exact answers with bounded per-task work:

1. collapse the input to one row per distinct value (partial + final hash
   aggregate, so a hot value costs one row, not a third of the table);
2. cut the distinct values into ``n`` value ranges using approximate quantile
   bounds (a one-row aggregate, ``n`` numbers);
3. exclusive running sums inside each range (one window task per range) plus a
   per-range offset from an ``n``-row table (broadcast: its size is ``n``).

Every step is a deterministic function of the data, so a lost executor
recomputes the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.session import materialize

BUCKET = "_rng"


def _n_buckets(df: DataFrame, n: int | None) -> int:
    if n:
        return max(1, int(n))
    try:
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # noqa: BLE001
        return 200


def _few(table: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """A written table, marked for broadcast only if it is counted small; else Spark's own choice of join."""
    return F.broadcast(table) if table.count() <= max_rows else table


def bounds_below(bounds: Column, x: Column, n: int) -> Column:
    """How many of ``n`` ascending bounds are below ``x``, by binary search."""
    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.get(bounds, middle) < x
        return F.when(at["lo"] >= at["hi"], at).when(below, F.struct((middle + 1).alias("lo"), at["hi"].alias("hi"))).otherwise(
            F.struct(at["lo"].alias("lo"), middle.alias("hi")))

    steps = max(1, n.bit_length())
    return F.aggregate(F.array(*[F.lit(0)] * steps), F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi")), halve, lambda at: at["lo"])


def value_counts(df: DataFrame, value: str, sums: dict[str, Column] | None = None,
                 keys: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per distinct non-NULL ``value`` (of each group of ``keys``) with ``_cnt`` and extra per-value sums."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("_cnt")]
    for name, expr in (sums or {}).items():
        aggs.append(F.sum(expr).cast("bigint").alias(name))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs)


def cumulative_before(distinct: DataFrame, value: str, cols: list[str], n_buckets: int | None = None,
                      keys: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """For a table with one row per distinct (``keys``, ``value``), add ``<c>_before`` =
    sum of ``c`` over rows of the same key with a strictly smaller value."""
    keys = list(keys)
    n = _n_buckets(distinct, n_buckets)
    if n > 1:
        qs = [i / n for i in range(1, n)]
        bounds = distinct.groupBy(*keys).agg(F.percentile_approx(F.col(value), qs, 10000).alias("_bounds"))
        # one row per key: broadcast if the keys are counted few (columns, classes, metrics)
        joined = distinct.crossJoin(F.broadcast(bounds)) if not keys else distinct.join(_few(materialize(bounds)), keys)
        db = joined.withColumn(BUCKET, bounds_below(F.col("_bounds"), F.col(value), n - 1)).drop("_bounds")
    else:
        db = distinct.withColumn(BUCKET, F.lit(0))
    totals = db.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    # (groups x n) rows: offsets per range, small
    wt = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, BUCKET, *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}")
                                             for c in cols])
    wl = Window.partitionBy(*keys, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = db.select("*", *[F.coalesce(F.sum(c).over(wl), F.lit(0)).alias(f"_l_{c}") for c in cols])
    # (groups x n) rows: without keys at most n
    out = local.join(F.broadcast(offsets) if not keys else _few(materialize(offsets)), [*keys, BUCKET])
    for c in cols:
        out = out.withColumn(f"{c}_before", (F.col(f"_o_{c}") + F.col(f"_l_{c}")).cast("bigint"))
    return out.drop(BUCKET, *[f"_o_{c}" for c in cols], *[f"_l_{c}" for c in cols])


def percent_ranks_multi(df: DataFrame, specs: dict[str, tuple[str, bool]], n_buckets: int | None = None) -> DataFrame:
    """``df`` with several SQL PERCENT_RANKs as further columns.

    ``specs`` maps output name -> (double-valued column, ascending).  Each metric has its
    own table of distinct values with ranks: one of few values is small enough for AQE to
    broadcast, so a value that most rows share gathers nowhere; one of many values is
    joined by value, where no value is hot.  Rows stay whole: nothing is stacked or
    pivoted.  A NULL input gets a NULL rank.
    """
    out = df
    for i, (name, (column, ascending)) in enumerate(specs.items()):
        x = F.col(column).cast("double") if ascending else -F.col(column).cast("double")
        value, total = f"_x{i}", f"_n{i}"
        counts = materialize(value_counts(df.select(x.alias(value)), value))
        n = counts.agg(F.sum("_cnt").alias(total))  # one row
        ranks = cumulative_before(counts, value, ["_cnt"], n_buckets).crossJoin(F.broadcast(n)).select(
            value, F.when(F.col(total) <= 1, F.lit(0.0))
            .otherwise(F.col("_cnt_before").cast("double") / (F.col(total) - 1).cast("double")).alias(name))
        out = out.withColumn("_x", x).join(ranks, F.col("_x") == F.col(value), "left").drop("_x", value)
    return out


def range_quantiles(df: DataFrame, value: str, qs: list[float], n_buckets: int | None = None,
                    keys: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles (PERCENTILE_CONT / numpy 'linear') of ``value``
    per group of ``keys`` (or globally).

    Returns one row per (keys, q): (keys..., q, quantile).  For groups too many to be
    counted on the driver (``selection.exact_quantiles`` serves the others): no task
    holds more than one value range; only the one or two order statistics that
    bracket each position are brought together.
    """
    keys = list(keys)
    spark = df.sparkSession
    base = df.select(*keys, F.col(value).cast("double").alias(value))
    counts = value_counts(base, value) if not keys else (
        base.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).cast("bigint").alias("_cnt")))
    cum = materialize(cumulative_before(counts, value, ["_cnt"], n_buckets, keys))
    n_total = cum.groupBy(*keys).agg(F.sum("_cnt").alias("_N"))
    qdf = spark.createDataFrame([(float(q),) for q in qs], "q double")
    pos = (n_total.crossJoin(F.broadcast(qdf))
                  .withColumn("_h", (F.col("_N") - 1) * F.col("q"))
                  .withColumn("_lo", F.floor("_h").cast("bigint"))
                  .withColumn("_hi", F.ceil("_h").cast("bigint")))

    def pick(pcol: str, out: str) -> DataFrame:
        p = pos.select(*keys, "q", F.col(pcol).alias("p"))
        cover = (F.col("_cnt_before") <= F.col("p")) & (F.col("p") < F.col("_cnt_before") + F.col("_cnt"))
        if keys:
            j = cum.join(p, keys).where(cover)
        else:
            # len(qs) rows: broadcast
            j = cum.join(F.broadcast(p), cover)
        return j.select(*keys, "q", F.col(value).alias(out))

    res = pos.join(pick("_lo", "_vlo"), [*keys, "q"]).join(pick("_hi", "_vhi"), [*keys, "q"])
    frac = F.col("_h") - F.col("_lo")
    return res.select(*keys, "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias("quantile"))


def hash_order_key(key: Column, salt: str = "") -> Column:
    """Deterministic pseudo-random order key: md5 of the key's text (L3)."""
    if salt:
        return F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.md5(key.cast("string"))
