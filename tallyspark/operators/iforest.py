"""Isolation forest (M5/M6) as Spark jobs.

* Subsamples are functions of a key hash, never of row order: each tree gets the
  ``psi`` (<= 256) rows with the smallest (row, tree) hashes, drawn without
  replacement and independently of the other trees.  A pair is built only if its
  hash lies under ``2 psi / n`` - one rule at every size, about 2 psi rows per tree.
* Trees grow in ``groupBy("tree").applyInPandas`` - one task per tree, psi rows.
* The node table (<= trees x (2 psi - 1) rows, bounded by the model, not the data)
  is broadcast and every row is scored vectorised in ``mapInPandas``.
* The flag threshold is the exact (1 - contamination) quantile of the scores,
  computed distributed; anomaly_score = score - threshold (higher = more
  anomalous), flag = anomaly_score > 0.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyspark.operators.selection import exact_quantiles
from tallyspark.session import materialize

N_TREES = 200
MAX_SAMPLES = 256
RANDOM_STATE = 42

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "leaf boolean, size long, depth int")


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _u01(*cols) -> F.Column:
    """Uniform [0, 1) from a 64-bit hash of the columns."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 53)).cast("double") / float(1 << 53))


def subsample(df: DataFrame, key: str, n_rows: int, n_trees: int = N_TREES, psi: int = MAX_SAMPLES,
              seed: int = RANDOM_STATE) -> DataFrame:
    """Rows of each tree's training subsample: (tree, <df columns>)."""
    psi = min(psi, n_rows)
    share = min(1.0, 2.0 * psi / max(n_rows, 1))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: _u01(F.col(key), t, F.lit(seed)) < F.lit(share))
    pairs = df.select(F.explode(drawn).alias("tree"), "*").withColumn("_h", _u01(F.col(key), F.col("tree"), F.lit(seed)))
    # a tree's window holds about 2 psi rows, whatever the table's size
    w = Window.partitionBy("tree").orderBy("_h", key)
    return pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= psi).drop("_rn", "_h")


def _grow_factory(features: list[str], psi: int, seed: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100003 + tree)
        rows = []

        def build(idx, depth):
            node = len(rows)
            rows.append(None)
            sub = x[idx]
            if depth >= max_depth or len(idx) <= 1:
                rows[node] = (tree, node, -1, 0.0, -1, -1, True, len(idx), depth)
                return node
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if usable.size == 0:  # all points equal: cannot split
                rows[node] = (tree, node, -1, 0.0, -1, -1, True, len(idx), depth)
                return node
            f = int(rng.choice(usable))
            t = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < t
            left = build(idx[go_left], depth + 1)
            right = build(idx[~go_left], depth + 1)
            rows[node] = (tree, node, f, t, left, right, False, len(idx), depth)
            return node

        build(np.arange(len(x)), 0)
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "leaf",
                                           "size", "depth"])

    return grow


def fit(df: DataFrame, features: list[str], key: str, n_trees: int = N_TREES, psi: int = MAX_SAMPLES,
        seed: int = RANDOM_STATE) -> DataFrame:
    """M5: node table of the forest (a DataFrame, one row per node)."""
    n_rows = df.count()
    psi = min(psi, n_rows)
    sample = subsample(df.select(key, *features).na.fill(0.0, subset=features), key, n_rows, n_trees, psi, seed)
    return sample.groupBy("tree").applyInPandas(_grow_factory(features, psi, seed), NODE_SCHEMA)


def _pack(nodes: pd.DataFrame, n_trees: int):
    width = int(nodes["node"].max()) + 1
    arr = {k: np.full((n_trees, width), v, dtype=t) for k, v, t in
           (("feature", -1, np.int64), ("threshold", 0.0, float), ("left", -1, np.int64), ("right", -1, np.int64),
            ("leaf", True, bool), ("pl", 0.0, float))}
    for r in nodes.itertuples(index=False):
        t, n = int(r.tree), int(r.node)
        arr["feature"][t, n], arr["threshold"][t, n] = r.feature, r.threshold
        arr["left"][t, n], arr["right"][t, n], arr["leaf"][t, n] = r.left, r.right, bool(r.leaf)
        arr["pl"][t, n] = r.depth + (c_factor(r.size) if r.leaf else 0.0)
    return arr


def raw_scores(df: DataFrame, nodes: DataFrame, features: list[str], psi: int, n_trees: int = N_TREES,
               carry: list[str] = ()) -> DataFrame:
    """M6: isolation score 2^(-E[h(x)] / c(psi)) for every row (vectorised per batch).

    The ``carry`` columns travel with their row, so nothing has to be joined back.
    """
    spark = df.sparkSession
    node_pdf = nodes.toPandas()  # bounded by trees x (2 psi - 1) rows
    bc = spark.sparkContext.broadcast(_pack(node_pdf, n_trees))
    cpsi = c_factor(psi)
    max_depth = int(node_pdf["depth"].max()) + 1

    def score(batches):
        a = bc.value
        for pdf in batches:
            x = pdf[features].fillna(0.0).to_numpy(dtype=float)
            m = len(x)
            total = np.zeros(m)
            rows = np.arange(m)
            for t in range(a["feature"].shape[0]):
                idx = np.zeros(m, dtype=np.int64)
                for _ in range(max_depth):
                    leaf = a["leaf"][t, idx]
                    if leaf.all():
                        break
                    f = a["feature"][t, idx]
                    val = x[rows, np.maximum(f, 0)]
                    nxt = np.where(val < a["threshold"][t, idx], a["left"][t, idx], a["right"][t, idx])
                    idx = np.where(leaf, idx, nxt)
                total += a["pl"][t, idx]
            s = np.power(2.0, -(total / a["feature"].shape[0]) / cpsi) if cpsi > 0 else np.full(m, 0.5)
            yield pdf[carry].assign(_s=s)

    carry = list(carry)
    rows = df.select(*carry, *[c for c in features if c not in carry])
    schema = T.StructType([*(df.schema[c] for c in carry), T.StructField("_s", T.DoubleType())])
    return rows.mapInPandas(score, schema)


def score_and_flag(df: DataFrame, nodes: DataFrame, features: list[str], psi: int, contamination: float,
                   n_trees: int = N_TREES, carry: list[str] = ()) -> DataFrame:
    """anomaly_score = score - quantile(score, 1 - contamination); flag = anomaly_score > 0."""
    s = materialize(raw_scores(df, nodes, features, psi, n_trees, carry))
    thr = exact_quantiles(s, "_s", [1.0 - contamination]).select("quantile").scalar()  # scalar subquery
    return s.select(*carry, (F.col("_s") - thr).alias("anomaly_score"),
                    (F.col("_s") > thr).cast("int").alias("is_flagged_iforest"))
