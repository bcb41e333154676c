"""Distributed isolation forest (Liu, Ting & Zhou, 2008) over an entity feature table.

* Sampling: every (entity, tree) pair gets a uniform number from ``xxhash64(keys, tree, seed)``;
  each tree takes the ``psi`` entities with the smallest numbers (sampling without replacement,
  independent of partitioning). A pre-filter keeps pairs below ``oversample * psi / n`` in the
  same narrow stage, so at most ~``oversample * psi`` rows per tree reach the shuffle; if a
  tree would come up short, the pre-filter is widened 4x and the sample redone (exact: every
  tree ends with min(psi, n) entities, and a tree's candidates stay ~``p * n``).
* Fitting: ``groupBy(tree_id).applyInPandas`` builds one tree per group from <= ``psi`` rows
  (height limit ceil(log2 psi), random feature among the non-constant ones, uniform split).
* Scoring: the node table is at most ``n_trees * (2 * psi - 1)`` rows (51,100 for the defaults),
  a bound fixed by the parameters, so it is collected once and broadcast; ``mapInPandas``
  walks all trees for a whole Arrow batch at a time.
* Threshold: ``offset`` = exact linear-interpolated percentile of the scores at
  ``contamination`` (distributed, see ``stats``); ``anomaly_score = score - offset`` (lower is
  more anomalous, as in the reference) and ``is_anomaly = anomaly_score < 0``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpguard.operators.features import FEATURE_COLS
from pumpguard.operators.stats import exact_percentile

# workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),   # -1 = leaf
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()),
    T.StructField("depth", T.IntegerType()),
])


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def impute(features: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """NULL feature values -> the column's global mean (0 when all NULL); one global aggregate.

    With ``prefix`` the imputed DOUBLE copies are added as ``prefix + name`` and the original
    columns keep their values and types."""
    cols = list(cols)
    means = features.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    fill = {c: float(means[c]) if means[c] is not None else 0.0 for c in cols}
    return features.withColumns({prefix + c: F.coalesce(F.col(c).cast("double"),
                                                         F.lit(fill[c])) for c in cols})


def _tree_builder(cols: list[str], max_depth: int, seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values("_u", kind="mergesort")
        X = pdf[cols].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows: list[tuple] = []

        def grow(idx: np.ndarray, depth: int) -> int:
            node = len(rows)
            rows.append(None)
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if depth >= max_depth or len(idx) <= 1 or usable.size == 0:
                rows[node] = (tree, node, -1, float("nan"), -1, -1, len(idx), depth)
                return node
            f = int(usable[rng.integers(usable.size)])
            thr = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < thr
            if go_left.all() or not go_left.any():  # degenerate draw at the boundary
                thr = float(hi[f])
                go_left = sub[:, f] < thr
            left = grow(idx[go_left], depth + 1)
            right = grow(idx[~go_left], depth + 1)
            rows[node] = (tree, node, f, thr, left, right, len(idx), depth)
            return node

        grow(np.arange(len(X)), 0)
        return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])
    return build


def sample_for_trees(features: DataFrame, keys: Sequence[str], cols: Sequence[str],
                     n_trees: int, psi: int, seed: int, n: int,
                     oversample: float = 4.0) -> DataFrame:
    keys, cols = list(keys), list(cols)
    tree = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id")
    pairs = features.select(*keys, *cols, tree)
    h = F.xxhash64(*[F.col(k) for k in keys], F.col("tree_id"), F.lit(seed))
    u = (F.abs(h % F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52)))
    pairs = pairs.withColumn("_u", u)

    def take(p: float) -> DataFrame:
        cand = pairs.filter(F.col("_u") < F.lit(p)) if p < 1.0 else pairs
        w = Window.partitionBy("tree_id").orderBy("_u", *keys)
        return cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= psi)

    p = min(1.0, oversample * psi / max(n, 1))
    while True:
        # the sample is at most n_trees * psi rows: materialize it once (shared checkpoint
        # folder), so the check below and the tree build do not both rescan all pairs
        sample = _reliable(take(p).select("tree_id", *keys, *cols, "_u"))
        if p >= 1.0:
            return sample
        # a tree with fewer than psi candidates would be smaller than specified: widen the
        # pre-filter (4x) and redo; each round still bounds a tree to ~p * n candidates
        full = sample.groupBy("tree_id").count().filter(F.col("count") >= psi).count()
        if full == n_trees:
            return sample
        p = min(1.0, p * 4.0)


def fit_forest(features: DataFrame, keys: Sequence[str] = ("enterprise_id",),
               cols: Sequence[str] = FEATURE_COLS, n_trees: int = 100, psi: int = 256,
               seed: int = 42, n: int | None = None) -> tuple[DataFrame, int]:
    """(node table, psi actually used). ``features`` must have no NULL in ``cols``."""
    n = features.count() if n is None else n
    psi_eff = max(1, min(psi, n))
    max_depth = int(math.ceil(math.log2(max(psi_eff, 2))))
    sample = sample_for_trees(features, keys, cols, n_trees, psi_eff, seed, n)
    nodes = (sample.groupBy("tree_id")
             .applyInPandas(_tree_builder(list(cols), max_depth, seed), NODE_SCHEMA))
    return nodes, psi_eff


class Forest:
    """Flat arrays of all trees: node i of tree t is at ``offset[t] + i``."""

    def __init__(self, nodes: pd.DataFrame, psi: int):
        nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        self.n_trees = int(nodes["tree_id"].nunique())
        counts = nodes.groupby("tree_id").size().to_numpy()
        self.roots = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        off = np.repeat(self.roots, counts)
        self.feature = nodes["feature"].to_numpy(np.int64)
        self.threshold = nodes["threshold"].to_numpy(float)
        leaf = self.feature < 0
        self.left = np.where(leaf, -1, nodes["left"].to_numpy(np.int64) + off)
        self.right = np.where(leaf, -1, nodes["right"].to_numpy(np.int64) + off)
        self.leaf_path = np.where(
            leaf, nodes["depth"].to_numpy(float) + average_path_length(nodes["size"].to_numpy()),
            0.0)
        self.max_depth = int(nodes["depth"].max()) if len(nodes) else 0
        self.c_psi = float(average_path_length([psi])[0])

    def score_samples(self, X: np.ndarray) -> np.ndarray:
        """-s(x) = -2^(-E[h(x)] / c(psi)); lower = more anomalous, range (-1, 0)."""
        m = X.shape[0]
        node = np.tile(self.roots, (m, 1))                      # m x trees
        rows = np.arange(m)[:, None]
        for _ in range(self.max_depth + 1):
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            val = X[np.broadcast_to(rows, node.shape), np.where(inner, f, 0)]
            nxt = np.where(val < self.threshold[node], self.left[node], self.right[node])
            node = np.where(inner, nxt, node)
        depth = self.leaf_path[node].mean(axis=1)
        if self.c_psi <= 0:
            return -np.full(m, 0.5)
        return -np.power(2.0, -depth / self.c_psi)


def score_forest(features: DataFrame, nodes: DataFrame, psi: int,
                 cols: Sequence[str] = FEATURE_COLS, contamination: float = 0.1) -> DataFrame:
    """features + ``anomaly_score`` (score - offset) + ``is_anomaly`` (anomaly_score < 0)."""
    cols = list(cols)
    spark = features.sparkSession
    forest = Forest(nodes.toPandas(), psi)       # bounded: n_trees * (2 psi - 1) rows
    bc = spark.sparkContext.broadcast(forest.__dict__)   # plain arrays
    out_schema = T.StructType(features.schema.fields + [T.StructField("_raw", T.DoubleType())])

    def apply(batches):
        fo = Forest.__new__(Forest)
        fo.__dict__.update(bc.value)
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=float)
            yield pdf.assign(_raw=fo.score_samples(X) if len(pdf) else np.zeros(0))

    raw = features.mapInPandas(apply, out_schema)
    raw = _reliable(raw)
    offset = exact_percentile(raw, "_raw", contamination)
    return (raw.withColumn("anomaly_score", F.col("_raw") - F.lit(offset)).drop("_raw")
            .withColumn("is_anomaly", F.col("anomaly_score") < 0))


def _reliable(df: DataFrame) -> DataFrame:
    """Materialize once in the shared checkpoint folder (survives executor loss, cuts lineage)."""
    from pumpguard.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def score_anomalies(features: DataFrame, keys: Sequence[str] = ("enterprise_id",),
                    cols: Sequence[str] = FEATURE_COLS, contamination: float = 0.1,
                    n_trees: int = 100, psi: int = 256, seed: int = 42) -> DataFrame:
    """Impute -> fit -> score. Output: the input columns (types unchanged), anomaly_score,
    is_anomaly. The forest sees mean-imputed DOUBLE copies of ``cols``."""
    cols = list(cols)
    xs = [f"_x_{c}" for c in cols]
    feats = _reliable(impute(features, cols, prefix="_x_"))
    n = feats.count()
    if n == 0:                                   # nothing to isolate
        return features.withColumns({"anomaly_score": F.lit(None).cast("double"),
                                     "is_anomaly": F.lit(False)})
    nodes, psi_eff = fit_forest(feats, keys, xs, n_trees, psi, seed, n)
    return score_forest(feats, nodes, psi_eff, xs, contamination).drop(*xs)


def worst(scored: DataFrame, k: int = 10, keys: Sequence[str] = ("enterprise_id",)) -> DataFrame:
    """The k most anomalous entities (top-k report)."""
    return scored.orderBy(F.col("anomaly_score").asc(), *[F.col(c) for c in keys]).limit(k)
