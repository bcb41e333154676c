"""Isolation forest grown by Spark aggregates, with every draw taken from a hash.

* Sampling: a tree takes the ``psi`` entities with the smallest md5 of (seed, tree, keys).
* Growing: level by level. Window aggregates over (tree, node) give each node's size and the
  minimum and maximum of every feature; the feature and the cut are drawn from the md5 of (seed,
  tree, node); each row moves on to its child. The rows are dealt by tree once and stay there,
  so a level is a sort and no shuffle. A tree has at most ``psi`` rows.
* Scoring: all trees (at most ``trees * (2 psi - 1)`` nodes, whatever the data) are walked for a
  whole Arrow batch at a time. Path lengths are whole numbers of ``UNIT``, so their sum does not depend
  on any order, and scores are rounded to ``DIGITS``.

As nothing depends on a generator, on partitions or on the order of sums, the same forest comes
out of plain SQL. A fitted forest is a ``Model``: it can be written to a folder of versions, and
read again to score other entities without a fit.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpguard.operators.features import FEATURE_COLS
from pumpguard.operators.iforest import NODE_SCHEMA, Forest, _reliable, average_path_length
from pumpguard.operators.stats import exact_percentile

# workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1e-9
DIGITS = 12


def _drawn(*parts: Column) -> Column:
    """52 bits of the md5 of the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def sample(features: DataFrame, keys: Sequence[str], cols: Sequence[str], n: int, trees: int,
           psi: int, seed: int, oversample: float = 4.0) -> DataFrame:
    """tree_id, x (the features): min(psi, n) entities for each tree. Candidates far behind the
    last one are left out before the shuffle; if a tree comes up short, more are let through."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree_id")
    pairs = features.select(*keys, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), tree)
    pairs = pairs.withColumn("_u", _drawn(F.lit(seed), F.col("tree_id"), *[F.col(k) for k in keys]))
    order = Window.partitionBy("tree_id").orderBy("_u", *keys)
    share = min(1.0, oversample * psi / max(n, 1))
    while True:
        near = pairs if share >= 1 else pairs.filter(F.col("_u") < F.lit(int(share * (1 << 52))))
        taken = _reliable(near.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= psi)
                          .select("tree_id", "x"))
        if share >= 1 or taken.groupBy("tree_id").count().filter(F.col("count") >= min(psi, n)).count() == trees:
            return taken
        share = min(1.0, 4 * share)


def grow(rows: DataFrame, n_cols: int, psi: int, seed: int) -> DataFrame:
    """The node table of the trees over the sampled ``rows`` (tree_id, x).

    Nodes are numbered as in a heap: the root is 1, the children of i are 2 i and 2 i + 1. A node
    is a leaf at the height limit, with one row, or when no feature differs."""
    depth = math.ceil(math.log2(max(psi, 2)))
    node = Window.partitionBy("tree_id", "node")
    rows = rows.repartition("tree_id").select("tree_id", "x", F.lit(1).cast("long").alias("node"),
                                              F.array().cast("array<struct<node:long,feature:int,threshold:double,"
                                                             "size:long,depth:int>>").alias("path"))
    for level in range(depth + 1):
        low = F.array(*[F.min(F.col("x")[i]).over(node) for i in range(n_cols)])
        high = F.array(*[F.max(F.col("x")[i]).over(node) for i in range(n_cols)])
        rows = rows.select("*", F.count(F.lit(1)).over(node).alias("size"), low.alias("low"), high.alias("high"))
        usable = F.filter(F.sequence(F.lit(0), F.lit(n_cols - 1)), lambda i: F.col("high")[i] > F.col("low")[i])
        rows = rows.withColumn("usable", usable if level < depth else F.array().cast("array<int>"))
        open_ = (F.col("node") > 0) & (F.size("usable") > 0)
        pick = _drawn(F.lit(seed), F.col("tree_id"), F.col("node"), F.lit("feature")) % F.greatest(F.size("usable"), F.lit(1))
        rows = rows.withColumn("feature", F.when(open_, F.get("usable", pick.cast("int"))))
        lo, hi = F.get("low", F.col("feature")), F.get("high", F.col("feature"))
        share = _drawn(F.lit(seed), F.col("tree_id"), F.col("node"), F.lit("cut")) / F.lit(float(1 << 52))
        cut = lo + share * (hi - lo)
        rows = rows.withColumn("threshold", F.when((cut > lo) & (cut <= hi), cut).otherwise(hi))
        step = F.struct("node", F.coalesce("feature", F.lit(-1)).alias("feature"), "threshold", "size",
                        F.lit(level).alias("depth"))
        rows = rows.withColumn("path", F.when(F.col("node") > 0, F.concat("path", F.array(step))).otherwise(F.col("path")))
        right = (F.get("x", F.col("feature")) >= F.col("threshold")).cast("long")
        # a row that has come to a leaf waits under a number of its own below zero
        after = F.when(open_, 2 * F.col("node") + right).otherwise(-F.abs("node"))
        rows = rows.select("tree_id", "x", after.alias("node"), "path")
    nodes = rows.select("tree_id", F.explode("path").alias("at")).select("tree_id", "at.*").distinct()
    inner = F.col("feature") >= 0
    return nodes.select("tree_id", F.col("node").cast("int").alias("node_id"), "feature",
                        F.when(inner, F.col("threshold")).alias("threshold"),
                        F.when(inner, 2 * F.col("node")).otherwise(-1).cast("int").alias("left"),
                        F.when(inner, 2 * F.col("node") + 1).otherwise(-1).cast("int").alias("right"),
                        "size", "depth")


@dataclass(frozen=True)
class Model:
    """A fitted forest: nodes (see ``NODE_SCHEMA``), sample size, feature columns, the means that
    stand for missing values, and the score below which an entity is an anomaly."""

    nodes: DataFrame
    psi: int
    trees: int
    cols: tuple[str, ...]
    means: tuple[float, ...]
    offset: float
    keys: tuple[str, ...] = ("enterprise_id",)
    seed: int = 42


def _filled(features: DataFrame, cols: Sequence[str], means: Sequence[float]) -> DataFrame:
    return features.withColumns({f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float(m)))
                                 for c, m in zip(cols, means)})


def _walker(nodes: DataFrame):
    """Flat arrays of all trees, with path lengths as whole numbers of ``UNIT``."""
    table = nodes.toPandas()  # bounded by the parameters: trees * (2 psi - 1) rows
    table = table.sort_values(["tree_id", "node_id"])
    # heap numbers to places inside the tree
    place = table.groupby("tree_id").cumcount()
    where = dict(zip(zip(table["tree_id"], table["node_id"]), place))
    for side in ("left", "right"):
        table[side] = [where.get((t, n), -1) for t, n in zip(table["tree_id"], table[side])]
    table["node_id"] = place
    forest = Forest(table[[f.name for f in NODE_SCHEMA.fields]], 2)
    forest.leaf_path = np.rint(forest.leaf_path / UNIT).astype(np.int64)
    return forest


def _raw_scores(features: DataFrame, nodes: DataFrame, xs: Sequence[str], psi: int, trees: int) -> DataFrame:
    """``features`` + ``_raw``: -2^(-mean path / c(psi)), lower is more anomalous."""
    xs = list(xs)
    arrays = features.sparkSession.sparkContext.broadcast(_walker(nodes).__dict__)

    def walk(batches):
        forest = Forest.__new__(Forest)
        forest.__dict__.update(arrays.value)
        for pdf in batches:
            values = pdf[xs].to_numpy(dtype=float)
            at = np.tile(forest.roots, (len(pdf), 1))
            rows = np.arange(len(pdf))[:, None]
            for _ in range(forest.max_depth + 1):
                feature = forest.feature[at]
                inner = feature >= 0
                if not inner.any():
                    break
                value = values[np.broadcast_to(rows, at.shape), np.where(inner, feature, 0)]
                further = np.where(value < forest.threshold[at], forest.left[at], forest.right[at])
                at = np.where(inner, further, at)
            yield pdf.assign(_path=forest.leaf_path[at].sum(axis=1))

    schema = T.StructType([*features.schema.fields, T.StructField("_path", T.LongType())])
    walked = features.mapInPandas(walk, schema)
    c_psi = float(average_path_length([psi])[0])
    mean = F.col("_path") / F.lit(float(trees / UNIT))
    raw = -F.pow(F.lit(2.0), -mean / F.lit(c_psi)) if c_psi > 0 else F.lit(-0.5)
    return walked.withColumn("_raw", F.round(raw, DIGITS)).drop("_path")


def _judged(raw: DataFrame, offset: float, xs: Sequence[str]) -> DataFrame:
    return (raw.withColumn("anomaly_score", F.round(F.col("_raw") - F.lit(offset), DIGITS))
            .withColumn("is_anomaly", F.col("anomaly_score") < 0).drop("_raw", *xs))


def fit(features: DataFrame, keys: Sequence[str] = ("enterprise_id",), cols: Sequence[str] = FEATURE_COLS,
        contamination: float = 0.1, trees: int = 100, psi: int = 256, seed: int = 42) -> tuple[Model, DataFrame]:
    """(the model, ``features`` with anomaly_score and is_anomaly). Missing features count as the
    column's mean (0 when all are missing); ``features`` must not be empty."""
    cols, keys = tuple(cols), tuple(keys)
    row = features.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    means = tuple(round(float(row[c]), DIGITS) if row[c] is not None else 0.0 for c in cols)
    xs = [f"_x_{c}" for c in cols]
    filled = _reliable(_filled(features, cols, means))
    used = max(1, min(psi, row["n"]))
    nodes = _reliable(grow(sample(filled, keys, xs, row["n"], trees, used, seed), len(cols), used, seed))
    raw = _reliable(_raw_scores(filled, nodes, xs, used, trees))
    offset = round(exact_percentile(raw, "_raw", contamination), DIGITS)
    return Model(nodes, used, trees, cols, means, offset, keys, seed), _judged(raw, offset, xs)


def score(features: DataFrame, model: Model) -> DataFrame:
    """``features`` with anomaly_score and is_anomaly by a fitted model: nothing is fitted, the
    model's means stand for missing values and its offset decides."""
    xs = [f"_x_{c}" for c in model.cols]
    filled = _filled(features, model.cols, model.means)
    return _judged(_raw_scores(filled, model.nodes, xs, model.psi, model.trees), model.offset, xs)


def fit_and_score(features: DataFrame, keys: Sequence[str] = ("enterprise_id",), cols: Sequence[str] = FEATURE_COLS,
                  contamination: float = 0.1, trees: int = 100, psi: int = 256, seed: int = 42) -> DataFrame:
    """``features`` with anomaly_score (lower is more anomalous) and is_anomaly (below zero)."""
    if features.isEmpty():  # nothing to isolate
        return features.withColumns({"anomaly_score": F.lit(None).cast("double"), "is_anomaly": F.lit(False)})
    return fit(features, keys, cols, contamination, trees, psi, seed)[1]


# ---------------------------------------------------------------- a folder of versions

_POINTER = "_current-"
_FACTS = ("psi", "trees", "cols", "means", "offset", "keys", "seed")


def save_model(model: Model, path: str) -> str:
    """Write the model as a new version below ``path``; returns the version's name.

    The version is a finished folder (nodes and parameters) before a small pointer file, put in
    place by one rename, says that it counts. The highest pointer counts; a run that stops before the
    rename leaves the version before it in force, and two runs cannot both take one number."""
    from pumpguard.sinks.writers import _folder, _rename
    spark = model.nodes.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/version={version}"
    model.nodes.coalesce(1).write.parquet(f"{folder}/nodes")
    facts = {k: getattr(model, k) for k in _FACTS}
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.text(f"{folder}/facts")
    number = max(_pointers(spark, path), default=(0, ""))[0] + 1
    text = f"{path.rstrip('/')}/_writing-{version}"
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(text)
    fs, staged = _folder(spark, text)
    _rename(fs, staged, _folder(spark, f"{path.rstrip('/')}/{_POINTER}{number:09d}")[1])
    return version


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    from pumpguard.sinks.writers import _folder
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted((int(n[len(_POINTER):]), n) for n in names if n.startswith(_POINTER))


def load_model(spark: SparkSession, path: str, version: str | None = None) -> Model:
    """The model that counts at ``path``, or a named version of it."""
    root = path.rstrip("/")
    if version is None:
        found = _pointers(spark, path)
        if not found:
            raise FileNotFoundError(f"no model at {path}")
        version = spark.read.text(f"{root}/{found[-1][1]}").first()[0]
    facts = json.loads(spark.read.text(f"{root}/version={version}/facts").first()[0])
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{root}/version={version}/nodes")
    return Model(nodes, **{k: tuple(v) if isinstance(v, list) else v for k, v in facts.items()})
