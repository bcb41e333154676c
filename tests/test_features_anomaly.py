import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pumpguard.operators.features import entity_features
from pumpguard.operators.iforest import (Forest, fit_forest, impute, score_anomalies,
                                         score_forest, worst)


def test_features_compute_verify_rate_and_volume(spark):
    rows = list(zip(["ent_3"] * 4 + ["ent_1"] * 2 + [None],
                    ["550199"] * 4 + ["447700"] * 2 + ["1"],
                    [False, False, False, True, True, True, True],
                    [100, 110, 120, 130, 90, None, 1]))
    df = spark.createDataFrame(rows, "enterprise_id string, number_range string, "
                                     "is_verified boolean, operator_latency_ms long")
    f = {r["enterprise_id"]: r for r in entity_features(df).collect()}
    assert set(f) == {"ent_3", "ent_1"}                 # NULL entity dropped
    assert f["ent_3"]["requests"] == 4
    assert f["ent_3"]["verify_rate"] == 0.25
    assert f["ent_1"]["verify_rate"] == 1.0
    assert f["ent_1"]["avg_latency"] == 90.0           # NULL latency skipped
    assert f["ent_3"]["range_spread"] == 1


def _fixture(spark):
    rows = [(f"ent_{i}", 20, 0.7, 120.0, 15) for i in range(9)]
    rows.append(("ent_bad", 5000, 0.01, 130.0, 1))
    return spark.createDataFrame(rows, "enterprise_id string, requests long, verify_rate double, "
                                       "avg_latency double, range_spread long")


def test_isolation_forest_flags_outlier_entity(spark):
    scored = score_anomalies(_fixture(spark))
    (w,) = worst(scored, 1).collect()
    assert w["enterprise_id"] == "ent_bad"
    assert w["is_anomaly"] is True
    flagged = scored.filter("is_anomaly").count()
    assert flagged <= math.floor(0.1 * 9) + 1


def test_forest_is_partitioning_independent(spark):
    from pumpguard.plans.registry import silver
    keys = ("enterprise_id", "number_range")
    feats = impute(entity_features(silver(spark, "/root/testdata/sf0.001"), keys),
                   ["requests", "verify_rate", "avg_latency", "range_spread"])
    a = score_anomalies(feats.repartition(1), keys).toPandas()
    b = score_anomalies(feats.repartition(8), keys).toPandas()
    m = a.merge(b, on=list(keys))
    assert len(m) == len(a) == len(b)
    assert np.allclose(m["anomaly_score_x"], m["anomaly_score_y"])
    assert (m["is_anomaly_x"] == m["is_anomaly_y"]).all()


def test_scores_match_brute_force_tree_walk(spark):
    feats = _fixture(spark)
    cols = ["requests", "verify_rate", "avg_latency", "range_spread"]
    nodes, psi = fit_forest(impute(feats, cols), n_trees=20)
    pdn = nodes.toPandas()
    assert len(pdn) <= 20 * (2 * psi - 1)
    X = feats.toPandas()[cols].to_numpy(float)

    def c(n):
        return 0.0 if n <= 1 else (1.0 if n == 2 else
                                   2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n)

    expected = []
    for x in X:
        depths = []
        for _, t in pdn.groupby("tree_id"):
            t = t.set_index("node_id")
            node = 0
            while t.loc[node, "feature"] >= 0:
                f, thr = t.loc[node, "feature"], t.loc[node, "threshold"]
                node = t.loc[node, "left"] if x[f] < thr else t.loc[node, "right"]
            depths.append(t.loc[node, "depth"] + c(t.loc[node, "size"]))
        expected.append(-2 ** (-np.mean(depths) / c(psi)))
    got = Forest(pdn, psi).score_samples(X)
    assert np.allclose(got, expected)
    assert ((got > -1) & (got < 0)).all()


def test_sampling_takes_psi_rows_per_tree(spark):
    from pumpguard.operators.iforest import sample_for_trees
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"),
                                  F.rand(3).alias("x"))
    s = sample_for_trees(df, ["k"], ["x"], n_trees=10, psi=64, seed=42, n=5000)
    counts = {r["tree_id"]: r["count"] for r in s.groupBy("tree_id").count().collect()}
    assert counts == {t: 64 for t in range(10)}
    again = sample_for_trees(df.repartition(3), ["k"], ["x"], 10, 64, 42, 5000)
    assert sorted(map(tuple, s.select("tree_id", "k").collect())) == \
        sorted(map(tuple, again.select("tree_id", "k").collect()))


def test_empty_feature_table_scores_nothing(spark):
    empty = _fixture(spark).limit(0)
    out = score_anomalies(empty)
    assert out.count() == 0 and {"anomaly_score", "is_anomaly"} <= set(out.columns)


def test_single_entity_is_not_flagged_alone(spark):
    out = score_anomalies(_fixture(spark).limit(1)).collect()
    assert len(out) == 1 and out[0]["anomaly_score"] == 0.0 and out[0]["is_anomaly"] is False
