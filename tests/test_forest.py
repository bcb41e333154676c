"""The hash-drawn forest: brute force, independence of partitions, saved models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pumpguard.operators import forest
from pumpguard.operators.features import FEATURE_COLS

SCHEMA = ("enterprise_id string, requests long, verify_rate double, avg_latency double, "
          "range_spread long, x string, node int")


def entities(spark, n=60):
    rows = [(f"e{i}", 20 + i % 7, 0.7 - (i % 5) / 100, 120.0 + i % 11 if i % 13 else None, 15 + i % 3, "x", 1)
            for i in range(n)]
    return spark.createDataFrame(rows + [("bad", 5000, 0.01, 900.0, 1, None, None)], SCHEMA)


def result(df):
    return sorted((r["enterprise_id"], r["anomaly_score"], r["is_anomaly"]) for r in df.collect())


def c(n):
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def test_trees_and_scores_are_a_plain_walk(spark):
    df = entities(spark)
    model, scored = forest.fit(df, trees=12, psi=32)
    nodes = {}
    for r in model.nodes.collect():
        nodes.setdefault(r["tree_id"], {})[r["node_id"]] = r
    assert len(nodes) == 12
    for tree in nodes.values():
        assert tree[1]["size"] == 32 and max(r["depth"] for r in tree.values()) <= 5
        for i, r in tree.items():
            if r["feature"] >= 0:  # children are there, and hold the node's rows
                assert (r["left"], r["right"]) == (2 * i, 2 * i + 1)
                assert tree[2 * i]["size"] + tree[2 * i + 1]["size"] == r["size"]
                assert tree[2 * i]["size"] and tree[2 * i + 1]["size"]
    raw = {}
    for r in df.collect():
        x = [m if r[k] is None else float(r[k]) for k, m in zip(FEATURE_COLS, model.means)]
        total = 0.0
        for tree in nodes.values():
            at = tree[1]
            while at["feature"] >= 0:
                at = tree[at["left"] if x[at["feature"]] < at["threshold"] else at["right"]]
            total += at["depth"] + c(at["size"])
        raw[r["enterprise_id"]] = -2 ** (-(total / 12) / c(32))
    border = np.quantile(list(raw.values()), 0.1)
    for key, score, flagged in result(scored):
        assert score == pytest.approx(raw[key] - border, abs=1e-9)
        assert flagged == (score < 0)
    assert min(result(scored), key=lambda r: r[1])[0] == "bad"


def test_forest_does_not_depend_on_partitions(spark):
    df = entities(spark)
    want = result(forest.fit_and_score(df.repartition(1), trees=9, psi=16))
    assert result(forest.fit_and_score(df.repartition(7), trees=9, psi=16)) == want
    assert result(forest.fit_and_score(df, trees=9, psi=16, seed=1)) != want


def test_sample_is_widened_until_every_tree_is_full(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 1.0).alias("v"))
    taken = forest.sample(df, ["k"], ["v"], 3000, 10, 64, 7, oversample=0.5)
    assert {r["count"] for r in taken.groupBy("tree_id").count().collect()} == {64}
    whole = forest.sample(df, ["k"], ["v"], 3000, 10, 64, 7, oversample=1000)
    assert sorted(map(str, taken.collect())) == sorted(map(str, whole.collect()))


def test_few_equal_or_no_entities(spark):
    one = entities(spark, 0)
    assert result(forest.fit_and_score(one, trees=3)) == [("bad", 0.0, False)]
    same = spark.createDataFrame([(f"e{i}", 1, None, None, 1, "", i) for i in range(5)], SCHEMA)
    assert {r[1:] for r in result(forest.fit_and_score(same, trees=3))} == {(0.0, False)}
    none = forest.fit_and_score(one.limit(0))
    assert none.count() == 0 and {"anomaly_score", "is_anomaly"} <= set(none.columns)


def test_saved_model_scores_alike_and_fits_nothing(spark, scratch, monkeypatch):
    df = entities(spark)
    model, scored = forest.fit(df, trees=9, psi=16)
    first = forest.save_model(model, scratch)
    back = forest.load_model(spark, scratch)
    monkeypatch.setattr(forest, "grow", None)       # scoring must not fit
    assert result(forest.score(df, back)) == result(scored)
    new_day = entities(spark, 5).withColumn("enterprise_id", F.concat(F.lit("new"), "enterprise_id"))
    got = {k: s for k, s, _ in result(forest.score(new_day, back))}
    assert got["newbad"] == min(got.values()) < 0
    monkeypatch.undo()
    other, _ = forest.fit(df, trees=9, psi=16, seed=5)
    second = forest.save_model(other, scratch)
    assert forest.load_model(spark, scratch).seed == 5
    assert forest.load_model(spark, scratch, first).seed == 42 and first != second


def test_a_save_that_stops_leaves_the_version_before(spark, scratch, monkeypatch):
    from pumpguard.sinks import writers
    df = entities(spark, 10)
    model, _ = forest.fit(df, trees=2, psi=8)
    forest.save_model(model, scratch)
    other, _ = forest.fit(df, trees=2, psi=8, seed=9)

    def stop(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(writers, "_rename", stop)
    with pytest.raises(KeyboardInterrupt):
        forest.save_model(other, scratch)
    monkeypatch.undo()
    assert forest.load_model(spark, scratch).seed == 42
    with pytest.raises(FileNotFoundError):
        forest.load_model(spark, f"{scratch}/nothing")


def test_daily_scan_is_replaced_by_its_rerun(spark, scratch):
    """Files and database: a rerun of a date replaces its rows, another date is added."""
    import uuid
    from pumpguard.plans.jobs import run_anomaly
    from pumpguard.sources.readers import read_jdbc
    rows = [(f"e{i % 12}", f"55{i % 12}", bool(i % 3), 100 + i % 12) for i in range(200)] + \
        [("bad", f"77{i}", False, 3000) for i in range(300)]
    silver = spark.createDataFrame(rows, "enterprise_id string, number_range string, is_verified boolean, operator_latency_ms int")
    url = f"jdbc:derby:memory:f{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        run_anomaly(spark, silver, path=f"{scratch}/out", model_path=f"{scratch}/model", scan_date=day)
        run_anomaly(spark, silver, jdbc_url=url, jdbc_properties=props, scan_date=day,
                    model_path=f"{scratch}/model", refit=False)
    files = spark.read.parquet(f"{scratch}/out").groupBy("scan_date").count().collect()
    assert {str(r["scan_date"]): r["count"] for r in files} == {"2024-01-01": 2, "2024-01-02": 2}
    table = read_jdbc(spark, url, "fraud_anomalies", props)
    table = table.toDF(*[n.lower() for n in table.columns]).groupBy("scan_date").count().collect()
    assert {r["scan_date"]: r["count"] for r in table} == {"2024-01-01": 2, "2024-01-02": 2}
