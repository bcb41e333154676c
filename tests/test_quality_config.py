import pytest
from pyspark.sql import functions as F

from pumpguard.config import Settings
from pumpguard.operators import quality as Q
from pumpguard.schemas import DELIVERY_FIELDS, REQUEST_FIELDS, TOPICS, VERIFICATION_FIELDS


def _broken(spark, **values):
    from pumpguard.plans.registry import silver
    s = silver(spark, "/root/testdata/sf0.001")
    return s.withColumns({c: F.when(F.col("request_id") == "17", F.lit(None)).otherwise(F.col(c))
                          for c in values}) if values else s


def test_silver_of_the_events_is_valid(spark):
    s = _broken(spark)
    assert Q.validate_silver(s) == {"ok": True, "failures": []}
    assert Q.validate_silver(s.filter("false"))["ok"]


def test_one_lost_id_among_a_thousand_is_found(spark):
    assert Q.validate_silver(_broken(spark, request_id=1))["failures"] == ["request_id"]
    both = _broken(spark, is_verified=1).union(_broken(spark, request_id=1))
    assert set(Q.validate_silver(both)["failures"]) == {"request_id", "is_verified"}


def test_null_flag_fails_in_set(spark):
    df = spark.createDataFrame([("r1", None)], "request_id string, is_verified boolean")
    assert Q.validate_silver(df)["failures"] == ["is_verified"]


def test_mart_checks(spark):
    f = spark.createDataFrame([("e", 0.5), (None, 1.5), ("x", None)],
                              "enterprise_id string, verify_rate double")
    nn = Q.not_null(f, "enterprise_id").first()
    rg = Q.accepted_range(f, "verify_rate", 0, 1).first()
    assert nn["failed_rows"] == 1 and not nn["ok"]
    assert rg["failed_rows"] == 1                      # NULL passes, 1.5 fails
    with pytest.raises(AssertionError):
        Q.raise_on_failure(Q.not_null(f, "enterprise_id"))


def test_unique_relationship_values(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "request_id string")
    child = spark.createDataFrame([("a", "x"), ("c", "delivered"), (None, "failed")],
                                  "request_id string, status string")
    assert Q.unique(parent, ["request_id"]).first()["failed_rows"] == 2
    assert Q.relationship(child, parent, "request_id").first()["failed_rows"] == 1
    assert Q.accepted_values(child, "status", ("delivered", "failed")).first()["failed_rows"] == 1
    assert Q.require_columns(child, ["request_id", "nope"]) == ["nope"]


def test_one_pass_checks_equal_the_single_ones(spark):
    parent = spark.createDataFrame([("a", "sms"), ("b", "fax"), ("b", None), (None, "sms"),
                                    (None, "sms")], "request_id string, channel string")
    child = spark.createDataFrame([("a", "x"), ("c", "delivered"), ("c", "y"), (None, "failed")],
                                  "request_id string, status string")
    values = [("p", "channel", ("sms",)), ("c", "status", ("delivered", "failed"))]
    for p, c in ((parent, child), (parent.filter("false"), child), (parent, child.filter("false"))):
        got = Q.table_checks(("p", p), [("c", c)], "request_id", ("p", "c"), ("c",), values)
        single = [Q.unique(p, ["request_id"], "p.request_id"),
                  Q.unique(c, ["request_id"], "c.request_id"),
                  Q.relationship(c, p, "request_id", "c.request_id"),
                  Q.accepted_values(p, "channel", ("sms",), "p.channel"),
                  Q.accepted_values(c, "status", ("delivered", "failed"), "c.status")]
        assert sorted(got.collect()) == sorted(r for q in single for r in q.collect())


def test_a_broken_layer_is_reported(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    good = E.queries()["bronze_reconciliation"](spark, sf).collect()
    bad = {r["layer"]: r["ok"] for r in E.queries()["bronze_reconciliation_broken"](spark, sf).collect()}
    assert all(r["ok"] for r in good) and all(r["rows"] > 0 for r in good)
    assert bad == {"messages": False, "bronze_requests": True, "silver": False}


def test_reconcile(spark):
    a = spark.range(5)
    out = {r["layer"]: r for r in Q.reconcile([("a", a, 5), ("b", a, a.limit(3)),
                                               ("c", a, None)]).collect()}
    assert out["a"]["ok"] and not out["b"]["ok"] and out["c"]["ok"]


def test_every_setting_comes_from_its_variable(monkeypatch):
    given = {"KAFKA_BOOTSTRAP": "b-1:9, b-2:9", "PG_CATALOG": "lake", "PG_CHECKPOINT_ROOT": "s3a://x/c",
             "PG_STATE_PARTITIONS": "900", "PG_SHUFFLE_PARTITIONS": "4000"}
    for k, v in given.items():
        monkeypatch.setenv(k, v)
    s = Settings.from_env()
    assert (s.kafka_bootstrap, s.catalog, s.checkpoint_root, s.state_partitions,
            s.shuffle_partitions) == ("b-1:9, b-2:9", "lake", "s3a://x/c", 900, 4000)
    for k in given:
        monkeypatch.delenv(k)
    assert Settings.from_env() == Settings()


def test_topics_and_shared_key():
    assert TOPICS == {"requests": "otp.requests", "delivery": "otp.delivery",
                      "verification": "otp.verification"}
    assert REQUEST_FIELDS[0] == "request_id" and "msisdn" in REQUEST_FIELDS
    for fields in (REQUEST_FIELDS, DELIVERY_FIELDS, VERIFICATION_FIELDS):
        assert "request_id" in fields
