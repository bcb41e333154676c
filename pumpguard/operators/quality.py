"""Data-quality checks. Each check is one distributed aggregate; only counts reach the driver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECK_SCHEMA = "check STRING, target STRING, failed_rows BIGINT, ok BOOLEAN"


def _null_count(col: str) -> Column:
    return F.count_if(F.col(col).isNull())


def silver_checks(df: DataFrame) -> DataFrame:
    """The Silver expectations as one row per check, in fixed order:
    ``request_id`` must not be NULL; ``is_verified`` must be True or False (NULL fails)."""
    counts = df.agg(
        _null_count("request_id").alias("request_id"),
        F.count_if(~F.coalesce(F.col("is_verified").isin(True, False), F.lit(False)))
        .alias("is_verified"),
    )
    return counts.select(F.inline(F.array(
        F.struct(F.lit("not_null").alias("check"), F.lit("request_id").alias("target"),
                 F.col("request_id").alias("failed_rows")),
        F.struct(F.lit("in_set").alias("check"), F.lit("is_verified").alias("target"),
                 F.col("is_verified").alias("failed_rows")),
    ))).withColumn("ok", F.col("failed_rows") == 0)


def observe_silver(df: DataFrame, name: str = "silver_checks"):
    """``(df, observation)``: the Silver expectations computed while ``df`` is written (no
    separate pass). After the write, ``observation.get`` holds the failure counts."""
    from pyspark.sql import Observation
    obs = Observation(name)
    observed = df.observe(
        obs, _null_count("request_id").alias("request_id"),
        F.count_if(~F.coalesce(F.col("is_verified").isin(True, False), F.lit(False)))
        .alias("is_verified"))
    return observed, obs


def observed_result(obs) -> dict:
    """``{"ok", "failures"}`` from a completed ``observe_silver`` observation."""
    got = obs.get
    failures = [k for k in ("request_id", "is_verified") if int(got.get(k, 0) or 0) > 0]
    return {"ok": not failures, "failures": failures}


def validate_silver(df: DataFrame) -> dict:
    """``{"ok": bool, "failures": [...]}``; an empty frame passes."""
    rows = silver_checks(df).collect()
    failures = [r["target"] for r in rows if not r["ok"]]
    return {"ok": not failures, "failures": failures}


def not_null(df: DataFrame, col: str, name: str = "") -> DataFrame:
    return _check(df.agg(_null_count(col).alias("n")), "not_null", name or col)


def accepted_range(df: DataFrame, col: str, lo: float | None, hi: float | None,
                   name: str = "") -> DataFrame:
    """Rows outside [lo, hi] (inclusive); NULL passes."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return _check(df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("n")),
                  "accepted_range", name or col)


def accepted_values(df: DataFrame, col: str, values: Iterable, name: str = "") -> DataFrame:
    """Non-NULL values outside the domain."""
    vals = list(values)
    bad = F.col(col).isNotNull() & ~F.col(col).isin(*vals)
    return _check(df.agg(F.count_if(bad).alias("n")), "accepted_values", name or col)


def unique(df: DataFrame, cols: Sequence[str], name: str = "") -> DataFrame:
    """Number of rows whose key occurs more than once (partial aggregate, then a sum)."""
    cols = list(cols)
    dup = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
           .agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n")))
    return _check(dup, "unique", name or ",".join(cols))


def relationship(child: DataFrame, parent: DataFrame, key: str, name: str = "") -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    orphans = (child.select(key).filter(F.col(key).isNotNull())
               .join(parent.select(key).distinct(), key, "left_anti")
               .agg(F.count(F.lit(1)).alias("n")))
    return _check(orphans, "relationship", name or key)


def table_checks(parent: tuple[str, DataFrame], children: Sequence[tuple[str, DataFrame]], key: str,
                 unique: Sequence[str] = (), related: Sequence[str] = (),
                 values: Sequence[tuple[str, str, Sequence]] = ()) -> DataFrame:
    """The uniqueness, relationship and domain checks of a parent table and its children in one
    scan of each table and one shuffle on ``key``.

    ``unique`` names the tables whose key must not repeat, ``related`` the children whose key
    must be in the parent, ``values`` the (table, column, domain) triples. Each row is tagged
    with its table and its domain failures; they are summed by key (partial on the map side, so
    a hot key is a row per task) and then once over all. Failure counts and the treatment of
    NULL are those of ``unique``, ``relationship`` and ``accepted_values``."""
    tables = [parent, *children]
    names = [n for n, _ in tables]

    def bad(name: str, i: int) -> Column:
        table, col, domain = values[i]
        hit = (F.col(col).isNotNull() & ~F.col(col).isin(*domain)) if table == name else F.lit(False)
        return F.coalesce(hit, F.lit(False)).cast("long").alias(f"_bad_{i}")

    tagged = None
    for name, df in tables:
        part = df.select(F.col(key).alias("_key"),
                         *[F.lit(int(n == name)).cast("long").alias(f"_in_{i}")
                           for i, n in enumerate(names)],
                         *[bad(name, i) for i in range(len(values))])
        tagged = part if tagged is None else tagged.unionByName(part)
    sums = [c for c in tagged.columns if c != "_key"]
    by_key = tagged.groupBy("_key").agg(*[F.sum(c).alias(c) for c in sums])
    checks = []
    for name in unique:
        n = F.col(f"_in_{names.index(name)}")
        checks.append(("unique", f"{name}.{key}", F.sum(F.when(n > 1, n))))
    for name in related:
        orphan = F.col("_key").isNotNull() & (F.col("_in_0") == 0)
        checks.append(("relationship", f"{name}.{key}",
                       F.sum(F.when(orphan, F.col(f"_in_{names.index(name)}")))))
    for i, (name, col, _) in enumerate(values):
        checks.append(("accepted_values", f"{name}.{col}", F.sum(f"_bad_{i}")))
    counts = by_key.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"_{i}")
                          for i, (_, _, c) in enumerate(checks)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(target).alias("target"),
                 F.col(f"_{i}").alias("failed_rows"))
        for i, (check, target, _) in enumerate(checks)]))).withColumn(
            "ok", F.col("failed_rows") == 0)


def _check(counts: DataFrame, check: str, target: str) -> DataFrame:
    return counts.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                         F.col("n").cast("long").alias("failed_rows"),
                         (F.col("n") == 0).alias("ok"))


def mart_checks(funnel: DataFrame, latency: DataFrame, loss: DataFrame) -> DataFrame:
    """The mart tests: three not-null checks and the verify_rate range."""
    vr = F.col("verify_rate")
    f = funnel.agg(_null_count("enterprise_id").alias("nn"),
                   F.count_if(F.coalesce((vr < 0) | (vr > 1), F.lit(False))).alias("rg"))
    funnel_rows = f.select(F.inline(F.array(
        F.struct(F.lit("not_null").alias("check"),
                 F.lit("delivery_funnel.enterprise_id").alias("target"),
                 F.col("nn").cast("long").alias("failed_rows")),
        F.struct(F.lit("accepted_range").alias("check"),
                 F.lit("delivery_funnel.verify_rate").alias("target"),
                 F.col("rg").cast("long").alias("failed_rows")),
    ))).withColumn("ok", F.col("failed_rows") == 0)
    return (funnel_rows
            .unionByName(not_null(latency, "mcc", "latency_pct.mcc"))
            .unionByName(not_null(loss, "estimated_ait_loss_usd",
                                  "ait_loss.estimated_ait_loss_usd")))


def reconcile(layers: Sequence[tuple[str, DataFrame, int | DataFrame | None]]) -> DataFrame:
    """One row per layer: name, rows, expected, ok. ``expected`` is a number, another
    DataFrame (its row count) or None (no expectation)."""
    out = None
    for name, df, expected in layers:
        if isinstance(expected, DataFrame):
            # both counts in one global aggregate over the tagged union (no join)
            tagged = (df.select(F.lit(1).alias("_a"), F.lit(0).alias("_b"))
                      .unionByName(expected.select(F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
            row = tagged.agg(F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("rows"),
                             F.coalesce(F.sum("_b"), F.lit(0)).cast("long").alias("expected"))
        else:
            row = (df.agg(F.count(F.lit(1)).alias("rows"))
                   .withColumn("expected", F.lit(expected).cast("long")))
        row = row.select(F.lit(name).alias("layer"), "rows", "expected",
                         F.coalesce(F.col("rows") == F.col("expected"), F.lit(True)).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


def require_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Missing column names (empty = all present). Schema-only, no job."""
    have = set(df.columns)
    return [n for n in names if n not in have]


def raise_on_failure(checks: DataFrame) -> DataFrame:
    """Stop a job when any check failed (only the check rows reach the driver)."""
    bad = [r for r in checks.collect() if not r["ok"]]
    if bad:
        raise AssertionError("quality checks failed: " + ", ".join(
            f"{r['check']}({r['target']})={r['failed_rows']}" for r in bad))
    return checks


def empty_checks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHECK_SCHEMA)
