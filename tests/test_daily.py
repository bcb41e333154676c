"""Marts merged from partials by day against the same marts built in full."""

import pytest

from pumpguard.operators import daily as D
from pumpguard.operators import marts as M
from pumpguard.plans.jobs import Layout, run_batch
from pumpguard.plans.registry import silver
from pumpguard.sinks.writers import with_event_date

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dated(spark):
    from pumpguard.session import scratch_path
    path = scratch_path(spark, "daily-silver")
    with_event_date(silver(spark, SF)).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


FULL = {"funnel_days": (D.merged_funnel, M.delivery_funnel), "latency_days": (D.merged_latency, M.latency_percentiles),
        "verify_days": (D.merged_verify_latency, M.verify_latency_percentiles)}


def test_merged_equals_full_after_every_day(spark, dated, scratch):
    """Days come one by one, the last two out of order; a late day rewrites its partition only."""
    days = [str(r[0]) for r in dated.select("event_date").distinct().orderBy("event_date").collect()]
    assert len(days) > 3
    layout = Layout(out_root=scratch)
    have = days[:-3]
    D.update_partials(spark, dated.filter(f"event_date <= '{have[-1]}'"), layout)
    for day in (days[-3], days[-1], days[-2]):
        have.append(day)
        before = files(spark, scratch, have[:-1])
        parts = D.update_partials(spark, dated, layout, (day, day))
        now = dated.filter(dated.event_date.cast("string").isin(have))
        for name, (merged, full) in FULL.items():
            assert rows(merged(parts[name]), full(now).columns) == rows(full(now)), name
        want = M.operator_performance(now)
        assert rows(D.merged_performance(parts["latency_days"]), want.columns) == rows(want)
        assert files(spark, scratch, have[:-1]) == before       # other days' files are untouched


def files(spark, root, days):
    out = set()
    for name in D.PARTIALS:
        for f in spark.read.parquet(f"{root}/{name}").inputFiles():
            if any(f"event_date={d}/" in f for d in days):
                out.add(f)
    return out


def test_only_the_days_are_read(spark, dated):
    plan = D.funnel_days(dated.filter("event_date between date'2024-01-01' and date'2024-01-01'"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "Exchange hashpartitioning(event_date" in text


def test_nulls_are_groups_and_missing_values_no_latency(spark):
    df = spark.createDataFrame(
        [("e", None, "1", "delivered", 5, True), ("e", None, "1", None, None, False), ("e", "2", "1", "failed", None, False)],
        "enterprise_id string, mcc string, mnc string, delivery_status string, operator_latency_ms int, is_verified boolean")
    df = df.selectExpr("*", "date'2024-01-01' as event_date")
    want = M.operator_performance(df)
    assert rows(D.merged_performance(D.latency_days(df)), want.columns) == rows(want)
    assert rows(D.merged_funnel(D.funnel_days(df))) == rows(M.delivery_funnel(df))


def test_daily_batch_equals_the_full_batch(spark, scratch):
    """The whole job: a full run, a rerun of the last day, against one full run elsewhere."""
    from pumpguard.plans.registry import FX, events
    ev = events(spark, SF)
    inputs = [with_event_date(d) for d in (FX.requests(ev), FX.delivery(ev), FX.verification(ev))]
    a = run_batch(spark, *inputs, Layout(out_root=f"{scratch}/a"))
    days = [str(r[0]) for r in a["silver"].select("event_date").distinct().orderBy("event_date").collect()]
    first = Layout(out_root=f"{scratch}/b")
    until = [d.filter(d.event_date.isNull() | (d.event_date.cast("string") <= days[-2])) for d in inputs]
    run_batch(spark, *until, first)
    b = run_batch(spark, *inputs, first, days=(days[-1], days[-1]))
    for name in ("delivery_funnel", "latency_pct", "ait_loss", "operator_performance"):
        assert rows(b[name]) == rows(a[name], b[name].columns), name
