"""Layers and tables survive runs that fail or are killed at any step."""

import itertools

import pytest
from pyspark.sql import functions as F

from pumpguard.sinks import writers as W


class Killed(BaseException):
    """Nothing catches it, like the end of a process."""


def days_at(spark, path):
    df = spark.read.parquet(path)
    return sorted((str(r["event_date"]), r["run"]) for r in df.select("event_date", "run").collect())


def write_days(spark, path, days, run):
    (spark.createDataFrame([(d, run) for d in days], "event_date string, run string").write.mode("overwrite")
     .partitionBy("event_date").parquet(path))


@pytest.mark.parametrize("error", [Killed, RuntimeError])
def test_switch_of_days_stopped_at_every_step(spark, scratch, monkeypatch, error):
    old = [("2024-01-01", "old"), ("2024-01-02", "old"), ("2024-01-03", "old")]
    new = [("2024-01-01", "old"), ("2024-01-02", "new"), ("2024-01-04", "new")]  # the 3rd is empty now
    rename = W._rename
    for step in itertools.count():
        layer, staged = f"{scratch}/layer{step}", f"{scratch}/staged{step}"
        write_days(spark, layer, [d for d, _ in old], "old")
        write_days(spark, staged, ["2024-01-02", "2024-01-04"], "new")
        left = step

        def stopping(fs, a, b):
            nonlocal left
            if left == 0:
                left = -1
                raise error("stopped")
            left -= 1
            rename(fs, a, b)
        monkeypatch.setattr(W, "_rename", stopping)
        try:
            W.switch_days(spark, staged, layer, "event_date", ("2024-01-02", "2024-01-04"))
        except error:
            monkeypatch.setattr(W, "_rename", rename)
            assert W.restore_days(spark, layer) == (error is Killed)
            assert days_at(spark, layer) == old
            write_days(spark, staged, ["2024-01-02", "2024-01-04"], "new")  # the run after stages anew
            W.switch_days(spark, staged, layer, "event_date", ("2024-01-02", "2024-01-04"))
            assert days_at(spark, layer) == new
            continue
        monkeypatch.setattr(W, "_rename", rename)
        assert days_at(spark, layer) == new
        break
    assert step == 5  # two days moved aside, two in, one rename that settles it


def test_switch_takes_no_day_beyond_its_range(spark, scratch):
    write_days(spark, f"{scratch}/layer", ["2024-01-01"], "old")
    write_days(spark, f"{scratch}/staged", ["2024-01-01", "2024-01-02"], "new")
    with pytest.raises(ValueError):
        W.switch_days(spark, f"{scratch}/staged", f"{scratch}/layer", "event_date", ("2024-01-02", "2024-01-02"))
    assert days_at(spark, f"{scratch}/layer") == [("2024-01-01", "old")]


@pytest.mark.parametrize("step", [0, 1])
def test_switch_of_a_folder_killed_between_its_renames(spark, scratch, monkeypatch, step):
    layer, staged = f"{scratch}/layer", f"{scratch}/staged"
    write_days(spark, layer, ["2024-01-01"], "old")
    write_days(spark, staged, ["2024-01-01"], "lost")
    rename, calls = W._rename, itertools.count()

    def stopping(fs, a, b):
        if next(calls) == step:
            raise Killed
        rename(fs, a, b)
    monkeypatch.setattr(W, "_rename", stopping)
    with pytest.raises(Killed):
        W.switch_folder(spark, staged, layer)
    monkeypatch.undo()
    write_days(spark, f"{scratch}/next", ["2024-01-01"], "new")

    def failing(fs, a, b):
        if a.getName() == "next":
            raise RuntimeError
        rename(fs, a, b)
    monkeypatch.setattr(W, "_rename", failing)
    with pytest.raises(RuntimeError):                   # the run after fails too: the old layer is still there
        W.switch_folder(spark, f"{scratch}/next", layer)
    monkeypatch.undo()
    assert days_at(spark, layer) == [("2024-01-01", "old")]
    W.switch_folder(spark, f"{scratch}/next", layer)
    assert days_at(spark, layer) == [("2024-01-01", "new")]


def leave(spark, name):
    """A folder without a table, as a failed or killed write leaves it."""
    fs, folder = W._folder(spark, W._table_folder(spark, name))
    fs.mkdirs(folder)
    fs.create(W._folder(spark, f"{folder.toString()}/part-0")[1]).close()


@pytest.mark.parametrize("leftover", ["__staging", "__old", ""])
def test_replace_table_with_a_leftover_folder(spark, leftover):
    name = f"pg_leftover{leftover.strip('_')}"
    W._clear_table(spark, name)
    if leftover:
        W.replace_table(spark.range(3), name)
    leave(spark, name + leftover)
    W.replace_table(spark.range(5), name)
    assert spark.table(name).count() == 5
    W._clear_table(spark, name)


@pytest.mark.parametrize("step", [0, 1])
def test_replace_table_killed_between_its_renames(spark, monkeypatch, step):
    name = "pg_killed"
    W._clear_table(spark, name)
    W.replace_table(spark.range(3), name)
    rename, calls = W._rename_table, itertools.count()

    def stopping(session, a, b):
        if next(calls) == step:
            raise Killed
        rename(session, a, b)
    monkeypatch.setattr(W, "_rename_table", stopping)
    with pytest.raises(Killed):
        W.replace_table(spark.range(4), name)
    monkeypatch.undo()
    with pytest.raises(Exception):                      # a failing run brings the old table back
        W.replace_table(spark.range(2).select(F.raise_error(F.lit("no good")).alias("id")), name)
    assert spark.table(name).count() == 3
    W.replace_table(spark.range(5), name)
    assert spark.table(name).count() == 5
    W._clear_table(spark, name)


def test_quarantine_is_not_switched_when_silver_fails_its_checks(spark, scratch):
    from pumpguard.plans.jobs import Layout, run_silver
    schema = "request_id string, msisdn string, enterprise_id string, event_ts timestamp"

    def run(rows):
        req = spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn(
            "event_ts", F.col("event_ts").cast("timestamp"))
        dlv = spark.createDataFrame([], "request_id string, status string, operator_latency_ms int, event_ts timestamp")
        ver = spark.createDataFrame([], "request_id string, outcome string, attempts int, event_ts timestamp")
        return run_silver(spark, req, dlv, ver, Layout(out_root=scratch))
    run([("a", "1", "e", "2024-01-01 00:00:00"), ("lost", "1", "e", None)])
    with pytest.raises(AssertionError):                 # a request without an id
        run([(None, "1", "e", "2024-01-01 00:00:00"), ("other", "1", "e", None)])
    ids = [r["request_id"] for r in spark.read.parquet(f"{scratch}/silver_quarantine").collect()]
    assert ids == ["lost"]
    assert [r["request_id"] for r in spark.read.parquet(f"{scratch}/silver").collect()] == ["a"]
