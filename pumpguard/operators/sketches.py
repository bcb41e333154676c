"""Distinct counts that add up: the registers of a HyperLogLog sketch per pane and group, united
for any window.

A pane is a short tumbling window. Its registers are rows of a table (or of a stream's output), at
most ``2 ** LG_REGISTERS`` a group however many values it saw, and two panes are united by the
larger of equal registers: in whatever order rows and batches came, the estimate is the same number.
Spark's built-in sketch is smaller but its estimate depends on the order of its merges, so a stream
and a batch would tell different counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.operators.aggregates import FRAUD_KEYS

#: Registers as a power of two: three hexadecimal digits of the hash, the next thirteen are its rest.
LG_REGISTERS = 12
REGISTERS = 1 << LG_REGISTERS
REST_BITS = 52


def error_bound(n: float, deviations: float = 3.0) -> float:
    """How far an estimate of ``n`` lies from it at most, by standard errors (1.6 % each) and two for
    the few values that share a register in small groups."""
    return deviations * 1.04 / REGISTERS ** 0.5 * n + 2


def distinct_panes(events: DataFrame, value: str = "ip", keys: Sequence[str] = FRAUD_KEYS,
                   pane: str = "1 minute", ts_col: str = "event_ts",
                   delay: str | None = None) -> DataFrame:
    """pane_start, pane_end, ``keys``, ``register`` and ``level``, the longest run of leading zeros
    plus one among the register's values.

    Rows with a null time drop out; null values give a row without register, so that their group is
    there. Null keys are a group. Rows collapse to registers where they lie, so a hot group sends
    at most its registers from each task. ``events`` may be a stream: ``delay`` is then its watermark,
    and in append mode a pane comes once, when it is closed."""
    if delay is not None:
        events = events.withWatermark(ts_col, delay)
    digest = F.md5(F.col(value).cast("string").cast("binary"))
    rest = F.conv(F.substring(digest, 4, 13), 16, 10).cast("long")
    level = F.when(rest == 0, REST_BITS + 1).otherwise(REST_BITS + 1 - F.length(F.bin(rest)))
    register = F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")
    return (events.filter(F.col(ts_col).isNotNull())
            .select(F.window(ts_col, pane).alias("_pane"), *keys, register.alias("register"),
                    F.when(F.col(value).isNotNull(), level).cast("int").alias("_level"))
            .groupBy("_pane", *keys, "register").agg(F.max("_level").alias("level"))
            .select(F.col("_pane.start").alias("pane_start"), F.col("_pane.end").alias("pane_end"),
                    *keys, "register", "level"))


def distinct_windows(panes: DataFrame, name: str = "distinct_ip", keys: Sequence[str] = FRAUD_KEYS,
                     size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """window_start, window_end, ``keys`` and the estimate ``name`` for windows of ``size`` every
    ``slide`` (none: tumbling). Window and slide must be whole panes. A pane written twice (a
    replayed batch) counts once. No panes: no rows."""
    window = F.window("pane_start", size, slide) if slide else F.window("pane_start", size)
    united = (panes.select(window.alias("_window"), *keys, "register", "level")
              .groupBy("_window", *keys, "register").agg(F.max("level").alias("level")))
    empty = F.lit(REGISTERS) - F.col("_used")
    raw = F.lit(0.7213 / (1 + 1.079 / REGISTERS) * REGISTERS * REGISTERS) / (F.col("_sum") + empty)
    few = F.lit(float(REGISTERS)) * F.log(F.lit(float(REGISTERS)) / empty)
    estimate = F.when((raw <= 2.5 * REGISTERS) & (empty > 0), few).otherwise(raw)
    return (united.groupBy("_window", *keys)
            .agg(F.count("register").alias("_used"),
                 F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("level"))), F.lit(0.0)).alias("_sum"))
            .select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                    *keys, F.round(estimate).cast("long").alias(name)))
