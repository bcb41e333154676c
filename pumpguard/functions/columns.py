"""Scalar ``Column`` builders. All are JVM expressions (whole-stage codegen, no UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_range(col: str | Column = "msisdn", n: int = 6) -> Column:
    """First ``n`` characters of the destination number (1-based substring)."""
    return F.substring(_c(col), 1, n)


def is_verified(col: str | Column = "verification_outcome") -> Column:
    """True iff the outcome is 'verified'; a missing outcome is False, never NULL."""
    return F.coalesce(_c(col) == F.lit("verified"), F.lit(False))


def to_event_time(col: str | Column = "event_ts") -> Column:
    """ISO-8601 text (with offset) or a timestamp -> TIMESTAMP; unparsable text -> NULL.

    A plain cast raises under ANSI mode, so untrusted text goes through ``try_to_timestamp``.
    """
    return F.try_to_timestamp(_c(col).cast("string"))


def to_day(col: str | Column) -> Column:
    return F.to_date(_c(col))


def safe_rate(num: str | Column, den: str | Column, dp: int | None = 4) -> Column:
    """``num / den`` in DOUBLE, NULL when ``den`` is 0, rounded to ``dp`` places."""
    r = _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    return F.round(r, dp) if dp is not None else r


def ait_loss_amount(requested: str | Column, rate: str | Column, cfg) -> Column:
    """Estimated loss: ``requested * cost`` when requested > min and rate < ceiling, else 0.

    Strict ``>`` on the request count (the rule engine uses ``>=``)."""
    req, vr = _c(requested), _c(rate)
    cond = (req > F.lit(cfg.loss_min_requests)) & (vr < F.lit(float(cfg.loss_verify_rate_ceiling)))
    return (F.when(cond, req.cast("double") * F.lit(float(cfg.loss_cost_per_message)))
            .otherwise(F.lit(0.0)))


def high_risk_route(mcc: str | Column = "mcc", mnc: str | Column = "mnc",
                    routes: Iterable[tuple[str, str]] = ()) -> Column:
    """(mcc, mnc) is one of ``routes``; NULL parts are never members."""
    m, n = _c(mcc), _c(mnc)
    cond = F.lit(False)
    for a, b in routes:
        cond = cond | ((m == F.lit(a)) & (n == F.lit(b)))
    return F.coalesce(cond, F.lit(False))


def millis_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed milliseconds between two timestamps (NULL if either is NULL)."""
    return F.timestamp_diff("MILLISECOND", _c(start), _c(end))
