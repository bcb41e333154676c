"""Bronze -> Silver: dedupe requests, attach delivery and verification, derive two columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.functions.columns import is_verified, number_range


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
           latest: bool = True) -> DataFrame:
    """One row per key.

    Without ``order_by`` any row of a key survives (``dropDuplicates``). With ``order_by`` the
    survivor is deterministic: the row with the largest (``latest``) or smallest ordering tuple,
    ties broken by the remaining columns. Both forms are sort aggregates with a map-side partial
    step (the sort order is reused by joins on the keys), so a key holding a third of the rows collapses to one row per map task before the
    shuffle (a ``row_number`` window would send the whole hot key to one task).
    """
    keys = list(keys)
    if not order_by:
        return df.dropDuplicates(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_row")
    pick = F.max(packed) if latest else F.min(packed)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order_by + rest])
            .select(*df.columns))


def _child(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def build_silver(requests: DataFrame, delivery: DataFrame, verification: DataFrame,
                 dedupe_children: bool = False) -> DataFrame:
    """Requests (deduplicated on request_id) left-joined to delivery and verification.

    * ``status`` -> ``delivery_status``, ``outcome`` -> ``verification_outcome``; the children's
      ``event_ts`` (and day partition ``event_date``) become ``delivery_ts`` /
      ``verification_ts`` (``delivery_date`` / ``verification_date``) so full rows do not
      collide.
    * ``number_range`` = first six msisdn characters; ``is_verified`` is False (not NULL) when
      there is no verification.
    * ``dedupe_children=False`` keeps the documented fan-out (n deliveries -> n rows);
      ``True`` keeps the latest child per request (by its timestamp when present).

    Plan: dedupe is an aggregate hash-partitioned on request_id, so the two sort-merge joins on the
    same key add one exchange per child and none on the request side.
    """
    req = dedupe(requests, ["request_id"])
    d = _child(delivery, {"status": "delivery_status", "event_ts": "delivery_ts",
                          "event_date": "delivery_date"})
    v = _child(verification, {"outcome": "verification_outcome", "event_ts": "verification_ts",
                              "event_date": "verification_date"})
    if dedupe_children:
        d = dedupe(d, ["request_id"], ["delivery_ts"] if "delivery_ts" in d.columns else None)
        v = dedupe(v, ["request_id"],
                   ["verification_ts"] if "verification_ts" in v.columns else None)
    joined = req.join(d, "request_id", "left").join(v, "request_id", "left")
    return joined.withColumns({
        "number_range": number_range("msisdn"),
        "is_verified": is_verified("verification_outcome"),
    })
