"""Route dimension: (mcc, mnc) -> country and operator label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROUTE_SCHEMA = "mcc STRING, mnc STRING, route_country STRING, operator STRING, high_risk BOOLEAN"

# The routes that occur in the event model, with descriptive labels.
ROUTES = [
    ("247", "1", "LV", "lv-premium-range", True),
    ("88", "0", "XX", "international-shared", True),
    ("881", "0", "XS", "global-satellite", True),
    ("310", "260", "US", "us-mobile-260", False),
    ("404", "45", "IN", "in-mobile-45", False),
    ("234", "10", "GB", "gb-mobile-10", False),
    ("724", "5", "BR", "br-mobile-5", False),
]


def route_dimension(spark: SparkSession, rows=None) -> DataFrame:
    """A caller-supplied routing table (defaults to ``ROUTES``); a few thousand rows at most in
    practice, so it is a broadcast candidate (size checked in ``route_enrichment``)."""
    return spark.createDataFrame(rows or ROUTES, ROUTE_SCHEMA)
