"""Helpers that several operators share: written tables, ranks without one-task groups, and
connected components."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pumpguard.session import scratch_path

#: Rows that one task ranks at once; a group larger than this is split into cells.
ROWS_PER_CELL = 50_000


def shipped_by_value(module: str) -> None:
    """Pickle what a module gives to Python workers by value: the workers then do not need this
    package on their own path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


#: Words: runs of ASCII letters, digits and underscores and of characters from U+00C0 on, but for
#: general punctuation.
WORD = re.compile("[0-9A-Za-z_\u00c0-\u1fff\u2070-\U0010ffff]+")
_BLANKED = bytes(c if c >= 128 or c == 95 or chr(c).isalnum() else 32 for c in range(256))
_SIGNS = re.compile(b"\xc2[\x80-\xbf]|\xe2\x80[\x80-\xbf]|\xe2\x81[\x80-\xaf]")


def blanked(lowered: str) -> bytes:
    """``lowered`` as UTF-8 with a space for all that is no part of a word."""
    raw = lowered.encode("utf-8", "surrogatepass")
    if not lowered.isascii():
        raw = _SIGNS.sub(b" ", raw)
    return raw.translate(_BLANKED)


def byte_words(lowered: str) -> list[bytes]:
    """``WORD.findall`` as UTF-8, several times faster."""
    return blanked(lowered).split()


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back: the
    lineage is cut and a lost executor costs nothing that was computed before."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


shipped_by_value(__name__)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit_hash(*parts: Column | str) -> Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits, exact in a double."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    hexed = F.substring(F.md5(F.concat_ws("|", *cols)), 1, 13)
    return F.conv(hexed, 16, 10).cast("long") / F.lit(float(1 << 52))


def rank_by_unit(df: DataFrame, keys: list[str], unit: str, ties: list[str], cells: int,
                 rank: str) -> DataFrame:
    """Add ``rank``: the gapless place (from 0) of each row inside its ``keys`` group, ordered by
    the column ``unit`` (a spread number in [0, 1)) and then ``ties``.

    A group is cut by ``unit`` into ``cells`` equal ranges; rows are numbered inside a cell and
    the counts of the cells before it are added, so no task sees a whole hot group. ``keys`` may
    be empty (one global order): then one task sums ``cells`` counts and nothing else.
    Null keys form a group of their own.
    """
    celled = df.withColumn("_cell", F.least(F.floor(F.col(unit) * cells),
                                            F.lit(cells - 1)).cast("int"))
    counts = celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_in"))
    before = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    before = before.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           F.col("_cell").alias("_at"),
                           F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"))
    same = F.col("_cell") == F.col("_at")
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_k_{k}")) & same
    inside = Window.partitionBy(*keys, "_cell").orderBy(unit, *ties)
    return (celled.withColumn("_row", F.row_number().over(inside))
            .join(counts, same, "inner")
            .withColumn(rank, (F.col("_before") + F.col("_row") - 1).cast("long"))
            .drop("_cell", "_row", "_at", "_before", *[f"_k_{k}" for k in keys]))


def first_by_unit(df: DataFrame, unit: str, ties: list[str], most: int) -> DataFrame:
    """The ``most`` rows that are lowest by the column ``unit`` (a spread number in [0, 1)) and
    then ``ties``. Rows with a ``unit`` far beyond the last one's are left out before the sort,
    so what the tasks send on is bounded by ``most`` and not by the number of tasks. Fewer rows:
    all of them."""
    near = (2 * most + 100) / max(df.count(), 1)
    return df.filter(F.col(unit) < F.lit(near)).orderBy(unit, *ties).limit(most)


def cells_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_CELL))


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): the smallest node of its
    connected component.

    Alternating star contraction: each round links every neighbour of a node to the smallest one
    of its neighbourhood, first the larger neighbours, then the smaller ones, until each
    component is one star. Groups are read through joins with an aggregated minimum, so a hub
    with very many neighbours never sits in one task's memory. Each round is a written table.
    """
    links = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), name)
    for _ in range(max_rounds):
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low2.select("a", F.col("m").alias("b"))).distinct())
        after = written(small, name)
        # a star forest: every node has one smaller neighbour, and no root hangs on another
        left = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        chained = after.select(F.col("b").alias("a")).join(after.select("a"), "a", "left_semi")
        links = after
        if left.isEmpty() and chained.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
