"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked inside their source; the fractional rank
``(rank + phase) / rows of the source`` spreads every source evenly over [0, 1); sorted by it,
any stretch of rows has the mixture of the whole, and equal stretches are the shards. Law:
``rows`` (counts at most one apart). The phase is a hash of the source, so that very many tiny
sources do not all fall on the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import cells_for, rank_by_unit, unit_hash, written

SHARDS = 40
SEED = "17"
#: Stands for a null source: a source of its own.
NO_SOURCE = "\x01null"


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The text is read once, for its length and checksum, and never shuffled. Null text: size 16
    and the checksum of the empty string. Null source: one more stratum. Null ids are kept; rows
    equal in id, source and text are interchangeable and take neighbouring places. No rows: no
    rows. Columns other than the three named are not read, whatever their names.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the checksum and length of the UTF-8 bytes
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("_s"),
                       (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    rows = rows.withColumn("_h", unit_hash(seed, F.coalesce("doc_id", F.lit(-1)), F.col("text_crc32")))
    rows = written(rows, "shard-rows")
    total = rows.count()
    cells = cells_for(total)
    ties = ["doc_id", "text_crc32", "size"]
    ranked = rank_by_unit(rows, ["_s"], "_h", ties, cells, "_rank")
    per_source = rows.groupBy(F.col("_s").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = ranked.join(per_source, F.col("_s") == F.col("_of")).drop("_of")
    ranked = ranked.withColumn("_frac", (F.col("_rank").cast("double") + unit_hash(seed, F.col("_s")))
                               / F.col("_n").cast("double"))
    placed = rank_by_unit(ranked, [], "_frac", ["_s", "_h", *ties], cells, "_pos")
    shard = F.expr(f"cast((_pos * {shards}L) div {max(total, 1)}L as int)")
    first = F.expr(f"((cast(shard as long) * {max(total, 1)}L) + {shards - 1}L) div {shards}L")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("_pos") - first)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), F.nullif(F.col("_s"), F.lit(NO_SOURCE)).alias("stratum")))
