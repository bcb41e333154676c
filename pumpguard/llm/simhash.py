"""SimHash near-duplicates: fingerprints of word shingles, linked by a byte-position index.

A fingerprint is eight positional bytes. Two fingerprints at most ``max_bits`` (4) bits apart
differ in at most four bytes, so they share at least four of the eight. The index is inverted on
positional bytes; since one byte alone is shared by 1/256 of all fingerprints, a posting key is
three bytes at fixed positions, and the 20 position triples are chosen so that any four
positions contain one of them (a Turan system for 8, 4, 3). Pairs that meet are tallied by
shared positional bytes, kept from the guaranteed count on, and verified by their bit distance.

Fingerprints are made distinct first, so a group of equal copies is one entry. Posting lists
over ``MAX_LIST`` are not paired: their fingerprints meet at half-way fingerprints instead, of
which each has a number that does not depend on the list. Both ways are exact.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pumpguard.llm.common import components, shipped_by_value, written

shipped_by_value(__name__)

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BYTES = 8
#: Fingerprints of one posting key that are compared pair by pair.
MAX_LIST = 1024


def _hashes(text: str, k: int):
    """The XXH64 digests (big-endian) of a text's shingles, as rows of eight bytes."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z; the six ASCII spaces
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    if len(words) >= k:
        starts, stops = starts[:len(words) - k + 1], stops[k - 1:]
    else:
        starts, stops = starts[:1], stops[-1:]
    cut = map(joined.__getitem__, map(slice, starts.tolist(), stops.tolist()))
    digests = b"".join(map(xxhash.xxh64_digest, cut, itertools.repeat(HASH_SEED)))
    return np.frombuffer(digests, np.uint8).reshape(-1, BYTES)


def fingerprint(text: str | None, k: int, bit_rows) -> int:
    """64 bits: a bit is set if it is set in over half of the shingle hashes; no word: zero."""
    if not text or not text.strip(" \t\n\x0b\x0c\r"):
        return 0
    rows = _hashes(text, k)
    counts = np.concatenate([np.bincount(rows[:, i], minlength=256) @ bit_rows
                             for i in range(BYTES)])
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big")


def _fingerprints(k: int):
    def run(batches):
        bit_rows = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
        for batch in batches:
            prints = [fingerprint(t.as_py(), k, bit_rows) for t in batch.column(0)]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([signed, *batch.columns[1:]],
                                             names=["fp", *batch.schema.names[1:]])
    return run


def covering_triples() -> list[tuple[int, int, int]]:
    """The fewest position triples of which every four positions contain one: 20 for 8, 4, 3.

    Turan's construction: three classes in a circle; the triples inside a class, and those with
    two positions of a class and one of the next.
    """
    size = {0: 3, 1: 3, 2: 2}
    kind = [c for c in size for _ in range(size[c])]
    out = []
    for t in itertools.combinations(range(BYTES), 3):
        n = [sum(kind[p] == c for p in t) for c in size]
        if 3 in n or any(n[c] == 2 and n[(c + 1) % 3] == 1 for c in size):
            out.append(t)
    return out


def links(prints: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """(a long, b long): edges whose components are those of all pairs of the distinct
    fingerprints ``fp`` at most ``max_bits`` bits apart."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees four shared bytes only up to 4 differing bits")
    shared_least = BYTES - max_bits
    triples = covering_triples()
    byte = [F.shiftrightunsigned("fp", 8 * (BYTES - 1 - p)).bitwiseAND(255) for p in range(BYTES)]
    keyed = prints.select("fp", F.explode(F.array(*[
        F.lit(i) * (1 << 24) + byte[x] * (1 << 16) + byte[y] * (1 << 8) + byte[z]
        for i, (x, y, z) in enumerate(triples)])).alias("key"))
    keyed = written(keyed, "simhash-keys")
    lists = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = written(keyed.join(lists, "key"), "simhash-lists")
    short = met.filter(F.col("n") <= max_list)
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    same = [F.shiftrightunsigned(differ, 8 * (BYTES - 1 - p)).bitwiseAND(255) == 0
            for p in range(BYTES)]
    tally = sum((s.cast("int") for s in same[1:]), same[0].cast("int"))
    # a pair meets under several keys; it is taken at the first of them
    first = F.coalesce(*[F.when(same[x] & same[y] & same[z], F.lit(i))
                         for i, (x, y, z) in enumerate(triples)])
    pairs = (short.alias("l").join(short.alias("r"), (F.col("l.key") == F.col("r.key"))
                                   & (F.col("l.fp") < F.col("r.fp"))
                                   & (tally >= shared_least)
                                   & (F.bit_count(differ) <= max_bits)
                                   & (first == F.shiftright(F.col("l.key"), 24)))
             .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
    return pairs.union(_halfway(met.filter(F.col("n") > max_list), max_bits))


def _halfway(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Edges of the crowded posting lists without pairing their members.

    Two fingerprints at most ``max_bits`` apart have a half-way point: one within ``floor`` and
    the other within ``ceil`` of half as many bits. Every member names the points around it,
    once for all of its crowded lists; all who name a point link to the smallest of those that
    are within the shorter reach, and each such link spans at most ``max_bits``.
    """
    short, far = max_bits // 2, -(-max_bits // 2)
    flips = [sum(1 << i for i in c) for n in range(far + 1)
             for c in itertools.combinations(range(64), n)]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in flips])
    named = crowded.select("fp").distinct().select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"),
        (F.bit_count("mask") <= short).alias("near"))
    centre = (named.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("low"),
                                         F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return (named.join(centre, "point").filter("fp <> low")
            .select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    max_list: int = MAX_LIST, id_col: str = "doc_id", text_col: str = "text",
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id that is reachable over links of at most ``max_bits`` differing bits), class_print
    (a fingerprint that stands for the component), and the small columns of ``carry``.

    Null, empty or blank texts have the fingerprint zero and are linked like any other. Null ids
    take part and are returned, but are never a component's id unless it has no other (then
    null). Repeated rows are returned as often as they come. Texts of any length are hashed
    whole. No rows: no rows. Other columns are not read.
    """
    carry = carry or {}
    slim = docs.select(F.col(text_col).cast("string").alias("text"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       *[c.alias(name) for name, c in carry.items()])
    schema = StructType([StructField("fp", LongType()), *slim.schema.fields[1:]])
    rows = written(slim.mapInArrow(_fingerprints(k), schema), "simhash-prints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "simhash-distinct")
    roots = components(links(prints, max_bits, max_list), "simhash-components")
    classed = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    lowest = classed.groupBy("root").agg(F.min("low_id").alias("component_id"))
    by_print = classed.join(lowest, "root").select("fp", "component_id", "root")
    return rows.join(by_print, "fp").select(
        "doc_id", _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("class_print"),
        *carry)


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _hashable(schema: StructType) -> Column:
    """The column ``row`` in a form that can be hashed: Spark hashes no maps, wherever they lie."""
    return F.to_json("row") if '"type":"map"' in schema.json() else F.col("row")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, one row of each component of ``near_duplicates``: that with
    the smallest id (null ids last), among equal ids that with the smallest hash of the row;
    of rows equal in all columns one."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    packed = packed.select("row", F.col(f"row.`{id_col}`").cast("long").alias("id"),
                           F.col(f"row.`{text_col}`").cast("string").alias("text"),
                           F.xxhash64(_hashable(docs.schema)).alias("mark"))
    found = near_duplicates(packed, k, max_bits, id_col="id", carry={"mark": F.col("mark")})
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "mark")
    first = found.groupBy("class_print").agg(F.min(order).alias("first"))
    first = first.select(F.coalesce("first.id", F.lit(0)).alias("keep_id"),
                         F.col("first.no_id").alias("keep_no_id"),
                         F.col("first.mark").alias("keep_mark"))
    same = ((F.coalesce("id", F.lit(0)) == F.col("keep_id"))
            & (F.col("id").isNull() == F.col("keep_no_id")) & (F.col("mark") == F.col("keep_mark")))
    kept = packed.join(first, same, "left_semi")
    # rows equal in all columns are as many as they came: one of them stays
    once = Window.partitionBy(F.coalesce("id", F.lit(0)), F.col("id").isNull(), "mark").orderBy("mark")
    return (kept.withColumn("n", F.row_number().over(once)).filter("n = 1")
            .select("row.*"))
