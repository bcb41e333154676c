"""Benchmark decontamination: rare n-gram seeds join passages to test items, then Smith-Waterman.

A seed is an ordered pair of a test item's words that follow each other or have one word between
them; a text holds it under the same rule, so a replaced, added or missing word breaks few seeds.
How many a copy must keep follows from the limit. Let an alignment of an item of n words match m of
them with e errors and reach the limit: 2m - e >= 2n * limit. Of its m - 1 neighbouring matches at
most e / 2 have two errors or more between them, so at least n * limit - 1 are seeds of both, all
within n * (3 - 2 * limit) words of the text. The commonest seeds, by word counts over the whole corpus,
can therefore be left out up to half of that number, and the other half must still be found. No
copy that the alignment accepts is lost, whatever the size of the corpus.

Seeds are a table of fingerprints, joined to the fingerprints of the texts; only those that a bit
map of fixed size holds are shuffled. A passage with enough seeds of one item is cut out of its text,
joined to the item and aligned. Equal texts are aligned once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpguard.llm.collocations import MAP_BITS, SEGMENT_BYTES, _bit_map, _marked, _mixed, _spans
from pumpguard.llm.common import WORD, blanked, byte_words, shipped_by_value, written

shipped_by_value(__name__)

EXPECTED = 1.0            # occurrences that a seed may have by chance in the whole corpus
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of a perfect alignment's score from which on a document is contaminated.
LIMIT = 0.5
#: Words from a seed's first word to its second.
STEPS = (1, 2)
#: Text that a task turns into fingerprints at once.
BLOCK_BYTES = 1 << 19
#: Keys of found texts up to which they are broadcast.
FEW_KEYS = 1_000_000
#: Different words that a task counts before it hands its counts on.
MOST_HELD = 200_000
#: Cells over which the texts of one seed, or of one item, are dealt.
SALTS = 16
_BASE, _PAIR = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def words_of(text: str | None) -> list[bytes]:
    return byte_words(text.lower()) if text else []


# ------------------------------------------------------------------ fingerprints

class Words:
    """The words of some texts: fingerprint, text and place in the text of each."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = raw != 0x20
        start = np.nonzero(inside[1:-1] & ~inside[:-2])[0]
        stop = np.nonzero(inside[1:-1] & ~inside[2:])[0] + 1
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        offsets = np.cumsum(sizes) - sizes
        self.doc = np.searchsorted(offsets, start, "right") - 1
        self.place = np.arange(len(start)) - np.searchsorted(start, offsets)[self.doc]
        self.prints = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):
            end = max(int(np.searchsorted(stop, start[at] + SEGMENT_BYTES, "right")), at + 1)
            values = raw[start[at]:stop[end - 1]].astype(np.uint64) + np.uint64(1)
            self.prints[at:end] = _spans(values, start[at:end] - start[at], stop[at:end] - start[at], _BASE)
            at = end
        self.prints = _mixed(self.prints)

    def pairs(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of the pairs of words ``step`` apart in one text."""
        at = np.nonzero(self.doc[step:] == self.doc[:-step])[0]
        return at, _mixed(self.prints[at] * np.uint64(_PAIR) + self.prints[at + step])


def _chunks(batches, column: int, block_bytes: int = BLOCK_BYTES):
    """(the other columns' rows, texts as bytes of lower-cased words) of ``block_bytes`` or one text."""
    rows, texts, held = [], [], 0
    for batch in batches:
        others = [c for i, c in enumerate(batch.columns) if i != column]
        for i in range(batch.num_rows):
            text = batch.column(column)[i].as_py()
            if not text:
                continue
            if texts and held + len(text) > block_bytes:
                yield rows, texts
                rows, texts, held = [], [], 0
            rows.append(tuple(c[i].as_py() for c in others))
            texts.append(blanked(text.lower()))
            held += len(text)
    if texts:
        yield rows, texts


def _batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))


def _item_seeds(batches):
    """item, n, seed, first, second: the seeds of every item; an item of one word is its own."""
    for rows, texts in _chunks(batches, 1):
        words = Words(texts)
        items = np.array([r[0] for r in rows], np.int64)
        sizes = np.bincount(words.doc, minlength=len(items))
        alone = np.nonzero(sizes[words.doc] == 1)[0]
        found = [(alone, alone, words.prints[alone])]
        found += [(at, at + step, seed) for step in STEPS for at, seed in [words.pairs(step)]]
        first, second, seed = (np.concatenate(c) for c in zip(*found))
        doc = words.doc[first]
        yield _batch([items[doc], sizes[doc], seed.view(np.int64), words.prints[first].view(np.int64),
                      words.prints[second].view(np.int64)], ("item", "n", "seed", "first", "second"))


def _word_counts(bits, block_bytes: int):
    """Counts of the words that the bit map holds; a row without a word counts all words."""
    def run(batches):
        total, known, counts = 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            return _batch([pa.array([None, *known.view(np.int64).tolist()], pa.int64()), [total, *counts.tolist()]],
                          ("word", "n"))
        for _, texts in _chunks(batches, 0, block_bytes):
            prints = Words(texts).prints
            total += len(prints)
            now, n = np.unique(prints[_marked(bits.value, prints)], return_counts=True)
            known, place = np.unique(np.concatenate((known, now)), return_inverse=True)
            added = np.zeros(len(known), np.int64)
            np.add.at(added, place, np.concatenate((counts, n)))
            counts = added
            if len(known) > MOST_HELD:
                yield out()
                total, known, counts = 0, known[:0], counts[:0]
        yield out()
    return run


def _text_seeds(bits, alone: bool, least: int, reach: int, block_bytes: int):
    """The seeds that the bit map holds, where at least ``least`` lie within ``reach`` words."""
    def run(batches):
        for rows, texts in _chunks(batches, 0, block_bytes):
            words = Words(texts)
            found = [(words.pairs(step), step) for step in STEPS]
            if alone:
                found.append(((np.arange(len(words.doc)), words.prints), 0))
            at, step, seed = [], [], []
            for (first, prints), s in found:
                good = _marked(bits.value, prints)
                at.append(first[good])
                seed.append(prints[good])
                step.append(np.full(len(at[-1]), s))
            at, step, seed = (np.concatenate(c) for c in (at, step, seed))
            order = np.argsort(at, kind="stable")
            at, step, seed = at[order], step[order], seed[order]
            many = np.searchsorted(at, at + reach) - np.arange(len(at))
            begins = np.nonzero(many >= least)[0]
            cover = np.zeros(len(at) + 1, np.int64)
            np.add.at(cover, begins, 1)
            np.add.at(cover, begins + many[begins], -1)
            near = np.cumsum(cover[:-1]) > 0
            at, step, seed = at[near], step[near], seed[near]
            doc = words.doc[at]
            for a in range(0, len(at), 100_000):
                part = slice(a, a + 100_000)
                keys = [rows[d] for d in doc[part].tolist()]
                yield _batch([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()),
                              words.place[at[part]], step[part].astype(np.int32), seed[part].view(np.int64)],
                             ("key", "check", "at", "step", "seed"))
    return run


def _pointed(column: int, bits):
    """The rows whose number in ``column`` the bit map holds."""
    def run(batches):
        for batch in batches:
            marked = _marked(bits.value, batch.column(column).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(marked))
    return run


# ------------------------------------------------------------------ alignment

def align(item: list[bytes], words: list[bytes]) -> tuple[int, int, int]:
    """(score, start, stop) of the best local alignment of ``item`` inside ``words``."""
    numbers: dict[bytes, int] = {}
    a = [numbers.setdefault(w, len(numbers)) for w in item]
    b = np.array([numbers.get(w, -1) for w in words])
    score, stop = _best(a, b)
    if not score:
        return 0, 0, 0
    back, length = _best(a[::-1], b[:stop][::-1], score)
    return score, stop - length, stop


def _best(a: list[int], b: np.ndarray, wanted: int | None = None) -> tuple[int, int]:
    """The best local score of a against b and where in b it ends; the first of equals."""
    slope = np.arange(len(b) + 1) * -GAP
    row, best, at = np.zeros(len(b) + 1, np.int64), 0, 0
    for x in a:
        step = np.where(b == x, MATCH, MISMATCH)
        new = np.zeros(len(b) + 1, np.int64)
        new[1:] = np.maximum(np.maximum(row[:-1] + step, row[1:] + GAP), 0)
        new = np.maximum.accumulate(new + slope) - slope  # gaps along b
        top = int(new.argmax())
        if new[top] > best:
            best, at = int(new[top]), top
        row = new
    return best, at


def spots_of(text: str) -> list[tuple[int, int]]:
    """Where the words of a text lie, in code points of the text itself: a letter that is longer in
    lower case (U+0130) moves none behind it."""
    lowered = text.lower()
    spans = [m.span() for m in WORD.finditer(lowered)]
    if len(lowered) == len(text):
        return spans
    owner = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(owner[a], owner[b - 1] + 1) for a, b in spans]


PASSAGES = ("key long, check int, item long, hits long, words binary, starts array<int>, stops array<int>")
ALIGNED = "key long, check int, item_id long, item long, score double, start int, stop int, seeds int"


def _passages(batches):
    """For each (item, block) that is wanted of a text: its words, and where they lie."""
    for batch in batches:
        for key, check, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            words, spots = words_of(text), spots_of(text)
            for a in range(0, len(wanted), 256):
                some = wanted[a:a + 256]
                parts = [slice(w["block"] * w["reach"], (w["block"] + 2) * w["reach"]) for w in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(some), pa.int64()), pa.array([check] * len(some), pa.int32()),
                     pa.array([w["item"] for w in some], pa.int64()), pa.array([w["hits"] for w in some], pa.int64()),
                     pa.array([b" ".join(words[p]) for p in parts], pa.binary()),
                     pa.array([[lo for lo, _ in spots[p]] for p in parts], pa.list_(pa.int32())),
                     pa.array([[hi for _, hi in spots[p]] for p in parts], pa.list_(pa.int32()))],
                    names=["key", "check", "item", "hits", "words", "starts", "stops"])


def _aligned(limit: float):
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())

    def run(batches):
        for batch in batches:
            out = [[] for _ in kinds]
            for key, check, item, hits, words, starts, stops, item_id, text in zip(
                    *(c.to_pylist() for c in batch.columns)):
                wanted = words_of(text)
                score, a, b = align(wanted, words.split(b" "))
                share = score / (MATCH * len(wanted))
                if share >= limit:
                    for column, value in zip(out, (key, check, item_id, item, share, starts[a], stops[b - 1], hits)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["key", "check", "item_id", "item", "score", "start", "stop", "seeds"])
    return run


# ------------------------------------------------------------------ joins

def _dealt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt():
    return F.pmod(F.xxhash64("key", "check"), F.lit(SALTS)).cast("int")


def item_seeds(items: DataFrame, texts: DataFrame, limit: float, expected: float,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """seed, item, reach (words that a copy may take), needed (seeds that it must keep) of ``items``
    (item, text), with word counts over all ``texts`` (text). Left out are seeds that chance would
    yield more than ``expected`` times, the commonest first, as far as every copy keeps enough."""
    pairs = written(items.select("item", "text").mapInArrow(
        _item_seeds, "item long, n long, seed long, first long, second long"), "decon-pairs")
    known = pairs.select(F.col("first").alias("word")).union(pairs.select("second")).distinct()
    bits = _bit_map(known, MAP_BITS)
    counts = written(texts.mapInArrow(_word_counts(bits, block_bytes), "word long, n long")
                     .groupBy("word").agg(F.sum("n").alias("count")), "decon-words")
    total = float(counts.filter("word is null").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] or 1)
    for side in ("first", "second"):
        counted = counts.select(F.col("word").alias(side), F.col("count").alias(f"{side}_n"))
        pairs = pairs.join(counted, side, "left")
    share = [F.coalesce(f"{s}_n", F.lit(1)) / F.lit(total) for s in ("first", "second")]
    chance = F.lit(total) * share[0] * share[1]
    kept = F.greatest(F.ceil(F.col("n") * limit) - 1, F.lit(1))  # seeds that a copy shares at least
    needed = F.ceil(kept / 2)
    commonest = Window.partitionBy("item").orderBy(F.desc("chance"), "seed")
    return (pairs.withColumn("chance", chance).withColumn("kept", kept).withColumn("needed", needed)
            .withColumn("place", F.row_number().over(commonest))
            .filter((F.col("place") > F.col("kept") - F.col("needed")) | (F.col("chance") <= expected))
            .select("seed", "item", F.ceil(F.col("n") * (3 - 2 * limit)).alias("reach"), "needed", "n").distinct())


def _keyed(docs: DataFrame, text_col: str, key: str = "key", check: str = "check") -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.withColumn(key, F.xxhash64(text)).withColumn(check, F.hash(text))


def matches(texts: DataFrame, items: DataFrame, limit: float, expected: float,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per different text of ``texts`` (text, key, check) and item of ``items`` (item_id, text)
    that it holds: key, check, item_id, score, start, stop, seeds. A written table."""
    items = written(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                    .filter("text is not null").distinct()
                    .withColumn("item", F.monotonically_increasing_id()), "decon-items")
    seeds = written(item_seeds(items, texts.select("text"), limit, expected, block_bytes), "decon-seeds")
    facts = seeds.agg(F.min("needed").alias("least"), F.max("reach").alias("reach"),
                      F.max(F.col("n") == 1).alias("alone")).first()
    if facts["least"] is None:
        least, reach, alone = 1, 1, False
    else:
        least, reach, alone = facts
    bits = _bit_map(seeds.select("seed"), MAP_BITS)
    hits = texts.select("text", "key", "check").mapInArrow(
        _text_seeds(bits, alone, least, reach, block_bytes), "key long, check int, at long, step int, seed long").distinct()
    joined = hits.withColumn("_salt", _salt()).join(
        _dealt(seeds.select("seed", "item", "reach", "needed")).hint("merge"), ["seed", "_salt"])
    block = F.floor(F.col("at") / F.col("reach"))
    wanted = (joined.withColumn("block", F.explode(F.array(block, block - 1))).filter("block >= 0")
              .groupBy("key", "check", "item", "reach", "needed", "block").agg(F.count(F.lit(1)).alias("hits"))
              .filter("hits >= needed"))
    wanted = written(wanted.select("key", "check", "item", "reach", "block", "hits"), "decon-wanted")
    pointed = _bit_map(wanted.select("key"), MAP_BITS)
    whole = (texts.select("text", "key", "check").mapInArrow(_pointed(1, pointed), "text string, key long, check int")
             .dropDuplicates(["key", "check"]))
    # a text's list has a few numbers for each stretch that holds enough seeds of an item
    lists = wanted.groupBy("key", "check").agg(F.collect_list(F.struct("item", "reach", "block", "hits")).alias("wanted"))
    passages = (whole.join(lists.hint("merge"), ["key", "check"]).select("key", "check", "text", "wanted")
                .mapInArrow(_passages, PASSAGES))
    both = passages.withColumn("_salt", _salt()).join(_dealt(items).hint("merge"), ["item", "_salt"])
    scored = both.select("key", "check", "item", "hits", "words", "starts", "stops", "item_id", "text").mapInArrow(
        _aligned(limit), ALIGNED)
    best = F.min(F.struct((-F.col("score")).alias("score"), "start", "stop", "seeds")).alias("best")
    return written(scored.groupBy("key", "check", "item_id", "item").agg(best)
                   .select("key", "check", "item_id", (-F.col("best.score")).alias("score"), "best.start", "best.stop",
                           "best.seeds"), "decon-found")


def contaminated(docs: DataFrame, items: DataFrame, limit: float = LIMIT,
                 expected: float = EXPECTED, block_bytes: int = BLOCK_BYTES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and test item that it holds: doc_id, item_id, score (share of a
    perfect alignment), start and stop (code points of the best alignment), seeds (found around it).

    Every document is found whose alignment reaches ``limit``; an item of two words must be held as
    a pair. Null and empty texts hold nothing; null, empty and wordless items are held by nothing.
    Equal items count once, different texts under one item_id are matched each. Repeated rows and
    null ids are matched row by row. Texts are read whole. Other columns are not read.
    """
    if not 0.0 < limit <= 1.0:
        raise ValueError("limit must lie in (0, 1]")
    slim = _keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).cast("string").alias("text")), "text")
    found = matches(slim, items, limit, expected, block_bytes)
    bits = _bit_map(found.select("key"), MAP_BITS)
    rows = slim.select("doc_id", "key", "check").mapInArrow(_pointed(1, bits), "doc_id long, key long, check int")
    return rows.join(found, ["key", "check"]).select(
        "doc_id", "item_id", F.round("score", 6).alias("score"), "start", "stop", "seeds")


def without_contaminated(docs: DataFrame, items: DataFrame, limit: float = LIMIT,
                         expected: float = EXPECTED, block_bytes: int = BLOCK_BYTES,
                         text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, without the rows that hold a test item as ``contaminated`` finds
    it: null, empty and repeated rows are kept or go as there."""
    if not 0.0 < limit <= 1.0:
        raise ValueError("limit must lie in (0, 1]")
    key, check = "_text_key", "_text_check"
    texts = _keyed(docs.select(F.col(text_col).cast("string").alias("text")), "text")
    found = written(matches(texts, items, limit, expected, block_bytes).select(
        F.col("key").alias("_key"), F.col("check").alias("_check")).distinct(), "decon-keys")
    # two numbers a row: at most FEW_KEYS of them are broadcast, more are joined by a shuffle
    found = F.broadcast(found) if found.count() <= FEW_KEYS else found.hint("merge")
    same = (F.col(key) == F.col("_key")) & (F.col(check) == F.col("_check"))
    return _keyed(docs, text_col, key, check).join(found, same, "left_anti").drop(key, check)
