"""Spelling variants: words one edit apart, found by a relational trie frontier.

All words of one length form a trie whose edges are a Spark table (node, label, words below).
A state is (word, position, node, edits); each round joins the states with the edges of one
level. Without an edit a state may follow its own letters, replace one letter, or (when the trie
holds words one shorter) skip one; with an edit it follows its own letters only. A state that
comes to an edge with one word below it is terminal, and a terminal state with one edit is a
pair of neighbours.

Two things keep the frontier small, and lose nothing. Of two words one edit apart, either the
first or the last half is equal: states start behind the first half, in a trie of the words and
in one of the reversed words, where few branches are left. And nearness is mutual: a replacement
is looked for from the smaller word only, a deletion from the longer one. A trie has at most
``LEVELS`` levels; the labels of words that are longer than that hold several letters.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import shipped_by_value, written

shipped_by_value(__name__)

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form must be this many times as frequent as the word.
FORM_RATIO = 10
#: One occurrence in so many loses a letter.
DELETE_MODULUS = 31
LEVELS = 64
#: Words a task counts before it passes its partial counts on.
HELD_WORDS = 200_000


def _counts(min_length: int, modulus: int):
    def run(batches):
        words = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                               pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                if not raw:
                    continue
                lowered = raw.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                mine: dict[str, int] = {}
                for w in words.findall(lowered):
                    mine[w] = mine.get(w, 0) + 1
                for w, n in mine.items():
                    h = zlib.crc32(w.encode(), start)
                    if h % modulus == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < min_length:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of at least ``MIN_LENGTH`` letters that occur ``MIN_COUNT`` times or more."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).cast("string").alias("text"))
    parts = rows.mapInArrow(_counts(MIN_LENGTH, DELETE_MODULUS), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _sub(text: Column, start, length=None) -> Column:
    """Code points of ``text`` from ``start`` (from 0) on."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.lit((1 << 31) - 1) if length is None else F.lit(length) if isinstance(length, int) else length
    return F.substring(text, start + 1, length)


def _halves(words: DataFrame, length: Column) -> DataFrame:
    """word, node, rest, step for both directions: the place behind the half that is taken as
    equal, in the trie of the words of ``length`` letters (the word's own, or one less)."""
    half = F.floor(length / 2).cast("int")
    ways = []
    for way, text, start in ((0, F.col("word"), half), (1, F.reverse("word"), length - half)):
        node = F.concat(F.lit(f"{way}:"), length.cast("string"), F.lit(":"), _sub(text, 0, start))
        step = F.ceil((length - start) / LEVELS).cast("int")
        ways.append(F.struct(node.alias("node"), _sub(text, start).alias("rest"), F.greatest(step, F.lit(1)).alias("step")))
    return words.select("word", F.explode(F.array(*ways)).alias("at")).select("word", "at.*")


def edge_table(words: DataFrame) -> DataFrame:
    """level, node, label, below, leaf: the edges of all tries. ``node`` is spelt out (direction,
    length and letters so far), so no two nodes are mixed up; ``below`` counts the words below
    an edge and ``leaf`` is one of them."""
    tails = _halves(words, F.char_length("word"))
    level = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.char_length("rest") / F.col("step")).cast("int") - 1, F.lit(0))))
    cut = tails.select("*", level.alias("level"))
    done = F.col("level") * F.col("step")
    return (cut.select("level", F.concat("node", _sub(F.col("rest"), 0, done)).alias("node"),
                       _sub(F.col("rest"), done, F.col("step")).alias("label"), "word")
            .groupBy("level", "node", "label").agg(F.count(F.lit(1)).alias("below"), F.min("word").alias("leaf")))


def neighbours(words: DataFrame, name: str = "spelling") -> DataFrame:
    """a, b: all pairs of different words of the column ``word`` (distinct, without nulls) that
    differ by one inserted, deleted or replaced code point, in both orders."""
    length = F.char_length("word")
    edges = written(edge_table(words), f"{name}-edges", ["level"])
    states = _halves(words, length).withColumn("skips", F.lit(False)).union(
        _halves(words.filter(length > 1), length - 1).withColumn("skips", F.lit(True)))
    states = written(states.withColumn("edits", F.lit(0)), f"{name}-states")
    found = []
    for level in range(LEVELS):
        here = edges.filter(F.col("level") == level).drop("level")
        rest, label, step = F.col("rest"), F.col("label"), F.col("step")
        size = F.char_length(label)
        exact = _sub(rest, 0, size) == label
        edited = states.filter("edits = 1").withColumn("next", _sub(rest, 0, step))
        followed = (edited.join(here.withColumnRenamed("label", "next"), ["node", "next"])
                    .withColumnRenamed("next", "label").withColumn("used", size))
        # the first letter that differs settles an edit, so each edit is tried in one way only
        replaced = ~F.col("skips") & (label > _sub(rest, 0, size)) & (F.levenshtein(_sub(rest, 0, size), label) == 1)
        skipped = F.col("skips") & ~exact & (F.levenshtein(_sub(rest, 0, size + 1), label) == 1)
        free = states.filter("edits = 0").join(here, "node").filter(exact | replaced | skipped)
        free = (free.withColumn("edits", F.when(exact, 0).otherwise(1))
                .withColumn("used", size + F.when(skipped, 1).otherwise(0)))
        met = written(followed.select(*free.columns).union(free) if level else free, f"{name}-states")
        ends = met.filter("below = 1 and word <> leaf").filter(F.levenshtein("word", "leaf", 1) == 1)
        found.append(ends.select(F.col("word").alias("a"), F.col("leaf").alias("b")))
        states = met.filter("below > 1").select(
            "word", F.concat("node", "label").alias("node"), _sub(rest, F.col("used")).alias("rest"),
            "step", "skips", "edits")
        if states.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case; an occurrence
    whose crc32 of ``doc_id:run`` is divisible by 31 loses the letter at that number modulo its
    length (a null id reads as empty). Kept are those of at least 7 letters and 2 occurrences.
    ``form`` is the near word of largest n (ties: the smallest) if it is at least ten times as
    frequent; ``root`` follows forms to the last. Null and empty texts hold no words, texts of
    any length are read whole, repeated rows count as often as they come; no documents: no
    rows. Other columns are not read.
    """
    words = written(vocabulary(docs, id_col, text_col), "spelling-words")
    pairs = written(neighbours(words.select("word")), "spelling-pairs")
    other = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word")))
    near = pairs.join(other, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near.withColumnRenamed("a", "word"), "word", "left")
    large = -F.col("best.less") >= FORM_RATIO * F.col("n")
    known = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(large, F.col("best.word")).alias("form"),
                                 F.when(large, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # each step is at least tenfold and n fits 63 bits: at most 18 steps, doubled five times
    jumps = known.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(5):
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("last"))
        jumps = jumps.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root"))
        jumps = written(jumps, "spelling-roots")
    return known.join(jumps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
