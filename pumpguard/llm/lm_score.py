"""Cross-entropy difference: every document scored by matched n-gram models.

The target models count the documents labelled as good, the background models count the whole
corpus. On either side a unigram and a bigram model (which also tells where a text begins and ends)
share one vocabulary, all words of the corpus, and one smoothing (add one), so the loss of a token
differs only by what was counted. The score is the difference of the losses, target minus background,
of bigrams and unigrams in a fixed weight, as a mean per token: the lower, the more like the target.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import shipped_by_value, written

shipped_by_value(__name__)

#: Words whose bigrams among themselves are counted in a table that every task gets (its square,
#: 32 MB): rows of a very common bigram are then never shuffled. It has no part in the result.
FREQUENT = 2047
#: Weight of the bigram losses; the rest goes to the unigram losses.
WEIGHT = 0.75
#: Words a task counts before it hands its counts on.
FLUSH_WORDS = 500_000
#: Words of the documents that a task packs together, and bytes of text behind one bucket of bigrams.
BUFFER_WORDS = 1 << 20
BUCKET_BYTES = 16 << 20
#: The number of the mark that stands before the first word of a text and behind its last.
MARK = 0
#: Before the first word, where bigrams are whole words.
NO_WORD = b""
#: Share of all tokens from which a word or bigram is hot, and the cells its rows are dealt over.
HOT_SHARE = 1 / 20_000
SALTS = 64


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between the six ASCII white spaces."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _word_counts(batches):
    """hash, background, target: words counted in a task."""
    background, target = Counter(), Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(_hashes(background).view(np.int64)), pa.array(background.values(), pa.int64()),
             pa.array(map(target.get, background, repeat(0)), pa.int64())], names=["h", "b", "t"])
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
            words = tokens(text.as_py())
            background.update(words)
            if good:
                target.update(words)
            if len(background) > FLUSH_WORDS:
                yield out()
                background.clear()
                target.clear()
    yield out()


class Frequent:
    """The most frequent words by hash, with their counts; places start behind the mark's."""

    def __init__(self, rows):
        self.place = {r["h"] & (1 << 64) - 1: i + 1 for i, r in enumerate(rows)}
        self.hashes = np.array(sorted(self.place), np.uint64)
        order = [self.place[int(h)] - 1 for h in self.hashes]
        self.background = np.array([rows[i]["b"] for i in order], np.int64)
        self.target = np.array([rows[i]["t"] for i in order], np.int64)
        self.places = np.array([i + 1 for i in order], np.int64)
        self.size = len(rows) + 1

    def numbered(self, words: list[bytes], known: Known) -> np.ndarray:
        """Places of ``words``, -1 for the others; ``known`` remembers words."""
        if len(known) > FLUSH_WORDS:
            known.clear()
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class Known(dict):
    """word -> its place among the frequent ones, looked up by hash once; -1 for the others."""

    def __init__(self, frequent: Frequent):
        super().__init__()
        self.place = frequent.place

    def __missing__(self, word: bytes) -> int:
        place = self[word] = self.place.get(xxhash.xxh3_64_intdigest(word), -1)
        return place


def _around(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bigrams of a text: every word behind the one before it, marks at both ends."""
    return np.concatenate(([MARK], ids)), np.concatenate((ids, [MARK]))


def _frequent_pairs(frequent: Frequent):
    """Bigrams of frequent words and marks, counted in a task by a square table."""
    size = frequent.size

    def run(batches):
        counts, known = np.zeros((2, size * size), np.int64), Known(frequent)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
                words = tokens(text.as_py())
                if not words:
                    continue
                u, v = _around(frequent.numbered(words, known))
                both = (u >= 0) & (v >= 0)
                seen, n = np.unique(u[both] * size + v[both], return_counts=True)
                counts[0, seen] += n
                if good:
                    counts[1, seen] += n
        seen = np.flatnonzero(counts[0])
        for lo in range(0, len(seen), 100_000):
            part = seen[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array((part // size).astype(np.int32)), pa.array((part % size).astype(np.int32)),
                 pa.array(counts[0, part]), pa.array(counts[1, part])], names=["u", "v", "b", "t"])
    return run


class Models:
    """Loss differences of bigrams and words from their counts: numbers that fit any corpus."""

    def __init__(self, words: int, totals: tuple[int, int], texts: tuple[int, int], weight: float):
        self.words, self.totals, self.texts, self.weight = words, totals, texts, weight

    def bigram(self, b, t, context_b, context_t):
        """-ln target(v|u) + ln background(v|u); a text may end instead of going on."""
        outcomes = self.words + 1
        return self.weight * (np.log((b + 1.0) / (context_b + outcomes))
                              - np.log((t + 1.0) / (context_t + outcomes)))

    def unigram(self, b, t):
        return (1.0 - self.weight) * (np.log((b + 1.0) / (self.totals[0] + self.words))
                                      - np.log((t + 1.0) / (self.totals[1] + self.words)))


def _difference_rows(frequent: Frequent, models: Models):
    """For one frequent context u: the differences of all frequent v."""
    context = np.zeros((2, frequent.size), np.int64)
    context[:, MARK] = models.texts
    context[0, frequent.places], context[1, frequent.places] = frequent.background, frequent.target

    def run(batches):
        for batch in batches:
            out = []
            for u, v, b, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                line = np.zeros(frequent.size)
                line[v] = models.bigram(np.array(b), np.array(t), *context[:, u])
                out.append(line.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())],
                                             names=["u", "line"])
    return run


def _heads(frequent: Frequent, models: Models, table):
    """Every text's length and the sum of what frequent words and bigrams of them give."""
    single = np.zeros(frequent.size + 1)  # the last place is that of all other words
    single[frequent.places] = models.unigram(frequent.background, frequent.target)

    def run(batches):
        differences = np.frombuffer(table.value).reshape(frequent.size, frequent.size)
        known = Known(frequent)
        for batch in batches:
            lengths, sums = [], []
            for text in batch.column(2):
                words = tokens(text.as_py())
                lengths.append(len(words))
                places = frequent.numbered(words, known)
                u, v = _around(places)
                both = (u >= 0) & (v >= 0)
                sums.append(float(differences[u[both], v[both]].sum() + single[places].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths, pa.int64()),
                 pa.array(sums, pa.float64())], names=["r", "doc_id", "n_tokens", "part"])
    return run


BLOCK = pa.schema([("bucket", pa.int32()), ("base", pa.int64()), ("contexts", pa.binary()),
                   ("runs", pa.binary()), ("nexts", pa.binary()), ("texts", pa.binary()),
                   ("counts", pa.binary()), ("good", pa.binary())])


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds the largest."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64)


def _blocks(frequent: Frequent, buckets: int):
    """The other bigrams of the texts, each once a text with its count, packed by bucket. A bucket
    has all bigrams of its contexts; those of a frequent context are dealt by both words."""
    def packed(base, number, ids, rows, good):
        hashes = np.concatenate(([np.uint64(0)], _hashes(number)))
        rare = np.fromiter((int(h) not in frequent.place for h in hashes), bool, len(hashes))
        rare[MARK] = False
        ends = [_around(i) for i in ids]
        u, v = (np.concatenate([e[k] for e in ends]) for k in (0, 1))
        d = np.repeat(np.array(rows, np.int64) - base, [len(e[0]) for e in ends])
        good = np.repeat(good, [len(e[0]) for e in ends])
        keep = rare[u] | rare[v]
        u, v, d, good = u[keep], v[keep], d[keep], good[keep]
        if not len(u):
            return
        key = np.where(rare[u], hashes[u], hashes[u] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[v])
        bucket = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((d, v, u, bucket))
        u, v, d, good, bucket = u[order], v[order], d[order], good[order], bucket[order]
        first = np.flatnonzero(np.concatenate(
            ([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (d[1:] != d[:-1]))))
        n = np.diff(np.append(first, len(u)))
        u, v, d, good, bucket = u[first], v[first], d[first], good[first], bucket[first]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(u))
        out = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            heads = np.flatnonzero(np.concatenate(([True], u[lo + 1:hi] != u[lo:hi - 1])))
            out.append((int(bucket[lo]), base, hashes[u[lo:hi][heads]].tobytes(),
                        _small(np.diff(np.append(heads, hi - lo))), hashes[v[lo:hi]].tobytes(),
                        _small(d[lo:hi]), _small(n[lo:hi]), np.packbits(good[lo:hi]).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), BLOCK)], schema=BLOCK)

    def numbers():
        return defaultdict(count(1).__next__)  # a new word takes the next number

    def run(batches):
        number, ids, rows, good, size = numbers(), [], [], [], 0
        for batch in batches:
            for r, text, target in zip(batch.column(0).to_pylist(), batch.column(1),
                                       batch.column(2).to_pylist()):
                if rows and (size >= BUFFER_WORDS or not 0 <= r - rows[0] < 1 << 31):
                    yield from packed(rows[0], number, ids, rows, good)
                    number, ids, rows, good, size = numbers(), [], [], [], 0
                words = tokens(text.as_py())
                if words:
                    ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                    rows.append(r)
                    good.append(target)
                    size += len(words)
        if rows:
            yield from packed(rows[0], number, ids, rows, good)
    return run


def _bucket_sums(frequent: Frequent, models: Models):
    """One bucket: counts over all its blocks, then for every block what its texts get."""
    def run(block: pa.Table) -> pa.Table:
        parts = []
        for heads, runs, nexts, texts, counts, good in zip(*(block.column(f).to_pylist() for f in (
                "contexts", "runs", "nexts", "texts", "counts", "good"))):
            v = np.frombuffer(nexts, np.uint64)
            u = np.frombuffer(heads, np.uint64)
            parts.append((np.repeat(u, _wide(runs, len(u))), v, _wide(texts, len(v)),
                          _wide(counts, len(v)),
                          np.unpackbits(np.frombuffer(good, np.uint8), count=len(v))))
        u, v, n, good = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3, 4))
        order = np.lexsort((v, u))
        u, v, n, good = u[order], v[order], n[order], good[order]
        new_u = np.concatenate(([True], u[1:] != u[:-1]))
        new = new_u | np.concatenate(([True], v[1:] != v[:-1]))
        at, at_u = np.flatnonzero(new), np.flatnonzero(new_u)
        b, t = np.add.reduceat(n, at), np.add.reduceat(n * good, at)
        context_b, context_t = np.add.reduceat(n, at_u), np.add.reduceat(n * good, at_u)
        single = models.unigram(context_b, context_t)
        contexts = u[at_u]
        for h, counted in [(0, models.texts), *zip(frequent.hashes.tolist(), zip(
                frequent.background, frequent.target))]:  # counted in whole beforehand
            i = np.searchsorted(contexts, np.uint64(h))
            if i < len(contexts) and contexts[i] == h:
                context_b[i], context_t[i] = counted
                single[i] = 0.0
        group = (np.cumsum(new_u) - 1)[at]
        pair = models.bigram(b, t, context_b[group], context_t[group]) + single[group]
        value = np.empty(len(u))
        value[order] = pair[np.cumsum(new) - 1] * n
        texts, sums, lo = [], [], 0
        for p in parts:
            where, which = np.unique(p[2], return_inverse=True)
            texts.append(_small(where))
            sums.append(np.bincount(which, value[lo:lo + len(p[2])]).tobytes())
            lo += len(p[2])
        return pa.table({"base": block.column("base"), "texts": pa.array(texts, pa.binary()),
                         "sums": pa.array(sums, pa.binary())})
    return run


def _text_sums(block: pa.Table) -> pa.Table:
    """One buffer of texts: what the buckets gave them, added up."""
    base = block.column("base")[0].as_py()
    sums = [np.frombuffer(raw) for raw in block.column("sums").to_pylist()]
    texts = [_wide(raw, len(s)) for raw, s in zip(block.column("texts").to_pylist(), sums)]
    where, which = np.unique(np.concatenate(texts), return_inverse=True)
    return pa.table({"r": where + base, "rest": np.bincount(which, np.concatenate(sums))})


def _good(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
            .agg(((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("_good"))
            .filter("_good"))


def _marked(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """r, doc_id, text and target of all rows, written."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    good = _good(labels).hint("merge")  # the same plan at every size
    return written(slim.join(good, F.col("doc_id") == F.col("_id"), "left").select(
        F.monotonically_increasing_id().alias("r"), "doc_id", "text",
        F.col("_good").isNotNull().alias("target")), "lm-rows")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          frequent_words: int = FREQUENT, weight: float = WEIGHT) -> DataFrame:
    """One row per document: doc_id, n_tokens, score (mean loss difference per token, rounded
    to 6 digits) and in_target (score below zero).

    Target: documents with a label of quality 1 and none of toxic 1 (a document labelled twice
    must pass both). Null, empty and blank texts have no tokens, a null score and in_target
    false. Null ids are counted in the background and scored. Without labels or without target
    documents the target models are flat. Repeated rows count as often as they come. No rows: no rows.

    All words count; words are told apart by 64 bits of hash. Bigrams of the ``frequent_words``
    commonest words among themselves are counted in a square table and scored where the texts lie;
    all others are shuffled once, with their texts, to the bucket that counts them, and what
    the texts get goes back to them. A bigram in the buckets has a word outside the table, so
    it holds at most one in ``frequent_words`` of all tokens.
    """
    rows = _marked(docs, labels, id_col, text_col)
    told = rows.select("text", "target")
    words = written(told.mapInArrow(_word_counts, "h long, b long, t long").groupBy("h")
                    .agg(F.sum("b").alias("b"), F.sum("t").alias("t")), "lm-words")
    zero = F.lit(0).cast("long")
    total = words.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("b"), zero).alias("b"),
                      F.coalesce(F.sum("t"), zero).alias("t")).first()
    held = F.col("text").rlike("[^ \\t-\\r]")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), zero).alias("bytes"),
                    F.count_if(held).alias("b"), F.count_if(held & F.col("target")).alias("t")).first()
    models = Models(total["words"], (total["b"], total["t"]), (size["b"], size["t"]), weight)
    frequent = Frequent(words.orderBy(F.desc("b"), "h").limit(frequent_words).collect())
    pairs = (told.mapInArrow(_frequent_pairs(frequent), "u int, v int, b long, t long")
             .groupBy("u", "v").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))
             .groupBy("u").agg(F.collect_list(F.struct("v", "b", "t")).alias("c"))  # one for each v
             .select("u", "c.v", "c.b", "c.t"))
    table = np.zeros((frequent.size, frequent.size))
    for line in pairs.mapInArrow(_difference_rows(frequent, models), "u int, line binary").toLocalIterator():
        table[line["u"]] = np.frombuffer(line["line"])
    # frequent_words squared doubles: 32 MB, whatever the corpus
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())
    heads = rows.select("r", "doc_id", "text").mapInArrow(
        _heads(frequent, models, shared), "r long, doc_id long, n_tokens long, part double")
    buckets = -(-size["bytes"] // BUCKET_BYTES) or 1
    blocks = rows.select("r", "text", "target").mapInArrow(
        _blocks(frequent, buckets), "bucket int, base long, contexts binary, runs binary, "
        "nexts binary, texts binary, counts binary, good binary")
    back = blocks.groupBy("bucket").applyInArrow(
        _bucket_sums(frequent, models), "base long, texts binary, sums binary")
    rest = back.groupBy("base").applyInArrow(_text_sums, "r long, rest double")
    mean = F.when(F.col("n_tokens") > 0, F.round(
        (F.col("part") + F.coalesce("rest", F.lit(0.0))) / F.col("n_tokens"), 6))
    return heads.join(rest, "r", "left").select(
        "doc_id", "n_tokens", mean.alias("score"), F.coalesce(mean < 0, F.lit(False)).alias("in_target"))


# ---------------------------------------------------------------- bigrams interpolated, counts as Spark tables

def _all_pair_counts(batches):
    """Bigrams of whole words, counted in a task and handed on when there are many."""
    background, target = Counter(), Counter()

    def out():
        keys = list(background)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.binary()),
             pa.array(background.values(), pa.int64()),
             pa.array([target[k] for k in keys], pa.int64())],
            names=["u", "v", "background", "target"])
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
            words = tokens(text.as_py())
            background.update(zip([NO_WORD, *words], words))
            if good:
                target.update(zip([NO_WORD, *words], words))
            if len(background) > FLUSH_WORDS:
                yield out()
                background.clear()
                target.clear()
    yield out()


def _bigram_rows(hot):
    """The distinct bigrams of every text, but for the hot ones: their differences are summed
    here. A text's first row has its id, length and that sum, and a key that no bigram has."""
    schema = pa.schema([("r", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("u", pa.binary()), ("v", pa.binary()), ("n", pa.int64()),
                        ("part", pa.float64())])

    def run(batches):
        known, rows = hot.value, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        for batch in batches:
            for r, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2)):
                words = tokens(text.as_py())
                part, head = 0.0, len(rows)
                rows.append(None)
                for pair, n in Counter(zip([NO_WORD, *words], words)).items():
                    if pair in known:
                        part += n * known[pair]
                    else:
                        rows.append((r, None, None, *pair, n, None))
                rows[head] = (r, doc_id, len(words), NO_WORD, b"\n%d" % r, 0, part)
                if len(rows) > FLUSH_WORDS // 5:
                    yield out()
                    rows.clear()
        if rows:
            yield out()
    return run


def _with_counts(pairs: DataFrame, words: DataFrame, hot: DataFrame, key: str, other: str,
                 counts: tuple[str, str]) -> DataFrame:
    """``pairs`` with the ``counts`` of their word ``key``. Rows of a hot word are dealt over
    ``SALTS`` cells by their other word."""
    hot = F.broadcast(hot.select(F.col("word").alias("_hot")))  # at most 2 / HOT_SHARE + 1 words
    salted = (pairs.join(hot, F.col(key) == F.col("_hot"), "left")
              .withColumn("_salt", F.when(F.col("_hot").isNotNull(),
                                          F.pmod(F.xxhash64(other), F.lit(SALTS))).otherwise(0))
              .drop("_hot"))
    cells = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = (words.join(hot, F.col("word") == F.col("_hot"), "left")
             .select("word", *counts, F.explode(F.coalesce(cells, F.array(F.lit(0)))).alias("_cell")))
    return (salted.join(dealt, (F.col(key) == F.col("word")) & (F.col("_salt") == F.col("_cell")))
            .drop("word", "_salt", "_cell"))


def _differences(pairs: DataFrame, words: DataFrame, hot: DataFrame, totals, weight: float) -> DataFrame:
    """u, v and the loss difference -ln target(v|u) + ln background(v|u) of every bigram."""
    pairs = _with_counts(pairs, words, hot, "u", "v", ("context_b", "context_t"))
    pairs = _with_counts(pairs, words, hot, "v", "u", ("single_b", "single_t"))
    outcomes = totals["words"] + 1  # one for words that the corpus does not have

    def log(n, context, single, total):
        alone = (F.col(single) + 1.0) / F.lit(float(total + outcomes))
        return F.log(F.when(F.col(context) == 0, alone).otherwise(
            F.lit(weight) * (F.col(n) / F.col(context)) + F.lit(1.0 - weight) * alone))
    return pairs.select("u", "v", (log("background", "context_b", "single_b", totals["b"])
                                   - log("target", "context_t", "single_t", totals["t"]))
                        .alias("difference"))


def score_all_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", weight: float = WEIGHT) -> DataFrame:
    """As ``score`` with bigrams that are interpolated with unigrams: bigram and word counts are
    Spark tables that are joined, and only what is hot is broadcast: words and bigrams
    with at least ``HOT_SHARE`` of all tokens, of which there is a fixed number at most.
    Summed in no fixed order, so a score may differ in its last digit between runs."""
    rows = _marked(docs, labels, id_col, text_col)
    pairs = written(rows.select("text", "target")
                    .mapInArrow(_all_pair_counts, "u binary, v binary, background long, target long")
                    .groupBy("u", "v").agg(F.sum("background").alias("background"),
                                           F.sum("target").alias("target")), "lm-all-pairs")
    zero = F.lit(0).cast("long")
    words = written(
        pairs.select(F.col("u").alias("word"), F.col("background").alias("cb"),
                     F.col("target").alias("ct"), zero.alias("sb"), zero.alias("st"))
        .union(pairs.select("v", zero, zero, "background", "target"))
        .groupBy("word").agg(F.sum("cb").alias("context_b"), F.sum("ct").alias("context_t"),
                             F.sum("sb").alias("single_b"), F.sum("st").alias("single_t")),
        "lm-all-words")
    totals = words.agg(F.coalesce(F.sum("single_b"), zero).alias("b"),
                       F.coalesce(F.sum("single_t"), zero).alias("t"),
                       F.count_if(F.col("single_b") > 0).alias("words")).first()
    much = max(totals["b"] * HOT_SHARE, 1.0)
    hot = words.filter((F.col("context_b") >= much) | (F.col("single_b") >= much)).select("word")
    frequent = F.col("background") >= F.lit(much)
    known = {(bytes(r["u"]), bytes(r["v"])): r["difference"] for r in _differences(
        pairs.filter(frequent), words, hot, totals, weight).collect()}  # at most 1 / HOT_SHARE
    rest = _differences(pairs.filter(~frequent), words, hot, totals, weight)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    found = rows.select("r", "doc_id", "text").mapInArrow(
        _bigram_rows(shared),
        "r long, doc_id long, n_tokens long, u binary, v binary, n long, part double")
    summed = (found.join(rest, ["u", "v"], "left").groupBy("r")
              .agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
                   F.sum(F.coalesce("part", F.col("n") * F.col("difference"))).alias("sum")))
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("sum") / F.col("n_tokens"), 6))
    return summed.select("doc_id", "n_tokens", mean.alias("score"),
                         F.coalesce(mean < 0, F.lit(False)).alias("in_target"))
