"""Phrase collocations: frequent phrases by Rabin-Karp fingerprints, materialised at the end only.

A task reads its texts as one array of bytes. Prefix polynomials modulo 2^64 give every word's
fingerprint from the bytes and every phrase's from its words' fingerprints, without building a
string. Equal fingerprints are counted inside the task and compared there with the text, word by
word. What is shuffled are rows (fingerprint, check, count, pointer): the check is a second
polynomial to another base, so two phrases that share a fingerprint in different tasks stay
apart, and the pointer names a document that holds the phrase. Only phrases that are frequent in
total follow their pointer: the document is read once more and must yield both numbers again, and
there the phrase becomes text.

A phrase is no more frequent than its parts, so pairs are made of frequent words only, triples of
frequent pairs and longer phrases of frequent triples. Tasks know these by a bit map of fixed size (``MAP_BITS``) over the
fingerprints: a bit too many costs a few shuffled rows and changes nothing, none is missing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pumpguard.llm.common import shipped_by_value, written

shipped_by_value(__name__)

MIN_COUNT = 100
MOST_WORDS = 5
TOP = 2000
NO_LANG = "und"
#: Bits of the map of frequent fingerprints: 8 MB, whatever the corpus.
MAP_BITS = 1 << 26
#: Text that a task holds as one array, and text that is turned into polynomials at once.
CHUNK_BYTES, SEGMENT_BYTES = 4 << 20, 1 << 20
#: Texts that are taken out of a batch at once.
TEXTS = 64

_SPACE, _CUT = 0x20, 0x0A
#: Bases of the fingerprint and of the check, for bytes and for words.
_BASES = ((0x9E3779B97F4A7C15, 0xD1342543DE82EF95), (0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5))
#: Checks and keys of documents are 32 bits in the shuffle. Documents may share a key: then all of
#: them are looked through.
SHORT = (1 << 32) - 1
#: Languages up to which their word totals are broadcast; beyond, they are joined by a shuffle.
FEW_LANGS = 10_000


def _byte_table() -> np.ndarray:
    """A-Z to lower case, tab to space, the signs that end a piece to a line feed."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[0x09] = _SPACE
    out[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = _CUT
    return out


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread over all 64 bits, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _spans(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """The polynomials of values[start:stop]: the sum of values[i] * base^(start - i), from
    differences of one prefix sum; all modulo 2^64, where an odd base has an inverse."""
    down, up = _powers(pow(base, -1, 1 << 64), len(values)), _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down, out=prefix[1:])
    return (prefix[stop] - prefix[start]) * up[start]


class Chunk:
    """The words of some documents (none of them empty): byte ranges, fingerprints, exact numbers."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        text = _byte_table()[raw]
        cut = text == _CUT
        inside = np.zeros(len(text) + 2, bool)
        inside[1:-1] = ~cut & (text != _SPACE)
        opens = np.zeros(len(text) + 1, bool)
        opens[offsets] = opens[-1] = True  # a document begins here
        self.text, self.offsets, self.langs = text, offsets, langs
        self.start = np.nonzero(inside[1:-1] & (~inside[:-2] | opens[:-1]))[0]
        self.stop = np.nonzero(inside[1:-1] & (~inside[2:] | opens[1:]))[0] + 1
        self.doc = (np.searchsorted(offsets, self.start, "right") - 1).astype(np.int32)
        piece = np.searchsorted(np.nonzero(cut)[0], self.start)
        self.joined = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.words = [_mixed(w) if i == 0 else w for i, w in enumerate(self._word_prints())]
        self.number = self._numbers()

    def _segments(self):
        """Ranges of words whose bytes are polynomials of moderate length."""
        at = 0
        while at < len(self.start):
            end = int(np.searchsorted(self.stop, self.start[at] + SEGMENT_BYTES, "right"))
            end = max(end, at + 1)
            yield at, end
            at = end

    def _word_prints(self) -> list[np.ndarray]:
        out = [np.empty(len(self.start), np.uint64) for _ in _BASES]
        for a, b in self._segments():
            low = self.start[a]
            values = self.text[low:self.stop[b - 1]].astype(np.uint64) + np.uint64(1)
            for prints, (base, _) in zip(out, _BASES):
                prints[a:b] = _spans(values, self.start[a:b] - low, self.stop[a:b] - low, base)
        return out

    def _numbers(self) -> np.ndarray:
        """One number for equal words, checked byte by byte against the word's first occurrence."""
        _, first, number = np.unique(self.words[0], return_index=True, return_inverse=True)
        first, number = first.astype(np.int32), number.astype(np.int32)
        length = self.stop - self.start
        other = first[number]
        if (length != length[other]).any():
            return self._numbers_by_text()
        for a, b in self._segments():
            size = length[a:b]
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            mine, theirs = (self.text[np.repeat(s, size) + inner] for s in (self.start[a:b], self.start[other[a:b]]))
            if (mine != theirs).any():
                return self._numbers_by_text()
        return number

    def _numbers_by_text(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        whole = self.text.tobytes()
        return np.array([seen.setdefault(whole[a:b], len(seen)) for a, b in zip(self.start, self.stop)], np.int32)

    def places(self, n: int) -> np.ndarray:
        """The first words of all phrases of ``n`` words."""
        size = len(self.start) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64)
        whole = np.ones(size, bool)
        for k in range(n - 1):
            whole &= self.joined[k:k + size]
        return np.nonzero(whole)[0]

    def prints(self, at: np.ndarray, n: int, kind: int = 0) -> np.ndarray:
        """The fingerprints (``kind`` 0) or checks (1) of the phrases of ``n`` words at ``at``
        (ascending), language included."""
        words, base = self.words[kind], _BASES[kind][1]
        found = np.empty(len(at), np.uint64)
        for a in range(0, len(at), SEGMENT_BYTES):
            part = at[a:a + SEGMENT_BYTES]
            low = part[0]
            found[a:a + len(part)] = _spans(words[low:part[-1] + n], part - low, part - low + n, base)
        found = (found + np.uint64(n * base % (1 << 64))) ^ self.langs[self.doc[at]]
        return found & np.uint64(SHORT) if kind else _mixed(found)

    def groups(self, at: np.ndarray, found: np.ndarray, n: int):
        """(fingerprint, count, first word of the first occurrence) of each different phrase."""
        prints, first, group, count = np.unique(found, return_index=True, return_inverse=True, return_counts=True)
        lang = self.langs[self.doc[at]].view(np.int64)
        same = lang == lang[first[group]]
        for k in range(n):
            same &= self.number[at + k] == self.number[at[first[group]] + k]
        if same.all():
            return prints, count, at[first]
        # phrases that share a fingerprint: told apart by language and words
        keys = np.stack([found.view(np.int64), lang] + [self.number[at + k] for k in range(n)], axis=1)
        _, first, count = np.unique(keys, axis=0, return_index=True, return_counts=True)
        return found[first], count, at[first]

    def phrase(self, at: int, n: int) -> str:
        return self.text[self.start[at]:self.stop[at + n - 1]].tobytes().decode("utf-8", "replace")


def _chunks(batches):
    """(keys, raw bytes, offsets, language marks) of at most ``CHUNK_BYTES`` of text, or one document."""
    keys, langs, texts, held = [], [], [], 0

    def out():
        sizes = np.array([len(t) for t in texts], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        return (np.array(keys, np.int64), np.frombuffer(b"".join(texts), np.uint8), offsets[:-1],
                np.array(langs, np.int64).view(np.uint64))
    parts = (batch.slice(a, TEXTS) for batch in batches for a in range(0, batch.num_rows, TEXTS))
    for batch in parts:
        for key, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   batch.column(2).cast(pa.large_binary()).to_pylist()):
            if not text:
                continue
            if texts and held + len(text) > CHUNK_BYTES:
                yield out()
                keys, langs, texts, held = [], [], [], 0
            keys.append(key)
            langs.append(lang)
            texts.append(text)
            held += len(text)
    if texts:
        yield out()


PARTIAL = "fp long, check long, n long, key long, lang long"


def _named(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _rows(chunk: Chunk, keys, prints, count, at, n: int):
    order = np.argsort(at)  # checks are taken in the order of the text
    prints, count, at = prints[order], count[order], at[order]
    doc = chunk.doc[at]
    columns = [prints.view(np.int64), chunk.prints(at, n, 1).view(np.int64), count, keys[doc],
               chunk.langs[doc].view(np.int64)]
    for a in range(0, len(at), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 100_000]) for c in columns], names=_named(PARTIAL))


def _marked(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = prints & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _count(lengths: list[int], bits=None):
    """Partial counts of the phrases of ``lengths`` words, made of phrases that the bit map holds,
    which are a word shorter than the shortest of ``lengths``."""
    def run(batches):
        for keys, raw, offsets, langs in _chunks(batches):
            chunk = Chunk(raw, offsets, langs)
            if not len(chunk.start):
                continue
            frequent = None
            if bits is not None:
                at = chunk.places(min(lengths) - 1)
                frequent = np.zeros(len(chunk.start), bool)
                frequent[at] = _marked(bits.value, chunk.prints(at, min(lengths) - 1))
            for n in lengths:
                at = chunk.places(n)
                if frequent is not None:
                    good = np.ones(len(at), bool)
                    for k in range(n - min(lengths) + 2):
                        good &= frequent[at + k]
                    at = at[good]
                if len(at):
                    yield from _rows(chunk, keys, *chunk.groups(at, chunk.prints(at, n), n), n)
    return run


def _bit_map(marks: DataFrame, map_bits: int):
    """The bits of the numbers of a column, as a broadcast array of ``map_bits`` / 64 numbers."""
    slot = marks.select(F.col(marks.columns[0]).bitwiseAND(map_bits - 1).alias("slot"))
    words = (slot.select(F.shiftright("slot", 6).alias("at"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(map_bits // 64, np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return marks.sparkSession.sparkContext.broadcast(out)


def _total(partials: DataFrame, *more: str) -> DataFrame:
    """One row a phrase: its count, a document that holds it and the columns of ``more``. Sums and
    minima of numbers, so tasks add up before the shuffle."""
    least = [F.min(c).alias(c) for c in ("key", *more)]
    return partials.groupBy("fp", "check").agg(F.sum("n").alias("n"), *least)


def _pointed(bits):
    """The rows whose key (first column) the bit map holds."""
    def run(batches):
        for batch in batches:
            good = _marked(bits.value, batch.column(0).to_numpy().view(np.uint64))
            if good.any():
                yield batch.filter(pa.array(good))
    return run


READ = "fp long, check long, lang string, phrase string, n_words int, f long"


def _read_back(most_words: int):
    """The text of the phrases that are looked for in each document, where both numbers agree."""
    def run(batches):
        for batch in (b.slice(a, TEXTS) for b in batches for a in range(0, b.num_rows, TEXTS)):
            texts, names = batch.column(0).cast(pa.large_binary()).to_pylist(), batch.column(1).to_pylist()
            marks = np.array(batch.column(2).to_pylist(), np.int64).view(np.uint64)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1])).astype(np.int64)
            chunk = Chunk(np.frombuffer(b"".join(texts), np.uint8), offsets, marks)
            wanted = {(p["fp"], p["check"]): p["n"] for found in batch.column(3).to_pylist() for p in found}
            looked = np.unique(np.array([fp for fp, _ in wanted], np.int64).view(np.uint64))
            out = []
            for n in range(1, most_words + 1):
                at = chunk.places(n)
                fp = chunk.prints(at, n)
                at, fp = at[np.isin(fp, looked)], fp[np.isin(fp, looked)]
                check = chunk.prints(at, n, 1).view(np.int64).tolist()
                for pair, i in zip(zip(fp.view(np.int64).tolist(), check), at.tolist()):
                    count = wanted.pop(pair, None)
                    if count is not None:
                        phrase = " ".join(w for w in chunk.phrase(i, n).split(" ") if w)
                        out.append((*pair, names[chunk.doc[i]], phrase, n, count))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_named(READ))
    return run


def _lang(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_LANG))


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, most_words: int = MOST_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  map_bits: int = MAP_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of all phrases of 1 to ``most_words`` words that occur ``least`` times or more
    in their language, and (lang, n) of all word occurrences."""
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.col(id_col).cast("string"), text).bitwiseAND(SHORT)
    rows = docs.select(key.alias("key"),
                       _lang(lang_col).alias("lang"), text.alias("text"))
    rows = rows.filter("text is not null and text <> ''")
    marked = rows.select("key", F.xxhash64("lang").alias("lang"), "text")
    words = written(_total(marked.mapInArrow(_count([1]), PARTIAL), "lang"), "phrase-words")
    found = [words.filter(F.col("n") >= least).drop("lang")]
    for lengths in ([2], [3], list(range(4, most_words + 1))):
        lengths = [n for n in lengths if n <= most_words]
        if lengths:
            bits = _bit_map(found[-1].select("fp"), map_bits)
            counted = _total(marked.mapInArrow(_count(lengths, bits), PARTIAL)).filter(F.col("n") >= least)
            found.append(written(counted, "phrase-frequent"))
    frequent = found[0]
    for more in found[1:]:
        frequent = frequent.union(more)
    # a document is read once for all the phrases that point at it, and no other is shuffled
    by_doc = frequent.groupBy("key").agg(F.collect_list(F.struct("fp", "check", "n")).alias("found"))
    held = rows.mapInArrow(_pointed(_bit_map(frequent.select("key"), map_bits)), rows.schema)
    read = held.join(by_doc, "key").select("text", "lang", F.xxhash64("lang").alias("mark"), "found")
    read = read.mapInArrow(_read_back(most_words), READ)
    # rows that are equal in id and text have one key and say the same
    counts = read.groupBy("fp", "check").agg(*[F.min(c).alias(c) for c in ("lang", "phrase", "n_words", "f")])
    totals = words.groupBy(F.col("lang").alias("mark")).agg(F.sum("n").alias("n"))
    names = docs.select(_lang(lang_col).alias("lang")).distinct().withColumn("mark", F.xxhash64("lang"))
    return (written(counts.select("lang", "phrase", "n_words", "f"), "phrase-counts"),
            written(names.join(totals, "mark").select("lang", "n"), "phrase-totals"))


def _words(first: Column | int, count: Column | int) -> Column:
    """``count`` words from ``first`` (from 0) on, of the array ``words``."""
    return F.array_join(F.slice("words", first + 1, count), " ")


def collocations(docs: DataFrame, least: int = MIN_COUNT, most_words: int = MOST_WORDS, top: int = TOP,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 map_bits: int = MAP_BITS) -> DataFrame:
    """lang, rank (long), phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and the line ends \\x0A to \\x0D into pieces and
    at spaces and tabs into words; phrases lie within a piece. ``a``, ``l`` and ``r`` count the
    phrase and the two parts of its weakest cut, ``n`` all words of the language, ``score`` is
    floor(1000 * a * n / (l * r)) in exact numbers. A phrase that lies in a longer one that is as
    frequent goes. Null and empty texts hold no words, a null language is ``und``, texts of any
    length are read whole, repeated rows count as often as they come; no documents: no rows.
    Ties are settled by score, a, then the phrase's bytes. Other columns are not read.
    """
    return ranked(*phrase_counts(docs, least, most_words, id_col, text_col, lang_col, map_bits), top)


def ranked(counts: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The collocations of counted phrases (lang, phrase, n_words, f) and of the numbers of words
    of the languages (lang, n)."""
    phrases = counts.filter("n_words > 1").select("lang", "phrase", F.col("f").alias("a"),
                                                  F.split("phrase", " ").alias("words"))
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _words(F.lit(0), F.col("k")).alias("left"),
                     _words(F.col("k"), F.size("words")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cut = cut.join(part, ["lang", side])
    score = F.expr("cast((1000BD * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div "
                   "(cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as long)")
    few = totals.limit(FEW_LANGS + 1).count() <= FEW_LANGS
    cut = cut.join(F.broadcast(totals) if few else totals, "lang").withColumn("score", score)
    weakest = F.min(F.struct("score", "k", "l", "r", "n")).alias("at")
    scored = cut.groupBy("lang", "phrase").agg(F.max("a").alias("a"), weakest)
    # every shorter phrase inside a phrase, with the longer one's count
    inner = phrases.select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.greatest(F.size("words") - 1, F.lit(2)))).alias("m"))
    inner = inner.filter(F.col("m") < F.size("words"))
    inner = inner.select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("m"))).alias("at"))
    longer = (inner.select("lang", _words(F.col("at"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") < F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("at.score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "at.l", "at.r", "at.n", "at.score")
