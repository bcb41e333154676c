"""Exact top-k, spelling variants and collocations against brute force, and at their edges."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pumpguard.llm import collocations, spelling, top_k

VECTORS = "vec_id long, embedding array<float>, row string, score int, rank int, block int"
MOST = (1 << 63) - 1


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- top-k

def brute_top_k(rows, k, step):
    clean = [(i, r[0], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows)
             if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, q, v in clean:
        if q is None or q % step:
            continue
        near = sorted((-max(-MOST, min(MOST, sum(a * b for a, b in zip(v, w)))), c is None, c or 0, j)
                      for j, c, w in clean if j != i)[:k]
        out += [(q, n + 1, None if no else c, -s) for n, (s, no, c, _) in enumerate(near)]
    return sorted(out, key=repr)


def vector_rows():
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.choice((0, 0, r.gauss(0, 1))))) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(150)]                      # a hot vector, many ties
    rows += [(40, list(rows[3][1])), (40, list(rows[3][1])), (None, list(rows[9][1])), (None, [1.0] * 12)]
    rows += [(20, None), (21, [None] + [0.5] * 11), (30, [math.nan] * 12), (31, [math.inf] * 12), (50, []), (60, [2.0])]
    return rows


def test_top_k_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "CANDIDATES", 64)
    monkeypatch.setattr(top_k, "QUERIES", 7)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], VECTORS).repartition(5)
    for components in (1 << 20, 40):  # one block of queries, and many
        got = whole(top_k.top_k(df, k=4, query_step=10, block_components=components))
        assert got == brute_top_k(rows, 4, 10)


def test_top_k_of_huge_components_is_exact(spark):
    rows = [(0, [3.0e38, -1.0]), (10, [2.5e38, 0.004]), (1, [1.0e-3, -2.0e38]), (2, [1.0, 1.0]), (3, [1.0, 1.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = whole(top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3, query_step=10))
    assert got == brute_top_k(rows, 3, 10)


def test_top_k_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whole(top_k.top_k(empty)) == []
    one = spark.createDataFrame([(0, [1.0]), (1, None)], "vec_id long, embedding array<float>")
    assert whole(top_k.top_k(one)) == []  # no candidate but the query
    none = spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert whole(top_k.top_k(none)) == []  # no query


def test_scatter_of_sparse_rows():
    vectors = pa.array([[0.0, 0.5, 0.0], [0.25, 0.0], [], [-0.001, 0.0, 1.0]], pa.list_(pa.float64()))
    row, term, weight = top_k._rows(vectors.slice(1), 256)  # a slice keeps its own rows
    assert list(zip(row, term, weight)) == [(0, 0, 64), (2, 0, -1), (2, 2, 256)]
    lists = top_k._by_term(row, term, weight)
    scores = top_k.accumulate(top_k._by_term(*top_k._rows(vectors, 256)), 4, lists, 3, np.int64)
    assert scores.tolist() == [[0, 0, 0], [64 * 64, 0, -64], [0, 0, 0], [-64, 0, 1 + 256 * 256]]


# ---------------------------------------------------------------- spelling

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("letters,sizes,count", [("ab", (1, 9), 250), ("abcé", (7, 10), 400), ("aßÿ", (3, 6), 300)])
def test_neighbours_are_all_pairs_one_edit_apart(spark, letters, sizes, count):
    r = random.Random(len(letters))
    words = {"".join(r.choice(letters) for _ in range(r.randint(*sizes))) for _ in range(count)}
    got = {tuple(x) for x in spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)} and got


def test_neighbours_of_words_beyond_the_levels(spark):
    """Labels of several letters: every place of the edit, at both ends and inside a label."""
    r = random.Random(3)
    base = "".join(r.choice("abcdefgh") for _ in range(400))
    words = {base, base[:150] + "z" + base[150:]}
    for i in [0, 1, 2, 3, 199, 200, 201, 202, 203, 204, 397, 398, 399, *range(210, 230)]:
        words |= {base[:i] + base[i + 1:], base[:i] + "x" + base[i + 1:], base[:i] + "y" + base[i:]}
    got = {tuple(x) for x in spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def brute_variants(rows):
    n = Counter()
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def spelling_rows():
    r = random.Random(11)
    words = ["Station", "stations", "stationär", "Bahnhöfe", "BAHNHÖFEN", "letters", "lettres", "lettera", "ÀÉÎõüÿß"]
    rows = [(i, " ".join(r.choice(words) for _ in range(60))) for i in range(40)]
    rows += [(i, "station " * 3000) for i in range(3)] + [(7, "statiom " * 250 + "stetiom " * 20 + "stetion-" * 2)]
    return rows + [(1, None), (None, None), (None, "stetiom stetiom"), (5, ""), (5, " \n 123 x"), (9, "q" * 50_000 + " " + "q" * 50_000)]


def test_variants_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = spelling_rows()
    df = spark.createDataFrame([(*r, 1, "w", None) for r in rows],
                               "doc_id long, text string, n int, word string, node string").repartition(4)
    got = whole(spelling.variants(df))
    assert got == brute_variants(rows)
    chain = {r[0]: r for r in got}
    assert chain["stetiom"][1] == "statiom" and chain["stetiom"][2] == "station"  # a form of a form


def test_variants_edges(spark):
    schema = "doc_id long, text string"
    assert whole(spelling.variants(spark.createDataFrame([], schema))) == []
    assert whole(spelling.variants(spark.createDataFrame([(1, "one word of nothing")], schema))) == []


# ---------------------------------------------------------------- collocations

def brute_phrases(rows, least, most, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    good = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in good.items():
        lang, words = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and b >= a and
               any(q[i:i + len(words)] == words for i in range(1, len(q))) for q, b in good.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k)
                       for k in range(1, len(words)))
        out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    ranked = []
    for lang in n:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[-1], -o[2], o[1].encode()))[:top]
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(mine)]
    return sorted(ranked, key=repr)


def phrase_rows():
    r = random.Random(2)
    words = "The the sun moon SEA sky öl Ö ha x\x0by a.b c,d   日本 e f".split(" ")
    rows = [(r.choice(["en", "de", None, "und"]), "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", "\n"])
                                                         for _ in range(r.randint(0, 60)))) for _ in range(250)]
    return rows + [("en", None), ("en", ""), (None, " . "), ("fr", "ha " * 3000), ("es", "only one line here")] + \
        [("de", "one passage that many share, word for word")] * 30


@pytest.mark.parametrize("chunk,bits", [(16 << 20, 1 << 20), (300, 1 << 6)])
def test_collocations_are_brute_force(spark, monkeypatch, chunk, bits):
    """Also in chunks of a text or two, and with a bit map that holds next to nothing."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(collocations, "SEGMENT_BYTES", 64)
    rows = phrase_rows()
    df = spark.createDataFrame([(i if i % 9 else None, t, lang, "x", 1, 2) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n int, key int").repartition(3)
    got = whole(collocations.collocations(df, least=9, top=60, map_bits=bits))
    assert got == brute_phrases(rows, 9, 5, 60) and len(got) > 60


def test_colliding_fingerprints_come_apart(spark, monkeypatch):
    """With fingerprints of six bits nearly all phrases collide, inside a task and across tasks."""
    monkeypatch.setattr(collocations, "_mixed", lambda h: h % np.uint64(61))
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string").repartition(3)
    assert whole(collocations.collocations(df, least=9, top=60, map_bits=1 << 10)) == brute_phrases(rows, 9, 5, 60)


def test_collocations_edges(spark):
    schema = "doc_id long, text string, lang string"
    assert whole(collocations.collocations(spark.createDataFrame([], schema))) == []
    nothing = spark.createDataFrame([(1, None, "en"), (None, "", None), (2, " ,. ", "en"), (3, "word", "en")], schema)
    assert whole(collocations.collocations(nothing, least=1)) == []
    assert whole(collocations.collocations(nothing.union(nothing), least=1)) == []


def test_large_products_are_exact(spark):
    """a * n and l * r beyond 64 bits."""
    counts = spark.createDataFrame([("en", "p q", 2, 6 * 10**12), ("en", "p", 1, 7 * 10**12), ("en", "q", 1, 9 * 10**12 + 1)],
                                   "lang string, phrase string, n_words int, f long")
    totals = spark.createDataFrame([("en", 10**15 + 7)], "lang string, n long")
    got = whole(collocations.ranked(counts, totals, 10))
    score = 1000 * 6 * 10**12 * (10**15 + 7) // (7 * 10**12 * (9 * 10**12 + 1))
    assert got == [("en", 1, "p q", 6 * 10**12, 7 * 10**12, 9 * 10**12 + 1, 10**15 + 7, score)]


def test_longer_phrases_are_made_of_frequent_triples(spark, monkeypatch):
    """All pairs of "a b c d" are frequent, its triples are not: no count of four words is handed on."""
    texts = ["a b", "b c", "c d"] * 3 + ["a b c d", "x y z w", "x y z w", "x y z w"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    rounds, whole = [], collocations._count
    monkeypatch.setattr(collocations, "_count", lambda lengths, bits=None: rounds.append((lengths, bits)) or whole(lengths, bits))
    counts, _ = collocations.phrase_counts(docs, least=3)
    assert {r["phrase"]: r["f"] for r in counts.filter("n_words > 2").collect()} == {
        "x y z": 3, "y z w": 3, "x y z w": 3}
    batch = pa.RecordBatch.from_pydict({"key": [1], "lang": [spark.sql("select xxhash64('en')").first()[0]], "text": ["a b c d"]})
    handed = {tuple(lengths): sum(b.num_rows for b in whole(lengths, bits)(iter([batch]))) for lengths, bits in rounds[2:]}
    assert handed == {(3,): 2, (4, 5): 0}
