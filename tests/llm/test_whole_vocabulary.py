"""op6: scores of models over all words, counted by hand."""

import math
import random
from collections import Counter

import pytest

from pumpguard.llm import lm_score


def by_hand(rows, target):
    pairs, contexts = [Counter(), Counter()], [Counter(), Counter()]
    events = [list(zip([b"", *w], [*w, b""])) if w else [] for _, w in rows]
    for (doc, _), e in zip(rows, events):
        for m in (0, 1) if doc in target else (0,):
            pairs[m].update(e)
            contexts[m].update(u for u, _ in e)
    size = len(set(contexts[0]) - {b""})
    total = [sum(n for u, n in c.items() if u) for c in contexts]

    def loss(m, u, v):
        alone = math.log((contexts[m][u] + 1) / (total[m] + size)) if u else 0.0
        return -0.75 * math.log((pairs[m][u, v] + 1) / (contexts[m][u] + size + 1)) - 0.25 * alone
    return [sum(loss(1, *e) - loss(0, *e) for e in es) / len(w) if w else None
            for (_, w), es in zip(rows, events)]


@pytest.mark.parametrize("frequent, buffer, bucket", [
    (2047, 1 << 20, 16 << 20), (0, 50, 700), (1, 1, 1 << 20), (5, 500, 300)])
def test_scores_as_counted_by_hand(spark, monkeypatch, frequent, buffer, bucket):
    """Also with more words than the frequent ones, many buffers, many buckets, hot words."""
    monkeypatch.setattr(lm_score, "BUFFER_WORDS", buffer)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", bucket)
    r = random.Random(5)
    texts = {i: " ".join(f"{'ab'[i % 2]}{r.randrange(1500)}" if k % 3 else "The" for k in range(90)) for i in range(60)}
    texts |= {60: "", 61: None, 62: " \n\x0b", 63: "a1 b1 a1 b1 A1", 64: "solo", 65: "İ x ß", 66: "x" * 5000}
    docs = spark.createDataFrame([*texts.items(), (3, texts[3]), (None, texts[4])], "doc_id long, text string")
    told = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(5, 0, 0), (7, 1, 1), (None, 1, 0)],
                                 "doc_id long, quality int, toxic int")
    rows = [(d["doc_id"], (d["text"] or "").encode().lower().split()) for d in docs.collect()]
    want = by_hand(rows, set(range(1, 30, 2)) - {5, 7})
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    got = sorted(((g["doc_id"], g["n_tokens"], g["score"], g["in_target"])
                  for g in lm_score.score(docs, told, frequent_words=frequent).collect()), key=key)
    want = sorted(((d, len(w), s) for (d, w), s in zip(rows, want)), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == (None if w[2] is None else pytest.approx(w[2], abs=2e-6))
        assert g[3] == (w[2] is not None and g[2] < 0)


def test_no_rows_no_labels_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6), (2, None, 5, 6)], "doc_id long, text string, r long, h long")
    told = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert lm_score.score(docs.filter("false"), told).count() == 0
    assert sorted((g["doc_id"], g["n_tokens"]) for g in lm_score.score(docs, told).collect()) == [(1, 2), (2, 0)]
    assert lm_score.score(docs.filter("text is null"), told).collect()[0]["score"] is None


def test_a_word_is_hashed_once_for_its_place(monkeypatch):
    frequent = lm_score.Frequent([{"h": lm_score.xxhash.xxh3_64_intdigest(w), "b": 9 - i, "t": 1}
                                  for i, w in enumerate((b"the", b"of"))])
    asked, whole = [], lm_score.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(lm_score.xxhash, "xxh3_64_intdigest", lambda w: asked.append(w) or whole(w))
    known = lm_score.Known(frequent)
    for _ in range(2):
        assert frequent.numbered([b"of", b"rare", b"the", b"of", b"rare"], known).tolist() == [2, -1, 1, 2, -1]
    assert frequent.numbered([], known).tolist() == []
    assert sorted(asked) == [b"of", b"rare", b"the"]
