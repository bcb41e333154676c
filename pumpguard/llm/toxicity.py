"""Toxicity by a linear-chain conditional random field over tokens.

Labels mark documents, so tokens are labelled first: a word or word beginning is telling if it
occurs nearly only in toxic documents, and there in many different surroundings, which the words
of a text that was copied often do not; tokens with it are labelled toxic. The field (features of a
token, and of two neighbouring labels) is trained on these labelled tokens.

Inference is exact: tokens without any learned feature all have the same potentials, so a run of
them is one power of the transition matrix, and forward and backward messages are passed over
the other tokens only. Marginals of those tokens give offending offsets; their positive log odds
add up to the evidence of the document, which a logistic curve fitted on the labelled documents
turns into its score.
"""

from __future__ import annotations

from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import (WORD, byte_words, first_by_unit, shipped_by_value, unit_hash,
                                  written)

shipped_by_value(__name__)

#: Labelled documents that are learned from at most, taken by a hash of their id.
MAX_FIT_DOCS = 8_000
#: Share of a telling feature's documents that are toxic at least, and how many features may look
#: telling by chance: from it follows in how many documents one must be.
MIN_SHARE = 0.9
BY_CHANCE = 0.05
FEWEST, MOST = 4, 30
#: Telling features at most, those in most toxic documents first.
MAX_FEATURES = 20_000
#: Tokens on either side of a labelled token that it is trained with; stretches of one document
#: and in all that are trained with at most.
CONTEXT = 8
MAX_SPANS_OF_ONE = 4
MAX_SPANS = 5_000
BEGINNINGS = (4, 5)
#: Words on either side by which two places are told apart, but for those of a phrase around it.
AROUND, PHRASE = 20, 4
STEPS, RATE, SHRINK = 120, 0.3, 0.02
START = itemgetter(slice(min(BEGINNINGS)))


def features(word: str) -> list[str]:
    return ["w=" + word, *(f"b={word[:n]}" for n in BEGINNINGS if len(word) >= n)]


def _feature_sets(batches):
    """(doc, toxic, feature, the surroundings of its first place) for the features of every text."""
    for batch in batches:
        out = ([], [], [], [])
        for doc, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2)):
            words = WORD.findall((text.as_py() or "").lower())
            pairs = [crc32(f"{a} {b}".encode("utf-8", "surrogatepass"))
                     for a, b in zip(words, words[1:])]
            found = {}
            for i, word in enumerate(words):
                new = [f for f in features(word) if f not in found]
                if new:
                    found.update(dict.fromkeys(new, surroundings(pairs, i)))
            out[0].extend([doc] * len(found))
            out[1].extend([toxic] * len(found))
            out[2].extend(found.keys())
            out[3].extend(found.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
             pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
            names=["doc", "toxic", "feature", "around"])


FEATURE_SCHEMA = "doc long, toxic int, feature string, around long"


def surroundings(pairs: list[int], i: int) -> int:
    """The smallest hash of the word pairs around word ``i``, without the phrase it stands in: the
    same in copies of a passage and mostly in edited ones, different where only a phrase is the
    same. ``pairs[k]`` is the hash of words k and k + 1. A short text has its phrase only."""
    around = pairs[max(0, i - AROUND):max(0, i - PHRASE)] + pairs[i + PHRASE:i + AROUND]
    return min(around or pairs, default=-1)


def spans(text: str, chosen: frozenset, toxic: bool) -> list:
    """Token sequences of one text with their labels: the surroundings of its tokens with a
    telling feature (toxic in a toxic document, not toxic in a clean one), or else some stretch
    of a clean text."""
    words = WORD.findall(text.lower())
    told = [any(f in chosen for f in features(w)) for w in words]
    rows, last = [], -1
    for i, t in enumerate(told):
        if t and i > last and len(rows) < MAX_SPANS_OF_ONE:
            last = i + CONTEXT
            part = slice(max(0, i - CONTEXT), last + 1)
            rows.append(list(zip(words[part], (toxic and x for x in told[part]))))
    if not rows and not toxic:
        middle = len(words) // 2
        rows.append([(w, False) for w in words[middle:middle + 2 * CONTEXT]])
    return rows


def _spans(chosen: frozenset):
    def run(batches):
        for batch in batches:
            out = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out.extend({"words": [w for w, _ in r], "marks": [int(m) for _, m in r]}
                           for r in spans(text.as_py() or "", chosen, bool(toxic)) if r)
            kind = pa.struct([("words", pa.list_(pa.string())), ("marks", pa.list_(pa.int32()))])
            table = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays(table.flatten(), names=["words", "marks"])
    return run


class Field:
    """Weights of a two-label chain: ``bias`` and ``weights`` (feature -> weight) for label 1,
    ``moves`` (2, 2) for neighbouring labels."""

    def __init__(self, bias: float, moves, weights: dict[str, float]):
        self.bias, self.moves, self.weights = float(bias), np.asarray(moves, float), weights
        self.slope, self.middle = 1.0, 2.0  # from evidence to the score of a document
        self.known: dict[str, float | None] = {}
        self.starts = frozenset(START(f[2:]) for f in weights)
        self.first_bytes = frozenset(START(s.encode("utf-8", "surrogatepass")) for s in self.starts)
        self.step = np.exp(self.moves + np.array([0.0, self.bias]))  # past a featureless token

    def emission(self, word: str) -> float | None:
        if word not in self.known:
            got = [self.weights[f] for f in features(word) if f in self.weights]
            self.known[word] = sum(got) if got else None
        return self.known[word]

    def may_emit(self, lowered: str) -> bool:
        """Whether any word may have a feature, judged by its first bytes."""
        return not self.first_bytes.isdisjoint(map(START, byte_words(lowered)))

    def run(self, n: int) -> np.ndarray:
        """``step`` to the power n, scaled to a sum of one."""
        out, base = np.eye(2), self.step / self.step.sum()
        while n:
            if n & 1:
                out = out @ base
                out = out / out.sum()
            base = base @ base
            base = base / base.sum()
            n >>= 1
        return out

    def marginals(self, places: list[int], emissions: list[float], length: int) -> np.ndarray:
        """Probability of label 1 at ``places`` of a text of ``length`` tokens; the tokens
        between them have no feature."""
        first = np.exp(np.array([0.0, self.bias]))
        lit = [np.exp(np.clip(np.array([0.0, e]), -50, 50)) for e in emissions]
        gaps = [b - a - 1 for a, b in zip(places, places[1:])]
        one = self.step
        ahead, message = [], None
        for k, place in enumerate(places):
            if k:
                message = (message @ self.run(gaps[k - 1])) @ one * lit[k]
            elif place:
                message = (first @ self.run(place - 1)) @ one * lit[k]
            else:
                message = first * lit[k]
            message = message / message.sum()
            ahead.append(message)
        back = self.run(length - 1 - places[-1]) @ np.ones(2)
        out = np.empty(len(places))
        for k in range(len(places) - 1, -1, -1):
            both = ahead[k] * back
            out[k] = both[1] / both.sum()
            if k:
                back = self.run(gaps[k - 1]) @ (one @ (lit[k] * back))
                back = back / back.sum()
        return out


def train(sequences: list[list[tuple[list[int], int]]], n_features: int) -> tuple:
    """(bias, moves, weights) by gradient ascent on the conditional likelihood; ``sequences``
    hold (feature numbers, label) per token. Forward and backward run over all sequences at
    once, padded at the end."""
    count, longest = len(sequences), max(map(len, sequences), default=0)
    bias, moves, weights = -2.0, np.zeros((2, 2)), np.zeros(n_features)
    if not count or not longest:
        return bias, moves, weights
    gold = np.zeros((count, longest), int)
    there = np.zeros((count, longest), bool)
    rows, cols, feats = [], [], []
    for s, sequence in enumerate(sequences):
        for t, (found, label) in enumerate(sequence):
            gold[s, t], there[s, t] = label, True
            rows += [s] * len(found)
            cols += [t] * len(found)
            feats += found
    rows, cols, feats = (np.array(x, int) for x in (rows, cols, feats))
    n = there.sum()
    m_b, m_m, m_w = 0.0, np.zeros((2, 2)), np.zeros(n_features)
    v_b, v_m, v_w = 0.0, np.zeros((2, 2)), np.zeros(n_features)
    want_w = np.bincount(feats, gold[rows, cols], n_features)
    pair = there[:, 1:] & there[:, :-1]
    want_m = np.array([[(pair & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for b in (0, 1)]
                       for a in (0, 1)], float)
    for step in range(1, STEPS + 1):
        lit = np.zeros((count, longest))
        np.add.at(lit, (rows, cols), weights[feats])
        emit = np.stack([np.zeros_like(lit), lit + bias], -1)
        ahead = np.zeros((count, longest, 2))
        back = np.zeros((count, longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            ahead[:, t] = emit[:, t] + np.logaddexp(ahead[:, t - 1, :1] + moves[0],
                                                    ahead[:, t - 1, 1:] + moves[1])
        ends = there.sum(1) - 1
        for t in range(longest - 2, -1, -1):
            nxt = emit[:, t + 1] + back[:, t + 1]
            got = np.stack([np.logaddexp(nxt[:, 0] + moves[a, 0], nxt[:, 1] + moves[a, 1])
                            for a in (0, 1)], -1)
            back[:, t] = np.where((t < ends)[:, None], got, 0.0)
        z = np.logaddexp.reduce(ahead[np.arange(count), ends], axis=1)
        p1 = np.exp(ahead[..., 1] + back[..., 1] - z[:, None]) * there
        both = (ahead[:, :-1, :, None] + moves + (emit + back)[:, 1:, None, :] - z[:, None, None, None])
        both = np.exp(both) * pair[..., None, None]
        grads = ((gold.sum() - p1.sum()) / n, (want_m - both.sum((0, 1))) / n - SHRINK * moves / n,
                 (want_w - np.bincount(feats, p1[rows, cols], n_features)) / n - SHRINK * weights / n)
        m_b, m_m, m_w = (0.9 * m + 0.1 * g for m, g in zip((m_b, m_m, m_w), grads))
        v_b, v_m, v_w = (0.99 * v + 0.01 * g * g for v, g in zip((v_b, v_m, v_w), grads))
        up = [RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
              for m, v in ((m_b, v_b), (m_m, v_m), (m_w, v_w))]
        bias, moves, weights = bias + up[0], moves + up[1], weights + up[2]
    return bias, moves, weights


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a null id is one of them."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_FIT_DOCS) -> Field:
    """The field, from at most ``max_docs`` labelled rows of ``docs`` (doc_id, text) that are
    not held out. A document labelled twice is toxic if either label says so."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc"), "toxic")
             .filter("doc is not null and toxic is not null").filter(~held_out(F.col("doc")))
             .groupBy("doc").agg(F.max("toxic").alias("toxic"))
             .withColumn("_u", unit_hash("toxicity", F.col("doc"))))
    known = first_by_unit(known, "_u", ["doc"], max_docs).drop("_u")
    sample = written(docs.join(F.broadcast(known), F.col("doc_id") == F.col("doc"))  # max_docs rows
                     .groupBy("doc").agg(F.first("toxic").alias("toxic"),
                                         F.max("text").alias("text")), "toxicity-sample")
    sets = sample.select("doc", "toxic", "text").mapInArrow(_feature_sets, FEATURE_SCHEMA)
    counted = written(
        sets.groupBy("feature", "around").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"),
                                F.count_if(F.col("t") > 0).alias("places"))
        .filter(F.col("n") >= FEWEST), "toxicity-features")
    base = sample.agg(F.avg("toxic")).first()[0] or 0.0
    often = {r["n"]: r["c"] for r in counted.groupBy(F.least("n", F.lit(MOST)).alias("n"))
             .agg(F.count(F.lit(1)).alias("c")).collect()}
    least = next((k for k in range(FEWEST, MOST) if base ** k * sum(
        c for n, c in often.items() if n >= k) <= BY_CHANCE), MOST)
    chosen = frozenset(r["feature"] for r in counted
                       .filter((F.col("t") >= least) & (F.col("places") >= least)
                               & (F.col("t") >= MIN_SHARE * F.col("n")))
                       .orderBy(F.desc("t"), "feature").limit(MAX_FEATURES).collect())
    if not chosen:
        return Field(-20.0, np.zeros((2, 2)), {})
    taken = (sample.select("toxic", "text").mapInArrow(
        _spans(chosen), "words array<string>, marks array<int>"))
    taken = taken.orderBy(F.xxhash64("words"), "words").limit(MAX_SPANS).collect()
    numbers = {f: i for i, f in enumerate(sorted(
        {f for r in taken for w, m in zip(r["words"], r["marks"]) if m for f in features(w)}))}
    sequences = [[([numbers[f] for f in features(w) if f in numbers], m)
                  for w, m in zip(r["words"], r["marks"])] for r in taken]
    bias, moves, weights = train(sequences, len(numbers))
    field = Field(bias, moves, {f: float(weights[i]) for f, i in numbers.items()
                                if weights[i] != 0.0})
    found = sample.select("toxic", "text").mapInArrow(_evidence(field), "toxic int, evidence double")
    pairs = np.array([tuple(r) for r in found.collect()], float)  # max_docs pairs
    field.slope, field.middle = calibrate(pairs[:, 1], pairs[:, 0])
    return field


def _evidence(field: Field):
    def run(batches):
        for batch in batches:
            got = [evidence(t.as_py() or "", field)[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())],
                                             names=["toxic", "evidence"])
    return run


def calibrate(found: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve from evidence to toxic documents; documents
    without evidence say nothing of it. Newton steps with a weak pull to slope 1, middle 2."""
    x, y = found[found > 0] - 2.0, toxic[found > 0]
    w = np.array([0.0, 1.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - 0.1 * (w - [0.0, 1.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, grad), -1.0, 1.0)
    slope = max(w[1], 0.05)
    return float(slope), float(2.0 - w[0] / slope)


def evidence(text: str, field: Field) -> tuple[float, list[int], np.ndarray, str]:
    """The positive log odds of all tokens' marginals, summed; the places of the tokens with a
    feature, their marginals, and the text the places are in."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a letter that changes its length: offsets need the text's own
        lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    none = (0.0, [], np.zeros(0), lowered)
    if not field.may_emit(lowered):
        return none
    words = WORD.findall(lowered)
    found = [(i, field.emission(w)) for i, w in enumerate(words) if START(w) in field.starts]
    places = [i for i, e in found if e is not None]
    if not places:
        return none
    p = field.marginals(places, [e for _, e in found if e is not None], len(words))
    odds = np.log(np.maximum(p, 1e-12)) - np.log(np.maximum(1 - p, 1e-12))
    return float(np.maximum(odds, 0.0).sum()), places, p, lowered


def tag(text: str, field: Field, limit: float) -> tuple[float, list[tuple[int, int]]]:
    """Score and offending (start, end) offsets of a text, in code points. No evidence: 0."""
    found, places, p, lowered = evidence(text, field)
    offending = [place for place, x in zip(places, p) if x >= limit]
    spots = [m.span() for m in WORD.finditer(lowered)] if offending else []
    score = 1 / (1 + np.exp(-np.clip(field.slope * (found - field.middle), -700, 700))) if found else 0.0
    return float(score), [spots[i] for i in offending]


def _scores(field: Field, limit: float):
    def run(batches):
        for batch in batches:
            got = [tag(t.as_py() or "", field, limit) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([[list(s) for s in g[1]] for g in got], pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "score", "spans"])
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_FIT_DOCS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, without the rows whose score is 0.5 or more; the field is
    fitted as in ``score``."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    field, column = fit(slim, labels, max_docs), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [tag(t.as_py() or "", field, 2.0)[0] < 0.5 for t in batch.column(column)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_FIT_DOCS, limit: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans (offsets of toxic tokens).

    Nothing but the text enters a score. Null and empty texts score 0. Null ids are held out and
    scored; repeated rows are scored each. Without usable labels no feature is known and all
    scores are 0. Texts are read whole, whatever their length. No rows: no rows. Other columns
    are not read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    field = fit(slim, labels, max_docs)
    scored = slim.mapInArrow(_scores(field, limit),
                             "doc_id long, score double, spans array<array<int>>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
