"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is read as a sparse row of integer weights: component ``t`` of weight ``w`` is the term
``t``. A task turns its candidates into posting lists (term -> candidates, weights); a query row
then takes its terms one after the other and scatters ``query weight x posting weights`` into a
dense array with one score for each candidate of the block. Partition selection keeps the k best of a block,
blocks of a task are merged as they come, and Spark merges the tasks.

Queries are taken in blocks of bounded size (``BLOCK_COMPONENTS``), one pass over the candidates
a block, each pass a written table; candidates stay where they are and are never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpguard.llm.common import shipped_by_value, written

shipped_by_value(__name__)

SCALE = 256
K = 5
#: Queries are the rows whose id is divisible by this.
QUERY_STEP = 50
#: Components of the queries that one pass sends to the tasks: 4 bytes to 8 bytes each.
BLOCK_COMPONENTS = 1 << 20
#: Candidates and queries whose scores are held at once.
CANDIDATES, QUERIES = 4096, 128
#: Scores up to this are exact in 64 bits together with a place among ``CANDIDATES``.
SAFE = 1 << 48
_LONG = (1 << 63) - 1


def _whole(x: float, scale: int) -> int:
    """floor(scale * x) without rounding or overflow."""
    return scale * int(x) if abs(x) >= 2.0 ** 52 else math.floor(scale * x)


def weights(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python integers where these do not hold them."""
    scaled = np.floor(values * float(scale))
    if not len(values) or np.abs(values).max() * scale < 2.0 ** 52:
        return scaled.astype(np.int64)
    return np.array([_whole(x, scale) for x in values.tolist()], object)


def _rows(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the weights other than zero of a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(column)), lengths)
    term = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weight = weights(values, scale)
    some = weight != 0
    return row[some], term[some], weight[some]


def _by_term(row, term, weight) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Posting lists: term -> (rows, weights)."""
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    terms, first = np.unique(term, return_index=True)
    cuts = zip(first, [*first[1:], len(term)])
    return {int(t): (row[a:b], weight[a:b]) for t, (a, b) in zip(terms, cuts)}


def accumulate(queries: dict, n_queries: int, postings: dict, n_candidates: int,
               dtype) -> np.ndarray:
    """Dense scores, one row a query: every term adds its weighted postings."""
    scores = np.zeros((n_queries, n_candidates), dtype)
    for t in queries.keys() & postings.keys():
        (who, how), (ids, w) = queries[t], postings[t]
        added = np.multiply.outer(how, w)
        if len(who) == n_queries and len(ids) == n_candidates:
            scores += added
        else:
            scores[np.ix_(who, ids)] += added
    return scores if dtype is np.int64 else np.clip(scores, -_LONG, _LONG)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores of each row; of equal ones the first places."""
    n = scores.shape[1]
    if n <= k:
        return np.tile(np.arange(n), (len(scores), 1))
    if scores.dtype == object:
        return np.array([sorted(range(n), key=lambda i: (-s[i], i))[:k] for s in scores])
    places = scores * n + np.arange(n - 1, -1, -1)  # one number for score and place: no ties
    return np.argpartition(places, n - k, axis=1)[:, n - k:]


class _Block:
    """A block of queries and the best candidates they have met."""

    def __init__(self, rows: list, ids: list, vectors: pa.Array, k: int, scale: int):
        self.rows, self.ids, self.k, self.scale = np.array(rows, np.int64), ids, k, scale
        self.sparse = _rows(vectors, scale)
        self.most = _size(self.sparse, len(rows))
        self.kept: list[list[tuple]] = [[] for _ in rows]

    def meet(self, rows, ids, vectors) -> None:
        """Score the candidates of one block against all queries, and keep the best."""
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i])), np.int64)
        ids, rows = [ids[i] for i in order], np.asarray(rows, np.int64)[order]
        sparse = _rows(vectors.take(pa.array(order)), self.scale)
        bound = self.most * _size(sparse, len(ids))
        dtype = np.int64 if bound < SAFE else object
        postings = _by_term(*(a if dtype is object else a.astype(np.int64) for a in sparse))
        for start in range(0, len(self.rows), QUERIES):
            stop = min(start + QUERIES, len(self.rows))
            mine = (self.sparse[0] >= start) & (self.sparse[0] < stop)
            row, term, weight = (a[mine] for a in self.sparse)
            terms = _by_term(row - start, term, weight if dtype is object else weight.astype(np.int64))
            scores = accumulate(terms, stop - start, postings, len(ids), dtype)
            # a query is no candidate of its own: one place more is selected, then it is left out
            best = _best(scores, min(self.k + 1, len(ids)))
            for q in range(start, stop):
                found = [(-int(scores[q - start, c]), ids[c] is None, ids[c] or 0, int(rows[c]))
                         for c in best[q - start].tolist() if rows[c] != self.rows[q]]
                self.kept[q] = sorted(self.kept[q] + found)[:self.k]

    def results(self):
        for q, found in enumerate(self.kept):
            for score, no_id, vec_id, row in found:
                yield int(self.rows[q]), self.ids[q], None if no_id else vec_id, row, -score


def _size(sparse, n: int) -> int:
    """An upper bound of a row's norm: a product of two bounds holds any inner product."""
    row, _, weight = sparse
    if not len(row):
        return 0
    if weight.dtype != object and np.abs(weight).max() < 1 << 20:
        return math.isqrt(int(np.bincount(row, weight.astype(np.float64) ** 2, n).max())) + 1
    return int(max(abs(int(w)) for w in weight.tolist())) * (math.isqrt(int(np.bincount(row).max())) + 1)


RESULT = "query_row long, query_id long, vec_id long, vec_row long, score long"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _search(block, k: int, scale: int):
    def run(batches):
        rows, ids, vectors = block.value
        queries = _Block(rows, ids, pa.array(vectors, pa.list_(pa.float64())), k, scale)
        for batch in batches:
            for at in range(0, batch.num_rows, CANDIDATES):
                part = batch.slice(at, CANDIDATES)
                queries.meet(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2))
        out = list(queries.results())
        for at in range(0, len(out), 10_000):
            columns = zip(*out[at:at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)
    return run


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding",
          block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products of the integer
    vectors floor(scale * x) for each row whose id is divisible by ``query_step``, against every
    other row; ties go to the smaller vec_id, null ids last.

    Vectors that are null or hold a null, NaN or infinite component take no part; an empty vector
    scores 0 with all, and a shorter vector counts as zero behind its end. Scores are exact; one
    beyond 64 bits counts as the nearest number of 64 bits. Repeated ids
    are rows of their own, each a candidate of the others. Null ids are no queries. Fewer
    candidates than ``k``: all. No rows or no queries: no rows. Other columns are not read.
    """
    value = F.col(vector_col).cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), value.alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & ~bad)
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "topk-rows")
    asked = rows.filter(F.col("vec_id") % query_step == 0)
    size = asked.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block_components))
    # blocks are dealt by a hash of the row's number, so each holds about the same
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")),
                    "topk-queries", ["block"])
    spark, found = vectors.sparkSession, []
    for b in range(blocks if size else 0):
        part = asked.filter(F.col("block") == b).select("row", "vec_id", "vector").toArrow()
        if not part.num_rows:
            continue
        part = part.combine_chunks()
        block = spark.sparkContext.broadcast((part.column(0).to_pylist(), part.column(1).to_pylist(),
                                              [v.values.to_numpy() for v in part.column(2)]))
        hits = rows.select("row", "vec_id", "vector").mapInArrow(_search(block, k, scale), RESULT)
        found.append(written(hits, "topk-hits"))
        block.destroy()
    if not found:
        found = [spark.createDataFrame([], RESULT)]
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
