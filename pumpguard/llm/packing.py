"""Best-fit packing of tokenised documents into sequences, planned on the length histogram.

Documents are tokenised where they lie and reduced to pieces (place and length). Only the counts
by length, at most ``capacity`` numbers, reach the driver; best-fit decreasing runs over these
counts and gives runs of equal steps ("ranks lo to hi of this length fill the sequences from s
on, k to a sequence, from this offset"). Pieces take the planned places by a join on their rank
within their length.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import cells_for, rank_by_unit, shipped_by_value, unit_hash, written

shipped_by_value(__name__)

CAPACITY = 4096
END_ID = 1
#: Words that a worker remembers the ids of; beyond it the memory is emptied before the next text.
REMEMBERED_WORDS = 400_000

#: Texts of these characters only are split by the pattern below exactly as the tokenizer does
#: (composed Latin letters, ASCII signs); every other text goes to the tokenizer whole.
PLAIN = re.compile("[\t-\r -~ -©«-¹»-įı-ž]*")
#: The vocabulary's own splitting pattern, over lower-cased plain texts.
PIECES = re.compile("[a-zµß-öø-ž]+"
                    "|'(?:[stmd]|re|ve|ll)"
                    "|[0-9²³¹¼-¾]"
                    "|[!-/:-@\\[-`{-~¡-±´¶-¸»¿×÷]+")
SPECIAL = "<|"
WORD_END = "</w>"


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes, asked of the tokenizer once. Words
    are what stands between white space, lower-cased, and the pieces that the pattern makes of them."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        vocab = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.split_already = _for_pieces(tokenizer)

    def learn(self, words: list[str]) -> None:
        split = [PIECES.findall(word) for word in words]
        new = list({p for pieces in split for p in pieces if p not in self})
        encoded, = self.split_already.encode_batch_fast([" ".join(new)], add_special_tokens=False)
        ids = np.array(encoded.ids, np.dtype("<u4"))
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) == len(new):
            starts = [0, *stops[:-1]]
            whole = ids.tobytes()
            self.update(zip(new, [whole[4 * a:4 * z] for a, z in zip(starts, stops)]))
        else:  # a vocabulary without word ends: one piece at a time
            for piece in new:
                self[piece] = _encoded(piece, self.tokenizer)
        for word, pieces in zip(words, split):
            if len(pieces) != 1:
                self[word] = b"".join(map(self.__getitem__, pieces))


def _for_pieces(tokenizer):
    """The tokenizer for lower-cased pieces of plain texts with a space between them: the same
    model, with nothing left to normalise and only the spaces to split at."""
    if "ByteLevel" not in str(tokenizer.pre_tokenizer):  # another kind: asked as it is
        return tokenizer
    from tokenizers import Tokenizer, pre_tokenizers
    out = Tokenizer(tokenizer.model)
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(" ", "removed"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])
    return out


def _encoded(text: str, tokenizer) -> bytes:
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return np.array(ids, np.dtype("<u4")).tobytes()


def token_bytes(text: str, words: WordIds) -> bytes:
    """The ids of a text as bytes, equal to ``encode(text, add_special_tokens=False)``: the
    tokenizer treats each split piece alone and no piece holds white space, so remembered words
    can be joined."""
    if SPECIAL in text or not PLAIN.fullmatch(text):
        return _encoded(text, words.tokenizer)
    found = text.lower().split()
    new = [word for word in set(found) if word not in words]
    if new:
        if len(words) > REMEMBERED_WORDS:
            words.clear()
            new = list(set(found))
        words.learn(new)
    return b"".join(map(words.__getitem__, found))


PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long")


def _pieces(tokenizer_path: str, capacity: int, end_id: int):
    def run(batches):
        from tokenizers import Tokenizer
        words = WordIds(Tokenizer.from_file(tokenizer_path))
        end = np.array([end_id], np.dtype("<u4")).tobytes()
        for batch in batches:
            out = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_bytes(text.as_py() or "", words) + end
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    stop = min(n, start + capacity)
                    for column, value in zip(out, (doc_id, k, start, stop - start,
                                                   zlib.crc32(ids[4 * start:4 * stop]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in out[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, lo, hi, sequence, per, offset) runs.

    Ranks lo <= r < hi of ``length`` go to sequence ``sequence + (r - lo) // per`` at
    ``offset + ((r - lo) % per) * length``. Sequences with the same room left are one entry of
    the plan, so work and size follow the number of lengths, not of documents.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, count)
    rooms: list[int] = []                        # the keys of room, sorted
    steps, opened = [], 0

    def leave(free: int, first: int, count: int) -> None:
        if free and count:
            if free not in room:
                bisect.insort(rooms, free)
                room[free] = []
            room[free].append((first, count))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                free = rooms[at]
                first, count = room[free].pop()
                if not room[free]:
                    del room[free]
                    rooms.pop(at)
            else:
                free, first = capacity, opened
                count = -(-todo // (capacity // length))
                opened += count
            per = free // length
            full = min(count, todo // per)
            if full:
                steps.append((length, rank, rank + full * per, first, per, capacity - free))
                leave(free - per * length, first, full)
                rank, todo = rank + full * per, todo - full * per
            used = full
            if todo and used < count:  # fewer than a sequence takes: the last one of this length
                steps.append((length, rank, rank + todo, first + used, per, capacity - free))
                leave(free - todo * length, first + used, 1)
                rank, todo, used = rank + todo, 0, used + 1
            leave(free, first + used, count - used)
    return steps


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: one piece that holds the end id alone. Texts of any length are
    tokenised whole; only documents over ``capacity`` ids are cut. Null or repeated ids are
    packed row by row. No rows: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    path = tokenizer_path or default_tokenizer_path()
    pieces = written(slim.mapInArrow(_pieces(path, capacity, end_id), PIECE_SCHEMA), "pieces")
    counts = {r["length"]: r["n"] for r in                     # at most ``capacity`` rows
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = plan(counts, capacity)
    places = spark.createDataFrame(
        steps, "p_length long, lo long, hi long, sequence long, per long, base long")
    ranked = pieces.withColumn("_u", unit_hash(F.coalesce("doc_id", F.lit(-1)), F.col("piece"),
                                               F.col("ids_crc32")))
    ranked = rank_by_unit(ranked, ["length"], "_u", ["doc_id", "piece", "ids_crc32", "start"],
                          cells_for(sum(counts.values())), "_rank")
    # the plan is bounded by the lengths (a few runs each), never by the documents
    return (ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length"))
                        & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    F.expr("sequence + (_rank - lo) div per").alias("sequence_id"),
                    F.expr("base + ((_rank - lo) % per) * length").alias("offset")))
