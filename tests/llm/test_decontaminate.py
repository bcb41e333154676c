"""Seeds of test items: no copy that the alignment accepts is lost."""

import random

import pytest
from pyspark.sql import functions as F

from pumpguard.llm import decontaminate as D

COMMON = [f"c{i}" for i in range(30)]


def full(a, b):
    """The best local score, cell by cell."""
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[j - 1] - 1))
        best, row = max(best, *new), new
    return best


def edited(r, words, every, kind):
    """``words`` with every ``every``-th one replaced, dropped or followed by another."""
    out = []
    for i, w in enumerate(words):
        hit = i % every == every - 1
        if hit and kind == "replace":
            out.append(f"new{r.randrange(10 ** 6)}")
        elif not hit or kind == "add":
            out.append(w)
        if hit and kind == "add":
            out.append(f"new{r.randrange(10 ** 6)}")
    return out


def noise(r, n):
    return [r.choice(COMMON) if r.random() < 0.7 else f"w{r.randrange(3000)}" for _ in range(n)]


def found(docs, items, **more):
    return {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items, **more).collect()}


@pytest.mark.parametrize("expected", [1.0, 1e-12])
def test_every_edited_copy_that_alignment_accepts_is_found(spark, expected):
    # expected 1e-12: as in a corpus so large that no seed is rare by chance
    r = random.Random(11)
    items = {i: noise(r, r.randrange(3, 45)) for i in range(24)}
    docs, n = {}, 0
    for words in items.values():
        for every, kind in ((1, "add"), (2, "add"), (3, "replace"), (3, "drop"), (4, "replace"), (5, "drop"), (8, "replace")):
            docs[n] = noise(r, r.randrange(60)) + edited(r, words, every, kind) + noise(r, r.randrange(60))
            n += 1
    want = {(d, i) for d, b in docs.items() for i, a in items.items() if full(a, b) >= D.LIMIT * D.MATCH * len(a)}
    assert len({d for d, _ in want}) >= 0.9 * n
    got = found(spark.createDataFrame([(d, " ".join(b)) for d, b in docs.items()], "doc_id long, text string"),
                spark.createDataFrame([(i, " ".join(a)) for i, a in items.items()], "item_id long, text string"),
                expected=expected)
    assert got == want


@pytest.mark.parametrize("limit", [0.3, 0.8, 1.0])
def test_other_limits(spark, limit):
    r = random.Random(5)
    items = {i: noise(r, r.randrange(3, 25)) for i in range(10)}
    docs = {n: noise(r, 20) + edited(r, items[n % 10], 2 + n % 6, ("add", "drop", "replace")[n % 3]) + noise(r, 9)
            for n in range(60)}
    docs.update({100 + i: a for i, a in items.items()})
    want = {(d, i) for d, b in docs.items() for i, a in items.items() if full(a, b) >= limit * D.MATCH * len(a)}
    got = found(spark.createDataFrame([(d, " ".join(b)) for d, b in docs.items()], "doc_id long, text string"),
                spark.createDataFrame([(i, " ".join(a)) for i, a in items.items()], "item_id long, text string"),
                limit=limit)
    assert got == want and len(want) >= 10


def test_short_items_odd_rows_and_other_columns(spark):
    rows = [(1, "say Xylophone now", 1), (2, "red fox", 2), (3, "red big fox", 3), (4, "fox red", 4), (None, "RED, fox!", 5),
            (1, "say Xylophone now", 1), (6, None, 6), (7, "", 7), (8, "... !", 8), (9, "plain", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int").withColumn(
        "check", F.create_map(F.lit("a"), F.lit(1))).withColumn("item", F.lit("x")).withColumn("a.b", F.lit(2))
    items = spark.createDataFrame([(1, "xylophone"), (2, "Red fox"), (2, "Red fox"), (3, None), (4, ""), (5, "?!")],
                                  "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 2), (3, 2), (None, 2)], key=repr)
    left = D.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [4, 6, 7, 8, 9]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0))):
        assert D.contaminated(d, i).count() == 0 and D.without_contaminated(d, i).count() == d.count()


def test_one_text_of_many_rows_and_a_very_long_one(spark):
    r = random.Random(3)
    item = [f"i{k}" for k in range(40)]
    copy = " ".join(noise(r, 50) + edited(r, item, 3, "replace"))
    long = " ".join(noise(r, 200_000) + edited(r, item, 4, "drop") + noise(r, 1000))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(copy)).otherwise(
        F.concat(F.lit("c1 c2 i3 i4 other text "), F.col("id"))).alias("text"))
    docs = docs.union(spark.createDataFrame([(5000, long)], "doc_id long, text string"))
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = D.contaminated(docs, items).collect()
    assert {r["doc_id"] for r in rows} == {*range(0, 3000, 3), 5000} and len(rows) == 1001
    hit = next(r for r in rows if r["doc_id"] == 5000)
    assert long[hit["start"]:hit["stop"]].split()[0] == "i0" and long[hit["start"]:hit["stop"]].split()[-1] in ("i38", "i39")
