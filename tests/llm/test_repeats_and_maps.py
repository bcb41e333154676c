"""Ids that come very often, and columns that Spark cannot hash."""

from pyspark.sql import functions as F

from pumpguard.llm import common, quality_rules, simhash


def test_a_repeated_id_teaches_once_and_leaves_the_others_their_place(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "learn", lambda values, bad, names, prune: seen.append((values, bad)) or [])
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("word"), i * (F.col("doc_id") + 1))))
    ids = spark.range(301).select(F.col("id").alias("doc_id"))
    for often in (0, 3, 77):
        docs = ids.union(spark.range(20_000).select(F.lit(often).cast("long"))).withColumn("text", words)
        stats = common.written(quality_rules.statistics(docs), "stats")
        labels = ids.withColumn("quality", (F.col("doc_id") % 3 != 0).cast("int"))
        quality_rules.fit(stats, labels, max_rows=250)
        values, bad = seen[-1]
        assert len(values) == 250 and 50 < bad.sum() < 120
    assert all((v == seen[0][0]).all() for v, _ in seen)


def test_rows_with_map_columns_are_kept_once(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (2, text), (1, text), (3, "another text " + text[::-1]), (None, None)],
                                 "doc_id long, text string")
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn(
        "s", F.array(F.struct(F.col("m").alias("inner"))))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["m"]["k"]) for r in kept.collect()), key=repr) == [(1, 1), (3, 3), (None, None)]
