"""Registered queries against their SQL, the pipeline against its operators one by one."""

import pytest

import corpus_pipeline
from pumpguard.llm import queries as Q
from pumpguard.llm import decontaminate, packing, quality_rules, simhash, toxicity
from pumpguard.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    got = duck.execute(Q.ORACLES[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(r) for r in got.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == want


def test_pipeline_is_its_stages_on_what_is_left(spark):
    docs, labels, bench = (table(spark, SF, t) for t in ("documents", "labels", "benchmark"))
    scored = toxicity.score(docs, labels).filter("predicted = 0").select("doc_id")
    left = docs.join(scored, "doc_id", "left_semi").select(docs.columns)
    good = quality_rules.verdicts(left, labels).filter("kept").select("doc_id")
    left = left.join(good, "doc_id", "left_semi")
    classes = simhash.near_duplicates(left).filter("doc_id = component_id").select("doc_id")
    left = left.join(classes, "doc_id", "left_semi")
    bad = decontaminate.contaminated(left, bench).select("doc_id")
    left = left.join(bad, "doc_id", "left_anti")
    want = {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packing.pack(left).collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want) > 0
