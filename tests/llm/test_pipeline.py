from pathlib import Path

import duckdb

import corpus_pipeline as P
from slipstream.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import pairs, words_of
from tests.llm.test_simhash_dedup import brute as components
from tests.llm.test_substring_dedup import brute as repeats


def test_every_stage_works_on_what_the_last_one_kept(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        before = pairs(docs)
        out = stage(spark, docs, sf_dir)
        if k == 4:
            break
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = P.staged(out, name)
        after = dict(pairs(docs))
        if k < 3:
            assert set(after.items()) <= set(before)
        if k == 2:
            assert set(after) == {i for i, _, c in components(before) if i == c}
        if k == 3:
            want = {i: n - gone for i, n, gone, _ in repeats(before)}
            assert {i: len(words_of(t)) for i, t in after.items()} == want
    assert {r["doc_id"] for r in out.collect()} == set(after)
    assert {tuple(r)[:5] for r in P.run(spark, sf_dir).collect()} == {tuple(r)[:5] for r in out.collect()}


def test_odd_rows_pass_through_the_stages(odd, table, spark):
    for docs in (odd, table([])):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns
            docs = P.staged(out, name)
        P.STAGES[-1][1](spark, docs, "").count()


def test_queries_against_their_sql(spark):
    connection = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        want = connection.sql(sql)
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        place = [want.columns.index(c) for c in columns]
        assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted((tuple(r[p] for p in place) for r in want.fetchall()), key=repr)
