import math

import brute
import duckdb
from conftest import ODD
from pyspark.sql import functions as F

from voltgrid.llm import mixing, queries


def mixed(docs):
    rows = mixing.sized(docs)
    return mixing.mix(rows, mixing.targets(rows))


def test_query_against_brute_force_and_sql(spark, small, documents):
    df = queries.QUERIES["op3_mix_sources"](spark, small)
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in df.collect()}
    expected = brute.mix([(d, t, s) for d, t, _, s in documents])
    assert got.keys() == expected.keys()
    for d, row in expected.items():
        assert got[d][:2] == row[:2] and got[d][3] == row[3] and math.isclose(got[d][2], row[2], rel_tol=1e-12)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    sql = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({queries.CHECKS['op3_mix_sources']})").fetchall()
    assert {r[0]: r[1:] for r in sql} == got


def test_odd_rows(clashing):
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixed(clashing).collect()}
    expected = brute.mix([(d, t, s) for d, t, _, s, _ in ODD])
    assert {d: (r[0], r[1], r[3]) for d, r in got.items()} == {d: (r[0], r[1], r[3]) for d, r in expected.items()}


def test_sums_reach_targets_and_reruns_agree(clashing):
    rows = mixed(clashing)
    sums = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 0.5 for r in sums)
    assert rows.where("taken > 2 * size").isEmpty()
    assert sorted(map(tuple, rows.drop("target").collect()), key=str) == sorted(map(tuple, mixed(clashing).drop("target").collect()), key=str)


def test_a_single_source_has_the_whole_share(spark):
    docs = spark.createDataFrame([(i, "a b c", "s") for i in range(100)], "doc_id long, text string, source string")
    rows = mixed(docs).collect()
    assert sum(r.taken for r in rows) == 450 and {r.taken for r in rows} <= {3, 4, 5, 6}


def test_mixed_documents(clashing, odd):
    shares = mixed(clashing)
    out = mixing.mixed_documents(clashing, shares)
    assert out.columns == clashing.columns
    count = lambda df: {r.doc_id: r.n for r in df.collect()}
    got = count(out.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORDS))).alias("n")))
    assert got == count(shares.where("taken > 0").select("doc_id", F.col("taken").alias("n")))


def test_repeated_rows_are_taken_as_often_as_all_of_them(odd):
    twice = odd.unionByName(odd)
    shares = mixed(twice)
    got = mixing.mixed_documents(twice, shares).agg(F.sum(F.regexp_count("text", F.lit(mixing.WORDS)))).first()[0]
    assert got == shares.agg(F.sum("taken")).first()[0]


def test_empty_table(no_documents):
    shares = mixed(no_documents)
    assert shares.isEmpty() and mixing.mixed_documents(no_documents, shares).isEmpty()
