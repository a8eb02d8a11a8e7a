"""Titles go through an inverted index and back, each row by itself."""

import hashlib

import __spark_entry__
import duckdb
from screenloom.functions import text as T

TEXTS = [(1, "a b a\nrest"), (1, "c  d"), (None, "no id"), (2, ""), (3, "\nno title"), (4, None), (5, " "), (6, "x" * 60_000 + ' "q" \\ x\u0001 [1] {"a":[0]}\nz'), (7, "a b a\nother"), (8, "é ß 東 \t:[0],")]


def test_round_trip_of_odd_rows_agrees_with_sql(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, __spark_entry__.queries()["inverted_index_roundtrip"](spark, str(tmp_path)).collect()), key=str)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert got == sorted(con.execute(__spark_entry__.oracle_sql()["inverted_index_roundtrip"]).fetchall(), key=str)
    assert (1, hashlib.md5(b"a b a").hexdigest(), True) in got and len(got) == 7


def test_index_of_long_words_and_their_places(spark):
    long = "w" * 60_000
    made = {r["k"]: r["index"] for r in T.inverted_index(spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "k int, t string"), "k", "t").collect()}
    assert made == {1: '{"b":[0,2],"a":[1]}', 2: '{"":[0]}'}
    indexes = [(1, f'{{"{long}": [1, 3],"\\"b\\\\":[0],"a":[2,0]}}'), (2, f'{{"{long}":[0],"b":[0]'), (3, f'{{"{long}":[0]}} x'), (4, '{"a":null,"b":[null,1]}'), (5, '{"' + '\\"\\\\' * 40_000 + '":[0]}')]
    back = {r.k: r.text for r in T.from_inverted_index(spark.createDataFrame(indexes, "k int, i string"), "k", "i").collect()}
    assert back == {1: f"a {long} a {long}", 2: None, 3: None, 4: "b", 5: '"\\' * 40_000}
