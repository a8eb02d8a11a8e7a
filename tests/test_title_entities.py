"""title_fingerprint undoes what its SQL undoes: references with a semicolon, of those that pages write."""


def test_fingerprints_equal_sql(spark, tmp_path):
    import duckdb

    from screenloom.plans import catalogue

    texts = ["a &amp; b", "cut &amp", "cut &am", "x&copy=1 &copy; y", "&amp;amp;lt; z", "&eacute; &nbsp; &#39;s &#x27;s", "&quot;Q&quot; &middot; &lt", "", None]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = dict(con.execute(catalogue.ORACLE_SQL["title_fingerprint"]).fetchall())
    assert {r.page_id: r.fingerprint_md5 for r in catalogue.QUERIES["title_fingerprint"](spark, str(tmp_path)).collect()} == want
