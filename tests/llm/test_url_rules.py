"""op5_url_filter judges by the rules of its contract."""

from screenloom.llm import queries

CONTRACT = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}


def test_query_follows_the_contract(spark, tmp_path):
    given = ["http://a.com/en/1", "http://example.com/en/7", "http://www.example.net/de/1", "http://example.net/de/8", "http://b.net/de/x", "http://c.org/es/2", "http://c.org/fr/2"]
    want = ["com/en/", "example.com/en/7", "net/de/", "example.net/de/8", "net/de/", "org/es/", None]
    spark.createDataFrame([(i, u, "") for i, u in enumerate(given)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op5_url_filter(spark, str(tmp_path)).collect()}
    assert [got[i].rule for i in range(len(given))] == want
    assert all(got[i].verdict == CONTRACT[w] for i, w in enumerate(want) if w)
    assert {r.name: r.verdict for r in queries.URL_RULES} == CONTRACT
