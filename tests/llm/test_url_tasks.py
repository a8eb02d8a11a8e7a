"""The trees of the URL filter are fitted in few tasks."""

from screenloom.llm import urls


def test_trees_are_fitted_in_few_tasks(spark, monkeypatch):
    """However many parts a shuffle has, and whether or not it merges small ones."""
    fit, parts = urls.GBTClassifier.fit, []
    monkeypatch.setattr(urls.GBTClassifier, "fit", lambda self, frame: (parts.append(frame.rdd.getNumPartitions()), fit(self, frame))[1])
    pages = spark.createDataFrame([(i, f"http://h{i}.{'bad' if i % 2 else 'fine'}/{i % 7}/") for i in range(80)], "page_id long, url string")
    settings = {"spark.sql.shuffle.partitions": "11", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert urls.filter_urls(pages, [urls.Rule("block", "bad", "/")]).count() == 80
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(parts) == urls.FOLDS and max(parts) <= urls.PARTS
