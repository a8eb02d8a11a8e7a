"""Shadow rules that no live rule beats, from each work's matches alone."""

from screenloom.plans import rules as R


def test_unbeaten_shadows(spark):
    rule = lambda i, p, shadow=False: {"id": i, "pile": "screen_cheap", "precedence": p, "shadow": shadow, "vocabulary": "replication", "match": {"title_regex": "x"}}
    bundle = R.load([rule("b", 50), rule("a", 50, True), rule("c", 50, True), rule("top", 90), rule("low", 10, True)])
    rows = [(1, ["a", "b", "c"]), (2, ["c"]), (3, ["top", "a"]), (4, []), (5, ["low"]), (5, ["top"]), (6, ["low"]), (6, ["low"]), (None, ["top", "low"]), (7, ["top"])]
    df = spark.createDataFrame(rows, "work_id long, matched array<string>")
    found = R.unbeaten_shadows(df, bundle)
    assert sorted(((r.rule_id, r.work_id) for r in found.collect()), key=str) == sorted([("a", 1), ("c", 2), ("low", 6), ("low", 6), ("low", None)], key=str)
    # the matches are read once, and nothing is joined
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
