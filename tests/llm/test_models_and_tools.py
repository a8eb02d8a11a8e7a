"""Classifiers, decontamination, URL filters, tool calls and the pipeline."""

import json
import random

import numpy as np
import pytest

from screenloom.llm import decontam, fm, tools, urls


def test_machine_scores_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    m = fm.Machine(0.3, rng.normal(size=fm.SIZE), rng.normal(size=(fm.SIZE, fm.RANK)))
    row, feature, value = np.array([0, 0, 0, 2, 2]), np.array([3, 50, 900, 3, 7]), np.array([1.0, 0.5, 2.0, 1.0, 1.0])
    z, _ = m.parts(row, feature, value, 4)
    for r in range(4):
        f, v = feature[row == r], value[row == r]
        pairs = sum(m.v[f[i]] @ m.v[f[j]] * v[i] * v[j] for i in range(len(f)) for j in range(i))
        assert np.isclose(z[r], m.w0 + m.w[f] @ v + pairs)


def test_quality_classifier(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(500)]

    def text(good):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        return " ".join(w) if good else rng.choice([" ".join(x.upper() + "!!" for x in w), " ".join([w[0]] * 60), " ".join(x + "$$$" for x in w)])

    rows = [(i, text(i % 4 != 0), len(str(i))) for i in range(600)]
    docs = spark.createDataFrame([*rows, (None, None, None), (900, "", 0), (901, "word1 " * 20000, None)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)] + [(5, None), (None, 1), (6, 7)], "doc_id long, quality int")
    machine = fm.train(docs, labels, sample=150)
    scored = fm.score_quality(docs.withColumn("score", docs["doc_id"]).withColumn("row", docs["doc_id"]), machine).collect()
    assert len(scored) == 603 and all(0 <= r.score <= 1 for r in scored)
    held_out = [r for r in scored if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert sum((r.score >= fm.THRESHOLD) == (r.doc_id % 4 != 0) for r in held_out) >= 0.95 * len(held_out)
    assert fm.score_quality(docs.limit(0), machine).count() == 0
    # repeated rows beside labels don't change what is learnt
    again = fm.train(docs.unionByName(docs.where("doc_id < 30")), labels, sample=150)
    assert np.allclose(again.w, machine.w) and np.allclose(again.v, machine.v)
    nothing = fm.train(docs, labels.limit(0))
    assert {r.score for r in fm.score_quality(docs.limit(3), nothing).collect()} == {0.5}


@pytest.mark.parametrize("pattern,text", [("kitten", "sitting kitchen"), ("abc", ""), ("a", "bbb"), ("benchmark item", "some benchmrk  item here"), ("x" * 90 + "y", "z" + "x" * 89 + "qy")])
def test_edit_distance(pattern, text):
    rows = [0] * (len(text) + 1)  # the pattern may begin anywhere
    for i, p in enumerate(pattern, 1):
        last, rows[0] = rows[0], i
        for j, t in enumerate(text, 1):
            last, rows[j] = rows[j], min(rows[j] + 1, rows[j - 1] + 1, last + (p != t))
    assert decontam.edit_distance(pattern, text, 1000)[0] == min(rows)


def test_decontamination(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(words(rng.randint(15, 60)))) for k in range(40)] + [(100, None), (101, ""), (102, items_short := "tiny item")]
    rows, edited = [], set()
    for i in range(300):
        w = words(rng.randint(50, 300))
        if i < 80:  # as it is, or in capitals
            p, k = rng.randint(0, len(w)), i % 40
            w[p:p] = (items[k][1].upper() if i % 2 else items[k][1]).split(" ")
        elif i < 200:
            k = i % 40
            near = items[k][1].split(" ")
            for _ in range(max(1, len(near) // 12)):
                q = rng.randrange(len(near))
                near[q : q + 1] = rng.choice([[], ["other"], [near[q], "more"]])
            w[10:10] = near
            if decontam.edit_distance(items[k][1], " ".join(near), 10**6)[0] <= decontam.PERCENT * len(items[k][1]) // 100:
                edited.add((i, k))
        rows.append((i, "\n".join(w) if i % 3 == 0 else " ".join(w)))
    docs = spark.createDataFrame([*rows, (None, None), (1000, ""), (1001, items_short), (1002, " ".join(words(40_000)) + " " + items[3][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.find_leaks(docs, bench).collect()}
    assert all(found.get((i, i % 40)) == 0 for i in range(80)) and found[1002, 3] == 0 and found[1001, 102] == 0
    assert len(edited & set(found)) >= 0.95 * len(edited) and len(edited) > 60
    assert all(i < 200 or i > 1000 for i, _ in found)  # nothing in clean documents
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0 and decontam.find_leaks(docs.limit(0), bench).count() == 0


def test_leaks_of_odd_rows(spark):
    """Null and repeated keys, repeated rows, columns with the operator's own names, and more items than one pass compares."""
    rng = random.Random(14)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))
    items = [(None, words(20)), (5, words(20)), (5, words(30))]
    texts = [f"{words(30)} {items[i % 3][1]} {words(30)}" for i in range(3)]
    rows = [(None, texts[0]), (None, texts[0]), (7, texts[1]), (7, texts[1]), (7, words(60)), (8, texts[2]), (None, words(60)), (None, None)]
    docs = spark.createDataFrame([(k, t, "x", "y", 3) for k, t in rows], "doc_id long, text string, key string, item string, distance int")
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, id string")
    want = sorted([(None, None), (None, None), (7, 5), (7, 5), (8, 5)], key=str)
    assert sorted(((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()), key=str) == want
    kept = decontam.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.where("text IS NOT NULL AND doc_id IS NOT NULL").collect()) == [rows[4]] and kept.count() == 3
    was, decontam.ITEM_BYTES = decontam.ITEM_BYTES, 100
    try:
        assert sorted(((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()), key=str) == want and decontam.without_leaks(docs, bench).count() == 3
    finally:
        decontam.ITEM_BYTES = was


def test_regions_that_edits_allow_are_compared():
    """The count of pieces never turns away a region within the allowed edits."""
    rng = random.Random(15)
    for _ in range(300):
        item = "".join(rng.choice("abc dé") for _ in range(rng.randint(5, 60))).strip() or "a"
        near = list(item)
        most = decontam.PERCENT * len(item) // 100
        for _ in range(most):
            q = rng.randrange(len(near) + 1)
            near[q : q + 1] = rng.choice([[], ["z"], ["y", "x"]])
        region = "before " + "".join(near) + " after"
        if decontam.edit_distance(item, region, most)[0] <= most:
            own = decontam.pieces(item)
            assert np.isin(own, decontam.pieces(region)).sum() >= len(own) - decontam.PIECE * most


def test_recall_of_misspelt_passages():
    """Items with 3 of 100 characters edited are nearly all found, with 6 of 100 nine of ten."""
    import pyarrow as pa

    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 10))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(words(rng.randint(16, 60)))) for k in range(100)]
    index = decontam.build(items)
    for percent, least in ((3, 0.97), (6, 0.9)):
        texts, want = [], []
        for i in range(200):
            near = list(items[i % 100][1])
            for _ in range(len(near) * percent // 100):
                q = rng.randrange(len(near))
                near[q : q + 1] = rng.choice([[], ["z"], [near[q], "y"]])
            texts.append(" ".join(words(60) + ["".join(near)] + words(60)))
            want.append((i, i % 100))
        w = decontam.split(pa.array(texts), lower=True)
        found = {(r, i) for r, i, _, _ in decontam.matches(w, decontam.symbols(w), index, decontam.PERCENT)}
        assert sum(x in found for x in want) >= least * len(want)


@pytest.mark.parametrize("percent", [10, 15, 20])
def test_recall_up_to_the_allowed_edits(percent):
    """Items with as many characters edited as the exact test accepts are found."""
    import pyarrow as pa

    rng = random.Random(13)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 10))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(words(rng.randint(16, 60)))) for k in range(100)]
    texts, want = [], []
    for i in range(200):
        near = list(items[i % 100][1])
        for _ in range(len(near) * percent // 100):
            q = rng.randrange(len(near))
            near[q : q + 1] = rng.choice([[], ["z"], [near[q], "y"]])
        texts.append(" ".join(words(60) + ["".join(near)] + words(60)))
        assert decontam.edit_distance(items[i % 100][1], texts[-1], 10**6)[0] <= decontam.PERCENT * len(items[i % 100][1]) // 100
        want.append((i, i % 100))
    w = decontam.split(pa.array(texts), lower=True)
    found = {(r, i) for r, i, _, _ in decontam.matches(w, decontam.symbols(w), decontam.build(items), decontam.PERCENT)}
    assert sum(x in found for x in want) >= decontam.RECALL * len(want)


def test_urls(spark):
    rows = [
        (1, "HTTPS://A.Example.com/en/1?x=1#f", "com/en/", "block"), (2, "http://example.com/en/77", "example.com/en/7", "allow"), (3, "http://www.example.com/en/7", "example.com/en/7", "allow"),
        (4, "http://notexample.com/en/7", "com/en/", "block"), (5, "x://net/de/8", "net/de/", "block"), (6, "x://b.example.net/de/8", "example.net/de/8", "block"), (7, "x://org/es", None, None),
        (8, None, None, None), (9, "no scheme", None, None), (10, "", None, None), (11, "http://COM?/en/", None, None), (12, "http://e.com/en/a://net/de/", "com/en/", "block"), (13, "http://é.org/" + "x" * 100_000, None, None), (None, "http://d.net/fr/", None, None),
    ]
    pages = spark.createDataFrame([(k, u) for k, u, _, _ in rows] + [(12, rows[11][1])], "page_id long, url string").selectExpr("*", "url AS host", "page_id AS key")
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(rows) + 1 and all(r.verdict in ("allow", "block") for r in got)
    by = {r.page_id: r for r in got}
    for k, _, rule, verdict in rows:
        assert by[k].rule == rule and (verdict is None or by[k].verdict == verdict)
    assert (by[1].host, by[1].path, by[9].host, by[11].host, by[11].path, by[12].path) == ("a.example.com", "/en/1", "", "com", "", "/en/a://net/de/")
    assert {r.verdict for r in urls.filter_urls(pages, rules=[]).collect()} == {"allow"}
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_url_trees_learn(spark):
    """Long URLs with many digits under blocked hosts: the trees block their like elsewhere."""
    rng = random.Random(6)
    bad = lambda h: f"http://{h}/" + "".join(rng.choice("0123456789") for _ in range(60))
    good = lambda h: f"http://{h}/" + "".join(rng.choice("abcdef") for _ in range(10))
    rows = [(i, bad("bad.test") if i % 2 else good("fine.test")) for i in range(600)] + [(1000 + i, bad("new.test") if i % 2 else good("new.test")) for i in range(40)]
    rules = [urls.Rule("block", "bad.test", "/"), urls.Rule("allow", "fine.test", "/")]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).where("page_id >= 1000").collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in got) >= 36


def test_suffix_rates_count_all_pages(spark, monkeypatch):
    """With two URLs of each label to fit on, the trees still see each suffix's rate over all rows of the other parts, and weights that add up to them."""
    from pyspark.sql import functions as F

    rows = [(f"http://a{i}.bad/x/" if i % 4 else f"http://a{i}.bad/y/") for i in range(200)] + [f"http://b{i}.odd/y/" for i in range(30)] + ["http://same.fine/y/"] * 170
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")
    seen = []
    fit = urls.GBTClassifier.fit

    def look(self, frame):
        seen.append(({r.label: r.w for r in frame.groupBy("label").agg(F.sum("weight").alias("w")).collect()}, {round(float(r.features[len(urls.NAMES)]), 6) for r in frame.collect()}))
        return fit(self, frame)

    monkeypatch.setattr(urls.GBTClassifier, "fit", look)
    assert urls.filter_urls(pages, [urls.Rule("block", "bad", "/x/")], sample=2).count() == 400
    folds = {r.page_id: r.fold for r in pages.select("page_id", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(urls.FOLDS)).alias("fold")).collect()}
    assert len(seen) == urls.FOLDS
    for fold in range(urls.FOLDS):
        own = [u for i, u in enumerate(rows) if folds[i] != fold]
        bad = sum(u.endswith("/x/") for u in own)
        rate = bad / len(own)
        count = lambda s: (sum(s in u and u.endswith("/x/") for u in own), sum(s in u for u in own))
        rates = {round((b + urls.SMOOTH * rate) / (n + urls.SMOOTH), 6) for b, n in map(count, (".bad/", ".odd/", ".fine/")) if n >= urls.FEWEST} | {round(rate, 6)}
        assert any(w == pytest.approx({1.0: bad, 0.0: len(own) - bad}) and r <= rates for w, r in seen)


def test_url_accuracy(spark):
    """Trees that haven't seen a URL agree with its label; a URL is judged alike however often it occurs."""
    rng = random.Random(16)
    bad = lambda: f"http://w{rng.randint(0, 9)}.bad.test/" + "".join(rng.choice("0123456789") for _ in range(60))
    good = lambda: f"http://w{rng.randint(0, 9)}.fine.test/" + "".join(rng.choice("abcdef") for _ in range(10))
    rows = [(i, bad() if i % 3 == 0 else good()) for i in range(500)]
    pages = spark.createDataFrame([*rows, *[(1000 + i, rows[0][1]) for i in range(50)], (None, None)], "page_id long, url string")
    rules = [urls.Rule("block", "bad.test", "/"), urls.Rule("allow", "fine.test", "/")]
    found = {r.label: (r.rows, r.blocked) for r in urls.accuracy(pages, rules).collect()}
    assert found["block"][0] == 217 and found["allow"][0] == 333 and found["block"][1] >= 0.95 * 217 and found["allow"][1] <= 0.05 * 333


def test_tool_calls(spark):
    schema = [tools.Argument("f", "n", "integer", True, 0, 9), tools.Argument("f", "s", "string", False, None, 3), tools.Argument("g", "x", "number"), tools.Argument("g", "ok", "boolean", False)]
    calls = [
        ("t", "a", "f", '{"s": "é\\"", "n": 3}', None), ("t", "b", "g", '{"x": 1.5, "ok": true, "z": {"q": 1, "b": [2, {"d": null, "c": 1}]}}', "a"), ("t", "c", "f", '{"n": 10}', "b"), ("t", "d", "f", '{"n": "3", "s": "long"}', "c"),
        ("t", "e", "h", "{}", "d"), ("t", "f", "f", "{bad", "e"), ("t", "g", "f", None, None), ("t", "h", "f", '{"n":1}', "i"), ("t", "i", "f", '{"n":1}', "h"), ("t", "j", "f", '{"n":1}', "gone"),
        ("t", "k", "f", '{"n":1}', None), ("t", "k", "f", '{"n":2}', None), ("u", "a", "f", '{"n":1}', None), ("u", "a", "f", '{"n":1}', None), (None, "a", "f", "{}", None), ("t", None, "f", "{}", None), ("v", "only", "f", '{"n":1}', None),
    ]
    results = [("t", x, f"r{x}") for x in "abcdefghijk"] + [("t", "b", "rb"), ("u", "a", "1"), ("u", "a", "2"), ("t", "nobody", "x"), (None, None, None)]
    got = {(r.thread, r.id): r for r in tools.link_calls(spark.createDataFrame(calls, "thread string, id string, name string, arguments string, after string"), spark.createDataFrame(results, "thread string, id string, content string"), schema).collect()}
    assert len(got) == 13
    assert got["t", "a"].json == '{"arguments":{"n":3,"s":"é\\""},"id":"a","name":"f","result":"ra"}'
    assert got["t", "b"].json == '{"arguments":{"ok":true,"x":1.5,"z":{"b":[2,{"c":1,"d":null}],"q":1}},"id":"b","name":"g","result":"rb"}' and got["t", "b"].n_results == 2
    errors = {k: v.errors for k, v in got.items()}
    assert errors["t", "c"] == ["n: too large"] and errors["t", "d"] == ["n: not integer", "s: too large"] and errors["t", "e"] == ["unknown tool"] and errors["t", "f"] == errors["t", "g"] == ["malformed arguments"]
    assert errors["t", "h"] == errors["t", "i"] == errors["t", "j"] == ["unordered"] and errors["t", "k"] == ["duplicate id"] and errors["u", "a"] == ["unequal results"] and errors["v", "only"] == ["no result"]
    assert [got["t", x].depth for x in "abcdef"] == [0, 1, 2, 3, 4, 5] and got["t", "h"].depth is None
    assert tools.link_calls(spark.createDataFrame([], "thread string, id string, name string, arguments string, after string"), spark.createDataFrame([], "thread string, id string, content string"), schema).count() == 0


def test_calls_that_wait_for_several(spark):
    """The longest path of dependencies counts; cycles and missing calls leave what waits for them unordered."""
    graph = {"a": [], "b": ["a"], "c": ["a", "b"], "d": ["a", "c", "b"], "e": ["f"], "f": ["e"], "g": ["a", "f"], "h": ["gone"], "i": []}
    calls = spark.createDataFrame([("t", k, "f", "{}", None, "x", 1) for k in graph] + [("u", "a", "f", "{}", None, "x", 1)], "thread string, id string, name string, arguments string, after string, depth string, errors int")
    needs = spark.createDataFrame([("t", k, a) for k, v in graph.items() for a in v] + [("t", "b", "a"), ("t", "b", None), ("t", "other", "a")], "thread string, id string, after string")
    results = spark.createDataFrame([("t", k, None if k == "i" else "long " * 20_000 if k == "a" else "r") for k in graph] + [("u", "a", "r")], "thread string, id string, content string")
    got = {(r.thread, r.id): r for r in tools.link_calls(calls, results, [], needs).collect()}
    assert {k: r.depth for (t, k), r in got.items() if t == "t"} == {"a": 0, "b": 1, "c": 2, "d": 3, "e": None, "f": None, "g": None, "h": None, "i": 0}
    assert got["u", "a"].depth == 0 and "unordered" in got["t", "g"].errors and "unknown tool" in got["t", "a"].errors
    schema = [tools.Argument("f", "n", "number")]
    plain = tools.link_calls(calls.where("id = 'i'").selectExpr("thread", "id", "name", "'{\"n\":1.50, \"a\":1e2}' AS arguments", "after", "1 AS content", "2 AS json"), results, schema).first()
    assert plain.errors == [] and json.loads(plain.json) == {"arguments": {"a": 100, "n": 1.5}, "id": "i", "name": "f", "result": None} and plain.json.index('"a"') < plain.json.index('"n"')
    assert tools.link_calls(calls.limit(0), results, schema, needs).count() == 0


def test_long_chain(spark):
    calls = spark.createDataFrame([("t", f"c{i}", "f", "{}", f"c{i - 1}" if i else None) for i in range(70)], "thread string, id string, name string, arguments string, after string")
    assert {r.id: r.depth for r in tools.depths(calls).collect()} == {f"c{i}": i for i in range(70)}


def test_native(spark):
    """Tool-call linking runs no Python on the executors."""
    calls, results = tools.conversation_calls(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string"))
    out = tools.link_calls(calls, results, tools.CONVERSATION_TOOLS)
    assert json.loads(out.first().json) == {"arguments": {"text": "hi", "turn": 0}, "id": "call-0", "name": "reply", "result": "yes"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, tmp_path):
    """Junk, copies, repeated passages and leaks go; clean documents stay and decode to their texts."""
    import corpus_pipeline

    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    text = lambda n=80: " ".join(rng.choice(vocabulary) for _ in range(n))
    item, passage = text(25), text(60)
    rows = [(i, text()) for i in range(200)] + [(i, " ".join(w.upper() + "!!" for w in text().split())) for i in range(200, 260)]
    rows += [(300, rows[0][1]), (301, rows[1][1].replace(rows[1][1].split(" ")[40], "x", 1)), (302, text() + " " + item + " " + text()), (303, text() + "\n" + passage), (304, passage + "\n" + text()), (305, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in range(260)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "byte-level BPE encoding and decoding"]
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) - {305} == {*range(200), 303, 304}
    left = {r.doc_id: r.text for r in step.collect()}
    assert left[303] == dict(rows)[303] and passage[:40] not in left[304] and left[5] == dict(rows)[5]


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, kind in (("documents", schema), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    some = spark.createDataFrame([(1, "a few words here", "en", "s", 4), (2, None, None, None, None)], schema)
    for _, stage in corpus_pipeline.STAGES:
        some = stage(spark, some, str(tmp_path))
    assert some.count() == 2


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    """What each stage keeps, against loops over all rows."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers

    from screenloom.llm import bpe

    rng = random.Random(23)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, items, rows = words(35), [(i, " ".join(words(22))) for i in range(4)], []
    for i in range(120):
        w = words(rng.randint(3, 120))
        if i % 5 == 0:
            w[3:3] = passage
        if i % 11 == 0:
            w[1:1] = items[i % 4][1].split(" ")
        if i % 7 == 0 and rows:
            w = rng.choice(rows)[1].split(" ")
            if len(w) > 60:
                w[len(w) // 2] = "changed"
        rows.append((i, " ".join(w)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    sets = {i: {tuple(t.split(" ")[p : p + 5]) for p in range(len(t.split(" ")) - 4)} or {tuple(t.split(" "))} for i, t in rows}
    group = {i: i for i in sets}
    for _ in range(6):
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    one = stages["n-gram Jaccard join"](spark, docs, str(tmp_path))
    texts = {r.doc_id: r.text for r in one.collect()}
    assert set(texts) == set(group.values()) and len(texts) < 120
    first = {}
    for i in sorted(texts):
        w = texts[i].split(" ")
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    left = {}
    for i, t in texts.items():
        w = t.split(" ")
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < i for q in range(p, p + 13)}
        if len(gone) < len(w):
            left[i] = [x for q, x in enumerate(w) if q not in gone]
    two = stages["substring dedup"](spark, one, str(tmp_path))
    assert {r.doc_id: r.text.split() for r in two.collect()} == left and all(r.n_chars == len(r.text) for r in two.collect())
    three = stages["benchmark decontamination"](spark, two, str(tmp_path))
    plain = {r.doc_id: " ".join(r.text.split()) for r in two.collect()}
    leaks = {i for i, t in plain.items() for _, x in items if decontam.edit_distance(x, t, decontam.PERCENT * len(x) // 100)[0] <= decontam.PERCENT * len(x) // 100}
    assert {r.doc_id for r in three.collect()} == set(left) - leaks and leaks
    encode = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    kept = {r.doc_id: r.text for r in three.collect()}
    for r in stages["byte-level BPE encoding and decoding"](spark, three, str(tmp_path)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == encode.encode_ordinary(kept[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].encode()).hexdigest()


def test_pipeline_rows_without_an_identifier_of_their_own(spark, tmp_path):
    """Null and repeated identifiers: leaks and copies go, one of each group stays, passages are cut, and clean rows are kept."""
    import corpus_pipeline

    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    text = lambda n=80: " ".join(rng.choice(vocabulary) for _ in range(n))
    item, passage, twice, nulls, alone, clean = text(25), text(40), text(), text(), text(), text()
    rows = [(1, alone), (None, alone), (2, twice), (2, twice), (None, nulls), (None, nulls), (None, nulls)]
    rows += [(3, clean), (3, text() + " " + item), (None, text() + " " + item), (4, text() + " " + passage), (4, passage + " " + text()), (None, passage + " " + text()), (None, passage + " " + text())]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = frame
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == frame.columns
    left = [(r.doc_id, r.text) for r in step.collect()]
    assert [k for k, t in left if t == alone] == [1] and [k for k, t in left if t == twice] == [2] and [k for k, t in left if t == nulls] == [None] and [k for k, t in left if t == clean] == [3]
    assert not any(item in t for _, t in left) and sum(passage in t for _, t in left) == 1 and len(left) == 9  # the second leak has lost its item as a repeated passage
