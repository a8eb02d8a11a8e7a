"""Scalar functions, folds, sources, citations and streaming on small frames with nulls."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from screenloom.functions import text as T
from screenloom.operators import citations, folds
from screenloom.sources import tables
from screenloom.streaming import log


def values(spark, expression, rows, schema="x string"):
    return [r.y for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(expression.alias("y")).collect()]


def test_identifiers(spark):
    x = F.col("x")
    assert values(spark, T.clean_doi(x), [" https://doi.org/10.1/AB/ ", "doi: 10.1/x", "http://dx.doi.org/10.2//y", "", None]) == ["10.1/ab", "10.1/x", "10.2//y", None, None]
    assert values(spark, T.group_doi(x), ["10.1//a///b"]) == ["10.1/a/b"]
    assert values(spark, T.work_id(x), ["https://openalex.org/W12", "w7", "8", "W1x", None, ""]) == [12, 7, 8, None, None, None]
    assert values(spark, T.year_text(x), ["2018.0", " 2019 ", "n.d.", None, "2018.5"]) == ["2018", "2019", "n.d.", "", "2018.5"]
    assert values(spark, T.surname(x), ["Smith, Jo", "Jo de Smith", " Žižek "]) == ["smith", "smith", "žižek"]
    assert values(spark, T.title_fingerprint(x), ["A &amp;amp;lt; B—c! &eacute;t&#233; &rarr; x", "  ", None]) == ["a b c t x", "", None]
    texts = spark.createDataFrame([("e\u0301  x\n\ty",), ("plain  text",), (None,), ("caf\u00e9\u2003z",), ("\u212b",), ("\u1112\u1161",)], "x string")
    assert [r.y for r in T.fold_text(texts, "x", "y").collect()] == ["\u00e9 x y", "plain text", None, "caf\u00e9 z", "\u00c5", "\ud558"]
    assert values(spark, T.whole(x), ["12", " -3 ", "1.0", "x", None, "99999999999"]) == [12, -3, None, None, None, None]
    assert values(spark, T.model_family(x), ["GPT-4.1", "o3-mini", "acme/qwen", "", None, "chatgpt"]) == ["gpt", "gpt", "qwen", "none", "none", "other"]
    assert values(spark, T.value_bytes(x), ["a" * 126, "a" * 127, None]) == [127, 131, 1]
    assert values(spark, F.date_format(T.utc(x), "yyyy-MM-dd HH:mm"), ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05", "2024-01-02", "soon", None]) == ["2024-01-02 03:04", "2024-01-02 01:04", "2024-01-02 03:04", "2024-01-02 00:00", None, None]
    assert values(spark, T.duration_text(x.cast("long")), ["5", "65", "7260"]) == ["5s", "1m 5s", "2h 1m"]
    assert values(spark, T.is_blank(x), [" 　\t\x0b", "a", None]) == [True, False, True]


def test_titles_and_keys(spark):
    pair = "a string, b string"
    match = T.titles_match(F.col("a"), F.col("b"))
    assert values(spark, match, [("The Big Effect of Sleep", "the big effect of sleep!"), ("effect of sleep on memory", "A study: effect of sleep on memory, revisited in many ways and places"), ("one two", "one two three four five six"), ("", "")], pair) == [True, True, False, False]
    assert values(spark, T.authors_match(F.col("a"), F.col("b")), [("smith", "smiths"), ("li", "lin"), ("lin", "line"), ("smith", "smithson"), ("smyth", "smith"), ("smita", "smith"), ("", "x")], pair) == [True, False, True, True, False, True, False]
    keys = T.identity_keys(F.col("a"), F.lit(None).cast("long"), F.col("b"), F.lit("A Title"))
    assert values(spark, keys, [("doi:10.1/X", " HTTP://U "), (None, ""), (None, None)], pair) == [["doi:10.1/x", "url:http://u"], ["title:a title"], ["title:a title"]]
    long = " ".join(f"w{i % 9000}" for i in range(20_000))
    indexes = spark.createDataFrame([(1, '{"b":[1],"a":[0,2]}'), (2, '{"z":[0],"a":[0]}'), (3, None), (4, "{bad"), (5, "{}")], "k int, i string").unionByName(T.inverted_index(spark.createDataFrame([(6, long), (7, "a  b")], "k int, t string"), "k", "t").withColumnRenamed("index", "i"))
    assert {r.k: r.text for r in T.from_inverted_index(indexes, "k", "i").collect()} == {1: "a b a", 2: "a", 3: None, 4: None, 5: None, 6: long, 7: "a  b"}
    assert values(spark, T.sentences(F.col("x")), ["Smith et al. found it. Was it? Yes!", "", "J. Doe, e.g. here, cf. No. 3. Then."]) == [["Smith et al. found it.", "Was it?", "Yes!"], [], ["J. Doe, e.g. here, cf. No. 3.", "Then."]]
    assert values(spark, T.sentence_context(F.array(*[F.lit(str(i)) for i in range(9)]), F.col("x").cast("int")), ["1", "5", "9"]) == ["0 1 2", "2 3 4 5 6", "6 7 8"]
    assert values(spark, T.published_after(F.col("a"), F.col("b")), [("2011", "2010.0"), ("2010", "2010"), ("n.d.", "2010"), (None, "2010"), ("in 2012", "2010")], pair) == [True, False, False, False, True]
    assert values(spark, T.years_agree(F.col("a"), F.col("b")), [("2011", "2010.0"), ("2012", "2010"), (None, "2010")], pair) == [True, False, True]
    low, high = T.wilson(F.col("x").cast("long"), F.lit(10))
    assert values(spark, F.round(low, 3), ["5"]) == [0.237] and values(spark, F.round(high, 3), ["5"]) == [0.763]
    assert values(spark, T.wilson(F.lit(0), F.lit(0))[0], ["1"]) == [None]


def test_folds(spark):
    rows = spark.createDataFrame([(1, 2, "b", "x"), (1, 1, "a", None), (2, 5, None, "y"), (2, 5, "c", "y")], "k int, t int, v string, voter string")
    assert {r.k: r.v for r in folds.first_by(rows, ["k"], ["t", F.col("v").isNull()]).collect()} == {1: "a", 2: "c"}
    assert {r.k: r.t for r in folds.latest_by(rows, ["k"], ["t"]).collect()} == {1: 2, 2: 5}
    gate = folds.vote_gate(F.col("v"))
    got = spark.createDataFrame([(["none", "none"],), (["none"],), (["none", "yes"],), ([],)], "v array<string>").select(gate.alias("g")).collect()
    assert [r.g for r in got] == ["discard", None, "proceed", None]
    votes = spark.createDataFrame([(1, "a", 1, 1, "no"), (1, "a", 2, 2, "yes"), (1, None, 1, 3, "p"), (1, None, 2, 4, "q"), (1, None, 2, 5, "r")], "work int, voter string, claim int, id int, v string")
    assert sorted(r.v for r in folds.one_vote_each(votes, "work", "voter", ["id"], "claim").collect()) == ["q", "r", "yes"]
    base, extra = spark.createDataFrame([(1, "old"), (2, "old"), (3, None)], "k int, v string"), spark.createDataFrame([(1, "new"), (2, "")], "k int, v string")
    assert {r.k: r.v for r in folds.overlay(base, extra, "k", "v").collect()} == {1: "new", 2: "old", 3: None}
    aliases = spark.createDataFrame([(1, 3)], "old int, canonical int")
    assert sorted(r.k for r in folds.resolve_alias(base, aliases, "k").collect()) == [2, 3, 3]
    assert [r.k for r in folds.without(base, [(extra.where("k = 1"), "k"), (aliases.selectExpr("canonical AS k"), "k")]).collect()] == [2]
    keyed = folds.suffixed(spark.createDataFrame([("s", i) for i in range(28)], "b string, i int"), "b", ["i"]).orderBy("i").collect()
    assert [keyed[i].key for i in (0, 1, 25, 26)] == ["s", "sb", "sz", "s27"]
    given = spark.createDataFrame([("s2009",), ("s2009b",), ("t2009",)], "key string")
    assert [r.key for r in folds.suffixed(spark.createDataFrame([("s2009", 1), ("u2009", 2)], "b string, i int"), "b", ["i"], given=given).orderBy("i").collect()] == ["s2009c", "u2009"]
    scores = spark.createDataFrame([("k", "a", 9.0), ("k", "b", 5.0), ("l", "a", 9.0), ("l", "b", 8.0), ("m", "z", 3.0), ("n", "b", 7.0), ("n", "a", 7.0), ("o", "a", 6.0)], "k string, item string, score double")
    assert {(r.k, r.item, r.second) for r in folds.dominant(scores, ["k"], "score", "item", 4, 1.5).collect()} == {("k", "a", 5.0), ("o", "a", 0.0)}
    shards = lambda rows: folds.shard_digests(spark.createDataFrame(rows, "k int, v string"), "k", F.col("v"), 1)
    one, two = shards([(i, str(i)) for i in range(60)]), shards([(i, str(i) if i else "x") for i in reversed(range(60))])
    assert folds.changed_shards(one, one).count() == 0 and [r.why for r in folds.changed_shards(one, two).collect()] == ["changed"]
    a, b = (spark.createDataFrame(x, "x string") for x in ([("a",), ("b",)], [("b",), ("a",)]))
    assert folds.content_digest(a, F.col("x")).first() == folds.content_digest(b, F.col("x")).first() != folds.content_digest(a.limit(1), F.col("x")).first()


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"entries": [{"url": "s3://bucket/a b.parquet", "meta": {"content_length": 5, "record_count": 2}}, {"url": "https://x/c", "meta": {"content_length": 6}}]}')
    manifest = tables.read_manifest(spark, f"{tmp_path}/m.json")
    assert [r.url for r in manifest.collect()] == ["https://bucket.s3.amazonaws.com/a b.parquet", "https://x/c"]
    (tmp_path / "bad.json").write_text('{"files": []}')
    with pytest.raises(ValueError):
        tables.read_manifest(spark, f"{tmp_path}/bad.json")
    ledger = spark.createDataFrame([("https://x/c", "done", 6), ("https://bucket.s3.amazonaws.com/a b.parquet", "done", 4)], "url string, status string, content_length long")
    assert [r.url for r in tables.to_scan(manifest, ledger).collect()] == ["https://bucket.s3.amazonaws.com/a b.parquet"]
    spark.createDataFrame([("W1", "t", 2020)], "id string, title string, publication_year int").write.parquet(f"{tmp_path}/pool")
    row = tables.read_pool(spark, f"{tmp_path}/pool").first()
    assert row.id == "W1" and row.doi is None and row.row_index == 0 and row.file_name.endswith(".parquet")
    rows = spark.createDataFrame([("a", 'say "hi",\nthere', None), ("b", "", "x" * 60)], "k string, t string, u string")
    tables.write_stage_csv(rows, f"{tmp_path}/csv", ["k", "t", "u"])
    assert {r.k: (r.t, r.u) for r in tables.read_stage_csv(spark, f"{tmp_path}/csv", ["k", "t", "u"], 50).fillna("").collect()} == {"a": ('say "hi",\nthere', ""), "b": ("", "x" * 50)}
    tables.replace_partition(rows.selectExpr("k", "t", "'r1' AS release"), f"{tmp_path}/store", ["release"])
    tables.replace_partition(rows.selectExpr("k", "t", "'r2' AS release"), f"{tmp_path}/store", ["release"])
    tables.replace_partition(rows.selectExpr("k", "t", "'r1' AS release").limit(1), f"{tmp_path}/store", ["release"])
    assert {r.release: r["count"] for r in spark.read.parquet(f"{tmp_path}/store").groupBy("release").count().collect()} == {"r1": 1, "r2": 2}
    for _ in range(2):
        tables.append_new(rows.select("k"), f"{tmp_path}/log", ["k"])
    assert spark.read.parquet(f"{tmp_path}/log").count() == 2
    assert tables.parse_years("2019, 2021-2023") == [2019, 2021, 2022, 2023]
    with pytest.raises(ValueError):
        tables.parse_years("2020-2019")


def test_citations(spark):
    text = "As Smith, Jones, and Brown (1999) and Miller et al. (2004) say; Fox's (2010) work, unlike Lee & Park, 2011, is old. Ng 2012."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, text string")
    got = citations.find_citations(docs, "id", "text").orderBy("start").collect()
    assert [(r.pattern, r.surname, r.year) for r in got] == [("list_bracketed", "smith,jones,andbrown", 1999), ("others_bracketed", "miller", 2004), ("one_bracketed", "fox", 2010), ("pair_plain", "lee", 2011)]
    assert [text[r.start : r.start + len(r.raw)] for r in got] == [r.raw for r in got]
    cases = {
        "Vess (2012, PS, Study 1)": [("one_bracketed", "vess", 2012)], "Adams, Baker & Clark, 1987 and": [("list_plain", "adams,baker&clark", 1987)], "de la Cruz et al., 1950": [("others_plain", "delacruz", 1950)],
        "Foxe & Hall (1999; a)": [("pair_bracketed", "foxe", 1999)], "Lees & Park, 2011": [("pair_plain", "lees", 2011)], "Foxe's (2010)": [("one_bracketed", "foxe", 2010)], "In May and June 2018": [], "Monday 2018": [], "Study 2019": [("one_plain", "study", 2019)], "Miller 20041": [],
        "Miller, 2051 by": [("one_plain", "miller", 2051)], "": [], "Çelik (2001) and \U0001f600 Ōta 2003": [("one_bracketed", "çelik", 2001), ("one_plain", "ōta", 2003)], "see \u00a0Vess\u00a0(2012)": [("one_bracketed", "vess", 2012)],
    }
    rows = spark.createDataFrame([(t, None if "2051" in t else 2100) for t in cases], "id string, most int").withColumn("text", F.col("id"))
    got = {}
    for r in citations.find_citations(rows, "id", "text", "most").orderBy("n").collect():
        assert r.id[r.start : r.start + len(r.raw)] == r.raw
        got.setdefault(r.id, []).append((r.pattern, r.surname, r.year))
    assert got == {t: want for t, want in cases.items() if want}
    one = lambda t, **k: citations.find_citations(spark.createDataFrame([(1, t, 2020)], "id int, text string, most int"), "id", "text", **k).count()
    assert one("Study 2019", strict=True) == 0 == one("Miller, 2051", max_year="most") and one("Miller 2019", strict=True) == 1
    cited = spark.createDataFrame([(1, 0, "Foxe (2010)", "foxe", 2010, "10.1/self"), (1, 1, "Lees 2011", "lees", 2011, "10.1/self")], "work_id int, n int, raw string, surname string, year int, doi_self string")
    refs = spark.createDataFrame([(1, "a", "10.1/a", "A", 2011, ["Foxe", "Lees"]), (1, "b", None, "B", 2010, ["Foxen"]), (1, "c", "10.1/SELF", "C", 2010, ["Foxe"]), (1, "d", None, "D", 2013, ["Lees"]), (2, "e", None, "E", 2010, ["Foxe"])], "work_id int, ref_id string, doi string, title string, year int, surnames array<string>")
    assert {(r.ref_id, r.match_year_exact, r.cited) for r in citations.find_candidates(cited, refs).collect()} == {("a", False, "Foxe (2010)"), ("b", True, "Foxe (2010)")}


def test_streaming(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    schema = "event_id long, ts timestamp, event_type string"
    for i, rows in enumerate(([(1, at(1), "a"), (2, at(2), "b"), (1, at(1), "a")], [(2, at(2), "b"), (3, at(3), "a")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assert i < 2
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for name, frame in (("events_once", log.distinct_events(stream)), ("counts", log.counts_by_window(stream, "event_type", width="1 day"))):
        q = frame.writeStream.format("memory").queryName(name).outputMode("append" if name == "events_once" else "complete").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted(r.event_id for r in spark.table("events_once").collect()) == [1, 2, 3]
    assert {r.event_type: r.events for r in spark.table("counts").collect()} == {"a": 3, "b": 2}
