"""Outcomes, audits, tiers, row assembly, exports and similar titles on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from screenloom.operators import assembly, audit, judging, outcomes, similar
from screenloom.operators.claims import select_verdicts
from screenloom.sources import exports
from tests_data import CONTENTS, SCHEMA, WORKS


def test_outcomes(spark):
    cases = [
        ("The effect did not replicate in Study 1, but was successfully replicated in Study 2.", "successful", "high"), ("It failed to replicate. It was successfully replicated elsewhere.", "failed", "high"),
        ("The finding partially replicated.", "mixed", "medium"), ("We replicated it.", "successful", "high"), ("There was no significant difference.", "failed", "medium"),
        ("Tested in a new culture.", "descriptive only", "medium"), ("Nothing.", None, None), (None, None, None), ("", None, None), ("NOT REPLICATED", "failed", "high"), ("x " * 50_000 + "mixed results", "mixed", "medium"),
    ]
    rows = outcomes.scan(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string"), "t").orderBy("i").collect()
    assert [(r.hit.outcome, r.hit.confidence) if r.hit else (None, None) for r in rows] == [c[1:] for c in cases]
    text = "One. Two. Three. It did not replicate. Five. Six. Seven."
    assert outcomes.scan(spark.createDataFrame([(text,)], "t string"), "t").first().hit.phrase == "Two. Three. It did not replicate. Five. Six."
    routed = spark.createDataFrame([("replication", "Mixed results", "They replicated it."), ("replication", "It was replicated successfully", "Mixed results."), ("Reproduction", "It was replicated", ""), (None, None, None)], "record_type string, title string, abstract string")
    assert [(r.outcome, r.outcome_source) for r in outcomes.predict(routed).collect()] == [("successful", "abstract"), ("successful", "title"), ("cannot_be_determined", ""), ("cannot_be_determined", "")]


CLEAN = {
    "pair_id": "p", "doi_r": "10.1/r", "doi_o": "10.1/o", "oa_work_id_r": "W1", "oa_work_id_o": "W2", "doi_o_verification": "verified", "outcome": "successful", "link_method": "llm_references", "link_evidence": "", "title_r": "R", "title_o": "O",
    "abstract_r": "We found it  again.", "year_r": "2010", "year_o": "2001", "outcome_phrase": "we FOUND it again", "out_quote_source": "abstract", "link_confidence": "high", "outcome_confidence": "high", "original_rank": "1", "n_originals": "1",
}


def extracted(spark, *changes):
    rows = [CLEAN | {"pair_id": f"p{i}", "doi_r": f"10.1/r{i}"} | c for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} string" for k in CLEAN))


def test_audit(spark):
    cases = [
        ({}, []), ({"doi_o": "HTTPS://doi.org/10.1/R1"}, ["self_link"]), ({"oa_work_id_o": "w1"}, ["self_link"]), ({"doi_o_verification": ""}, ["doi_o_unverified"]), ({"doi_o": "", "doi_o_verification": "no_doi"}, []),
        ({"doi_o_verification": "no_doi", "oa_work_id_o": None}, ["doi_o_unverified"]), ({"outcome": "pending"}, ["unresolved_stage"]), ({"link_method": "api_error"}, ["unresolved_stage"]), ({"title_o": " "}, ["missing_display_field"]), ({"year_o": "2012"}, ["original_postdates_replication"]),
        ({"year_o": "2011.0"}, []), ({"year_o": "n.d."}, []), ({"outcome": "success"}, ["outcome_not_canonical"]), ({"outcome_phrase": "something quite different from it"}, ["quote_not_in_abstract"]), ({"outcome_phrase": "we fund it agan"}, []),
        ({"outcome_phrase": "we found | elsewhere", "out_quote_source": "abstract | fulltext"}, []), ({"outcome_phrase": "a | b | c", "out_quote_source": "fulltext"}, ["quote_source_count_mismatch"]), ({"link_confidence": "low", "outcome_confidence": "low"}, ["low_link_confidence", "low_outcome_confidence"]),
        ({"pair_id": "same"}, ["duplicate_pair_id"]), ({"pair_id": " same "}, ["duplicate_pair_id"]), ({"doi_r": "10.1/two", "original_rank": "1", "n_originals": "2"}, []), ({"doi_r": "10.1/TWO", "original_rank": "2.0", "n_originals": "2"}, []),
        ({"n_originals": "x"}, ["multi_original_inconsistent"]), ({"doi_r": "", "n_originals": "7"}, []), ({k: None for k in CLEAN}, ["doi_o_unverified", "missing_display_field"]),
    ]
    rows = extracted(spark, *[c for c, _ in cases]).withColumn("i", F.monotonically_increasing_id())
    found = {}
    for part in (audit.row_findings(rows), audit.group_findings(rows)):
        for r in part.collect():
            found.setdefault(r.i, []).extend(f.check for f in r.findings)
    order = sorted(found)
    assert [sorted(found[i]) for i in order] == [sorted(w) for _, w in cases]
    blocked = {r.pair_id for r in audit.blocked(audit.audit(rows)).collect()}
    assert {"p1", "p2", "p3", "p5", "p6", "p7", "p8", "same", " same "} == blocked
    assert audit.audit(rows.limit(0)).count() == 0 and audit.concerns(rows.limit(0)).count() == 0
    assert {r.concern: r.rows for r in audit.concerns(rows).collect()}["self_link"] == 2


def test_set_aside(spark):
    cases = [
        ({}, None), ({"link_method": "llm_references", "doi_o": ""}, "target_pending"), ({"doi_r": "10.7910/x", "outcome": "not_a_replication"}, "non_article"), ({"link_method": "screen_disagreement", "doi_r": "10.6084/x"}, "screen_disagreement"),
        ({"outcome": "not_a_replication", "link_method": "api_error"}, "not_a_replication"), ({"link_method": "api_error"}, "api_error"), ({"doi_o": "10.1/R6"}, "self_link"), ({"doi_o_verification": "mismatch"}, "doi_mismatch"),
        ({"link_method": "llm_title_search", "link_evidence": "x | search_confirm: clearly_target — y | search_confirm: likely_target — a | b"}, "search_link_unconfirmed"), ({"link_method": "llm_title_search", "link_evidence": "search_confirm: clearly_target — not clearly_not_target"}, None),
        ({"link_evidence": "search_confirm: likely_target"}, None), ({k: None for k in CLEAN}, None),
    ]
    rows = extracted(spark, *[c for c, _ in cases])
    got = audit.partition(rows).collect()
    assert [r.bucket for r in got] == [w for _, w in cases] and got[1].link_evidence.startswith("demoted by sanity_check") and got[2].destination == "not_a_replication.csv"
    assert audit.partition(rows, unconfirmed=True).where("bucket = 'search_link_unconfirmed'").count() == 0
    works = [("10.1037/e5-3", None, None, "psycextra_record"), ("10.1037/t5-3", None, None, ""), ("10.7287/p/Reviews/2", None, None, "peer_review_object"), (None, "Replication data for: X", None, "data_repository_deposit"), (None, "Replication Data Analysis", None, ""), (None, None, "Peer_Review", "peer_review_object"), (None, None, "data-paper", "")]
    frame = spark.createDataFrame(works, "d string, t string, k string, want string")
    assert all(r.got == r.want for r in frame.select("want", audit.non_article(F.col("d"), F.col("t"), F.col("k")).alias("got")).collect())


def test_tiers(spark):
    works = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "short text"), (5, None)], "work_id int, bypass string")
    answers = spark.createDataFrame([(1, 1, "no"), (1, 2, "no"), (2, 1, "yes"), (2, 2, "no"), (3, 1, "no"), (3, 2, " "), (4, 1, "no"), (4, 2, "no")], "work_id int, voter int, verdict string")
    votes = judging.cheap_judge(works, answers)
    assert sorted((r.work_id, r.voter, r.verdict) for r in votes.collect()) == [(1, "1", "no"), (1, "2", "no"), (2, "1", "yes"), (3, "1", "no"), (3, "2", "no_answer"), (4, "prescreen_bypass", "proceed"), (5, "1", "no_answer")]
    decided = judging.cheap_decision(votes)
    assert {r.work_id: r.state for r in judging.progress(works.unionByName(spark.createDataFrame([(9, None)], works.schema)), votes).collect()} == {1: "decided", 2: "decided", 3: "incomplete", 4: "decided", 5: "incomplete", 9: "untouched"}
    assert {r.work_id for r in decided.where("outcome = 'discard'").collect()} == {1}
    routing = spark.createDataFrame([(1, "screen_cheap"), (2, "screen_cheap")], "work_id int, pile string")
    assert [tuple(r) for r in judging.would_discard(decided, routing).collect()] == [("screen_cheap", 1)]
    verdicts = spark.createDataFrame([("a", "screen_expensive", 1, "m", "none"), ("a", "screen_expensive", 1, "n", "none"), ("a", "screen_expensive", 2, "m", "none"), ("b", "screen_cheap", 1, "m", "no"), ("z", "screen_cheap", 3, "m", "no")], "claim string, tier string, work_id int, voter string, verdict string")
    claims = spark.createDataFrame([("a", "screen_expensive", "r"), ("b", "screen_cheap", "r"), ("z", "screen_cheap", "old")], "claim string, tier string, release_id string")
    assert {(r.tier, r.work_id): r.outcome for r in judging.tier_outcomes(verdicts, claims, "r").collect()} == {("screen_expensive", 1): "discard", ("screen_expensive", 2): None, ("screen_cheap", 1): "proceed"}
    marked = verdicts.withColumn("superseded_by", F.when(F.col("work_id") == 2, 9))
    meta = spark.createDataFrame([("a", "live", "g")], "claim string, mode string, generation string")
    assert select_verdicts(marked, meta, mode="live").count() == 2 and select_verdicts(marked, meta).count() == 4 and select_verdicts(marked, meta, superseded=True, kinds=["none"]).count() == 3
    flips = judging.decision_flips(spark.createDataFrame([(1, "base", True), (1, "x", False), (2, "base", False), (2, "x", True), (3, "x", True)], "work_id int, option string, accepted boolean"))
    assert [tuple(r) for r in flips.collect()] == [("x", 2, 1, 1)]
    assert judging.bypass(F.lit("t"), F.lit(None), F.lit("s"), "x") is not None


def test_assembly(spark):
    schema = "work_id int, stage int, position int, key string, doi string, settled boolean, outcome string, note string"
    targets = spark.createDataFrame([(1, 0, 0, "a", "10.1/A", True, "failed", "first"), (1, 1, 0, "z", "10.1/a", False, "none", "second"), (1, 1, 1, "b", None, False, "open", "third"), (1, 2, 0, "b", "10.1/b", True, "mixed", "fourth"), (1, 2, 1, None, None, False, "x", "alone"), (2, 0, 0, "a", "10.1/A", False, "y", "other")], schema)
    got = {(r.work_id, r.note): (r.settled, r.outcome, r.key) for r in assembly.union_targets(targets).collect()}
    assert got == {(1, "second"): (True, "failed", "z"), (1, "fourth"): (True, "mixed", "b"), (1, "alone"): (False, "x", None), (2, "other"): (False, "y", "a")}
    works = spark.createDataFrame([(1, "10.1/r", "W1", "T", "replication", None, None), (2, "", "W2", "T", "", "api_error", "timeout"), (3, None, None, " A  title ", None, "no_original_found", None)], "work_id int, doi_r string, oa_work_id_r string, title_r string, record_type string, ending string, error string")
    found = spark.createDataFrame([(1, 1, "10.2/o", "W9", "O", "1999.0", "llm_references", "medium", "e", "failed"), (1, 2, None, "W8", "P", None, "llm_references", "high", None, None)], "work_id int, rank int, doi string, openalex_id string, title string, year string, method string, confidence string, evidence string, outcome string")
    rows = {(r.work_id, r.original_rank): r for r in assembly.assemble(works, found).collect()}
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert rows[1, 1].pair_id == md5("10.1/r|10.2/o") and rows[1, 2].pair_id == md5("10.1/r|oa:W8") and rows[2, 1].pair_id == md5("oa:W2|") and rows[3, 1].pair_id == md5("t:a title|")
    assert (rows[1, 1].year_o, rows[1, 1].link_confidence, rows[1, 2].link_confidence, rows[1, 2].oa_work_id_o, rows[1, 1].n_originals) == ("1999", "low", "high", "W8", 2)
    assert (rows[2, 1].link_method, rows[2, 1].outcome, rows[2, 1].link_evidence, rows[3, 1].link_method) == ("api_error", "api_error", "timeout", "no_original_found")
    ordered = spark.createDataFrame([(1, "2", 0), (1, "x", 0), (1, "1", 5), (0, None, 3)], "work_id int, original_rank string, position int").orderBy(*assembly.total_order()).collect()
    assert [tuple(r) for r in ordered] == [(0, None, 3), (1, "x", 0), (1, "1", 5), (1, "2", 0)]
    ids = spark.createDataFrame([(i % 50,) for i in range(200)], "k int")
    drawn = assembly.draws(ids, "k", "s", {"dev": 20, "test": 25, "rest": 20}).collect()
    assert len({r.k for r in drawn}) == len(drawn) == 50 and sorted({r.draw for r in drawn}) == ["dev", "rest", "test"] and {(r.draw, r.k) for r in drawn} == {(r.draw, r.k) for r in assembly.draws(ids.repartition(3), "k", "s", {"dev": 20, "test": 25, "rest": 20}).collect()}
    before, after = (spark.createDataFrame(x, "k string, a string, b int") for x in ([("1", "x", 1), ("2", "x", None), ("", "x", 1)], [("1", "y", 1), ("2", "x", 5), ("", "z", 2)]))
    changes = assembly.patches(before, after, "k")
    assert {r.k: r.patch for r in changes.collect()} == {"1": {"a": "y"}, "2": {"b": "5"}}
    assert sorted(map(tuple, assembly.apply_patches(before, changes, "k").collect())) == [("", "x", 1), ("1", "y", 1), ("2", "x", 5)]


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None, "2001"), (1, 'a "q",\nz', "x", "n.d.")], "work_id int, title string, note string, year_r string")
    path = f"{tmp_path}/out"
    manifest = exports.export_csv(rows, path, ["title", "note", "year_r"], [F.col("work_id")], "2024-01-01", {"pile": "p"})
    assert manifest["rows"] == 2 and json.loads((tmp_path / "out.manifest.json").read_text()) == manifest
    assert all(f.read_bytes().startswith(b"\xef\xbb\xbf") for f in (tmp_path / "out").glob("part-*"))
    assert sorted(map(tuple, exports.read_export(spark, path).collect())) == [('a "q",\nz', "x", "n.d."), ("b", "", "2001")]
    with pytest.raises(exports.Refused, match="exists"):
        exports.export_csv(rows, path, ["title"], [F.col("work_id")], "x")
    with pytest.raises(exports.Refused, match="missing columns: z"):
        exports.export_csv(rows, f"{path}2", ["title", "z"], [F.col("work_id")], "x")
    with pytest.raises(exports.Refused, match="year_r in 1 rows"):
        exports.check_years(rows.withColumn("year_r", F.when(F.col("work_id") == 1, "2001.0")))
    for f in (tmp_path / "out").glob("part-*"):
        f.write_text(f.read_text().replace("2001", "2002"))
    for f in (tmp_path / "out").glob(".*crc"):
        f.unlink()
    with pytest.raises(exports.Refused, match="manifest describes"):
        exports.read_export(spark, path)
    assert exports.mirror(spark, path, f"{tmp_path}/copy", ["title", "note", "year_r"]) and not exports.mirror(spark, path, f"{tmp_path}/copy", ["title", "note", "year_r"]) and spark.read.parquet(f"{tmp_path}/copy").count() == 2


def test_overlay_and_store(spark, tmp_path):
    folder = f"{tmp_path}/overlay"
    frame = lambda rows: spark.createDataFrame(rows, exports.OVERLAY)
    assert exports.overlay_errors(spark, folder) and exports.add_chunk(frame([]), folder) is None
    exports.add_chunk(frame([(1, "text", "s", "t"), (2, " ", None, "t")]), folder)
    first = exports.freeze_overlay(spark, folder, "pool", "now")
    assert first["rows"] == 2 and first["sources"] == {"s": 1, "unknown": 1} and exports.freeze_overlay(spark, folder, "pool", "later")["overlay_hash"] == first["overlay_hash"]
    assert [r.work_id for r in exports.overlay_texts(spark, folder).collect()] == [1]
    exports.add_chunk(frame([(1, "again", "s", "t"), (None, "x", "s", "t")]), folder)
    with pytest.raises(exports.Refused, match="1 works in more than one row"):
        exports.freeze_overlay(spark, folder, "pool", "now")
    assert any("without work_id" in e for e in exports.overlay_errors(spark, folder))
    spark.createDataFrame([(1,)], "other int").write.parquet(f"{folder}/chunk-00009")
    assert any("columns" in e for e in exports.overlay_errors(spark, folder))
    store = exports.Store(spark, f"{tmp_path}/kv")
    row = lambda n, k, v, at: spark.createDataFrame([(n, k, v, at)], "namespace string, key string, value string, t string").withColumn("at", F.col("t").cast("timestamp"))
    store.put(row("a", "k", None, "2024-01-01"))
    store.fill(row("a", "k", "late", "2024-01-02"))
    keys = spark.createDataFrame([("a", "k"), ("a", "none")], "namespace string, key string")
    assert {r.key: (r.tried, r.value) for r in store.lookup(keys).collect()} == {"k": (True, None), "none": (False, None)}
    store.put(row("a", "k", "new", "2024-01-03"))
    store.put(row("b", "k", "other", "2024-01-03"))
    assert {r.key: r.value for r in store.lookup(keys).collect()} == {"k": "new", "none": None}
    store.drop("a")
    assert [tuple(r)[:3] for r in store.rows().collect()] == [("b", "k", "other")]


def test_similar_titles(spark):
    import random

    rng = random.Random(3)
    words = ["the", "study", *[f"word{i}" for i in range(30)]]
    titles = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(150)})
    sets = {t: set(t.split()) for t in titles}
    want = {(a, b) for a in titles for b in titles if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    got = {(r.a, r.b): r.jaccard for r in similar.alike(spark.createDataFrame([(t,) for t in [*titles, None, "", *titles[:5]]], "title string")).collect()}
    assert set(got) == want and all(abs(j - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 1e-9 for (a, b), j in got.items())
    items, works = [(i, " ".join(rng.sample(words, 8))) for i in range(10)] + [(99, None)], list(enumerate(titles))
    hits = {(r.item, r.work) for r in similar.covered(spark.createDataFrame(items, "item int, text string"), spark.createDataFrame(works, "work int, title string"), 0.3).collect()}
    assert hits == {(i, w) for i, t in items if t for w, x in works if len(set(t.split()) & sets[x]) >= 0.3 * len(set(t.split()))}


def test_command_line(spark, tmp_path):
    from screenloom.__main__ import run

    spark.createDataFrame(WORKS, SCHEMA).write.parquet(f"{tmp_path}/pool")
    for name, contents in (("rules", CONTENTS), ("other", CONTENTS[1:])):
        (tmp_path / name).mkdir()
        for c in contents:
            (tmp_path / name / f"{c['id']}.json").write_text(json.dumps(c))
    at = lambda *a: run(spark, [x.replace("@", f"{tmp_path}/") for x in a])
    piles = {r.pile: r.works for r in at("route", "--pool", "@pool", "--rules", "@rules", "--store", "@store", "--at", "2024-01-01").collect()}
    assert piles == {"discard": 2, "pending": 2, "screen_cheap": 3, "screen_expensive": 1}
    assert {(r.was, r.becomes) for r in at("diagnose", "--pool", "@pool", "--rules", "@rules", "--other", "@other").where("was <> becomes").collect()} == {("discard", "screen_cheap")}
    release = at("status", "--store", "@store").first()
    assert release.works == 8
    assert {r.work_id for r in at("worklist", "--store", "@store", "--release", release.release_id[:8], "--pile", "screen_cheap").collect()} == {106, 107, 108}
    out = at("export", "--pool", "@pool", "--rules", "@rules", "--store", "@store", "--release", release.release_id[:8], "--pile", "screen_cheap", "--out", "@csv", "--at", "2024-01-02").first()
    assert out.rows == 3 and exports.read_export(spark, f"{tmp_path}/csv").count() == 3
    both = at("export-csv", "--pool", "@pool", "--rules", "@rules", "--store", "@store", "--release", release.release_id[:8], "--out", "@both", "--at", "2024-01-02").first()
    assert both.rows == 4 and {r.paper_type for r in exports.read_export(spark, f"{tmp_path}/both").collect()} >= {"needs_review"}
    specs = at("specs", "--rules", "@rules").collect()
    assert len(specs) == len(CONTENTS) and len({r.bundle for r in specs}) == 1
    screen = ("screen", "--store", "@store", "--release", release.release_id[:8], "--pile", "screen_cheap", "--tier", "cheap", "--at")
    assert {r.work for r in at(*screen, "2024-01-03 00:00:00").collect()} == {106, 107, 108} and at("release-claim", "--store", "@store", "--at", "2024-01-03 00:00:00").count() == 0
    assert at(*screen, "2024-01-03 00:00:00", "--limit", "2", "--claim", "c1", "--run").first().works == [106, 107]
    assert {r.work for r in at(*screen, "2024-01-03 01:00:00").collect()} == {108} and at(*screen, "2024-01-03 09:00:00").count() == 3
    held = at("release-claim", "--store", "@store", "--at", "2024-01-03 09:00:00").first()
    assert (held.claim, held.expired) == ("c1", True)
    assert at("release-claim", "--store", "@store", "--at", "2024-01-03 02:00:00", "--claim", "c1").first().state == "released"
    assert at("release-claim", "--store", "@store", "--at", "2024-01-03 02:00:00").count() == 0 and at(*screen, "2024-01-03 02:30:00").count() == 3
    with pytest.raises(SystemExit):
        at(*screen, "2024-01-03 00:00:00", "--run")
    spark.createDataFrame([(1, "h1", "response_pending_upload"), (2, "h2", "response_pending_upload")], "id int, response_hash string, response_state string").write.parquet(f"{tmp_path}/verdicts")
    spark.createDataFrame([("h1",)], "response_hash string").write.parquet(f"{tmp_path}/stored")
    done = {r.response_state: r.verdicts for r in at("reconcile", "--verdicts", "@verdicts", "--stored", "@stored", "--out", "@marked").collect()}
    assert done == {"uploaded": 1, "response_pending_upload": 1} and spark.read.parquet(f"{tmp_path}/marked").where("response_state = 'uploaded'").first().id == 1
