"""Verification, guards, types, votes, outcomes, hand-over, supersession and payloads on small frames."""

import hashlib
import json

from pyspark.sql import functions as F

from screenloom.operators import linking as L


def test_verify(spark):
    rows = [  # key, doi, title, year -> status, doi
        ("same", "10.1/a", "Sleep and memory in mice", "2001"), ("near", "10.1/b", "Sleep and memory in mice", "2003"), ("wrong", "https://doi.org/10.1/C", "Sleep and memory in mice", "2001"), ("none", "10.1/d", "Sleep and memory in mice", ""),
        ("gone", "10.1/e", "Another title of a work", "1999"), ("silent", "10.1/c", "Unfound title of a work", "2001"), ("unasked", "10.1/x", "T", "2001"), ("untitled", "10.1/a", "", "2001"), ("again", "10.1/b", "Sleep and memory in mice", "1990"),
        ("fill", "", "A title to look for", None), ("id", None, "A chapter in a book", "1950"), ("lost", "", "A title of nothing", ""), ("mute", "", "A title nobody answered", ""), ("blank", None, " ", None), ("late", "10.1/c", "Found by a later tier only", "2001"),
    ]
    registry = [("10.1/a", True, "Sleep and Memory in Mice", 2001, "bem"), ("10.1/B", True, "Sleep and memory in mice", 2004, "bem"), ("10.1/c", True, "Something else altogether", 2001, "lee"), ("10.1/d", False, None, None, None), ("10.1/e", False, None, None, None)]
    searches = [
        ("wrong", 0, True, "10.9/new", "", "Sleep and memory in mice"), ("wrong", 1, True, "10.9/later", "", "x"), ("none", 0, True, None, "W7", "Sleep"), ("gone", 0, True, "", "", ""), ("silent", 0, False, None, None, None), ("silent", 1, True, None, None, None),
        ("again", 2, True, "https://doi.org/10.1/B", None, "Sleep"), ("fill", 0, True, "10.9/f", None, "A title"), ("id", 0, True, None, "W8", "A chapter"), ("lost", 0, True, None, None, None), ("mute", 0, False, None, None, None), ("late", 0, False, None, None, None), ("late", 2, True, "10.9/late", None, "Found"),
    ]
    out = L.verify(
        spark.createDataFrame(rows, "row_key string, doi_o string, title_o string, year_o string"), spark.createDataFrame(registry, "doi string, registered boolean, title string, year int, surname string"),
        spark.createDataFrame(searches, "row_key string, tier int, answered boolean, doi string, ident string, title string"),
    )
    got = {r.row_key: (r.doi_o_verification, r.doi_o) for r in out.collect()}
    assert got == {
        "same": ("verified", "10.1/a"), "near": ("verified", "10.1/b"), "wrong": ("corrected", "10.9/new"), "none": ("no_doi", ""), "gone": ("no_metadata", "10.1/e"), "silent": ("api_error", "10.1/c"), "unasked": ("api_error", "10.1/x"),
        "untitled": ("mismatch", "10.1/a"), "again": ("verified", "10.1/b"), "fill": ("corrected", "10.9/f"), "id": ("no_doi", ""), "lost": ("not_found", ""), "mute": ("api_error", ""), "blank": ("skipped", ""), "late": ("corrected", "10.9/late"),
    }
    notes = {r.row_key: r.note for r in out.collect()}
    assert notes["wrong"] == "DOI corrected: 10.1/c pointed to a different work; replaced with 10.9/new (Sleep and memory in mice)" and "year or author" in notes["again"] and notes["same"] == ""
    keeps = spark.createDataFrame([("not_found", "no_doi", "W1"), ("api_error", "no_doi", "https://x.org/W2"), ("not_found", "no_doi", ""), ("mismatch", "no_doi", "W1"), ("not_found", "verified", "W1")], "n string, p string, w string")
    assert [r[0] for r in keeps.select(L.keeps_no_doi(F.col("n"), F.col("p"), F.col("w"))).collect()] == [True, True, False, False, False]


COLUMNS = ["row_key", "doi_r", "doi_o", "title_r", "title_o", "oa_work_id_r", "oa_work_id_o", "link_method", "link_evidence", "link_confidence", "doi_o_verification", "pair_id", "year_o"]


def test_guard_links(spark):
    base = dict(zip(COLUMNS, ["", "10.1/r", "10.1/o", "A replication of some work", "The original of some work", "W1", "W2", "llm_fulltext", "seen", "high", "", "p", "1990"], strict=True))
    cases = {
        "kept": {}, "self_doi": {"doi_o": "https://doi.org/10.1/R"}, "same_title": {"title_o": "A Replication of: some work"}, "pending": {"link_method": "target_pending", "doi_o": "10.1/r"},
        "filled": {"doi_o": ""}, "filled_self": {"doi_o": ""}, "data": {"doi_o": "", "oa_work_id_o": ""}, "by_id": {"doi_o": None, "oa_work_id_o": ""}, "own_id": {"doi_o": "", "oa_work_id_o": ""},
        "fragment": {"doi_o": "", "title_o": "M. Moieni, M.R"}, "nameless": {"doi_o": "", "oa_work_id_o": "", "link_evidence": ""}, "carried": {"doi_o": "", "oa_work_id_o": "https://x.org/W9"}, "other_method": {"doi_o": "", "oa_work_id_o": None, "link_method": "guess"},
    }
    rows = spark.createDataFrame([tuple({**base, "row_key": k, **v}[c] for c in COLUMNS) for k, v in cases.items()], ", ".join(f"{c} string" for c in COLUMNS))
    found = spark.createDataFrame([("filled", "10.7/f", "W5"), ("filled_self", "10.7/g", "W1"), ("data", "10.6084/m9.x", None), ("by_id", None, "W6"), ("own_id", None, "W1"), ("kept", "10.7/no", None)], "row_key string, doi string, ident string")
    out = L.guard_links(rows, found, resolved=["llm_fulltext"])
    assert out.columns == COLUMNS
    got = {r.row_key: r for r in out.collect()}
    pick = lambda k: (got[k].link_method, got[k].doi_o, got[k].oa_work_id_o, got[k].doi_o_verification)
    assert pick("kept") == ("llm_fulltext", "10.1/o", "W2", "") and got["kept"].pair_id == "p" and pick("pending") == ("target_pending", "10.1/r", "W2", "")
    for k, why in (("self_doi", "same DOI"), ("same_title", "same title"), ("filled_self", "recovered DOI is a self-link"), ("own_id", "self-link"), ("fragment", "no usable title_o")):
        assert pick(k) == ("target_pending", "", "", "skipped") and why in got[k].link_evidence and got[k].link_evidence.startswith("seen | rejected: ") and got[k].link_confidence == "low" and got[k].year_o == got[k].title_o == "", k
    assert pick("filled") == ("llm_fulltext", "10.7/f", "", "") and got["filled"].pair_id == hashlib.md5(b"10.1/r|10.7/f").hexdigest()
    assert pick("data") == ("unidentified_original", "", "", "no_doi") == pick("nameless") and got["nameless"].link_evidence.startswith("the named original") and got["data"].link_evidence.startswith("seen | the named")
    assert pick("by_id") == ("llm_fulltext", None, "W6", "no_doi") and pick("carried") == ("llm_fulltext", "", "W9", "no_doi") and pick("other_method") == ("guess", "", "", "no_doi")
    assert {r.row_key: r.link_method for r in L.guard_links(rows.where("row_key = 'other_method'")).collect()} == {"other_method": "unidentified_original"}


def test_demotion_types_and_endings(spark):
    rows = [(1, "llm_references", "", "e"), (1, "llm_references", "pdf", ""), (1, "other", None, ""), (2, "llm_references", None, ""), (3, "llm_references", " ", None), (3, "llm_references", None, None)]
    df = spark.createDataFrame(rows, "k int, link_method string, pdf_source string, link_evidence string").withColumn("link_confidence", F.lit("high"))
    got = sorted((r.k, r.link_confidence, r.link_evidence or "") for r in L.demote_reference_only(df, ["k"]).collect())
    assert got == [(1, "high", ""), (1, "high", ""), (1, "low", f"e | {L.NO_DOCUMENT}"), (2, "high", ""), (3, "low", L.NO_DOCUMENT), (3, "low", L.NO_DOCUMENT)]
    kinds = [("reproduction", True, "replication", "reproduction"), ("", True, " Replication", "replication"), (None, True, "needs_review", ""), (None, False, "needs_review", "replication"), ("x", False, "reproduction", "reproduction"), (None, False, None, "replication")]
    df = spark.createDataFrame(kinds, "s string, had boolean, p string, want string")
    assert all(r[0] == r[1] for r in df.select("want", L.record_type(F.col("s"), F.col("had"), F.col("p"))).collect())
    ends = spark.createDataFrame([("llm_refscreen_partial", "proceed"), ("llm_refscreen_failed", None), ("x", "discard"), ("x", "proceed"), (None, None)], "m string, v string")
    assert [r[0] for r in ends.select(L.front_door(F.col("m"), F.col("v"))).collect()] == ["target_pending", "api_error", "not_a_replication", None, None]


def test_outcomes(spark):
    rows = [(1, "successful"), (1, "failed"), (2, "failed"), (2, "uninformative"), (3, "descriptive only"), (3, "uninformative"), (4, "not_a_replication"), (5, "pending"), (5, None), (6, "mixed"), (6, "mixed")]
    got = {r.k: r.outcome for r in L.fold_outcomes(spark.createDataFrame(rows, "k int, outcome string"), ["k"]).collect()}
    assert got == {1: "mixed", 2: "failed", 3: "uninformative", 4: "not_a_replication", 5: L.UNSETTLED, 6: "mixed"}
    axes = [("computational issues", " robust ", "computational issues, robust"), ("not checked", "not checked", "not checked, not checked"), ("technical failure", "cannot_be_determined", L.UNSETTLED), (None, "robust", L.UNSETTLED), ("odd", "robust", L.UNSETTLED)]
    df = spark.createDataFrame(axes, "c string, r string, want string")
    assert all(r[0] == r[1] for r in df.select("want", L.reproduction_outcome(F.col("c"), F.col("r"))).collect())


def test_votes(spark):
    texts = ["m-1=Replication/confident|m2=none/unconfident", "a=b=c/d/confident", "junk|=x/confident", "m=bare", "", None, " m = x / confident "]
    parsed = [[tuple(v) for v in r[0]] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(L.parse_votes(F.col("t"))).collect()]
    assert parsed == [[("m-1", "replication", True), ("m2", "none", False)], [("a", "b=c/d", True)], [("", "x", True)], [("m", "", False)], [], [], [("m", "x", True)]]
    back = spark.createDataFrame([(texts[0].lower(),)], "t string").select(L.format_votes(L.parse_votes(F.col("t")))).first()[0]
    assert back == texts[0].lower()
    votes = spark.createDataFrame([([("m1", " said so "), ("m2", None), (None, "alone"), ("", "")],), ([],)], "v array<struct<model:string,quote:string>>")
    assert [r[0] for r in votes.select(L.format_evidence(F.col("v"))).collect()] == ["m1: said so || alone", ""]


def test_hand_on(spark):
    rows = [(1, "screen_cheap", "needs_review", "engine"), (2, "screen_expensive", "needs_review", "engine"), (3, "screen_cheap", "needs_review", "engine"), (4, "screen_cheap", "needs_review", "engine"), (5, "screen_expensive", "x", "engine"), (6, "discard", "x", "engine"), (7, "screen_cheap", "x", "engine")]
    vote = [("m1", "replication", True, "q1"), ("m2", "none", False, "")]
    decided = [(1, "cheap", "discard", None, None), (2, "expensive", "proceed", "reproduction", vote), (3, "cheap", "discard", "", None), (3, "expensive", "proceed", "", vote), (4, "cheap", "proceed", None, None), (5, "expensive", "discard", "", vote), (7, "expensive", "incomplete", "", vote)]
    kinds = "work_id long, tier string, outcome string, record_type string, votes array<struct<model:string,classification:string,confident:boolean,quote:string>>"
    frames = spark.createDataFrame(rows, "work_id long, pile string, paper_type string, filter_method string"), spark.createDataFrame(decided, kinds)
    got = {r.work_id: (r.pile_order, r.screen_verdict, r.paper_type, r.filter_method, r.screen_votes, r.screen_evidence) for r in L.hand_on(*frames).collect()}
    text = "m1=replication/confident|m2=none/unconfident"
    assert got == {2: (1, "proceed", "reproduction", "screen", text, "m1: q1"), 3: (2, "proceed", "needs_review", "engine", text, "m1: q1"), 4: (2, "", "needs_review", "engine", "", ""), 7: (2, "", "x", "engine", "", "")}
    assert {r.work_id for r in L.hand_on(*frames, screened_only=True).collect()} == {2, 3}


def test_supersession_and_payloads(spark):
    diffs = spark.createDataFrame([(1, "pending", "discard"), (2, "discard", "screen_cheap"), (3, "a", "b")], "work_id long, old_pile string, new_pile string")
    sent = spark.createDataFrame([(1, "r2", True), (1, "r1", False), (1, "r1", False), (2, "r3", None), (9, "r9", True), (3, None, True)], "work_id long, record_id string, validated boolean")
    got = {r.work_id: (r.kind, r.record_ids, r.n_validated, r.n_unvalidated) for r in L.plan_supersession(diffs, sent).collect()}
    assert got == {1: ("withdrawal", ["r1", "r2"], 1, 2), 2: ("reroute", ["r3"], 0, 1)}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    columns = ["pair_id", "doi_r", "doi_o", "oa_work_id_r", "oa_work_id_o", "title_r", "title_o", "paper_type", "n"]
    payloads = [
        (1, {"input": {"doi_r": "10.1/r", "filter_status": "old", "secret": "x", "n": 3}, "targets": [{"doi_o": "10.1/o", "pair_id": "p"}, {"doi_o": "", "title_o": "T", "paper_type": "new", "pair_id": "q"}]}),
        (2, {"input": {"title_r": " A  Title ", "doi_r": None}, "targets": [{"doi_o": "10.1/o", "pair_id": "stale"}, {"title_o": "known", "pair_id": "stays"}]}),
        (3, {"input": {"oa_work_id_r": "https://x.org/W5"}, "targets": [{"pair_id": "stale"}]}), (4, {"input": {}, "targets": []}),
    ]
    stored = spark.createDataFrame([(i, json.dumps(p)) for i, p in payloads] + [(5, "{bad"), (6, None)], "id int, payload string")
    rows = {(r.id, r["at"]): r for r in L.render_payload(stored, "payload", ["doi_r", "title_r", "oa_work_id_r", "paper_type", "n"], columns, {"filter_status": "paper_type"}).collect()}
    assert set(rows) == {(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)}
    assert (rows[1, 0].pair_id, rows[1, 0].paper_type, rows[1, 0].n, rows[1, 1].paper_type, rows[1, 1].doi_r) == ("p", "old", "3", "new", "10.1/r")
    assert rows[2, 0].pair_id == md5("t:a title|10.1/o") and rows[2, 1].pair_id == "stays" and rows[3, 0].pair_id == md5("oa:W5|")
