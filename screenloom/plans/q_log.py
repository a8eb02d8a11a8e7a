"""Queries on the append-only verdict log: folds, gates, claims, payloads and patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import claims, folds, linking
from ..operators.claims import select_verdicts
from .registry import Registry
from .standins import LOG_SQL, log, rounded, table

query = Registry()
WITH = f"WITH {LOG_SQL} "
#: The generation that counts.
CURRENT = 50


@query(WITH + "SELECT work, claim, verdict, id FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY (claim >= 50) DESC, tm DESC, id DESC) AS n FROM log) WHERE n = 1")
def latest_wins(spark, sf_dir):
    rows = log(spark, sf_dir).withColumn("current", F.col("claim") >= CURRENT)
    return folds.latest_by(rows, ["work"], ["current", "at", "id"]).select("work", "claim", "verdict", "id")


VOTES_SQL = "v AS (SELECT work, claim, id, tm, verdict, CASE WHEN claim % 7 = 0 THEN NULL ELSE 'm' || claim % 3 END AS voter FROM log), named AS (SELECT work, voter, id, verdict FROM (SELECT *, row_number() OVER (PARTITION BY work, voter ORDER BY tm DESC, id DESC) AS n FROM v WHERE voter IS NOT NULL) WHERE n = 1), lastc AS (SELECT work, claim FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY tm DESC, id DESC) AS n FROM v WHERE voter IS NULL) WHERE n = 1), votes AS (SELECT work, voter, id, verdict FROM named UNION ALL SELECT v.work, NULL, v.id, v.verdict FROM v JOIN lastc USING (work, claim) WHERE v.voter IS NULL)"


def votes(spark, sf_dir):
    rows = log(spark, sf_dir).withColumn("voter", F.when(F.col("claim") % 7 != 0, F.concat(F.lit("m"), F.col("claim") % 3)))
    return folds.one_vote_each(rows, "work", "voter", ["at", "id"], "claim").select("work", "voter", "id", "verdict")


@query(f"{WITH}, {VOTES_SQL} SELECT * FROM votes")
def vote_dedup(spark, sf_dir):
    return votes(spark, sf_dir)


@query(f"{WITH}, {VOTES_SQL} SELECT work, count(*)::BIGINT AS n_votes, CASE WHEN count(*) < 2 THEN NULL WHEN count(*) FILTER (verdict <> 'error') = 0 THEN 'discard' ELSE 'proceed' END AS gate FROM votes GROUP BY work")
def vote_gate(spark, sf_dir):
    # votes per work are at most one a voter, and those of one claim
    g = votes(spark, sf_dir).groupBy("work").agg(F.collect_list("verdict").alias("v"))
    return g.select("work", F.size("v").cast("long").alias("n_votes"), folds.vote_gate(F.col("v"), "error").alias("gate"))


@query(f"{WITH}, {VOTES_SQL} SELECT work, count(*)::BIGINT AS n_votes FROM votes WHERE verdict IN ('view', 'click') GROUP BY work HAVING count(*) < 2")
def short_voted(spark, sf_dir):
    return votes(spark, sf_dir).where(F.col("verdict").isin("view", "click")).groupBy("work").agg(F.count(F.lit(1)).alias("n_votes")).where("n_votes < 2")


@query(WITH + "SELECT work, CASE WHEN bool_or(verdict = 'purchase' AND score > 200) THEN 'resolved' WHEN bool_or(verdict = 'signup' AND score > 200) THEN 'partial' WHEN bool_or(verdict = 'error' AND score > 200) THEN 'failed' ELSE 'resting' END AS ending FROM log GROUP BY work")
def ending_precedence(spark, sf_dir):
    had = F.collect_set(F.when(F.col("score") > 200, F.col("verdict")))
    has = lambda v: F.array_contains("had", v)
    return log(spark, sf_dir).groupBy("work").agg(had.alias("had")).select("work", F.coalesce(T.first_reason([("resolved", has("purchase")), ("partial", has("signup")), ("failed", has("error"))]), F.lit("resting")).alias("ending"))


@query(WITH + """, q AS (SELECT work, md5((max(claim) // 2)::VARCHAR) AS now_hash, max(tm) - INTERVAL 2 DAY AS text_at FROM log GROUP BY work),
s AS (SELECT work, id, tm, CASE WHEN id % 3 <> 0 THEN md5((claim // 2)::VARCHAR) ELSE '' END AS hash FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY tm DESC, id DESC) AS n FROM log WHERE verdict = 'purchase') WHERE n = 1),
r AS (SELECT work, id, CASE WHEN hash <> '' AND hash <> now_hash THEN 'question moved' WHEN hash = '' AND text_at > tm THEN 'text is newer' END AS reason FROM s JOIN q USING (work))
SELECT * FROM r WHERE reason IS NOT NULL""")
def stale_verdicts(spark, sf_dir):
    """The last verdict of each work whose question isn't today's: by the question that it recorded, or else by the time of the text."""
    rows = log(spark, sf_dir).withColumn("work_id", F.col("work"))
    half = lambda c: F.md5(F.floor(c / 2).cast("string"))
    now = rows.groupBy("work_id").agg(half(F.max("claim")).alias("question_hash"), (F.max("at") - F.expr("INTERVAL 2 DAYS")).alias("text_at"))
    last = folds.latest_by(rows.where("verdict = 'purchase'"), ["work_id"], ["at", "id"]).withColumn("question_hash", F.when(F.col("id") % 3 != 0, half(F.col("claim"))))
    return claims.stale(last, now).select("work", "id", "reason")


#: Claims of the log as events: each claims the works that were viewed, until six hours after the last.
EVENTS_SQL = "e AS (SELECT claim, work, max(tm) OVER (PARTITION BY claim) + INTERVAL 6 HOUR AS expires_at, max(CASE WHEN claim % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY claim) AS over FROM log WHERE verdict = 'view')"


def claim_events(spark, sf_dir):
    views = log(spark, sf_dir).where("verdict = 'view'").groupBy("claim").agg(F.array_sort(F.collect_set("work")).alias("works"), F.min("at").cast("timestamp").alias("began"), F.max("at").cast("timestamp").alias("at"))
    row = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"))
    kinds = F.when(F.col("claim") % 5 == 0, F.array(row("claim", F.col("began")), row("finish", F.col("at") + F.expr("INTERVAL 1 SECOND")))).otherwise(F.array(row("claim", F.col("began")), row("renew", F.col("at"))))
    out = views.select("claim", "works", "at", F.explode(kinds).alias("k"))
    return out.select(F.col("claim").cast("string").alias("claim"), F.lit("cheap").alias("tier"), "k.kind", "works", F.col("k.at").alias("at"), (F.col("at") + F.expr("INTERVAL 6 HOURS")).alias("expires_at"))


@query(WITH + f", {EVENTS_SQL} SELECT DISTINCT e.work, e.claim::VARCHAR AS claim FROM e WHERE over = 0 AND expires_at > TIMESTAMP '2024-01-30 12:00:00' AND work IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0)")
def claim_conflicts(spark, sf_dir):
    """Works of a batch that live claims hold."""
    batch = table(spark, sf_dir, "customer").where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("work"))
    return claims.conflicts(batch, claim_events(spark, sf_dir), "cheap", "2024-01-30 12:00:00")


@query(WITH + f", {EVENTS_SQL} SELECT claim::VARCHAR AS claim, any_value(expires_at) AS expires_at, count(DISTINCT work)::BIGINT AS works FROM e WHERE over = 0 AND expires_at <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY claim")
def lease_expiry(spark, sf_dir):
    """Claims whose lease ran out while they were active."""
    out = claims.expired(claim_events(spark, sf_dir), "2024-01-30 12:00:00")
    return out.select("claim", F.col("expires_at").cast("timestamp_ntz").alias("expires_at"), F.col("n_works").alias("works"))


@query(WITH + "SELECT id, CASE WHEN id % 97 = 0 THEN 'deleted' WHEN id % 89 = 0 AND id % 3 = 0 THEN 'verdict,score' WHEN id % 89 = 0 THEN 'verdict' ELSE 'score' END AS what FROM log WHERE id % 97 = 0 OR id % 89 = 0 OR id % 83 = 0 AND id % 3 = 0")
def permanence_violations(spark, sf_dir):
    """Verdicts that are gone, or changed in what should stay, between two states of the log."""
    before = log(spark, sf_dir).select("id", "work", "verdict", "score").withColumn("superseded_by", F.lit(None).cast("long"))
    i = F.col("id")
    changed = (i % 89 == 0) | (i % 83 == 0)
    after = before.where(i % 97 != 0).withColumn("verdict", F.when(i % 89 == 0, "other").otherwise(F.col("verdict"))).withColumn("score", F.when(changed & (i % 3 == 0), F.col("score") + 1).otherwise(F.col("score"))).withColumn("superseded_by", F.when(i % 2 == 0, i + 1))
    return claims.tampered(before, after)


@query("WITH d AS (SELECT c_custkey AS work, CASE WHEN c_nationkey < 5 THEN 'withdrawal' ELSE 'reroute' END AS kind FROM customer WHERE c_acctbal < 2000) SELECT work, kind, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR) AS record_ids, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS validated, count(*) FILTER (o_orderstatus <> 'F')::BIGINT AS unvalidated FROM d JOIN orders ON o_custkey = work GROUP BY work, kind")
def supersession_plan(spark, sf_dir):
    """Works whose pile changed after records of them were sent, and how many of these were validated."""
    diffs = table(spark, sf_dir, "customer").where("c_acctbal < 2000").select(F.col("c_custkey").alias("work_id"), F.lit("pending").alias("old_pile"), F.when(F.col("c_nationkey") < 5, "discard").otherwise("screen_cheap").alias("new_pile"))
    sent = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("work_id"), F.col("o_orderkey").cast("string").alias("record_id"), (F.col("o_orderstatus") == "F").alias("validated"))
    out = linking.plan_supersession(diffs, sent)
    return out.select(F.col("work_id").alias("work"), "kind", F.array_join("record_ids", ",").alias("record_ids"), F.col("n_validated").alias("validated"), F.col("n_unvalidated").alias("unvalidated"))


@query(WITH + "SELECT work, max(CASE WHEN verdict = 'view' THEN score END) AS view, max(CASE WHEN verdict = 'click' THEN score END) AS click, max(CASE WHEN verdict = 'purchase' THEN score END) AS purchase FROM log GROUP BY work")
def drilldown_pivot(spark, sf_dir):
    return log(spark, sf_dir).groupBy("work").pivot("verdict", ["view", "click", "purchase"]).agg(F.max("score"))


@query(WITH + """, p AS (SELECT id, CASE WHEN claim % 4 = 0 THEN '' ELSE '10.1/r' || work END AS r, 'Study ' || work AS t, 0 AS pos, '10.2/o' || claim AS o, '' AS title_o, 'kept' AS pair, 'replication' AS kind FROM log
UNION ALL SELECT id, CASE WHEN claim % 4 = 0 THEN '' ELSE '10.1/r' || work END, 'Study ' || work, 1, '', CASE WHEN claim % 3 = 0 THEN 'A title' ELSE '' END, 'kept', CASE WHEN claim % 5 = 0 THEN 'reproduction' ELSE 'replication' END FROM log)
SELECT id, pos::INTEGER AS pos, CASE WHEN r = '' AND (o <> '' OR title_o = '') THEN md5('t:' || lower(t) || '|' || o) ELSE pair END AS pair_id, r AS doi_r, o AS doi_o, kind AS paper_type FROM p""")
def payload_render(spark, sf_dir):
    """Stored payloads as rows of their targets, columns under old names read, keys made without a DOI mended."""
    r = F.when(F.col("claim") % 4 != 0, F.concat(F.lit("10.1/r"), "work"))
    inputs = F.struct(r.alias("doi_r"), F.concat(F.lit("Study  "), "work").alias("title_r"), F.lit("replication").alias("filter_status"))
    none = F.lit(None).cast("string")
    target = lambda o, title, kind: F.struct(o.alias("doi_o"), title.alias("title_o"), F.lit("kept").alias("pair_id"), kind.alias("paper_type"))
    targets = F.array(target(F.concat(F.lit("10.2/o"), "claim"), none, none), target(none, F.when(F.col("claim") % 3 == 0, "A title"), F.when(F.col("claim") % 5 == 0, "reproduction")))
    stored = log(spark, sf_dir).select("id", F.to_json(F.struct(inputs.alias("input"), targets.alias("targets"))).alias("payload"))
    columns = ["pair_id", "doi_r", "doi_o", "oa_work_id_r", "oa_work_id_o", "title_r", "title_o", "paper_type"]
    return linking.render_payload(stored, "payload", ["doi_r", "title_r", "paper_type"], columns, {"filter_status": "paper_type"}).select("id", F.col("at").alias("pos"), "pair_id", "doi_r", "doi_o", "paper_type")


@query(WITH + "SELECT work, claim, CASE WHEN count(DISTINCT verdict) FILTER (verdict IN ('purchase', 'error')) > 1 THEN 'mixed' WHEN bool_or(verdict = 'purchase') THEN 'successful' WHEN bool_or(verdict = 'error') THEN 'failed' WHEN bool_or(verdict = 'signup') THEN 'uninformative' WHEN bool_or(verdict = 'click') THEN 'descriptive only' ELSE 'cannot_be_determined' END AS outcome FROM log GROUP BY ALL")
def outcome_fold(spark, sf_dir):
    """One outcome of a work's studies: what has substance before what hasn't, mixed where it differs."""
    v = F.col("verdict")
    named = F.when(v == "purchase", "successful").when(v == "error", "failed").when(v == "signup", "uninformative").when(v == "click", "descriptive only").otherwise("pending")
    return linking.fold_outcomes(log(spark, sf_dir).withColumn("outcome", named), ["work", "claim"])


@query(WITH + ", f AS (SELECT work, claim, verdict, min(id) AS pos, min(score) AS score FROM log GROUP BY ALL), g AS (SELECT work, claim, string_agg(verdict, '; ' ORDER BY pos) AS labels, min(score) AS weakest, min(pos) AS first FROM f GROUP BY ALL) SELECT work, claim, labels, weakest, row_number() OVER (PARTITION BY work ORDER BY first)::BIGINT AS rank FROM g")
def collapse_groups(spark, sf_dir):
    from pyspark.sql.window import Window

    labels = log(spark, sf_dir).groupBy("work", "claim", "verdict").agg(F.min("id").alias("pos"), F.min("score").alias("score"))
    g = labels.groupBy("work", "claim").agg(F.array_sort(F.collect_list(F.struct("pos", "verdict"))).alias("ls"), F.min("score").alias("weakest"), F.min("pos").alias("first"))
    return g.select("work", "claim", F.array_join(F.transform("ls", lambda x: x["verdict"]), "; ").alias("labels"), "weakest", F.row_number().over(Window.partitionBy("work").orderBy("first")).cast("long").alias("rank"))


@query(WITH + ", a AS (SELECT id, CASE verdict WHEN 'view' THEN 'computationally reproducible' WHEN 'click' THEN 'computational issues' WHEN 'signup' THEN 'not checked' WHEN 'purchase' THEN 'technical failure' ELSE 'unheard of' END AS c, CASE WHEN claim < 33 THEN 'robust' WHEN claim < 66 THEN 'robustness challenges' ELSE 'cannot_be_determined' END AS r FROM log) SELECT id, CASE WHEN c = 'unheard of' OR r = 'cannot_be_determined' THEN 'cannot_be_determined' ELSE c || ', ' || r END AS derived FROM a")
def derive_outcome(spark, sf_dir):
    """A reproduction's outcome by its two axes, unsettled if either is."""
    v, claim = F.col("verdict"), F.col("claim")
    computation = F.when(v == "view", "computationally reproducible").when(v == "click", "computational issues").when(v == "signup", " not checked").when(v == "purchase", "technical failure").otherwise("unheard of")
    robustness = F.when(claim < 33, "robust").when(claim < 66, "robustness challenges").otherwise(linking.UNSETTLED)
    return log(spark, sf_dir).select("id", linking.reproduction_outcome(computation, robustness).alias("derived"))


@query(WITH + "SELECT work, array_to_string(list_filter(['signup', 'view', 'click', 'purchase', 'error'], lambda x: list_contains(list(DISTINCT verdict), x)), '|') AS labels FROM log WHERE score > 150 GROUP BY work")
def ordered_label_union(spark, sf_dir):
    order = F.array(*map(F.lit, ("signup", "view", "click", "purchase", "error")))
    return log(spark, sf_dir).where("score > 150").groupBy("work").agg(F.collect_set("verdict").alias("v")).select("work", F.array_join(F.array_intersect(order, "v"), "|").alias("labels"))


@query(WITH + "SELECT h AS response_hash, count(*)::BIGINT AS verdicts, min(id)::BIGINT AS first, bool_or(h IN (SELECT md5(c_custkey::VARCHAR) FROM customer WHERE c_acctbal > 2000)) AS present FROM (SELECT md5(claim::VARCHAR) AS h, id FROM log WHERE verdict <> 'view') GROUP BY h")
def reconcile_blobs(spark, sf_dir):
    """Responses still pending, how many verdicts name each, and which are stored by now."""
    blobs = table(spark, sf_dir, "customer").where("c_acctbal > 2000").select(F.md5(F.col("c_custkey").cast("string")).alias("response_hash"))
    verdicts = log(spark, sf_dir).select("id", F.md5(F.col("claim").cast("string")).alias("response_hash"), F.when(F.col("verdict") != "view", claims.PENDING).otherwise(claims.UPLOADED).alias("response_state"))
    return claims.reconcile(verdicts, blobs)


@query(WITH + "SELECT id, 'm0' AS model, verdict AS classification, claim < 60 AS confident FROM log UNION ALL SELECT id, 'm1', 'none', claim % 2 = 0 FROM log")
def parse_votes(spark, sf_dir):
    """Votes written as `model=class/confident|...` as rows."""
    sure = lambda c: F.when(c, "confident").otherwise("unconfident")
    line = F.concat(F.lit("m0="), F.initcap("verdict"), F.lit("/"), sure(F.col("claim") < 60), F.lit("|no vote|m1=none/"), sure(F.col("claim") % 2 == 0))
    return log(spark, sf_dir).select("id", F.explode(linking.parse_votes(line)).alias("v")).select("id", "v.model", "v.classification", "v.confident")


@query(WITH + "SELECT id, CASE WHEN score <= 100 AND claim < 30 THEN verdict WHEN claim % 2 = 1 THEN 'replication' WHEN score <= 100 THEN '' ELSE 'replication' END AS record_type, CASE WHEN verdict = 'click' THEN 'target_pending' WHEN verdict = 'error' THEN 'api_error' WHEN claim % 7 = 0 THEN 'not_a_replication' ELSE 'goes on' END AS ending FROM log")
def type_resolution(spark, sf_dir):
    """A work's type by its screen, or else its paper, and how a screen ends it."""
    claim, verdict = F.col("claim"), F.col("verdict")
    kind = linking.record_type(F.when(claim < 30, verdict), F.col("score") <= 100, F.when(claim % 2 == 0, "needs_review").otherwise(" Replication"))
    method = F.when(verdict == "click", "llm_refscreen_partial").when(verdict == "error", "llm_refscreen_failed").otherwise("llm_refscreen")
    ending = F.coalesce(linking.front_door(method, F.when(claim % 7 == 0, "discard").otherwise("proceed")), F.lit("goes on"))
    return log(spark, sf_dir).select("id", kind.alias("record_type"), ending.alias("ending"))


@query("""
WITH o AS (SELECT o_orderkey AS k, '10.1/r' || o_orderkey AS r, CASE o_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN '10.1/r' || o_orderkey ELSE '10.2/o' || o_custkey END AS o, CASE o_orderkey % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS t, 'W' || o_orderkey AS wr,
       CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'W' || o_custkey END AS wo, CASE WHEN o_orderstatus = 'P' THEN 'target_pending' ELSE 'llm_fulltext' END AS method,
       CASE WHEN o_orderkey % 6 = 0 THEN '10.3/f' || o_orderkey ELSE '' END AS fd, CASE o_orderkey % 6 WHEN 1 THEN 'W' || o_orderkey WHEN 2 THEN 'W' || o_custkey ELSE '' END AS fw FROM orders),
u AS (SELECT *, o = '' AND t <> 2 AND fd <> '' AS filled, CASE WHEN t <> 2 AND fw <> '' THEN fw ELSE wo END AS ident FROM o),
v AS (SELECT *, method <> 'target_pending' AND (o = r OR t = 1 OR o = '' AND NOT filled AND (t = 2 OR ident = wr)) AS bad FROM u)
SELECT k AS o_orderkey, CASE WHEN bad THEN 'target_pending' WHEN method <> 'target_pending' AND o = '' AND NOT filled AND ident = '' THEN 'unidentified_original' ELSE method END AS link_method,
       CASE WHEN method = 'target_pending' THEN o WHEN bad THEN '' WHEN filled THEN fd ELSE o END AS doi_o,
       CASE WHEN method = 'target_pending' THEN wo WHEN bad OR filled THEN '' WHEN o = '' AND ident <> '' THEN ident ELSE wo END AS oa_work_id_o,
       CASE WHEN method = 'target_pending' THEN '' WHEN bad THEN 'skipped' WHEN o = '' AND NOT filled THEN 'no_doi' ELSE '' END AS status FROM v""")
def self_link_guard(spark, sf_dir):
    """Orders as links, of which those to themselves, or to nothing that has a name, are set back, and DOIs found by title filled in."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    w = lambda x: F.concat(F.lit("W"), x)
    study = F.concat(F.lit("Study number "), k, F.lit(" of the series"))
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        k.alias("row_key"), F.concat(F.lit("10.1/r"), k).alias("doi_r"), F.when(c % 10 == 0, "").when(c % 10 == 1, F.concat(F.lit("10.1/R"), k)).otherwise(F.concat(F.lit("10.2/o"), c)).alias("doi_o"), study.alias("title_r"),
        F.when(k % 9 == 0, F.upper(study)).when(k % 9 == 1, "M. Moieni, M.R").otherwise(F.concat(F.lit("Work number "), c, F.lit(" of the list"))).alias("title_o"), w(k).alias("oa_work_id_r"), F.when(k % 4 == 0, "").otherwise(w(c)).alias("oa_work_id_o"),
        F.when(F.col("o_orderstatus") == "P", "target_pending").otherwise("llm_fulltext").alias("link_method"), F.lit("").alias("link_evidence"), F.lit("high").alias("link_confidence"), F.lit("").alias("doi_o_verification"),
    )
    found = o.where(k % 6 < 3).select(k.alias("row_key"), F.when(k % 6 == 0, F.concat(F.lit("10.3/f"), k)).alias("doi"), F.when(k % 6 == 1, w(k)).when(k % 6 == 2, w(c)).alias("ident"))
    out = linking.guard_links(rows, found, ["llm_fulltext"])
    return out.select(F.col("row_key").alias("o_orderkey"), "link_method", F.lower("doi_o").alias("doi_o"), "oa_work_id_o", F.col("doi_o_verification").alias("status"))


@query(f"SELECT l_orderkey, l_linenumber::BIGINT AS line, CASE WHEN low THEN 'low' ELSE 'high' END AS confidence, CASE WHEN low THEN '{linking.NO_DOCUMENT}' ELSE '' END AS evidence FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) > 1 AND l_returnflag = 'N' AND l_linestatus = 'O' AS low FROM lineitem)")
def demote_multi(spark, sf_dir):
    """Links of works with several originals that rest on a list of references alone: of low confidence, with a note."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), F.when(F.col("l_returnflag") == "N", "llm_references").otherwise("llm_fulltext").alias("link_method"), F.when(F.col("l_linestatus") != "O", "pdf").alias("pdf_source"), F.lit("high").alias("link_confidence"), F.lit("").alias("link_evidence"))
    return linking.demote_reference_only(lines, ["l_orderkey"]).select("l_orderkey", "line", F.col("link_confidence").alias("confidence"), F.col("link_evidence").alias("evidence"))


@query("""
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '10.1/c' || o_custkey END AS doi, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'order of customer ' || o_custkey END AS title, year(o_orderdate) AS y, o_custkey FROM orders),
m AS (SELECT '10.1/c' || c_custkey AS doi, c_acctbal >= 0 AS registered, CASE WHEN c_nationkey % 2 = 0 THEN 'order of customer ' || c_custkey ELSE 'something else entirely' END AS title, 1994 + c_nationkey % 4 AS y FROM customer WHERE c_custkey % 3 <> 0),
s AS (SELECT o_orderkey AS k, o_orderkey % 5 <> 0 AS answered, CASE WHEN o_orderkey % 3 = 0 THEN '10.5/s' || o_orderkey WHEN o_orderkey % 7 = 0 THEN '10.1/c' || o_custkey ELSE '' END AS doi, CASE WHEN o_orderkey % 4 = 0 THEN 'W' || o_orderkey ELSE '' END AS ident FROM orders WHERE o_orderkey % 2 = 0),
j AS (SELECT o.*, m.doi IS NOT NULL AS known, coalesce(m.registered, false) AS registered, coalesce(m.registered AND o.title <> '' AND o.title = m.title AND abs(o.y - m.y) <= 1, false) AS ok, coalesce(s.answered AND (s.doi <> '' OR s.ident <> ''), false) AS hit, coalesce(s.doi, '') AS found, coalesce(NOT s.answered, false) AS silent
      FROM o LEFT JOIN m ON m.doi = o.doi LEFT JOIN s ON s.k = o.k),
v AS (SELECT *, CASE WHEN doi <> '' THEN CASE WHEN NOT known THEN 'api_error' WHEN ok THEN 'verified' WHEN NOT hit AND silent THEN 'api_error' WHEN hit AND found = doi THEN 'verified' WHEN hit AND found <> '' THEN 'corrected' WHEN hit THEN 'no_doi' WHEN registered THEN 'mismatch' ELSE 'no_metadata' END
  ELSE CASE WHEN title = '' THEN 'skipped' WHEN NOT hit AND silent THEN 'api_error' WHEN hit AND found <> '' THEN 'corrected' WHEN hit THEN 'no_doi' ELSE 'not_found' END END AS status FROM j)
SELECT k AS o_orderkey, status, CASE WHEN status = 'corrected' THEN found WHEN status IN ('no_doi', 'not_found', 'skipped') THEN '' ELSE doi END AS doi FROM v""")
def verification_status(spark, sf_dir):
    """Orders as links whose DOI customers' registry and searches by metadata verify, correct, fill or leave open."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0")
    key, own = F.col("o_orderkey"), lambda c: F.concat(F.lit("10.1/C"), c)
    title = lambda c: F.concat(F.lit("order of customer "), c)
    rows = o.select(key.alias("row_key"), F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(own("o_custkey")).alias("doi_o"), F.when(key % 11 == 0, "").otherwise(title("o_custkey")).alias("title_o"), F.year("o_orderdate").cast("string").alias("year_o"))
    registry = c.select(own("c_custkey").alias("doi"), (F.col("c_acctbal") >= 0).alias("registered"), F.when(F.col("c_nationkey") % 2 == 0, title("c_custkey")).otherwise("something else entirely").alias("title"), (1994 + F.col("c_nationkey") % 4).alias("year"), F.lit("maker").alias("surname"))
    doi = F.when(key % 3 == 0, F.concat(F.lit("10.5/s"), key)).when(key % 7 == 0, own("o_custkey"))
    searches = o.where(key % 2 == 0).select(key.alias("row_key"), F.lit(0).alias("tier"), (key % 5 != 0).alias("answered"), doi.alias("doi"), F.when(key % 4 == 0, F.concat(F.lit("W"), key)).alias("ident"), F.lit("found").alias("title"))
    return linking.verify(rows, registry, searches).select(F.col("row_key").alias("o_orderkey"), F.col("doi_o_verification").alias("status"), F.col("doi_o").alias("doi"))


@query("SELECT c_custkey, CASE WHEN b > 9000 THEN 'AUDITED' ELSE c_mktsegment END AS segment, b > 9000 AS patched FROM (SELECT c_custkey, c_mktsegment, coalesce(c_acctbal, 0) AS b FROM customer)")
def apply_patches(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    patches = c.where("c_acctbal > 9000").select("c_custkey", F.create_map(F.lit("c_mktsegment"), F.lit("AUDITED")).alias("patch"))
    return c.join(patches, "c_custkey", "left").select("c_custkey", F.coalesce(F.try_element_at("patch", F.lit("c_mktsegment")), "c_mktsegment").alias("segment"), F.col("patch").isNotNull().alias("patched"))


@query(WITH + "SELECT work, claim, coalesce(string_agg(verdict || ': q' || id, ' || ' ORDER BY id) FILTER (score > 100), '') AS evidence, count(*)::BIGINT AS votes FROM log GROUP BY ALL")
def vote_evidence(spark, sf_dir):
    """Every voter's quote, in order, votes without one left out."""
    quote = F.when(F.col("score") > 100, F.concat(F.lit("q"), "id")).otherwise(" ")
    g = log(spark, sf_dir).groupBy("work", "claim").agg(F.array_sort(F.collect_list(F.struct("id", F.col("verdict").alias("model"), quote.alias("quote")))).alias("v"))
    return g.select("work", "claim", linking.format_evidence(F.col("v")).alias("evidence"), F.size("v").cast("long").alias("votes"))


@query(WITH + "SELECT work, arg_max(claim, struct_pack(a := tm, i := id)) AS newest_claim, max(tm)::VARCHAR AS fetched_at FROM log GROUP BY work")
def newest_release(spark, sf_dir):
    g = log(spark, sf_dir).groupBy("work").agg(F.max_by("claim", F.struct("at", "id")).alias("newest_claim"), F.max("at").alias("m"))
    return g.select("work", "newest_claim", F.regexp_replace(F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+\z", "").alias("fetched_at"))


@query(WITH + "SELECT id, CASE WHEN claim % 3 = 0 THEN 'validation' ELSE 'live' END AS mode, 'g' || claim // 50 AS generation FROM log WHERE claim % 3 <> 0 AND claim // 50 = 1 AND verdict IN ('purchase', 'signup') AND score <= 300")
def verdict_filter(spark, sf_dir):
    """Live verdicts of two kinds of one generation that nothing supersedes, with their claim's metadata."""
    verdicts = log(spark, sf_dir).withColumn("superseded_by", F.when(F.col("score") > 300, F.col("id") + 1))
    claims = verdicts.select("claim").distinct().select("claim", F.when(F.col("claim") % 3 == 0, "validation").otherwise("live").alias("mode"), F.concat(F.lit("g"), F.floor(F.col("claim") / 50)).alias("generation"))
    return select_verdicts(verdicts, claims, "live", "g1", ["purchase", "signup"]).select("id", "mode", "generation")


@query(WITH + ", s AS (SELECT id, tm, CASE WHEN claim < 60 THEN claim WHEN claim < 80 THEN claim * 30 ELSE claim * 3660 END AS s FROM log WHERE id % 4 <> 3) SELECT id, strftime(tm, '%Y-%m-%dT%H:%M:%S') AS at, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s // 3600 || 'h ' || s % 3600 // 60 || 'm' END AS took FROM s")
def iso_times(spark, sf_dir):
    """Times read from texts with Z, an offset or neither, those that can't be read left out; durations for people."""
    written = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("id") % 4 == 0, F.concat(written, F.lit("Z"))).when(F.col("id") % 4 == 1, written).when(F.col("id") % 4 == 2, F.concat(F.date_format(F.col("at") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise("soon")
    seconds = F.when(F.col("claim") < 60, F.col("claim")).when(F.col("claim") < 80, F.col("claim") * 30).otherwise(F.col("claim") * 3660)
    rows = log(spark, sf_dir).select("id", T.utc(text).alias("t"), T.duration_text(seconds).alias("took")).where("t IS NOT NULL")
    return rows.select("id", F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss").alias("at"), "took")


@query(WITH + "SELECT work, verdict, round(score, 6) AS best, round(coalesce(second, 0), 6) AS second FROM (SELECT work, verdict, s AS score, lead(s) OVER w AS second, row_number() OVER w AS n FROM (SELECT work, verdict, max(score) AS s FROM log GROUP BY ALL) WINDOW w AS (PARTITION BY work ORDER BY s DESC, verdict)) WHERE n = 1 AND score >= 50 AND score >= 1.5 * coalesce(second, 0)")
def dominance_match(spark, sf_dir):
    scored = log(spark, sf_dir).groupBy("work", "verdict").agg(F.max("score").alias("score"))
    return folds.dominant(scored, ["work"], "score", "verdict", 50, 1.5).select("work", "verdict", rounded("score").alias("best"), rounded("second").alias("second"))


@query(WITH + "SELECT work, arg_max(verdict, struct_pack(s := score, i := -id)) AS parser, max(score) AS score FROM log GROUP BY work")
def best_parse(spark, sf_dir):
    return log(spark, sf_dir).groupBy("work").agg(F.max_by("verdict", F.struct("score", -F.col("id"))).alias("parser"), F.max("score").alias("score"))


@query("""
WITH RECURSIVE l AS (SELECT DISTINCT 'g' || (n_nationkey % 20) AS a, 'g' || (n_nationkey * 7 % 20) AS b FROM nation WHERE n_nationkey % 4 <> 1),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT a AS i, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.i),
k AS (SELECT i, min(c) AS class FROM r GROUP BY i),
v AS (SELECT event_id, 'g' || ((props->>'$.k')::BIGINT % 23) AS generation FROM events)
SELECT now.g AS current, count(*)::BIGINT AS verdicts FROM (SELECT 'g' || i AS g FROM range(23) s(i)) now LEFT JOIN k x ON x.i = now.g JOIN v ON v.generation = now.g OR v.generation IN (SELECT i FROM k WHERE k.class = x.class) GROUP BY 1""")
def equivalent_generations(spark, sf_dir):
    """Verdicts that answer each generation: its own and those of generations declared equivalent, in any number of steps."""
    n = F.col("n_nationkey")
    pairs = table(spark, sf_dir, "nation").where(n % 4 != 1).select(F.concat(F.lit("g"), n % 20).alias("a"), F.concat(F.lit("g"), n * 7 % 20).alias("b"))
    classes = claims.generation_classes(pairs)
    counts = log(spark, sf_dir).groupBy(F.concat(F.lit("g"), F.col("claim") % 23).alias("generation")).agg(F.count(F.lit(1)).alias("n"))
    known = counts.join(classes, "generation", "left").withColumn("class", F.coalesce("class", F.concat(F.lit("own "), "generation")))
    return known.select(F.col("generation").alias("current"), "class").join(known.groupBy("class").agg(F.sum("n").alias("verdicts")), "class").select("current", "verdicts")


@query("SELECT o_orderkey, spent_before::BIGINT AS spent_before, spent_before < 300000000000 AS decided FROM (SELECT o_orderkey, sum(cents) OVER (ORDER BY o_orderdate, o_orderkey) - cents AS spent_before FROM (SELECT *, floor(o_totalprice * 100)::BIGINT AS cents FROM orders))")
def budget_stop(spark, sf_dir):
    """Orders in order of their date, each decided as long as what was spent before it is below the budget."""
    cents = F.floor(F.col("o_totalprice") * 100).cast("long").alias("cents")
    works = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", cents)
    return claims.affordable(works, "cents", ["o_orderdate", "o_orderkey"], 300_000_000_000).select("o_orderkey", "spent_before", "decided")
