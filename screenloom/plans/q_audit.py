"""Queries on extracted links: audits, set-aside files, exports and their order, samples, votes of tiers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import assembly, audit, judging
from ..sources import tables
from .registry import Registry
from .standins import EXTRACTED_SQL, LOG_SQL, POOL_SQL, ROUTED_SQL, extracted, log, pool, routed, table

query = Registry()
WITH = f"WITH {EXTRACTED_SQL}"

#: Registry types and titles of works, for non-articles.
KINDS = "CASE work_id % 8 WHEN 0 THEN 'Dataset' WHEN 1 THEN 'peer_review' WHEN 2 THEN 'data-paper' WHEN 3 THEN 'supplementary-materials' WHEN 4 THEN '' ELSE 'article' END"
TITLES = "CASE WHEN work_id % 9 = 0 THEN 'Vol. 3(2): Replication data for: ' || title_r WHEN work_id % 9 = 1 THEN 'Replication data analysis' ELSE title_r END"
BY_DOI = "CASE WHEN starts_with(doi_r, '10.6084/') THEN 'figshare_data_record' WHEN starts_with(doi_r, '10.3886/') THEN 'data_repository_deposit' WHEN contains(doi_r, '/reviews/') THEN 'peer_review_object' ELSE '' END"


@query(WITH + f", k AS (SELECT DISTINCT work_id, doi_r, {KINDS} AS kind, {TITLES} AS title FROM x WHERE position = 1), d AS (SELECT work_id, CASE WHEN {BY_DOI} <> '' THEN {BY_DOI} WHEN title LIKE 'Vol. 3(2)%' THEN 'data_repository_deposit' WHEN kind = 'Dataset' THEN 'dataset_record' WHEN kind = 'peer_review' THEN 'peer_review_object' WHEN kind = 'supplementary-materials' THEN 'supplementary_material' ELSE '' END AS reason FROM k) SELECT DISTINCT work_id, reason FROM d WHERE reason <> ''")
def reason_codes(spark, sf_dir):
    """Works that aren't studies, and why."""
    works = extracted(spark, sf_dir).where("position = 1").select("work_id", "doi_r", F.expr(KINDS).alias("kind"), F.expr(TITLES).alias("title"))
    return works.select("work_id", audit.non_article(F.col("doi_r"), F.col("title"), F.col("kind")).alias("reason")).where("reason <> ''").distinct()


DEMOTED = "CASE WHEN link_method IN ('llm_title_search', 'llm_references') AND doi_o = '' THEN 'target_pending' ELSE link_method END"
BUCKET = f"CASE WHEN m = 'screen_disagreement' THEN m WHEN {BY_DOI} <> '' THEN 'non_article' WHEN m = 'target_pending' THEN m WHEN outcome = 'not_a_replication' THEN outcome WHEN m IN ('api_error', 'no_original_found') THEN m WHEN doi_o <> '' AND lower(doi_o) = lower(doi_r) THEN 'self_link' WHEN doi_o_verification = 'mismatch' THEN 'doi_mismatch' WHEN m = 'llm_title_search' AND link_evidence LIKE 'search_confirm: clearly_not_target%' THEN 'search_link_unconfirmed' END"
PLACE = "CASE bucket WHEN 'screen_disagreement' THEN 'screen_disagreement.csv' WHEN 'non_article' THEN 'not_a_replication.csv' WHEN 'target_pending' THEN 'target_pending.csv' WHEN 'not_a_replication' THEN 'not_a_replication.csv' WHEN 'api_error' THEN 'api_error.csv' WHEN 'no_original_found' THEN 'no_original_found.csv' WHEN 'self_link' THEN 'unresolved_self_links.csv' WHEN 'doi_mismatch' THEN 'unresolved_doi_mismatch.csv' WHEN 'search_link_unconfirmed' THEN 'search_link_unconfirmed.csv' END"


@query(WITH + f", m AS (SELECT *, {DEMOTED} AS m FROM x), b AS (SELECT work_id, position, {BUCKET} AS bucket FROM m) SELECT work_id, position, bucket, {PLACE} AS destination FROM b")
def quarantine_partition(spark, sf_dir):
    """Where each extracted row belongs: the main file or the first set-aside file that fits."""
    return audit.partition(extracted(spark, sf_dir)).select("work_id", "position", "bucket", "destination")


@query(WITH + ", g AS (SELECT work_id, position, CASE WHEN link_evidence LIKE 'found%' THEN 'clearly_target' WHEN link_evidence LIKE 'search_confirm%' THEN 'clearly_not_target' ELSE '' END AS grade FROM x WHERE link_method = 'llm_title_search') SELECT * FROM g WHERE grade <> ''")
def search_grades(spark, sf_dir):
    """How sure links by search are, by the last note of their evidence."""
    return extracted(spark, sf_dir).select("work_id", "position", audit.grade().alias("grade")).where("grade <> ''")


LATE = "substr(year_o, 1, 4)::INTEGER > TRY_CAST(year_r AS INTEGER) + 1"
RANK, ORIGINALS = "TRY_CAST(original_rank AS INTEGER)", "TRY_CAST(n_originals AS INTEGER)"
#: (check, severity, condition, detail).
CHECKS = [
    ("doi_o_unverified", "BLOCKER", "doi_o_verification NOT IN ('verified', 'corrected') AND NOT (doi_o_verification = 'no_doi' AND oa_work_id_o <> '')", "'doi_o_verification=' || coalesce(nullif(doi_o_verification, ''), 'empty') || CASE WHEN doi_o_verification = 'no_doi' THEN ', no oa_work_id_o' ELSE '' END"),
    ("self_link", "BLOCKER", "doi_o <> '' AND lower(doi_o) = lower(doi_r)", "'doi_o == doi_r (' || lower(doi_o) || ')'"),
    ("self_link", "BLOCKER", "oa_work_id_o = oa_work_id_r", "'oa_work_id_o == oa_work_id_r (' || oa_work_id_o || ')'"),
    ("unresolved_stage", "BLOCKER", "outcome = 'pending' OR link_method IN ('target_pending', 'api_error', 'no_original_found')", "'outcome=' || outcome || ', link_method=' || link_method"),
    ("missing_display_field", "BLOCKER", "trim(title_r) = '' OR title_o = ''", "'empty: ' || concat_ws(', ', CASE WHEN trim(title_r) = '' THEN 'title_r' END, CASE WHEN title_o = '' THEN 'title_o' END)"),
    ("original_postdates_replication", "WARNING", LATE, "'year_o=' || substr(year_o, 1, 4) || ' > year_r=' || year_r || ' + 1'"),
    ("outcome_not_canonical", "WARNING", "outcome = 'odd'", "'outcome=odd'"),
    ("quote_source_count_mismatch", "WARNING", "position = 5", "'outcome_phrase has 2 passage(s) but out_quote_source names 1 source(s)'"),
    ("quote_source_count_mismatch", "WARNING", "position = 2", "'outcome_robustness_quote has 1 passage(s) but out_quote_robust_source names 2 source(s)'"),
    ("quote_not_in_abstract", "WARNING", "position % 4 = 1", "'outcome_phrase not found in abstract_r'"),
    ("quote_not_in_abstract", "WARNING", "position = 3", "'outcome_computational_quote not found in abstract_r'"),
    ("low_link_confidence", "WARNING", "link_confidence = 'low'", "'link_confidence=low'"),
    ("low_outcome_confidence", "WARNING", "outcome_confidence = 'low'", "'outcome_confidence=low'"),
    ("duplicate_pair_id", "BLOCKER", "pair_id IN (SELECT pair_id FROM x GROUP BY pair_id HAVING count(*) > 1)", "'pair_id ' || pair_id || ' in ' || (SELECT count(*) FROM x y WHERE y.pair_id = x.pair_id) || ' rows'"),
    ("multi_original_inconsistent", "WARNING", f"doi_r IN (SELECT doi_r FROM x GROUP BY doi_r HAVING NOT coalesce(count({RANK}) = count(*) AND count(DISTINCT {RANK}) = count(*) AND min({RANK}) = 1 AND max({RANK}) = count(*) AND min({ORIGINALS}) = count(*) AND max({ORIGINALS}) = count(*), false))", "'ranks or n_originals don''t fit the ' || (SELECT count(*) FROM x y WHERE y.doi_r = x.doi_r) || ' row(s) of ' || lower(doi_r)"),
]
FINDINGS_SQL = WITH + ", f AS (" + " UNION ALL ".join(f"SELECT pair_id, doi_r, '{c}' AS \"check\", '{s}' AS severity, {d} AS detail FROM x WHERE {w}" for c, s, w, d in CHECKS) + ")"


@query(FINDINGS_SQL + " SELECT * FROM f")
def audit_findings(spark, sf_dir):
    """Every finding of every extracted row, with its detail; ratios of passages are left out, as SQL has none."""
    return audit.audit(extracted(spark, sf_dir), ratios=False)


@query(FINDINGS_SQL + " SELECT DISTINCT pair_id FROM f WHERE severity = 'BLOCKER'")
def blocked_pairs(spark, sf_dir):
    return audit.blocking(extracted(spark, sf_dir))


@query(FINDINGS_SQL + f""", m AS (SELECT *, {DEMOTED} AS m FROM x), b AS (SELECT {BUCKET} AS bucket FROM m)
SELECT "check" AS concern, count(*)::BIGINT AS rows FROM f GROUP BY 1 UNION ALL SELECT 'set aside: ' || bucket, count(*)::BIGINT FROM b WHERE bucket IS NOT NULL GROUP BY 1
UNION ALL SELECT * FROM (SELECT 'empty title_r', count(*)::BIGINT AS n FROM x WHERE trim(title_r) = '' UNION ALL SELECT 'empty title_o', count(*)::BIGINT FROM x WHERE title_o = '' UNION ALL SELECT 'unreadable year_r', count(*)::BIGINT FROM x WHERE year_r = 'n.d.') WHERE n > 0""")
def concern_list(spark, sf_dir):
    return audit.concerns(extracted(spark, sf_dir))


@query(WITH + " SELECT work_id, position, row_number() OVER (PARTITION BY work_id ORDER BY coalesce(TRY_CAST(original_rank AS INTEGER), position + 1), position)::BIGINT AS place FROM x")
def export_order(spark, sf_dir):
    """The place of each row among its work's rows in an export."""
    place = F.row_number().over(Window.partitionBy("work_id").orderBy(*assembly.total_order()[1:]))
    return extracted(spark, sf_dir).select("work_id", "position", place.cast("long").alias("place"))


@query(WITH + " SELECT work_id, position, TRY_CAST(year_r AS INTEGER) IS NOT NULL AND TRY_CAST(year_o AS DOUBLE) > TRY_CAST(year_r AS INTEGER) AS after, coalesce(abs(TRY_CAST(TRY_CAST(year_o AS DOUBLE) AS INTEGER) - TRY_CAST(year_r AS INTEGER)) <= 1, true) AS agrees FROM x")
def published_after(spark, sf_dir):
    """Originals that appeared after the work that names them, and those whose years agree within one."""
    return extracted(spark, sf_dir).select("work_id", "position", T.published_after(F.col("year_o"), F.col("year_r")).alias("after"), T.years_agree(F.col("year_o"), F.col("year_r")).alias("agrees"))


@query(WITH + " SELECT count(*) FILTER (regexp_matches(year_o, '^[0-9]+\\.0$'))::BIGINT AS float_years, count(*) FILTER (year_r = 'n.d.')::BIGINT AS passed_through FROM x")
def float_years(spark, sf_dir):
    """Years that an export refuses, and those that pass through as they are."""
    rows = extracted(spark, sf_dir)
    return rows.agg(F.count_if(F.col("year_o").rlike(r"\A[0-9]+\.0\z")).alias("float_years"), F.count_if((T.year_text(F.col("year_r")) == F.col("year_r")) & T.year_number(F.col("year_r")).isNull()).alias("passed_through"))


@query("WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY md5('11:' || doc_id), doc_id) AS n FROM documents) SELECT CASE WHEN n <= 40 THEN 'dev' ELSE 'holdout' END AS draw, doc_id AS work_id FROM d WHERE n <= 70")
def disjoint_draws(spark, sf_dir):
    return assembly.draws(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id")), "work_id", "11", {"dev": 40, "holdout": 30})


@query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) END, '') AS segment, coalesce(CASE WHEN c_acctbal < 0 THEN '-' END, '') AS name FROM customer WHERE c_nationkey % 2 = 0 OR c_acctbal < 0")
def version_patch(spark, sf_dir):
    """The changed columns between two versions of a row."""
    before = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    after = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, "-").otherwise(F.col("c_name")).alias("c_name"), F.when(F.col("c_nationkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    changes = assembly.patches(before, after, "c_custkey")
    return changes.select("c_custkey", *[F.coalesce(F.try_element_at("patch", F.lit(c)), F.lit("")).alias(n) for c, n in (("c_mktsegment", "segment"), ("c_name", "name"))])


TARGETS_SQL = LOG_SQL + ", t AS (SELECT work AS work_id, claim % 3 AS stage, id AS position, CASE WHEN claim % 4 = 0 THEN NULL ELSE 'k' || claim % 6 END AS key, verdict <> 'view' AS settled, verdict AS outcome FROM log WHERE claim % 4 <> 0 AND claim < 40)"


@query(f"WITH {TARGETS_SQL}, g AS (SELECT work_id, key, arg_max(position, (stage, position)) AS last, arg_max(outcome, (settled, stage, position)) AS outcome, bool_or(settled) AS settled FROM t GROUP BY ALL) SELECT work_id, key, last AS position, settled, outcome FROM g")
def target_union(spark, sf_dir):
    """Targets of several readings, one row each: the last reading, with the last settled outcome."""
    rows = log(spark, sf_dir).where("claim % 4 <> 0 AND claim < 40").select(F.col("work").alias("work_id"), (F.col("claim") % 3).alias("stage"), F.col("id").alias("position"), F.concat(F.lit("k"), F.col("claim") % 6).alias("key"), F.lit(None).cast("string").alias("doi"), (F.col("verdict") != "view").alias("settled"), F.col("verdict").alias("outcome"))
    return assembly.union_targets(rows).select("work_id", "key", "position", "settled", "outcome")


@query("""WITH w AS (SELECT o_orderkey AS work_id, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '10.1/' || o_orderkey END AS doi_r, o_orderpriority AS ending FROM orders),
t AS (SELECT l_orderkey AS work_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rank, count(*) OVER (PARTITION BY l_orderkey) AS n, CASE WHEN l_partkey % 4 = 0 THEN '' ELSE '10.2/' || l_partkey END AS doi, l_partkey AS work, l_returnflag AS outcome FROM lineitem WHERE l_linenumber <= 2 AND l_quantity > 10)
SELECT w.work_id, md5(CASE WHEN doi_r <> '' THEN doi_r ELSE 'oa:W' || w.work_id END || '|' || CASE WHEN coalesce(doi, '') <> '' THEN doi WHEN n > 1 THEN 'oa:W' || work ELSE '' END) AS pair_id,
  coalesce(doi, '') AS doi_o, CASE WHEN n IS NULL THEN ending ELSE 'llm_references' END AS link_method, coalesce(outcome, '') AS outcome, coalesce(rank, 1)::BIGINT AS original_rank, coalesce(n, 1)::BIGINT AS n_originals
FROM w LEFT JOIN t ON t.work_id = w.work_id""")
def row_assembly(spark, sf_dir):
    """A row per target of each work, and one for works without any."""
    none = F.lit(None).cast("string")
    works = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("10.1/"), "o_orderkey")).alias("doi_r"), F.concat(F.lit("W"), "o_orderkey").alias("oa_work_id_r"), none.alias("title_r"), none.alias("record_type"), F.col("o_orderpriority").alias("ending"), none.alias("error"))
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2 AND l_quantity > 10")
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    targets = lines.select(F.col("l_orderkey").alias("work_id"), rank.alias("rank"), F.when(F.col("l_partkey") % 4 == 0, "").otherwise(F.concat(F.lit("10.2/"), "l_partkey")).alias("doi"), F.concat(F.lit("W"), "l_partkey").alias("openalex_id"), none.alias("title"), none.alias("year"), F.lit("llm_references").alias("method"), F.lit("high").alias("confidence"), none.alias("evidence"), F.col("l_returnflag").alias("outcome"))
    return assembly.assemble(works, targets).select("work_id", "pair_id", "doi_o", "link_method", "outcome", "original_rank", "n_originals")


BYPASS = "CASE WHEN source = 'src7' THEN 'curated' WHEN length(trim(abstract, ' ' || chr(9) || chr(10) || chr(13))) < 200 THEN 'short text' WHEN regexp_matches(txt, '(?i)\\bthat the\\b') THEN 'signal' END"


def bypassed(spark, sf_dir):
    works = tables.spread(pool(spark, sf_dir))
    return works.select("work_id", judging.bypass(F.col("title"), F.col("abstract"), F.col("source"), r"\bthat the\b", ("src7",)).alias("bypass"))


@query(f"WITH {POOL_SQL} SELECT work_id, {BYPASS} AS bypass FROM p")
def screen_bypass(spark, sf_dir):
    return bypassed(spark, sf_dir)


def answers(spark, sf_dir):
    """Labels as answers: quality 0 is voter 1's no, toxic 1 voter 2's."""
    one = F.struct(F.lit(1).alias("voter"), F.when(F.col("quality") == 0, "no").otherwise("yes").alias("verdict"))
    two = F.struct(F.lit(2).alias("voter"), F.when(F.col("toxic") == 1, "no").when(F.col("doc_id") % 2 == 0, " ").otherwise("yes").alias("verdict"))
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id"), F.explode(F.array(one, two)).alias("a")).select("work_id", "a.*")


VOTES_SQL = f"b AS (SELECT p.work_id, {BYPASS} AS bypass, l.quality, l.toxic FROM p JOIN labels l ON l.doc_id = p.work_id), votes AS (SELECT work_id, 'prescreen_bypass' AS voter, 'proceed' AS verdict FROM b WHERE bypass IS NOT NULL UNION ALL SELECT work_id, '1', CASE quality WHEN 0 THEN 'no' ELSE 'yes' END FROM b WHERE bypass IS NULL UNION ALL SELECT work_id, '2', CASE WHEN toxic = 1 THEN 'no' WHEN work_id % 2 = 0 THEN 'no_answer' ELSE 'yes' END FROM b WHERE bypass IS NULL AND quality = 0), dec AS (SELECT work_id, CASE WHEN count(*) FILTER (verdict = 'no') >= 2 AND count(*) FILTER (verdict <> 'no') = 0 THEN 'discard' ELSE 'proceed' END AS outcome FROM votes GROUP BY work_id)"


def cheap_votes(spark, sf_dir):
    asked = answers(spark, sf_dir)
    return judging.cheap_judge(bypassed(spark, sf_dir).join(asked.select("work_id").distinct(), "work_id", "left_semi"), asked)


@query(f"WITH {POOL_SQL}, {VOTES_SQL} SELECT * FROM votes")
def cheap_judge(spark, sf_dir):
    """The votes that are asked for: voter 2 only where voter 1 said no, none where a work bypasses the tier."""
    return cheap_votes(spark, sf_dir)


@query(f"WITH {POOL_SQL}, {VOTES_SQL}, s AS (SELECT work_id, bool_or(verdict = 'no_answer') AS open FROM votes GROUP BY work_id) SELECT p.work_id, CASE WHEN s.open IS NULL THEN 'untouched' WHEN s.open THEN 'incomplete' ELSE 'decided' END AS state FROM p LEFT JOIN s ON s.work_id = p.work_id")
def tier_progress(spark, sf_dir):
    """How far the cheap tier is with each work."""
    return judging.progress(pool(spark, sf_dir), cheap_votes(spark, sf_dir))


@query(f"WITH {ROUTED_SQL}, {VOTES_SQL} SELECT r.pile, count(*)::BIGINT AS works FROM dec JOIN routing r ON r.work_id = dec.work_id WHERE outcome = 'discard' GROUP BY r.pile")
def would_discard(spark, sf_dir):
    """What the cheap tier would discard, by the pile that the rules chose."""
    return judging.would_discard(judging.cheap_decision(cheap_votes(spark, sf_dir)), routed(spark, sf_dir).select("work_id", "pile"))


@query(f"WITH {LOG_SQL}, v AS (SELECT work AS work_id, CASE WHEN claim % 2 = 0 THEN 'screen_cheap' ELSE 'screen_expensive' END AS tier, 'm' || id % 3 AS voter, CASE WHEN verdict IN ('error', 'view', 'click') THEN CASE WHEN claim % 2 = 0 THEN 'no' ELSE 'none' END ELSE 'yes' END AS verdict FROM log WHERE claim BETWEEN 10 AND 20), g AS (SELECT tier, work_id, count(DISTINCT voter) AS n, count(DISTINCT voter) FILTER (verdict IN ('no', 'none')) AS noes, count(*) FILTER (verdict = 'yes') AS others FROM v GROUP BY ALL) SELECT tier, work_id, CASE WHEN tier = 'screen_expensive' AND n < 2 THEN NULL WHEN others = 0 AND noes >= 2 THEN 'discard' WHEN tier = 'screen_expensive' AND others = 0 THEN 'discard' ELSE 'proceed' END AS outcome FROM g")
def tier_outcomes(spark, sf_dir):
    """Each tier's outcomes, recomputed from the permanent votes of one release's claims."""
    tier = F.when(F.col("claim") % 2 == 0, "screen_cheap").otherwise("screen_expensive")
    none = F.when(F.col("claim") % 2 == 0, "no").otherwise("none")
    rows = log(spark, sf_dir).withColumn("tier", tier).select("claim", "tier", F.col("work").alias("work_id"), F.concat(F.lit("m"), F.col("id") % 3).alias("voter"), F.when(F.col("verdict").isin("error", "view", "click"), none).otherwise("yes").alias("verdict"))
    claims = rows.select("claim", "tier", F.when(F.col("claim").between(10, 20), "r1").otherwise("r0").alias("release_id")).distinct()
    return judging.tier_outcomes(rows, claims, "r1")


MODELS = "CASE p_partkey % 7 WHEN 0 THEN 'Gemini-2.0' WHEN 1 THEN 'gpt-4.1' WHEN 2 THEN 'o3-mini' WHEN 3 THEN 'acme/Qwen-72b' WHEN 4 THEN 'mistral-large' WHEN 5 THEN ' ' ELSE 'chatgpt-4' END"


@query(f"WITH m AS (SELECT {MODELS} AS model FROM part) SELECT CASE WHEN model LIKE 'Gemini%' THEN 'gemini' WHEN model LIKE 'gpt%' OR model LIKE 'o3%' THEN 'gpt' WHEN model LIKE '%Qwen%' THEN 'qwen' WHEN model LIKE 'mistral%' THEN 'mistral' WHEN model = ' ' THEN 'none' ELSE 'other' END AS family, count(*)::BIGINT AS n FROM m GROUP BY 1")
def model_family(spark, sf_dir):
    return table(spark, sf_dir, "part").select(T.model_family(F.expr(MODELS)).alias("family")).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH m AS (SELECT p_type AS template, {MODELS} AS model FROM part) SELECT CASE WHEN template = (SELECT min(p_type) FROM part) AND model = 'gpt-4.1' THEN 'first' ELSE 'other' END AS cohort, count(*)::BIGINT AS answers FROM m GROUP BY 1")
def cohort_counts(spark, sf_dir):
    """Cached answers by cohort: the digest of the prompt's template and the model."""
    rows = table(spark, sf_dir, "part").select(F.col("p_type").alias("template"), F.expr(MODELS).alias("model"))
    first = rows.agg(F.sha2(F.min("template"), 256)).first()[0]
    return judging.cohorts(rows, {(first, "gpt-4.1"): "first"}).groupBy("cohort").agg(F.count(F.lit(1)).alias("answers"))


@query(f"WITH {POOL_SQL}, o AS (SELECT work_id, regexp_matches(abstract, '(?i)\\b(?:the|de|der)\\b') AS base, regexp_matches(abstract, '(?i)\\b(?:the|de|der)\\b[^.]*\\b(?:of|la|die)\\b') AS strict, regexp_matches(txt, '(?i)\\b(?:the|de|der|tion)\\b') AS wide FROM p) SELECT 'strict' AS option, count(*)::BIGINT AS works, count(*) FILTER (strict AND NOT base)::BIGINT AS gained, count(*) FILTER (base AND NOT strict)::BIGINT AS lost FROM o UNION ALL SELECT 'wide', count(*)::BIGINT, count(*) FILTER (wide AND NOT base)::BIGINT, count(*) FILTER (base AND NOT wide)::BIGINT FROM o")
def decision_flips(spark, sf_dir):
    """Works that another extractor's pattern would accept anew or no longer."""
    works = tables.spread(pool(spark, sf_dir).select("work_id", "title", "abstract"))
    options = {"base": ("abstract", r"\b(?:the|de|der)\b"), "strict": ("abstract", r"\b(?:the|de|der)\b[^.]*\b(?:of|la|die)\b"), "wide": ("txt", r"\b(?:the|de|der|tion)\b")}
    works = works.withColumn("txt", F.concat_ws("\n", "title", "abstract"))
    rows = works.select("work_id", F.explode(F.array(*[F.struct(F.lit(n).alias("option"), T.matches(F.col(c), p).alias("accepted")) for n, (c, p) in options.items()])).alias("o")).select("work_id", "o.*")
    return judging.decision_flips(rows)
