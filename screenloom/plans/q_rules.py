"""Queries on routing by rules and on releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import text as T
from ..sources import tables
from . import rules as R
from .registry import Registry
from .standins import BUNDLE, BUNDLE_B, COLUMNS, POOL_SQL, ROUTED_B_SQL, ROUTED_SQL, RULES_SQL, pool, routed

query = Registry()
WITH = f"WITH {ROUTED_SQL} "
BOTH = f"WITH {ROUTED_SQL}, {ROUTED_B_SQL} "


def evaluations(spark, sf_dir, bundle=BUNDLE):
    return R.evaluations(routed(spark, sf_dir, bundle))


def rule_table(spark, bundle=BUNDLE):
    return F.broadcast(R.as_table(spark, bundle))


@query(rf"WITH {POOL_SQL}, g AS (SELECT work_id, regexp_matches(title, '(?i)tion|ment') AS hit_title, regexp_matches(abstract, '(?i)tion|ment') AS hit_abstract, type IN ('en', 'fr') OR work_id % 10 = 3 AS hit_concept, work_id % 10 = 3 AS hit_json FROM p) SELECT * FROM g WHERE hit_title OR hit_abstract OR hit_concept")
def gate_scan(spark, sf_dir):
    """Works that a stem in title or abstract, or a concept, admits; concepts as lists of structs, and as JSON."""
    stem = "tion|ment"
    ident = lambda c: F.concat(F.lit(I.CONCEPT_BASE), c)
    works = tables.spread(pool(spark, sf_dir)).withColumn("concepts", F.array(F.struct(ident(F.lit("Cx")).alias("id"), F.lit(1).alias("level")), F.struct(ident(F.concat(F.lit("C"), "type")).alias("id"), F.lit(2).alias("level")), F.struct(F.when(F.col("work_id") % 10 == 3, "C3").alias("id"), F.lit(3).alias("level"))))
    works = works.withColumn("concepts_json", F.to_json("concepts"))
    hit = I.has_concept(works, "concepts", ["Cen", "Cfr", "C3"])
    hits = works.select("work_id", T.matches(F.col("title"), stem).alias("hit_title"), T.matches(F.col("abstract"), stem).alias("hit_abstract"), hit.alias("hit_concept"), I.has_concept(works, "concepts_json", ["C3"]).alias("hit_json"))
    return hits.where("hit_title OR hit_abstract OR hit_concept")


@query(f"WITH {POOL_SQL} SELECT work_id, " + ", ".join(f'({sql}) AS "{i}"' for i, (_, _, _, sql) in RULES_SQL.items()) + " FROM p")
def rule_match_matrix(spark, sf_dir):
    works, columns = COLUMNS.prepared(tables.spread(pool(spark, sf_dir)), [r.match for r in BUNDLE])
    return works.select("work_id", *[R.compile_block(r.match, columns).alias(r.id) for r in BUNDLE])


@query(WITH + ", m AS (SELECT work_id, string_agg(rule_id, '|' ORDER BY prec DESC, rule_id) AS matched_rules FROM ev JOIN rules USING (rule_id) WHERE NOT shadow GROUP BY work_id) SELECT r.work_id, r.pile, r.pending_reason, r.rule_id, r.precedence, coalesce(matched_rules, '') AS matched_rules FROM routing r LEFT JOIN m ON m.work_id = r.work_id")
def route_winner(spark, sf_dir):
    return routed(spark, sf_dir).select("work_id", "pile", "pending_reason", "rule_id", "precedence", F.array_join("live", "|").alias("matched_rules"))


@query(WITH + "SELECT work_id, rule_id, pile, pending_reason FROM routing WHERE pending_reason = 'no_text'")
def route_no_text(spark, sf_dir):
    return routed(spark, sf_dir).where("pending_reason = 'no_text'").select("work_id", "rule_id", "pile", "pending_reason")


@query(WITH + r"""SELECT r.work_id, r.rule_id, CASE r.rule_id
  WHEN 'drop-notice' THEN regexp_extract(txt, '(?i)licensed under|all rights reserved|copyright') WHEN 'drop-secret' THEN regexp_extract(txt, '(?i)token = .[0-9a-f]{40}')
  WHEN 'ask-contact' THEN regexp_extract(txt, '(?i)[a-z]@[a-z]') WHEN 'ask-french' THEN 'fields' WHEN 'skim-spanish' THEN regexp_extract(txt, '(?i)\bde los\b')
  WHEN 'skim-german' THEN regexp_extract(abstract, '(?i)\bder die\b|\bund der\b') WHEN 'skim-language' THEN 'fields' END AS evidence
  FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.rule_id IS NOT NULL""")
def match_evidence(spark, sf_dir):
    return routed(spark, sf_dir).where("rule_id IS NOT NULL").select("work_id", "rule_id", "evidence")


@query(WITH + "SELECT pile, count(*)::BIGINT AS works FROM routing GROUP BY pile")
def pile_counts(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("pile").agg(F.count(F.lit(1)).alias("works"))


@query(WITH + "SELECT rule_id, count(DISTINCT work_id)::BIGINT AS works FROM ev GROUP BY rule_id")
def rule_hits(spark, sf_dir):
    return evaluations(spark, sf_dir).groupBy("rule_id").agg(F.countDistinct("work_id").alias("works"))


@query(WITH + "SELECT rule_id FROM rules WHERE rule_id NOT IN (SELECT rule_id FROM ev)")
def inert_rules(spark, sf_dir):
    return R.as_table(spark, BUNDLE).select("rule_id").join(evaluations(spark, sf_dir).select("rule_id").distinct(), "rule_id", "left_anti")


@query(WITH + "SELECT pile, nullif(pending_reason, '') AS reason, rule_id, count(*)::BIGINT AS works, count(*) FILTER (rule_id IS NOT NULL AND pending_reason = 'no_text')::BIGINT AS won_without_text FROM routing GROUP BY ALL")
def routing_outcome(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("pile", F.nullif("pending_reason", F.lit("")).alias("reason"), "rule_id").agg(F.count(F.lit(1)).alias("works"), F.count_if(F.col("rule_id").isNotNull() & (F.col("pending_reason") == "no_text")).alias("won_without_text"))


@query(WITH + """, dom AS (SELECT work_id, CASE type WHEN 'fr' THEN 'ask-french' WHEN 'es' THEN 'skim-spanish' ELSE 'skim-german' END AS rule_id FROM p WHERE type IN ('fr', 'es', 'de'))
SELECT d.rule_id, count(DISTINCT d.work_id)::BIGINT AS works, count(DISTINCT e.work_id)::BIGINT AS matched, count(DISTINCT CASE WHEN r.pile = 'pending' THEN d.work_id END)::BIGINT AS pending, count(DISTINCT CASE WHEN r.rule_id = d.rule_id THEN d.work_id END)::BIGINT AS won
FROM dom d JOIN routing r ON r.work_id = d.work_id LEFT JOIN ev e ON e.work_id = d.work_id AND e.rule_id = d.rule_id GROUP BY d.rule_id""")
def domain_coverage(spark, sf_dir):
    works = R.match_flags(routed(spark, sf_dir), BUNDLE, COLUMNS, "domain")
    d = works.select("work_id", F.explode("domains").alias("domain"), "matched", "rule_id", "pile")
    one = lambda holds: F.countDistinct(F.when(holds, F.col("work_id")))
    return d.groupBy(F.col("domain").alias("of")).agg(F.countDistinct("work_id").alias("works"), one(F.array_contains("matched", F.col("domain"))).alias("matched"), one(F.col("pile") == "pending").alias("pending"), one(F.col("rule_id") == F.col("domain")).alias("won")).withColumnRenamed("of", "rule_id")


@query(BOTH + "SELECT a.work_id, a.pile AS pile_a, b.pile AS pile_b, a.rule_id AS rule_a, b.rule_id AS rule_b FROM routing a JOIN routing_b b USING (work_id) WHERE a.pile IS DISTINCT FROM b.pile")
def release_diff(spark, sf_dir):
    return R.route_two(tables.spread(pool(spark, sf_dir)), BUNDLE, BUNDLE_B, COLUMNS).where(~F.col("pile_a").eqNullSafe(F.col("pile_b")))


@query(WITH + "SELECT e.rule_id, e.work_id FROM ev e JOIN rules s ON s.rule_id = e.rule_id AND s.shadow WHERE NOT EXISTS (SELECT 1 FROM ev l JOIN rules r USING (rule_id) WHERE l.work_id = e.work_id AND NOT r.shadow AND (r.prec > s.prec OR (r.prec = s.prec AND r.rule_id < s.rule_id)))")
def shadow_would_win(spark, sf_dir):
    return R.unbeaten_shadows(routed(spark, sf_dir).select("work_id", "matched"), BUNDLE)


@query(BOTH + "SELECT a.pile AS was, b.pile AS becomes, count(*)::BIGINT AS works, count(*) FILTER (a.rule_id IS DISTINCT FROM b.rule_id)::BIGINT AS other_rule FROM routing a JOIN routing_b b USING (work_id) GROUP BY ALL")
def diagnose_moves(spark, sf_dir):
    both = R.route_two(tables.spread(pool(spark, sf_dir)), BUNDLE, BUNDLE_B, COLUMNS)
    return both.groupBy(F.col("pile_a").alias("was"), F.col("pile_b").alias("becomes")).agg(F.count(F.lit(1)).alias("works"), F.count_if(~F.col("rule_a").eqNullSafe(F.col("rule_b"))).alias("other_rule"))


@query(WITH + "SELECT a.rule_id AS rule_a, b.rule_id AS rule_b, count(*)::BIGINT AS works FROM ev a JOIN ev b ON a.work_id = b.work_id AND a.rule_id < b.rule_id GROUP BY ALL")
def rule_overlap(spark, sf_dir):
    m = routed(spark, sf_dir).select("matched")
    pairs = m.select(F.explode("matched").alias("rule_a"), "matched").select("rule_a", F.explode("matched").alias("rule_b")).where("rule_a < rule_b")
    return pairs.groupBy("rule_a", "rule_b").agg(F.count(F.lit(1)).alias("works"))


@query(WITH + ", x AS (SELECT work_id, max(CASE WHEN rule_id = 'skim-language' THEN 1 ELSE 0 END) AS mine, count(*) AS n FROM ev GROUP BY work_id) SELECT count(*) FILTER (mine = 1)::BIGINT AS matched, count(*) FILTER (mine = 1 AND n = 1)::BIGINT AS exclusive, count(*) FILTER (mine = 1 AND n > 1)::BIGINT AS covered FROM x")
def rule_diagnosis(spark, sf_dir):
    m = routed(spark, sf_dir).where(F.size("matched") > 0)
    mine, alone = F.array_contains("matched", "skim-language"), F.size("matched") == 1
    return m.agg(F.count_if(mine).alias("matched"), F.count_if(mine & alone).alias("exclusive"), F.count_if(mine & ~alone).alias("covered"))


@query(WITH + ", q AS (SELECT e.rule_id, count(*)::BIGINT AS n, count(*) FILTER (l.quality = 1)::BIGINT AS hits FROM ev e JOIN labels l ON l.doc_id = e.work_id GROUP BY e.rule_id) SELECT rule_id, n, hits, round(hits / n::DOUBLE, 6) AS precision, round((hits / n::DOUBLE + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(hits / n::DOUBLE * (1 - hits / n::DOUBLE) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS low, round((hits / n::DOUBLE + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(hits / n::DOUBLE * (1 - hits / n::DOUBLE) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS high FROM q")
def rule_precision(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("work_id"), "quality")
    g = evaluations(spark, sf_dir).join(labels, "work_id").groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("hits"))
    low, high = T.wilson(F.col("hits"), F.col("n"))
    return g.select("rule_id", "n", "hits", F.round(F.col("hits") / F.col("n"), 6).alias("precision"), F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query(WITH + ", m AS (SELECT work_id, bit_or(1 << rn) AS mask FROM (SELECT work_id, (CASE rule_id WHEN 'skim-spanish' THEN 0 WHEN 'skim-german' THEN 1 WHEN 'skim-language' THEN 2 END) AS rn FROM ev WHERE rule_id IN ('skim-spanish', 'skim-german', 'skim-language')) GROUP BY work_id), n AS (SELECT count(*) AS n FROM p) SELECT b.arm, count(*) FILTER (mask & (1 << b.bit) <> 0)::BIGINT AS total, count(*) FILTER (mask = 1 << b.bit)::BIGINT AS exclusive, round(1000.0 * count(*) FILTER (mask & (1 << b.bit) <> 0) / any_value(n.n), 6)::DOUBLE AS yield_per_1000 FROM m, n, (VALUES ('skim-spanish', 0), ('skim-german', 1), ('skim-language', 2)) b(arm, bit) GROUP BY b.arm")
def arm_attribution(spark, sf_dir):
    arms = ["skim-spanish", "skim-german", "skim-language"]
    by_id = {r.id: r for r in BUNDLE}
    mask = sum((F.when(R.compile_block(by_id[a].match, COLUMNS), 1 << i).otherwise(0) for i, a in enumerate(arms)), F.lit(0))
    masks = tables.spread(pool(spark, sf_dir)).select(mask.alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    out = masks.select("mask", "n", F.posexplode(F.array(*map(F.lit, arms))).alias("bit", "arm")).withColumn("b", F.expr("shiftleft(1, bit)"))
    g = out.groupBy("arm").agg(F.sum(F.when(F.col("mask").bitwiseAND(F.col("b")) != 0, F.col("n")).otherwise(0)).alias("total"), F.sum(F.when(F.col("mask") == F.col("b"), F.col("n")).otherwise(0)).alias("exclusive"), F.sum("n").alias("works"))
    return g.select("arm", "total", "exclusive", F.round(F.lit(1000.0) * F.col("total") / F.col("works"), 6).alias("yield_per_1000"))


@query(WITH + ", m AS (SELECT l.doc_id, l.quality, e.rule_id, count(*) OVER (PARTITION BY l.doc_id) AS k FROM labels l JOIN ev e ON e.work_id = l.doc_id), t AS (SELECT count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM labels) SELECT rule_id, round(count(*) FILTER (quality = 1) / any_value(pos)::DOUBLE, 6) AS recall, round(count(*) FILTER (quality = 1 AND k = 1) / any_value(pos)::DOUBLE, 6) AS unique_recall, round(count(*) FILTER (quality = 0) / any_value(neg)::DOUBLE, 6) AS false_rate FROM m, t GROUP BY rule_id")
def pattern_unique_recall(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("work_id"), "quality")
    pos, neg = labels.agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    hits = routed(spark, sf_dir).select("work_id", F.size("matched").alias("k"), F.explode("matched").alias("rule_id")).join(labels, "work_id")
    good = F.col("quality") == 1
    g = hits.groupBy("rule_id").agg(F.count_if(good).alias("a"), F.count_if(good & (F.col("k") == 1)).alias("b"), F.count_if(F.col("quality") == 0).alias("c"))
    share = lambda c, n: F.round(F.try_divide(F.col(c), F.lit(n)), 6)
    return g.select("rule_id", share("a", pos).alias("recall"), share("b", pos).alias("unique_recall"), share("c", neg).alias("false_rate"))
