"""The engine's tables, made of the given ones: a pool, a rule bundle, aliases, votes and a verdict log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import tables
from . import rules as R


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as works: the title is the first line, the abstract the rest, the type the language."""
    at = F.instr("text", "\n")
    title = F.when(at > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text"))
    abstract = F.when(at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise("")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), title.alias("title"), abstract.alias("abstract"), F.col("lang").alias("type"), "source", "n_chars")


COLUMNS = R.Pool(doi=None, url=None, publication_year=None, concept_ids=None)

CONTENTS = [
    {"id": "drop-notice", "pile": "discard", "precedence": 71, "match": {"text_regex": "licensed under|all rights reserved|copyright", "abstract_missing": False}},
    {"id": "drop-secret", "pile": "discard", "precedence": 66, "match": {"text_regex": "token = .[0-9a-f]{40}", "abstract_missing": False}},
    {"id": "watch-tion", "pile": "discard", "precedence": 58, "shadow": True, "match": {"text_regex": r"\btion", "abstract_missing": False}},
    {"id": "ask-contact", "pile": "screen_expensive", "precedence": 47, "match": {"all_of": [{"text_regex": "[a-z]@[a-z]"}, {"text_regex": "[0-9]{3}"}]}},
    {"id": "ask-french", "pile": "screen_expensive", "precedence": 39, "match": {"all_of": [{"fields": {"type": ["fr"]}}, {"text_regex": r"\bde la\b"}]}, "domain": {"fields": {"type": ["fr"]}}},
    {"id": "skim-spanish", "pile": "screen_cheap", "precedence": 31, "vocabulary": "reproduction", "match": {"text_regex": r"\bde los\b"}, "domain": {"fields": {"type": ["es"]}}},
    {"id": "skim-german", "pile": "screen_cheap", "precedence": 24, "vocabulary": "replication", "match": {"abstract_regex": r"\bder die\b|\bund der\b"}, "domain": {"fields": {"type": ["de"]}}},
    {"id": "skim-language", "pile": "screen_cheap", "precedence": 15, "vocabulary": "replication", "match": {"fields": {"type": ["de", "es"]}}},
    {"id": "skim-nothing", "pile": "screen_cheap", "precedence": 6, "match": {"title_regex": "no such title in any text"}},
]
BUNDLE = R.load(CONTENTS)
#: The same with one rule's precedence changed and one rule left out.
BUNDLE_B = R.load([c | ({"precedence": 83} if c["id"] == "ask-french" else {}) for c in CONTENTS if c["id"] != "ask-contact"])


def routed(spark: SparkSession, sf_dir: str, bundle: list[R.Rule] = BUNDLE) -> DataFrame:
    return R.route(tables.spread(pool(spark, sf_dir)), bundle, COLUMNS)


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(old, canonical): works with equal texts are one, the smallest."""
    docs = table(spark, sf_dir, "documents")
    first = docs.groupBy(F.xxhash64("text").alias("h"), F.md5("text").alias("m")).agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return docs.select("doc_id", F.xxhash64("text").alias("h"), F.md5("text").alias("m")).join(first, ["h", "m"]).where("doc_id <> canonical").select(F.col("doc_id").alias("old"), "canonical")


#: Columns of links ready for validation, made of order lines: expressions that read the same in Spark and in SQL.
EXTRACTED = {
    "work_id": "l_orderkey",
    "position": "CAST(l_linenumber AS BIGINT)",
    "doi_r": "CASE WHEN l_orderkey % 41 = 0 THEN '10.6084/m9.figshare.' || CAST(l_orderkey AS STRING) WHEN l_orderkey % 43 = 0 THEN '10.7287/x.' || CAST(l_orderkey AS STRING) || '/reviews/2' WHEN l_orderkey % 47 = 0 THEN '10.3886/E' || CAST(l_orderkey AS STRING) ELSE '10.1000/r' || CAST(l_orderkey AS STRING) END",
    "doi_o": "CASE WHEN l_partkey % 13 = 0 THEN '' WHEN l_partkey % 29 = 0 THEN '10.1000/R' || CAST(l_orderkey AS STRING) ELSE '10.2000/o' || CAST(l_partkey AS STRING) END",
    "oa_work_id_r": "'W' || CAST(l_orderkey AS STRING)",
    "oa_work_id_o": "CASE WHEN l_partkey % 3 = 0 THEN '' WHEN l_partkey % 97 = 0 THEN 'W' || CAST(l_orderkey AS STRING) ELSE 'W' || CAST(l_partkey AS STRING) END",
    "doi_o_verification": "CASE WHEN l_partkey % 13 = 0 THEN 'no_doi' WHEN l_suppkey % 17 = 0 THEN 'mismatch' WHEN l_suppkey % 5 = 0 THEN 'corrected' WHEN l_suppkey % 19 = 0 THEN '' ELSE 'verified' END",
    "outcome": "CASE WHEN l_returnflag = 'A' THEN 'successful' WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linenumber = 6 THEN 'pending' WHEN l_linenumber = 7 THEN 'not_a_replication' WHEN l_linenumber = 5 THEN 'odd' ELSE 'mixed' END",
    "link_method": "CASE WHEN l_suppkey % 23 = 0 THEN 'target_pending' WHEN l_suppkey % 31 = 0 THEN 'api_error' WHEN l_suppkey % 37 = 0 THEN 'screen_disagreement' WHEN l_suppkey % 41 = 0 THEN 'no_original_found' WHEN l_suppkey % 2 = 0 THEN 'llm_title_search' ELSE 'llm_references' END",
    "link_evidence": "CASE WHEN l_suppkey % 4 = 0 THEN 'found | search_confirm: likely_target - first | search_confirm: clearly_target \u2014 same | title' WHEN l_suppkey % 6 = 0 THEN 'search_confirm: clearly_not_target \u2014 other' ELSE 'cited' END",
    "title_r": "CASE WHEN l_quantity < 3 THEN '  ' ELSE 'Study ' || CAST(l_orderkey AS STRING) END",
    "title_o": "CASE WHEN l_quantity > 49 THEN '' ELSE 'Work ' || CAST(l_partkey AS STRING) END",
    "abstract_r": "'We find  that part ' || CAST(l_partkey AS STRING) || ' was shipped. It was late.'",
    "year_r": "CASE WHEN l_tax > 0.07 THEN 'n.d.' ELSE CAST(year(l_shipdate) AS STRING) END",
    "year_o": "CAST(1990 + l_linenumber AS STRING) || CASE WHEN l_linenumber % 2 = 0 THEN '.0' ELSE '' END",
    "outcome_phrase": "CASE WHEN l_linenumber % 4 = 0 THEN 'we find that PART ' || CAST(l_partkey AS STRING) WHEN l_linenumber % 4 = 1 THEN 'nothing like it at all, whatever one may say | it was late' ELSE '' END",
    "out_quote_source": "CASE WHEN l_linenumber = 5 THEN 'abstract' WHEN l_linenumber % 4 = 1 THEN 'abstract | fulltext' ELSE 'abstract' END",
    "outcome_computational_quote": "CASE WHEN l_linenumber = 3 THEN 'quite another sentence, which nobody wrote' ELSE '' END",
    "out_quote_computational_source": "CASE WHEN l_linenumber = 3 THEN 'abstract' ELSE '' END",
    "outcome_robustness_quote": "CASE WHEN l_linenumber = 2 THEN 'It was late.' ELSE '' END",
    "out_quote_robust_source": "CASE WHEN l_linenumber = 2 THEN 'abstract | fulltext' ELSE '' END",
    "link_confidence": "CASE WHEN l_discount < 0.02 THEN 'low' ELSE 'high' END",
    "outcome_confidence": "CASE WHEN l_discount > 0.08 THEN 'low' ELSE 'high' END",
    "original_rank": "CASE WHEN l_orderkey % 53 = 0 THEN 'x' ELSE CAST(l_linenumber AS STRING) END",
    "n_originals": "CASE WHEN l_orderkey % 59 = 0 THEN '9' ELSE '' END",
}


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as extracted links; n_originals is the order's number of lines unless given.

    The lines are counted before they become links, so that no text is shuffled, and only where n_originals is asked for.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")).cast("string")
    rows = tables.spread(table(spark, sf_dir, "lineitem")).withColumn("_n", n).selectExpr(*[f"{e} AS {c}" for c, e in EXTRACTED.items()], "_n")
    return rows.withColumn("n_originals", F.coalesce(F.nullif("n_originals", F.lit("")), "_n")).withColumn("pair_id", F.md5(F.concat_ws("|", "doi_r", "doi_o"))).drop("_n")


EXTRACTED_SQL = "x0 AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in EXTRACTED.items()) + "), x AS (SELECT * REPLACE (CASE WHEN n_originals = '' THEN CAST(count(*) OVER (PARTITION BY work_id) AS STRING) ELSE n_originals END AS n_originals), md5(doi_r || '|' || doi_o) AS pair_id FROM x0)"
EXTRACTED_SQL = EXTRACTED_SQL.replace("), x AS", " FROM lineitem), x AS", 1)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as verdicts: (id, work, claim, verdict, score, at)."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("work"), F.get_json_object("props", "$.k").cast("long").alias("claim"), F.col("event_type").alias("verdict"), F.col("value").alias("score"), F.col("ts").alias("at"))


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)


BLANKS = r"\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
POOL_SQL = r"""pool AS (SELECT doc_id AS work_id, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS title,
  CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract, lang AS type, source, n_chars FROM documents),
p AS (SELECT *, title || chr(10) || abstract AS txt, NOT regexp_matches(abstract, '[^""" + BLANKS + r"""]') AS blank FROM pool)"""
RULES_SQL = {
    "drop-notice": (71, "discard", False, r"regexp_matches(txt, '(?i)licensed under|all rights reserved|copyright') AND NOT blank"),
    "drop-secret": (66, "discard", False, r"regexp_matches(txt, '(?i)token = .[0-9a-f]{40}') AND NOT blank"),
    "watch-tion": (58, "discard", True, r"regexp_matches(txt, '(?i)\btion') AND NOT blank"),
    "ask-contact": (47, "screen_expensive", False, r"regexp_matches(txt, '(?i)[a-z]@[a-z]') AND regexp_matches(txt, '[0-9]{3}')"),
    "ask-french": (39, "screen_expensive", False, r"type = 'fr' AND regexp_matches(txt, '(?i)\bde la\b')"),
    "skim-spanish": (31, "screen_cheap", False, r"regexp_matches(txt, '(?i)\bde los\b')"),
    "skim-german": (24, "screen_cheap", False, r"regexp_matches(abstract, '(?i)\bder die\b|\bund der\b')"),
    "skim-language": (15, "screen_cheap", False, "type IN ('de', 'es')"),
    "skim-nothing": (6, "screen_cheap", False, "regexp_matches(title, '(?i)no such title in any text')"),
}


def rules_sql(name: str = "rules", without: str = "", changed: dict[str, int] | None = None) -> str:
    """A CTE (rule_id, prec, pile, shadow)."""
    rows = ", ".join(f"('{i}', {(changed or {}).get(i, p)}, '{pile}', {str(sh).lower()})" for i, (p, pile, sh, _) in RULES_SQL.items() if i != without)
    return f"{name} AS (SELECT * FROM (VALUES {rows}) v(rule_id, prec, pile, shadow))"


def routed_sql(suffix: str = "", without: str = "", changed: dict[str, int] | None = None) -> str:
    """CTEs rules, ev (work_id, rule_id) and routing (work_id, rule_id, precedence, pile, pending_reason)."""
    arms = " UNION ALL ".join(f"SELECT work_id, '{i}' AS rule_id FROM p WHERE {sql}" for i, (_, _, _, sql) in RULES_SQL.items() if i != without)
    return f"""{rules_sql('rules' + suffix, without, changed)},
ev{suffix} AS ({arms}),
best{suffix} AS (SELECT e.work_id, r.*, row_number() OVER (PARTITION BY e.work_id ORDER BY r.prec DESC, r.rule_id) AS rn FROM ev{suffix} e JOIN rules{suffix} r USING (rule_id) WHERE NOT r.shadow),
routing{suffix} AS (SELECT p.work_id, b.rule_id, b.prec AS precedence, CASE WHEN b.pile IS NULL OR (b.pile LIKE 'screen%' AND p.blank) THEN 'pending' ELSE b.pile END AS pile,
  CASE WHEN b.pile LIKE 'screen%' AND p.blank THEN 'no_text' ELSE '' END AS pending_reason
  FROM p LEFT JOIN best{suffix} b ON b.work_id = p.work_id AND b.rn = 1)"""


ROUTED_SQL = f"{POOL_SQL}, {routed_sql()}"
ROUTED_B_SQL = routed_sql("_b", "ask-contact", {"ask-french": 83})
LOG_SQL = "log AS (SELECT event_id AS id, user_id AS work, (props->>'$.k')::BIGINT AS claim, event_type AS verdict, value AS score, ts AS tm FROM events)"
ALIAS_SQL = "alias AS (SELECT d.doc_id AS old, m.canonical FROM documents d JOIN (SELECT text, min(doc_id) AS canonical FROM documents GROUP BY text HAVING count(*) > 1) m ON m.text = d.text WHERE d.doc_id <> m.canonical)"
