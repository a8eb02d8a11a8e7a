"""Queries on linking by parsed text, permits of works and identifier classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import parse
from ..functions import text as T
from ..functions.regex import to_java
from ..operators import candidates, folds
from ..sources import tables
from . import release as L
from . import rules as R
from .registry import Registry
from .standins import BLANKS, BUNDLE, LOG_SQL, POOL_SQL, ROUTED_SQL, log, pool, rounded, routed, table

query = Registry()


#: The longest common subsequence of texts p and q: a row of its table for each character of q, in which a cell is the largest of those before it.
LCS = "list_reduce(list_prepend(list_transform(range(0, len(p) + 1), lambda i: 0), list_transform(string_split(q, ''), lambda ch: [ascii(ch)])), lambda row, ch: list_transform(range(1, len(p) + 2), lambda i: list_max(list_transform(range(1, i + 1), lambda k: CASE WHEN k > 1 AND ascii(substr(p, k - 1, 1)) = ch[1] THEN row[k - 1] + 1 ELSE row[k] END))))[-1]"
TOKEN_SQL = f"""
WITH t AS (SELECT DISTINCT 1950 + p_size AS year, p_name || ' ' || p_type AS title FROM part),
w AS (SELECT *, list_sort(list_distinct(regexp_extract_all(lower(title), '[\\w]+'))) AS ws FROM t),
c AS (SELECT x.year, x.title, y.title AS other, list_filter(x.ws, lambda v: list_contains(y.ws, v)) AS mutual, list_filter(x.ws, lambda v: NOT list_contains(y.ws, v)) AS l, list_filter(y.ws, lambda v: NOT list_contains(x.ws, v)) AS r
      FROM w x JOIN w y ON x.year = y.year AND x.title < y.title AND list_has_any(list_filter(x.ws, lambda v: len(v) >= 3), list_filter(y.ws, lambda v: len(v) >= 3))),
s AS (SELECT year, title, other, array_to_string(mutual, ' ') AS com, array_to_string(list_concat(mutual, l), ' ') AS p, array_to_string(list_concat(mutual, r), ' ') AS q FROM c),
z AS (SELECT *, greatest(200.0 * len(com) / (len(com) + len(p)), 200.0 * len(com) / (len(com) + len(q)), 200.0 * {LCS} / (len(p) + len(q))) AS ratio FROM s)
SELECT year, title, min(other) AS other, arg_min(ratio, other)::DOUBLE AS ratio FROM z WHERE ratio >= 75 GROUP BY year, title"""


@query(TOKEN_SQL)
def token_set_match(spark, sf_dir):
    """For each distinct title of a year the first other one of that year, in order, that shares a word and has nearly the same words."""
    titles = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("title"), (1950 + F.col("p_size")).alias("year")).distinct()
    words = titles.select("title", "year", F.explode(T.title_words(F.col("title"))).alias("word"))
    pairs = words.join(words.withColumnRenamed("title", "other"), ["year", "word"]).where("title < other").select("year", "title", "other").distinct()
    hits = pairs.withColumn("ratio", parse.token_set_ratio_of("title", "other")).where("ratio >= 75")
    return folds.first_by(hits, ["title", "year"], ["other"])


@query(r"SELECT item_id, md5(trim(regexp_replace(lower(regexp_replace(strip_accents(text), '([\p{L}\p{N}_])[-‐‑]\s+([\p{L}\p{N}_])', '\1\2', 'g')), '\s+', ' ', 'g'))) AS normal_md5 FROM benchmark")
def title_normal(spark, sf_dir):
    """Compatibility forms of texts in lower case, without accents and with hyphenation undone."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.md5(parse.fold_title_of("text")).alias("normal_md5"))


@query()
def quote_ratio(spark, sf_dir):
    """Works whose title is found in their whole abstract, or nearly so."""
    return tables.spread(pool(spark, sf_dir)).select("work_id", parse.quote_found_of("title", "abstract").alias("found"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part")
def citation_cleaning(spark, sf_dir):
    """Titles of raw citations that begin with a number, a conjunction now and then, and authors."""
    cited = F.concat(F.when(F.col("p_size") % 2 == 0, "and ").otherwise(F.concat(F.lit("["), F.col("p_partkey") % 1000, F.lit("] "))), F.lit("M.B. Maker, Other K., et al., "), F.initcap("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", D.clean_title(cited).alias("title"))


@query("SELECT p_partkey, p_size % 4 IN (0, 1) AS fragment, p_size % 4 = 3 AND length(p_name) >= 5 OR p_size % 4 = 2 AND length(p_name) >= 10 AS usable, CASE p_size % 4 WHEN 3 THEN 'Some ' || p_name || ' and more of it' ELSE '' END AS rest FROM part")
def citation_kinds(spark, sf_dir):
    """Which texts are pieces of citations, which can be searched for, and what stands behind an author-year citation."""
    size, name = F.col("p_size"), F.col("p_name")
    text = F.when(size % 4 == 0, F.concat(F.lit("M.B. Maker, "), name)).when(size % 4 == 1, F.concat(name, F.lit(", M.R"))).when(size % 4 == 2, name).otherwise(F.concat(F.lit("Some "), name))
    cited = F.when(size % 4 == 3, F.concat(F.lit("Maker, Other, & Third ("), 1950 + size, F.lit(", JX, Study 2) Some "), name, F.lit(" and more of it"))).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", D.is_fragment(text).alias("fragment"), D.usable_title(text).alias("usable"), D.without_citation(cited).alias("rest"))


PAPER_SQL = f"""
WITH {POOL_SQL}, t AS (SELECT work_id, title, CASE WHEN blank THEN 'none' ELSE regexp_replace(abstract, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g') END AS a FROM p),
b AS (SELECT work_id, title || chr(10) || 'Discussion' || chr(10) || a || chr(10) AS body, 'Discussion' || chr(10) || a AS block, length(title) + 1 AS pos FROM t),
o AS (SELECT *, pos >= length(body) * 0.4 AND length(block) >= 300 AS found FROM b),
x AS (SELECT work_id, CASE WHEN found THEN 'discussion' ELSE 'tail' END AS origin, CASE WHEN NOT found THEN right(body, 2000) WHEN length(block) <= 2000 THEN block
        ELSE regexp_replace(substr(block, 1, 1198), '[{BLANKS}]+$', '') || chr(10) || chr(8230) || chr(10) || regexp_replace(right(block, 799), '^[{BLANKS}]+', '') END AS s FROM o)
SELECT work_id, origin, md5(regexp_replace(s, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')) AS text_md5 FROM x"""


@query(PAPER_SQL)
def outcome_window(spark, sf_dir):
    """The part of a paper, made of a work's title and abstract, that states its verdict."""
    abstract = F.when(T.is_blank(F.col("abstract")), "none").otherwise(T.trim_all(F.col("abstract")))
    paper = F.concat("title", F.lit("\nDiscussion\n"), abstract, F.lit("\nReferences\n[1] A. Bee, Sea (1999)"))
    rows = tables.spread(pool(spark, sf_dir)).select("work_id", D.outcome_text(paper, 2000).alias("o"))
    return rows.select("work_id", "o.origin", F.md5("o.text").alias("text_md5"))


@query("SELECT p_brand, p_size, 'Maker, B.' AS authors, (1950 + p_size)::INTEGER AS year, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part")
def reference_lists(spark, sf_dir):
    """Authors, years and titles of references made of each brand's parts, one list per brand and size."""
    line = F.concat(F.lit("["), "p_partkey", F.lit("] Maker, B. ("), 1950 + F.col("p_size"), F.lit("). "), F.initcap("p_name"), F.lit("."))
    # a line is parsed by itself, so that long lists may be cut
    cut = F.pmod(F.xxhash64("p_partkey"), F.lit(16)).alias("cut")
    lists = table(spark, sf_dir, "part").groupBy("p_brand", "p_size", cut).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("block"))
    return lists.select("p_brand", "p_size", F.explode(D.references(F.col("block"))).alias("r")).select("p_brand", "p_size", "r.authors", "r.year", "r.title")


@query(f"WITH {POOL_SQL}, s AS (SELECT work_id, 'abstract' AS heading, length(trim(title, ' ' || chr(9) || chr(10) || chr(13))) AS chars FROM p UNION ALL SELECT work_id, 'methods', length(trim(abstract, ' ' || chr(9) || chr(10) || chr(13))) FROM p) SELECT work_id, heading, chars::INTEGER AS chars FROM s WHERE chars > 0")
def section_lengths(spark, sf_dir):
    text = F.concat(F.lit("Abstract\n"), "title", F.lit("\nMethods\n"), "abstract")
    s = pool(spark, sf_dir).select("work_id", F.explode(D.sections(text)).alias("s"))
    return s.select("work_id", "s.heading", F.length("s.body").alias("chars"))


@query(r"SELECT page_id, CASE WHEN regexp_matches(url, '://blog\.') THEN 'registration' WHEN regexp_matches(url, '\.html$') THEN 'other identifier' WHEN url <> '' THEN 'address only' ELSE 'none' END AS kind FROM pages")
def identifier_class(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(T.first_reason([("registration", u.rlike(to_java(r"://blog\."))), ("other identifier", u.rlike(to_java(r"\.html$"))), ("address only", u != "")]), F.lit("none")).alias("kind"))


@query(f"WITH {LOG_SQL}, m AS (SELECT DISTINCT user_id AS work FROM events WHERE event_type = 'signup' AND value > 300), k AS (SELECT work, count(*) FILTER (claim < 50) AS seen, count(*) AS n FROM log GROUP BY work) SELECT k.work, k.n::BIGINT AS records, k.seen::BIGINT AS identified, m.work IS NOT NULL AS known, CASE WHEN m.work IS NOT NULL THEN 'skip' WHEN k.seen < k.n / 2.0 THEN 'ask' ELSE 'keep' END AS action FROM k LEFT JOIN m USING (work)")
def validated_skip(spark, sf_dir):
    known = log(spark, sf_dir).where("verdict = 'signup' AND score > 300").select("work", F.lit(True).alias("known")).distinct()
    k = log(spark, sf_dir).groupBy("work").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("claim") < 50).alias("identified"))
    out = k.join(known, "work", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return out.withColumn("action", F.when(F.col("known"), "skip").when(F.col("identified") < F.col("records") / 2, "ask").otherwise("keep"))


@query(f"""WITH {ROUTED_SQL} SELECT r.work_id, CASE WHEN r.rule_id = 'skim-spanish' THEN 'reproduction' WHEN r.rule_id IN ('skim-german', 'skim-language') THEN 'replication' ELSE 'needs_review' END AS paper_type, 'engine:0123456789ab' AS filter_method,
  'rule:' || r.rule_id || '; ' || CASE r.rule_id WHEN 'ask-contact' THEN regexp_extract(txt, '(?i)[a-z]@[a-z]') WHEN 'skim-spanish' THEN regexp_extract(txt, '(?i)\\bde los\\b') WHEN 'skim-german' THEN regexp_extract(abstract, '(?i)\\bder die\\b|\\bund der\\b') ELSE 'fields' END AS filter_evidence,
  CASE WHEN r.pile = 'screen_expensive' THEN 'high' ELSE 'medium' END AS filter_confidence FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.pile LIKE 'screen%' AND 1990 + p.n_chars % 30 BETWEEN 1995 AND 2010""")
def export_status(spark, sf_dir):
    """Exported works of both screens and some years: a rule's vocabulary names their status, else the pile's."""
    works, rows = pool(spark, sf_dir).withColumn("publication_year", (1990 + F.col("n_chars") % 30).cast("int")), routed(spark, sf_dir)
    parts = [L.export_rows(works, rows, BUNDLE, pile, "0123456789abcdef", from_year=1995, to_year=2010) for pile in R.SCREENS]
    return parts[0].unionByName(parts[1]).select("work_id", "paper_type", "filter_method", "filter_evidence", "filter_confidence")


@query(f"WITH {POOL_SQL}, b AS (SELECT work_id, title, regexp_extract(title, '(?i)\\bof ([a-z]+)', 1) AS target, len(regexp_extract_all(title, '(?i)\\bthe\\b')) AS n FROM p) SELECT work_id, nullif(target, '') AS target, n::BIGINT AS studies, n > 1 AS umbrella FROM b")
def title_target(spark, sf_dir):
    """What a title says that it is about, and how many studies it counts."""
    t = F.col("title")
    n = F.size(F.regexp_extract_all("title", F.lit(to_java(r"\bthe\b")), 0))
    return pool(spark, sf_dir).select("work_id", F.nullif(F.regexp_extract(t, to_java(r"\bof ([a-z]+)"), 1), F.lit("")).alias("target"), n.cast("long").alias("studies"), (n > 1).alias("umbrella"))


HITS_SQL = """
WITH RECURSIVE h AS (SELECT c_custkey // 6 AS work, c_custkey % 6 AS place, CASE WHEN c_custkey % 3 = 0 THEN '10.1/d' || (c_custkey % 9) WHEN c_custkey % 11 = 0 THEN '10.6084/m9.x' ELSE '' END AS doi, CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN 'W' || (c_custkey % 4) ELSE '' END AS ident,
       c_mktsegment || ' of the ' || c_nationkey AS title, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'Author ' || c_nationkey END AS author, c_custkey AS id FROM customer),
w AS (SELECT DISTINCT work, '10.1/d' || (work % 9) AS doi_r, 'BUILDING of the ' || (work % 25) AS title_r, CASE WHEN work % 2 = 0 THEN 'author' WHEN work % 7 = 0 THEN '' ELSE 'others' END AS surname FROM h),
words AS (SELECT h.*, surname, doi_r, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{3,}')) AS a, list_distinct(regexp_extract_all(lower(title_r), '[a-z0-9]{3,}')) AS b FROM h JOIN w USING (work)),
fit AS (SELECT * FROM words WHERE (doi <> '' OR ident <> '') AND doi <> doi_r AND doi NOT LIKE '10.6084/%' AND len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE <= 0.9 AND (surname = '' OR author <> '')),
e AS (SELECT x.id AS i, y.id AS j FROM fit x JOIN fit y ON x.work = y.work AND (x.doi = y.doi AND x.doi <> '' OR x.ident = y.ident AND x.ident <> '')),
r AS (SELECT id AS i, id AS g FROM fit UNION SELECT e.j, r.g FROM r JOIN e ON e.i = r.i),
g AS (SELECT i, min(g) AS g FROM r GROUP BY i),
one AS (SELECT fit.*, row_number() OVER (PARTITION BY work, g ORDER BY place) AS k FROM fit JOIN g ON g.i = fit.id)
SELECT work, row_number() OVER (PARTITION BY work ORDER BY place)::INTEGER AS n, doi, ident, title, CASE place WHEN 0 THEN 'first' ELSE 'later' END AS source, CASE WHEN surname = 'others' THEN 1 ELSE 0 END::INTEGER AS n_flags FROM one WHERE k = 1"""


@query(HITS_SQL)
def title_search_candidates(spark, sf_dir):
    """Hits of several sources for a title: fit ones, one for those that share a DOI or an identifier, odd ones flagged."""
    key = F.col("c_custkey")
    hits = table(spark, sf_dir, "customer").select(
        F.floor(key / 6).alias("work"), (key % 6).cast("int").alias("place"), F.when(key % 6 == 0, "first").otherwise("later").alias("source"),
        F.when(key % 3 == 0, F.concat(F.lit("10.1/d"), key % 9)).when(key % 11 == 0, "10.6084/m9.x").alias("doi"), F.when((key % 5).isin(0, 1, 2), F.concat(F.lit("W"), key % 4)).alias("ident"),
        F.concat("c_mktsegment", F.lit(" of the "), "c_nationkey").alias("title"), F.lit(None).cast("int").alias("year"), F.when(key % 13 != 0, F.array(F.concat(F.lit("Author "), "c_nationkey"))).alias("authors"),
    )
    w = F.col("work")
    works = hits.select("work").distinct().select("work", F.concat(F.lit("10.1/D"), w % 9).alias("doi_r"), F.concat(F.lit("BUILDING of the "), w % 25).alias("title_r"), F.when(w % 2 == 0, "author").when(w % 7 == 0, "").otherwise("others").alias("surname"))
    return candidates.title_candidates(hits, works).select("work", "n", "doi", "ident", "title", "source", F.size("flags").alias("n_flags"))


@query(f"""WITH {LOG_SQL}, v AS (SELECT *, CASE verdict WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'cannot_be_determined' ELSE '' END AS axis0, CASE WHEN verdict IN ('error', 'purchase') THEN 'q' || (id % 3)::VARCHAR ELSE '' END AS quote0 FROM log),
s AS (SELECT *, CASE WHEN axis0 IN ('failure', 'success') THEN axis0 END AS settled FROM v),
q AS (SELECT work, claim, quote0, verdict, min(id) AS id FROM v WHERE quote0 <> '' GROUP BY ALL),
j AS (SELECT work, claim, string_agg(quote0, ' | ' ORDER BY id) AS quote, string_agg(verdict, ' | ' ORDER BY id) AS source FROM q GROUP BY ALL)
SELECT s.work, s.claim, min(score) AS weakest, CASE WHEN count(DISTINCT settled) > 1 THEN 'conflict' ELSE coalesce(min(settled), arg_min(axis0, id) FILTER (axis0 <> ''), '') END AS axis, coalesce(any_value(quote), '') AS quote, coalesce(any_value(source), '') AS source
FROM s LEFT JOIN j ON j.work = s.work AND j.claim = s.claim GROUP BY s.work, s.claim""")
def axis_fold(spark, sf_dir):
    """One axis of several rows: their value, `conflict` where they differ, and the quotes behind it in order, each once."""
    value = F.when(F.col("verdict") == "error", "failure").when(F.col("verdict") == "purchase", "success").when(F.col("verdict") == "click", folds.UNSETTLED)
    quote = F.when(F.col("verdict").isin("error", "purchase"), F.concat(F.lit("q"), F.col("id") % 3))
    rows = log(spark, sf_dir).select("work", "claim", "id", "score", value.alias("axis"), quote.alias("quote"), F.col("verdict").alias("source"))
    folded = folds.fold_axes(rows, ["work", "claim"], ["id"], {"axis": ("conflict", "quote", "source")}, once=True)
    return folded.join(rows.groupBy("work", "claim").agg(F.min("score").alias("weakest")), ["work", "claim"])


@query("SELECT c.c_mktsegment AS segment, count(*)::BIGINT AS cases, sum(CASE WHEN s.s_acctbal > c.c_acctbal THEN 1 ELSE 0 END)::BIGINT AS higher FROM customer c JOIN supplier s ON s.s_suppkey = c.c_custkey GROUP BY 1")
def case_merge(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return c.join(s, c["c_custkey"] == s["s_suppkey"]).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("cases"), F.count_if(F.col("s_acctbal") > F.col("c_acctbal")).alias("higher"))
