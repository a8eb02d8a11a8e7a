"""Queries on works: aliases, overlays, exports, worklists, sets and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identifiers
from ..functions import text as T
from ..operators import folds, linking
from ..sources import tables
from . import rules as R
from .registry import Registry
from .standins import ALIAS_SQL, POOL_SQL, ROUTED_SQL, aliases, pool, rounded, routed, table

query = Registry()


@query(f"WITH {ALIAS_SQL} SELECT l.doc_id AS work_id, coalesce(a.canonical, l.doc_id) AS canonical_id FROM labels l LEFT JOIN alias a ON a.old = l.doc_id")
def alias_resolve(spark, sf_dir):
    works = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id"), F.col("doc_id").alias("canonical_id"))
    return folds.resolve_alias(works, aliases(spark, sf_dir), "canonical_id").select("work_id", "canonical_id")


@query(f"WITH {ALIAS_SQL} SELECT coalesce(a.canonical, d.doc_id) AS work_id, arg_min(d.source, d.doc_id) AS source, count(*)::BIGINT AS arrivals FROM documents d LEFT JOIN alias a ON a.old = d.doc_id GROUP BY 1")
def first_writer_wins(spark, sf_dir):
    # arrival: by file and row, as the pool is read
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"), "source")
    rows = folds.resolve_alias(rows, aliases(spark, sf_dir), "work_id")
    first = folds.first_by(rows, ["work_id"], ["file_name", "row_index"])
    return first.join(rows.groupBy("work_id").agg(F.count(F.lit(1)).alias("arrivals")), "work_id").select("work_id", "source", "arrivals")


OVERLAY_SQL = "ov AS (SELECT item_id AS work_id, CASE WHEN length(text) < 200 THEN '' ELSE text END AS abstract FROM benchmark)"


def overlay_rows(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("work_id"), F.when(F.length("text") < 200, "").otherwise(F.col("text")).alias("abstract"))


@query(f"WITH {POOL_SQL}, {OVERLAY_SQL} SELECT p.work_id, md5(CASE WHEN length(o.abstract) > 0 THEN o.abstract ELSE p.abstract END) AS abstract_md5 FROM p LEFT JOIN ov o ON o.work_id = p.work_id")
def overlay_apply(spark, sf_dir):
    return folds.overlay(pool(spark, sf_dir).select("work_id", "abstract"), overlay_rows(spark, sf_dir), "work_id", "abstract").select("work_id", F.md5("abstract").alias("abstract_md5"))


@query("SELECT user_id AS work_id, count(DISTINCT event_type)::BIGINT AS chunks, count(*)::BIGINT AS rows FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1")
def overlay_validate(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("work_id")).agg(F.countDistinct("event_type").alias("chunks"), F.count(F.lit(1)).alias("rows")).where("chunks > 1")


@query(f"WITH {ROUTED_SQL}, {ALIAS_SQL} SELECT r.work_id, r.pile, r.rule_id, p.source, 'engine:' || r.rule_id AS filter_method FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.pile IN ('screen_cheap', 'screen_expensive') AND r.work_id NOT IN (SELECT old FROM alias)")
def pile_export(spark, sf_dir):
    rows = folds.resolve_alias(routed(spark, sf_dir).withColumn("arrival", F.col("work_id")), aliases(spark, sf_dir), "work_id")
    one = folds.first_by(rows.select("work_id", "arrival", "pile", "rule_id", "source"), ["work_id"], ["arrival"])
    return one.where(F.col("pile").isin(*R.SCREENS)).select("work_id", "pile", "rule_id", "source", F.concat(F.lit("engine:"), "rule_id").alias("filter_method"))


@query(f"WITH {ROUTED_SQL} SELECT r.work_id, p.title, p.blank FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.pile = 'pending' AND r.pending_reason = 'no_text' UNION SELECT r.work_id, p.title, p.blank FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.pile LIKE 'screen%' AND p.source = 'src1'")
def backfill_worklist(spark, sf_dir):
    r = routed(spark, sf_dir)
    pending = r.where("pile = 'pending' AND pending_reason = 'no_text'")
    admitted = r.where(F.col("pile").isin(*R.SCREENS) & (F.col("source") == "src1"))
    return pending.unionByName(admitted).select("work_id", "title", T.is_blank(F.col("abstract")).alias("blank")).distinct()


@query("SELECT d.doc_id AS work_id, md5(coalesce(b.text, p.url, d.source)) AS value_md5, CASE WHEN b.text IS NOT NULL THEN 'benchmark' WHEN p.url IS NOT NULL THEN 'pages' ELSE 'documents' END AS provider FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id")
def source_priority_coalesce(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), "source")
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("work_id"), F.col("text").alias("b"))
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("work_id"), "url")
    return d.join(b, "work_id", "left").join(p, "work_id", "left").select("work_id", F.md5(F.coalesce("b", "url", "source")).alias("value_md5"), F.when(F.col("b").isNotNull(), "benchmark").when(F.col("url").isNotNull(), "pages").otherwise("documents").alias("provider"))


@query(f"WITH {POOL_SQL} SELECT work_id AS openalex_id_r, title AS title_r, abstract AS abstract_r, '' AS doi_r, source AS journal_r, 'pool' AS source FROM p")
def candidate_projection(spark, sf_dir):
    return pool(spark, sf_dir).select(F.col("work_id").alias("openalex_id_r"), F.col("title").alias("title_r"), F.col("abstract").alias("abstract_r"), F.lit("").alias("doi_r"), F.col("source").alias("journal_r"), F.lit("pool").alias("source"))


@query(f"""WITH {ROUTED_SQL}, d AS (SELECT doc_id AS work_id, doc_id % 3 <> 0 AS expensive, quality = 1 AS proceeds, CASE WHEN toxic = 1 THEN 'reproduction' ELSE '' END AS kind FROM labels)
SELECT r.work_id, r.pile, CASE r.pile WHEN 'screen_expensive' THEN 1 ELSE 2 END::INTEGER AS pile_order, CASE WHEN d.expensive THEN 'proceed' ELSE '' END AS screen_verdict, CASE WHEN d.expensive AND d.kind <> '' THEN d.kind ELSE 'needs_review' END AS paper_type, CASE WHEN d.expensive AND d.kind <> '' THEN 'screen' ELSE 'engine' END AS filter_method
FROM routing r LEFT JOIN d ON d.work_id = r.work_id WHERE r.pile LIKE 'screen%' AND (d.proceeds IS NULL OR d.proceeds)""")
def handoff(spark, sf_dir):
    """Routed works with what the screens decided, in order of their piles; discarded ones dropped, types of the screen before the paper's."""
    labels = table(spark, sf_dir, "labels")
    rows = routed(spark, sf_dir).select("work_id", "pile", F.lit("needs_review").alias("paper_type"), F.lit("engine").alias("filter_method"))
    votes = F.lit(None).cast("array<struct<model:string,classification:string,confident:boolean,quote:string>>")
    decisions = labels.select(F.col("doc_id").alias("work_id"), F.when(F.col("doc_id") % 3 == 0, "cheap").otherwise("expensive").alias("tier"), F.when(F.col("quality") == 1, "proceed").otherwise("discard").alias("outcome"), F.when(F.col("toxic") == 1, "reproduction").otherwise("").alias("record_type"), votes.alias("votes"))
    return linking.hand_on(rows, decisions).select("work_id", "pile", "pile_order", "screen_verdict", "paper_type", "filter_method")


@query("SELECT doc_id AS work_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT item_id FROM benchmark) AND source NOT IN (SELECT 'src' || n_nationkey FROM nation WHERE n_regionkey = 0)")
def worklist_subtract(spark, sf_dir):
    works = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), "source")
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id"))
    held = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("work_id"))
    skip = table(spark, sf_dir, "nation").where("n_regionkey = 0").select(F.concat(F.lit("src"), "n_nationkey").alias("source"))
    return folds.without(works, [(done, "work_id"), (held, "work_id"), (skip, "source")]).select("work_id", "source")


@query("SELECT c_custkey, c_name FROM customer WHERE lower(trim(c_name)) IN (SELECT lower(trim('Customer#' || lpad(o_custkey::VARCHAR, 9, '0'))) FROM orders WHERE o_orderpriority = '1-URGENT')")
def known_item_semi(spark, sf_dir):
    key = lambda c: F.lower(F.trim(c))
    known = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(key(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("k"))
    return table(spark, sf_dir, "customer").withColumn("k", key(F.col("c_name"))).join(known, "k", "left_semi").select("c_custkey", "c_name")


@query("SELECT 'customer' AS stage, c_nationkey AS nation, count(*)::BIGINT AS n, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::BIGINT AS negative FROM customer GROUP BY 2 UNION ALL SELECT 'supplier', s_nationkey, count(*)::BIGINT, sum(CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END)::BIGINT FROM supplier GROUP BY 2")
def tagged_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("stage"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"), "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("stage"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal"))
    return c.unionByName(s, allowMissingColumns=True).groupBy("stage", "nation").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("bal") < 0, 1).otherwise(0)).alias("negative"))


@query("SELECT DISTINCT k FROM (SELECT unnest(string_split('10.1/n' || c_nationkey || ';10.1/s' || lower(c_mktsegment), ';')) AS k FROM customer UNION ALL SELECT '10.17605/osf.io/' || lpad((c_custkey % 97)::VARCHAR, 5, 'a') FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT lower('part ' || p_brand || ', ' || p_type) FROM part UNION ALL SELECT '10.1/n' || p_size FROM part)")
def skip_key_union(spark, sf_dir):
    """Keys of works to skip from cells with several DOIs, addresses of pages, and cells that a comma doesn't divide."""
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    cells = c.select(F.concat(F.lit("10.1/N"), "c_nationkey", F.lit(", 10.1/s"), "c_mktsegment").alias("ids"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://osf.io/"), F.lpad((F.col("c_custkey") % 97).cast("string"), 5, "a"), F.lit("/?view"))).otherwise("https://x.org").alias("url"))
    parts = p.select(F.concat(F.lit("part "), "p_brand", F.lit(", "), "p_type").alias("name"), F.concat(F.lit("https://doi.org/10.1/n"), "p_size").alias("doi"))
    return identifiers.skip_keys([(cells, ["ids"], ["url"]), (parts, ["name", "doi"], [])]).select(F.col("key").alias("k"))


@query("SELECT k, arg_min(src, pri) AS provider, min(pri)::BIGINT AS priority FROM (SELECT doc_id AS k, 'labels' AS src, 0 AS pri FROM labels UNION ALL SELECT item_id, 'benchmark', 1 FROM benchmark UNION ALL SELECT page_id, 'pages', 2 FROM pages) GROUP BY k")
def priority_union(spark, sf_dir):
    part = lambda name, key, p: table(spark, sf_dir, name).select(F.col(key).alias("k"), F.lit(name).alias("provider"), F.lit(p).cast("long").alias("priority"))
    rows = part("labels", "doc_id", 0).unionByName(part("benchmark", "item_id", 1)).unionByName(part("pages", "page_id", 2))
    return folds.first_by(rows, ["k"], ["priority"])


@query("SELECT doc_id AS work_id, quality, coalesce(b.text, d.text) = b.text AS from_benchmark FROM labels l JOIN documents d USING (doc_id) LEFT JOIN benchmark b ON b.item_id = l.doc_id")
def labelled_set_build(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id"), "quality")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), "text")
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("work_id"), F.col("text").alias("b"))
    return labels.join(docs, "work_id").join(bench, "work_id", "left").select("work_id", "quality", (F.coalesce("b", "text") == F.col("b")).alias("from_benchmark"))


@query("(SELECT 'missing' AS side, c_nationkey AS nation, c_mktsegment AS segment, n::BIGINT AS n FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0 EXCEPT ALL SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 1000) GROUP BY ALL)) UNION ALL (SELECT 'extra', c_nationkey, c_mktsegment, n::BIGINT FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 1000 EXCEPT ALL SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0) GROUP BY ALL))")
def multiset_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cols = [F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")]
    a, b = c.where("c_acctbal > 0").select(*cols), c.where("c_acctbal > 1000").select(*cols)
    side = lambda name, x, y: x.exceptAll(y).groupBy("nation", "segment").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "nation", "segment", "n")
    return side("missing", a, b).unionByName(side("extra", b, a))


@query("SELECT doc_id AS work_id, md5(text) AS text_md5, source FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT doc_id) > 1)")
def duplicate_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.md5("text").alias("text_md5"), "source")
    groups = docs.groupBy("text_md5").agg(F.countDistinct("work_id").alias("n")).where("n > 1")
    return docs.join(groups, "text_md5", "left_semi").select("work_id", "text_md5", "source")


@query("SELECT d.doc_id AS old_id, m.canonical FROM documents d JOIN (SELECT text, arg_min(doc_id, struct_pack(r := CASE WHEN source LIKE 'src1%' THEN 1 ELSE 0 END, i := doc_id)) AS canonical FROM documents GROUP BY text HAVING count(*) > 1) m USING (text) WHERE d.doc_id <> m.canonical")
def canonical_alias(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("m"), F.col("source").startswith("src1").cast("int").alias("repository"))
    best = docs.groupBy("m").agg(F.min_by("doc_id", F.struct("repository", "doc_id")).alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return docs.join(best, "m").where("doc_id <> canonical").select(F.col("doc_id").alias("old_id"), "canonical")


@query("SELECT md5(text) AS group_id, count(*)::BIGINT AS members, count(DISTINCT lang)::BIGINT AS langs, count(DISTINCT source)::BIGINT AS sources, CASE WHEN count(DISTINCT lang) > 1 THEN 'language disagrees' WHEN count(DISTINCT source) > 1 THEN 'source disagrees' ELSE 'merge' END AS outcome FROM documents GROUP BY text HAVING count(*) > 1")
def alias_refusals(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("group_id")).agg(F.count(F.lit(1)).alias("members"), F.countDistinct("lang").alias("langs"), F.countDistinct("source").alias("sources")).where("members > 1")
    return g.withColumn("outcome", F.coalesce(T.first_reason([("language disagrees", F.col("langs") > 1), ("source disagrees", F.col("sources") > 1)]), F.lit("merge")))


@query("WITH v AS (SELECT p_partkey, p_brand AS base, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS ver FROM part) SELECT p_partkey, base, ver FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY (ver IS NULL) DESC, ver DESC, p_partkey) AS n, count(ver) OVER (PARTITION BY base) AS c FROM v) WHERE n = 1 OR c = 0")
def version_dedup(spark, sf_dir):
    v = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("base"), F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("ver"))
    # the first row and the number of versions of each base; only bases without any are joined back to their rows
    first = F.min_by(F.struct("p_partkey", "ver"), F.struct(F.col("ver").isNotNull(), -F.coalesce("ver", F.lit(0)), "p_partkey"))
    bases = v.groupBy("base").agg(first.alias("one"), F.count("ver").alias("c"))
    rest = v.join(bases.where("c = 0").select("base"), "base", "left_semi")
    return bases.where("c > 0").select("one.p_partkey", "base", "one.ver").unionByName(rest.select("p_partkey", "base", "ver"))


@query("SELECT p.doc_id AS url_key, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.quality = 0 THEN 'not done' WHEN l.toxic <> p.len % 2 THEN 'changed' END AS why FROM (SELECT doc_id, length(text) AS len FROM documents) p LEFT JOIN labels l ON l.doc_id = p.doc_id WHERE l.doc_id IS NULL OR l.quality = 0 OR l.toxic <> p.len % 2")
def incremental_targets(spark, sf_dir):
    manifest = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), (F.length("text") % 2).cast("long").alias("content_length"))
    ledger = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("url"), F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status"), F.col("toxic").cast("long").alias("content_length"))
    todo = tables.to_scan(manifest, ledger)
    return todo.select(F.col("url").alias("url_key"), F.when(F.col("status").isNull(), "new").when(F.col("status") != "done", "not done").otherwise("changed").alias("why"))


@query("SELECT substr(md5(doc_id::VARCHAR), 1, 2) AS shard, count(*)::BIGINT AS keys FROM documents GROUP BY 1")
def hash_shard_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 2).alias("shard")).agg(F.count(F.lit(1)).alias("keys"))


@query("SELECT doc_id AS work_id, md5('7:' || doc_id) AS draw FROM documents ORDER BY draw, work_id LIMIT 50")
def seeded_sample(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.md5(F.concat(F.lit("7:"), "doc_id")).alias("draw")).orderBy("draw", "work_id").limit(50)


@query("SELECT doc_id AS work_id, CASE WHEN ascii(right(md5(doc_id::VARCHAR), 1)) IN (48, 50, 52, 54, 56, 97, 99, 101) THEN 'dev' ELSE 'test' END AS split FROM documents")
def hash_split(spark, sf_dir):
    parity = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 32, 1), 16, 10).cast("int") % 2
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.when(parity == 0, "dev").otherwise("test").alias("split"))


@query("WITH h AS (SELECT p, list(h ORDER BY h) AS hs FROM (SELECT sha256(doc_id || ':' || md5(text)) AS h, substr(sha256(doc_id || ':' || md5(text)), 1, 3) AS p FROM documents) GROUP BY p) SELECT sha256(string_agg(sha256(array_to_string(hs, chr(10))), chr(10) ORDER BY p)) AS fingerprint FROM h")
def set_fingerprint(spark, sf_dir):
    return folds.content_digest(table(spark, sf_dir, "documents"), F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.md5("text")))


@query("SELECT p_partkey, p_name, p_retailprice FROM (SELECT *, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n BETWEEN 41 AND 60")
def page(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy(F.desc("p_retailprice"), "p_partkey").offset(40).limit(20).select("p_partkey", "p_name", "p_retailprice")


@query("SELECT prefix, count(*)::BIGINT AS releases, CASE WHEN count(*) = 1 THEN min(id) ELSE 'ambiguous' END AS release FROM (SELECT sha256(doc_id::VARCHAR) AS id, substr(sha256(doc_id::VARCHAR), 1, 2) AS prefix FROM documents) GROUP BY prefix")
def resolve_prefix(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("id"))
    return ids.groupBy(F.substring("id", 1, 2).alias("prefix")).agg(F.count(F.lit(1)).alias("releases"), F.when(F.count(F.lit(1)) == 1, F.min("id")).otherwise("ambiguous").alias("release"))


@query("SELECT o_orderkey, c_name, o_orderdate::DATE AS day, o_orderpriority, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) BETWEEN 1995 AND 1996 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND (contains(lower(c_name), '7') OR contains(lower(o_orderstatus), '7') OR contains(lower(c_mktsegment), '7') OR contains(lower(o_orderpriority), '7'))")
def faceted_search(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    any_text = T.either([F.contains(F.lower(c), F.lit("7")) for c in ("c_name", "o_orderstatus", "c_mktsegment", "o_orderpriority")])
    year = F.coalesce(F.year("o_orderdate"), F.lit(-1))
    return rows.where((year >= 1995) & (year <= 1996) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & any_text).select("o_orderkey", "c_name", F.to_date("o_orderdate").alias("day"), "o_orderpriority", "c_mktsegment")


@query("SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE contains(o_orderkey::VARCHAR, '88') OR contains(o_custkey::VARCHAR, '88') OR contains(lower(o_orderstatus), '88') OR contains(o_totalprice::VARCHAR, '88') OR contains(o_orderdate::VARCHAR, '88') OR contains(lower(o_orderpriority), '88')")
def free_text_search(spark, sf_dir):
    """Rows with a text in any of their columns."""
    orders = table(spark, sf_dir, "orders")
    return orders.where(T.any_contains(orders, "88")).select("o_orderkey", "o_orderstatus", "o_custkey")


PARTS = {"work_id": "p_partkey", "doi": "'https://doi.org/10.' || CAST(p_size % 4 AS STRING) || '/' || CAST(p_partkey AS STRING)", "title": "p_name", "abstract": "p_type", "url": "''", "type": "p_brand", "publication_year": "CAST(1950 + p_size AS INT)", "concepts": "'[{\"id\":\"https://x/C' || CAST(p_size AS STRING) || '\"}]'"}
CONDITIONS = R.load([
    {"id": "a-doi", "pile": "discard", "precedence": 9, "match": {"doi_prefix": "10.2"}}, {"id": "b-year", "pile": "screen_cheap", "precedence": 8, "match": {"fields": {"publication_year": [1960, 1961]}}},
    {"id": "c-concept", "pile": "screen_cheap", "precedence": 7, "match": {"fields": {"concept_ids": ["C1"]}}}, {"id": "d-none", "pile": "screen_expensive", "precedence": 6, "match": {"none_of": [{"doi_regex": "10[.]3/"}, {"fields": {"type": ["Brand#11"]}}]}},
    {"id": "e-any", "pile": "screen_cheap", "precedence": 5, "match": {"any_of": [{"doi_regex": "/1.$"}, {"all_of": [{"fields": {"publication_year": [1999]}}, {"abstract_missing": False}]}]}},
])


@query("SELECT p_partkey AS work_id, concat_ws('|', CASE WHEN p_size % 4 = 2 THEN 'a-doi' END, CASE WHEN p_size IN (10, 11) THEN 'b-year' END, CASE WHEN p_size = 1 THEN 'c-concept' END, CASE WHEN p_size % 4 <> 3 AND p_brand <> 'Brand#11' THEN 'd-none' END, CASE WHEN p_partkey BETWEEN 10 AND 19 OR (p_size = 49 AND trim(p_type) <> '') THEN 'e-any' END) AS rules FROM part")
def rule_conditions(spark, sf_dir):
    """The set of rules that each work meets, by identifiers, years, concepts and nested conditions."""
    works = table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {c}" for c, e in PARTS.items()])
    return R.match_flags(works, CONDITIONS, R.Pool()).select("work_id", F.array_join("matched", "|").alias("rules"))


SHARDS_SQL = "SELECT substr(md5(doc_id::VARCHAR), 1, 2) AS shard, md5(count(*) || ':' || sum(('0x' || substr(md5({0}), 1, 15))::BIGINT) || ':' || sum(('0x' || substr(md5({0}), 16, 15))::BIGINT)) AS digest FROM documents {1} GROUP BY 1"


@query("WITH a AS (" + SHARDS_SQL.format("source", "WHERE n_chars > 40") + "), b AS (" + SHARDS_SQL.format("CASE WHEN doc_id % 50 = 0 THEN '' ELSE source END", "") + ") SELECT coalesce(a.shard, b.shard) AS shard, CASE WHEN a.shard IS NULL THEN 'new' WHEN b.shard IS NULL THEN 'gone' ELSE 'changed' END AS why FROM a FULL JOIN b ON a.shard = b.shard WHERE a.digest IS DISTINCT FROM b.digest")
def shard_changes(spark, sf_dir):
    """Shards of a cache that differ between two versions, by digest."""
    d = table(spark, sf_dir, "documents")
    before = folds.shard_digests(d.where("n_chars > 40"), "doc_id", F.col("source"))
    return folds.changed_shards(before, folds.shard_digests(d, "doc_id", F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.col("source"))))


@query("SELECT lang, count(*)::BIGINT AS n, min(n_chars)::BIGINT AS least, round(median(n_chars), 6) AS p50, max(CASE WHEN rn = floor(0.9 * c)::BIGINT + 1 THEN n_chars END)::BIGINT AS p90, max(n_chars)::BIGINT AS most FROM (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS c FROM documents) GROUP BY lang")
def length_quantiles(spark, sf_dir):
    # by counts of each length, so that no group's rows meet in one task
    sizes = table(spark, sf_dir, "documents").groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("lang").orderBy("n_chars").rowsBetween(Window.unboundedPreceding, 0)
    upto = sizes.withColumn("upto", F.sum("k").over(w)).withColumn("c", F.sum("k").over(Window.partitionBy("lang")))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("n_chars")))
    mid = (at(F.floor((F.col("c") + 1) / 2)) + at(F.floor((F.col("c") + 2) / 2))) / 2
    return upto.groupBy("lang").agg(F.sum("k").alias("n"), F.min("n_chars").alias("least"), rounded(mid).alias("p50"), at(F.least(F.floor(F.lit(0.9) * F.col("c")) + 1, "c")).alias("p90"), F.max("n_chars").alias("most"))


@query(f"WITH {ROUTED_SQL} SELECT r.pile, count(*)::BIGINT AS works, sum(CASE WHEN r.pile = 'screen_expensive' THEN 3 ELSE 1 END * ceil(p.n_chars / 4.0))::BIGINT AS tokens, round(sum(CASE WHEN r.pile = 'screen_expensive' THEN 3 ELSE 1 END * ceil(p.n_chars / 4.0)) * 2.5 / 1000000, 6) AS cost, round(sum(CASE WHEN r.pile = 'screen_expensive' THEN 3 ELSE 1 END * ceil(p.n_chars / 4.0)) * 2.5 / 1000000 / count(*) * 100000, 4) AS cost_per_100k FROM routing r JOIN p ON p.work_id = r.work_id WHERE r.pile LIKE 'screen%' GROUP BY r.pile")
def cost_estimate(spark, sf_dir):
    rows = routed(spark, sf_dir).where(F.col("pile").isin(*R.SCREENS)).withColumn("t", F.when(F.col("pile") == "screen_expensive", 3).otherwise(1) * F.ceil(F.col("n_chars") / 4))
    g = rows.groupBy("pile").agg(F.count(F.lit(1)).alias("works"), F.sum("t").alias("tokens"))
    cost = F.col("tokens") * 2.5 / 1_000_000
    return g.select("pile", "works", "tokens", F.round(cost, 6).alias("cost"), F.round(cost / F.col("works") * 100_000, 4).alias("cost_per_100k"))


WIDTH_SQL = "CASE WHEN strlen({0}) < 127 THEN strlen({0}) + 1 ELSE strlen({0}) + 4 END"


@query("WITH w AS (SELECT source, 28 + ceil((8 + " + WIDTH_SQL.format("text") + " + " + WIDTH_SQL.format("source") + ") / 8.0) * 8 AS b FROM documents) SELECT source, count(*)::BIGINT AS rows, sum(b)::BIGINT AS heap_bytes, round(sum(b) / 1048576.0, 6)::DOUBLE AS mb FROM w GROUP BY source")
def sizing_model(spark, sf_dir):
    """Bytes that works with their texts and sources take as rows of a store."""
    size = T.heap_bytes(F.lit(8) + T.value_bytes(F.col("text")) + T.value_bytes(F.col("source")))
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum(size.cast("long")).alias("heap_bytes"), F.round(F.sum(size.cast("long")) / F.lit(1048576.0), 6).alias("mb"))


@query("SELECT source, count(*)::BIGINT AS works, count(*) FILTER (lang = 'en')::BIGINT AS english, count(*) FILTER (n_chars < 500)::BIGINT AS short, min(n_chars)::BIGINT AS least FROM documents GROUP BY source")
def pool_stats(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("works"), F.count_if(F.col("lang") == "en").alias("english"), F.count_if(F.col("n_chars") < 500).alias("short"), F.min("n_chars").alias("least"))
