"""Queries behind reports: counts, crosstabs, agreement, usage, quality audits and evaluations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import running
from ..sources import tables
from . import rules as R
from .registry import Registry
from .standins import BUNDLE, COLUMNS, LOG_SQL, POOL_SQL, ROUTED_SQL, log, pool, rounded, table

query = Registry()


def n_rows():
    return F.count(F.lit(1))


@query("WITH v(k) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('9-NEVER')), c AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '9-NEVER') THEN o_orderpriority ELSE '_other' END AS k, count(*) AS n FROM orders GROUP BY 1) SELECT coalesce(v.k, c.k) AS k, coalesce(n, 0)::BIGINT AS n FROM v FULL JOIN c ON v.k = c.k")
def vocab_counts(spark, sf_dir):
    known = ["1-URGENT", "2-HIGH", "9-NEVER"]
    vocabulary = spark.createDataFrame([(k,) for k in known], "k string")
    counts = table(spark, sf_dir, "orders").groupBy(F.when(F.col("o_orderpriority").isin(known), F.col("o_orderpriority")).otherwise("_other").alias("k")).agg(n_rows().alias("n"))
    return vocabulary.join(counts, "k", "full").select("k", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT substr(y, 1, 4) AS year, count(*)::BIGINT AS n FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'n.d.' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS y FROM orders) WHERE regexp_matches(substr(y, 1, 4), '^[0-9]{4}$') GROUP BY 1")
def year_histogram(spark, sf_dir):
    y = F.substring(F.when(F.col("o_orderkey") % 11 == 0, "n.d.").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), 1, 4)
    return table(spark, sf_dir, "orders").select(y.alias("year")).where(F.col("year").rlike(r"\A[0-9]{4}\z")).groupBy("year").agg(n_rows().alias("n"))


@query("SELECT 'priority' AS what, o_orderpriority AS value, count(*)::BIGINT AS n FROM orders GROUP BY 2 UNION ALL SELECT 'status', o_orderstatus, count(*)::BIGINT FROM orders GROUP BY 2 UNION ALL SELECT 'year', year(o_orderdate)::VARCHAR, count(*)::BIGINT FROM orders GROUP BY 2")
def stage_stats(spark, sf_dir):
    cols = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").cast("string").alias("year"))
    return cols.unpivot([], ["priority", "status", "year"], "what", "value").groupBy("what", "value").agg(n_rows().alias("n"))


@query("SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS F, count(*) FILTER (o_orderstatus = 'O')::BIGINT AS O, count(*) FILTER (o_orderstatus = 'P')::BIGINT AS P FROM orders GROUP BY 1")
def axis_crosstab(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).agg(n_rows())
    return g.na.fill(0)


PAIRS_SQL = "x AS (SELECT l_returnflag AS pipe, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag ELSE CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'R' END END AS final FROM lineitem)"


def pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("pipe"), F.when(F.col("l_linenumber") % 3 == 0, F.col("l_returnflag")).when(F.col("l_linestatus") == "F", "A").otherwise("R").alias("final"))


@query(f"WITH {PAIRS_SQL} SELECT pipe, final, count(*)::BIGINT AS n, round(100.0 * sum(CASE WHEN pipe = final THEN count(*) ELSE 0 END) OVER () / sum(count(*)) OVER (), 1)::DOUBLE AS accuracy FROM x GROUP BY pipe, final")
def confusion_matrix(spark, sf_dir):
    cells = pairs(spark, sf_dir).groupBy("pipe", "final").agg(n_rows().alias("n"))
    # a window over the cells of the matrix, as many as there are pairs of labels
    whole = Window.partitionBy(F.lit(0))
    right = F.sum(F.when(F.col("pipe") == F.col("final"), F.col("n")).otherwise(0)).over(whole)
    return cells.withColumn("accuracy", F.round(F.lit(100.0) * right / F.sum("n").over(whole), 1))


@query("SELECT CASE WHEN quality IS NULL OR toxic IS NULL THEN 'one vote' WHEN quality = toxic THEN 'agree' ELSE 'disagree' END AS agreement, CASE WHEN doc_id % 5 = 0 THEN 'resolved' ELSE 'open' END AS state, count(*)::BIGINT AS n, count(*) FILTER (quality = 1)::BIGINT AS final_is_first FROM (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN quality END AS quality, toxic FROM labels) GROUP BY ALL")
def agreement_buckets(spark, sf_dir):
    v = table(spark, sf_dir, "labels").withColumn("quality", F.when(F.col("doc_id") % 7 != 0, F.col("quality")))
    bucket = F.when(F.col("quality").isNull() | F.col("toxic").isNull(), "one vote").when(F.col("quality") == F.col("toxic"), "agree").otherwise("disagree")
    return v.groupBy(bucket.alias("agreement"), F.when(F.col("doc_id") % 5 == 0, "resolved").otherwise("open").alias("state")).agg(n_rows().alias("n"), F.count_if(F.col("quality") == 1).alias("final_is_first"))


@query("SELECT c_nationkey AS nation, count(*)::BIGINT AS orders, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS done, count(DISTINCT o_orderpriority)::BIGINT AS kinds, round(CASE WHEN count(*) FILTER (o_orderstatus <> 'P') = 0 THEN 0 ELSE count(*) FILTER (o_orderstatus = 'F') / (count(*) FILTER (o_orderstatus <> 'P'))::DOUBLE END, 6) AS ratio FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def completion_kpis(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    g = o.groupBy(F.col("c_nationkey").alias("nation")).agg(n_rows().alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") != "P").alias("due"), F.countDistinct("o_orderpriority").alias("kinds"))
    return g.select("nation", "orders", "done", "kinds", F.round(F.coalesce(F.try_divide("done", "due"), F.lit(0.0)), 6).alias("ratio"))


@query("SELECT count(*) FILTER (a)::BIGINT AS returned, count(*) FILTER (b)::BIGINT AS open, count(*) FILTER (c)::BIGINT AS discounted, count(*)::BIGINT AS orders FROM (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS a, bool_or(l_linestatus = 'O') AS b, bool_or(l_discount > 0.08) AS c FROM lineitem GROUP BY 1)")
def any_flag_then_count(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("a"), F.bool_or(F.col("l_linestatus") == "O").alias("b"), F.bool_or(F.col("l_discount") > 0.08).alias("c"))
    return per.agg(F.count_if("a").alias("returned"), F.count_if("b").alias("open"), F.count_if("c").alias("discounted"), n_rows().alias("orders"))


@query("SELECT day, event_type, model, count(*)::BIGINT AS calls, sum(tokens)::BIGINT AS tokens FROM (SELECT ts::DATE::VARCHAR AS day, event_type, 'm' || user_id % 3 AS model, round(value * 100)::BIGINT AS tokens FROM events) GROUP BY ROLLUP (day, event_type, model)")
def usage_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type", F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"), F.round(F.col("value") * 100).cast("long").alias("tokens"))
    return e.rollup("day", "event_type", "model").agg(n_rows().alias("calls"), F.sum("tokens").alias("tokens"))


@query("SELECT split_part(c_name, '#', 1) || ':' || c_mktsegment AS namespace, count(*) FILTER (c_acctbal > 0)::BIGINT AS hits, count(*) FILTER (NOT c_acctbal > 0)::BIGINT AS misses FROM customer GROUP BY 1")
def source_evidence(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.groupBy(F.concat_ws(":", F.substring_index("c_name", "#", 1), "c_mktsegment").alias("namespace")).agg(F.count_if(F.col("c_acctbal") > 0).alias("hits"), F.count_if(~(F.col("c_acctbal") > 0)).alias("misses"))


@query("SELECT lang AS template, source AS verdict, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars, round(median(n_chars), 6) AS median_chars FROM documents GROUP BY ALL")
def census(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("template"), F.col("source").alias("verdict")).agg(n_rows().alias("n"), F.sum("n_chars").alias("chars"), rounded(F.median("n_chars")).alias("median_chars"))


GATES_SQL = "('all none', a = 0 AND b = 0), ('any none', a = 0 OR b = 0), ('first none', a = 0)"


@query("WITH v AS (SELECT quality AS truth, doc_id % 3 AS k, CASE WHEN doc_id % 4 = 0 THEN 1 - quality ELSE quality END AS a, CASE WHEN doc_id % 6 = 0 THEN 1 - quality ELSE quality END AS b FROM labels) SELECT gate, 'set' || k AS cohort, count(*) FILTER (truth = 1 AND fires)::BIGINT AS missed, count(*) FILTER (truth = 0 AND fires)::BIGINT AS discarded, count(*)::BIGINT AS n FROM (SELECT truth, k, unnest([{'gate': 'all none', 'fires': a = 0 AND b = 0}, {'gate': 'any none', 'fires': a = 0 OR b = 0}, {'gate': 'first none', 'fires': a = 0}], recursive := true) FROM v) GROUP BY ALL")
def gate_sweep(spark, sf_dir):
    flip = lambda m: F.when(F.col("doc_id") % m == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    v = table(spark, sf_dir, "labels").select("quality", (F.col("doc_id") % 3).alias("k"), flip(4).alias("a"), flip(6).alias("b"))
    none_a, none_b = F.col("a") == 0, F.col("b") == 0
    gates = {"all none": none_a & none_b, "any none": none_a | none_b, "first none": none_a}
    rows = v.select("quality", "k", F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), g.alias("fires")) for n, g in gates.items()])).alias("g")).select("quality", "k", "g.*")
    return rows.groupBy("gate", F.concat(F.lit("set"), "k").alias("cohort")).agg(F.count_if((F.col("quality") == 1) & F.col("fires")).alias("missed"), F.count_if((F.col("quality") == 0) & F.col("fires")).alias("discarded"), n_rows().alias("n"))


@query("WITH v AS (SELECT quality AS t, CASE WHEN doc_id % 4 = 0 THEN 1 - quality ELSE quality END AS a, CASE WHEN doc_id % 6 = 0 THEN 1 - quality ELSE quality END AS b FROM labels) SELECT 'a' AS model, round(avg((a = t)::INT), 6) AS accuracy, count(*) FILTER (t = 1 AND a = 0)::BIGINT AS misses, count(*) FILTER (t = 0 AND a = 1)::BIGINT AS false_hits, count(*) FILTER (a <> t AND b = t)::BIGINT AS mended FROM v UNION ALL SELECT 'b', round(avg((b = t)::INT), 6), count(*) FILTER (t = 1 AND b = 0)::BIGINT, count(*) FILTER (t = 0 AND b = 1)::BIGINT, count(*) FILTER (b <> t AND a = t)::BIGINT FROM v")
def solo_accuracy(spark, sf_dir):
    flip = lambda m: F.when(F.col("doc_id") % m == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    v = table(spark, sf_dir, "labels").select(F.col("quality").alias("t"), flip(4).alias("a"), flip(6).alias("b"))
    rows = v.select("t", F.explode(F.array(F.struct(F.lit("a").alias("model"), F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.lit("b").alias("model"), F.col("b").alias("x"), F.col("a").alias("y")))).alias("m")).select("t", "m.*")
    t, x, y = F.col("t"), F.col("x"), F.col("y")
    return rows.groupBy("model").agg(F.round(F.avg((x == t).cast("int")), 6).alias("accuracy"), F.count_if((t == 1) & (x == 0)).alias("misses"), F.count_if((t == 0) & (x == 1)).alias("false_hits"), F.count_if((x != t) & (y == t)).alias("mended"))


BUCKETS_SQL = "CASE WHEN l_quantity <= 2 THEN 'malformed' WHEN l_discount > 0.09 THEN 'refused' WHEN l_returnflag = 'R' AND l_tax > 0.06 THEN 'contested' WHEN l_linestatus = 'O' THEN 'open' ELSE 'main' END"


@query("SELECT l_orderkey, count(*)::BIGINT AS n, count(DISTINCT l_linenumber) < count(*) AS repeated, NOT (count(DISTINCT l_linenumber) = count(*) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(*)) AS bad_ranks FROM lineitem GROUP BY 1")
def group_consistency(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(n_rows().alias("n"), F.countDistinct("l_linenumber").alias("d"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    return g.select("l_orderkey", "n", (F.col("d") < F.col("n")).alias("repeated"), (~((F.col("d") == F.col("n")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n")))).alias("bad_ranks"))


@query("SELECT count(*)::BIGINT AS rows, count(*) FILTER (o_totalprice < 2000)::BIGINT AS blank, count(*) FILTER (l_shipdate < o_orderdate)::BIGINT AS out_of_order, count(*) FILTER (TRY_CAST(substr(o_orderpriority, 1, 2) AS INTEGER) IS NULL)::BIGINT AS not_numbers FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def sanity_report(spark, sf_dir):
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.agg(n_rows().alias("rows"), F.count_if(F.col("o_totalprice") < 2000).alias("blank"), F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("out_of_order"), F.count_if(T.whole(F.substring("o_orderpriority", 1, 2)).isNull()).alias("not_numbers"))


@query(f"WITH {POOL_SQL} SELECT source, count(*)::BIGINT AS rows, count(*) FILTER (abstract = '')::BIGINT AS no_abstract, count(*) FILTER (length(title) < 40)::BIGINT AS short_title, count(*) FILTER (blank AND type = 'en')::BIGINT AS blank_english FROM p GROUP BY source")
def completeness(spark, sf_dir):
    return pool(spark, sf_dir).groupBy("source").agg(n_rows().alias("rows"), F.count_if(F.col("abstract") == "").alias("no_abstract"), F.count_if(F.length("title") < 40).alias("short_title"), F.count_if(T.is_blank(F.col("abstract")) & (F.col("type") == "en")).alias("blank_english"))


@query(f"WITH {LOG_SQL}, d AS (SELECT claim, count(*) AS files, sum(round(score * 100)::BIGINT) AS bytes, max(tm) AS done_at FROM log GROUP BY claim) SELECT claim, bytes::BIGINT AS bytes, sum(bytes) OVER (ORDER BY done_at, claim)::BIGINT AS done_bytes, round((sum(bytes) OVER w - first_value(bytes) OVER w) / nullif(epoch_us(done_at) - epoch_us(first_value(done_at) OVER w), 0)::DOUBLE * 1000000, 4) AS bytes_per_s FROM d WINDOW w AS (ORDER BY done_at, claim ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)")
def scan_progress(spark, sf_dir):
    """Progress of a scan and its rate over the last 50 partitions, the first one's bytes left out; a row per partition of the manifest."""
    d = log(spark, sf_dir).groupBy("claim").agg(F.sum(F.round(F.col("score") * 100).cast("long")).alias("bytes"), F.max("at").alias("done_at"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    last = running.in_order(d, ["done_at", "claim"]).trailing(50, sent=lambda w: F.sum("bytes").over(w) - F.first("bytes").over(w), took=lambda w: micros(F.col("done_at")) - micros(F.first("done_at").over(w)))
    return last.running(done_bytes=F.col("bytes")).done().select("claim", "bytes", "done_bytes", F.round(F.col("sent") / F.nullif("took", F.lit(0)) * 1_000_000, 4).alias("bytes_per_s"))


@query(f"WITH {LOG_SQL} SELECT verdict, 'moved' AS kind, count(*)::BIGINT AS n FROM log WHERE claim > 70 GROUP BY 1 UNION ALL SELECT verdict, 'stays', count(*)::BIGINT FROM log WHERE NOT claim > 70 GROUP BY 1")
def supersession_counts(spark, sf_dir):
    return log(spark, sf_dir).groupBy("verdict", F.when(F.col("claim") > 70, "moved").otherwise("stays").alias("kind")).agg(n_rows().alias("n"))


@query(f"WITH {ROUTED_SQL} SELECT rule_id AS arm, count(*)::BIGINT AS works FROM ev WHERE rule_id IN ('ask-french', 'skim-spanish', 'skim-german') GROUP BY 1")
def fused_prefilter(spark, sf_dir):
    """A looser pattern that holds wherever any arm does, made from the arms' rules, drops most texts before the exact arms are tried."""
    arms = [r for r in BUNDLE if r.id in ("ask-french", "skim-spanish", "skim-german")]
    rows = tables.spread(pool(spark, sf_dir)).where(T.matches(F.concat_ws("\n", "title", "abstract"), R.fused_prefilter(arms)))
    return R.evaluations(R.match_flags(rows, arms, COLUMNS)).groupBy(F.col("rule_id").alias("arm")).agg(n_rows().alias("works"))
