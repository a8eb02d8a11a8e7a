"""Queries on scans, caches and pools: what files and their ledgers say."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import scans, shards, shared, tables
from .registry import Registry
from .standins import table

query = Registry()

WORK = T.StructType([T.StructField("id", T.LongType()), T.StructField("size", T.LongType()), T.StructField("note", T.StringType())])


def _files(spark, folder, grown=""):
    """A manifest of a folder's files; those of the language `grown` look longer than they are."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    more = F.when(F.col("path").contains(f"lang={grown}/"), 1).otherwise(0) if grown else F.lit(0)
    return found.select(F.col("path").alias("url"), (F.col("length") + more).alias("content_length"))


@query("""
WITH d AS (SELECT doc_id, lang, n_chars, doc_id % 50 = 7 AS bad FROM documents),
r AS (SELECT lang, count(*)::BIGINT AS records, count(*) FILTER (bad)::BIGINT AS malformed, count(*) FILTER (NOT bad AND n_chars > 500 AND lang <> 'fr')::BIGINT AS kept,
             coalesce(sum(doc_id) FILTER (NOT bad AND n_chars > 500 AND lang <> 'fr'), 0)::BIGINT AS ids FROM d GROUP BY lang)
SELECT lang, CASE WHEN lang = 'fr' THEN 2 ELSE 1 END::BIGINT AS run, records, malformed, kept, kept AS pool_rows, ids FROM r""")
def scan_commit(spark, sf_dir):
    """A scan and a rescan of the documents as JSON files, equal names in folders by language; the files of one language change and keep nothing the second time."""
    place = shared.fresh(spark, "scans")
    docs = table(spark, sf_dir, "documents").select("lang", F.when(F.col("doc_id") % 50 == 7, "{bad").otherwise(F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("size")))).alias("value"))
    docs.write.partitionBy("lang").text(f"{place}/source")
    gate = lambda least: F.col("size") > least
    lang = F.regexp_extract("url", "lang=([^/]*)/", 1).alias("lang")
    scans.scan(spark, _files(spark, f"{place}/source"), place, WORK, gate(500), [F.col("id"), F.col("size")])
    scans.scan(spark, _files(spark, f"{place}/source", "fr"), place, WORK, gate(1 << 40), [F.col("id"), F.col("size")])
    last = scans.last_rows(scans.ledger(spark, place)).select("*", lang)
    files = last.groupBy("lang").agg(*[F.sum(c).alias(c) for c in ("records", "malformed", "kept")], F.max("run").alias("run"))
    pool = scans.read(spark, place, WORK).join(last.select("source", "lang"), "source").groupBy("lang").agg(F.count(F.lit(1)).alias("pool_rows"), F.sum("id").alias("ids"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return files.join(pool, "lang", "left").select("lang", "run", "records", "malformed", "kept", zero("pool_rows"), zero("ids"))


CACHE = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("key", T.LongType()), T.StructField("value", T.LongType())])


@query("""
WITH c AS (SELECT c_mktsegment AS namespace, substr(md5(c_custkey::VARCHAR), 1, 1) AS shard, c_custkey AS key, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END::BIGINT AS value FROM customer),
new AS (SELECT namespace, substr(md5((key + 10000000)::VARCHAR), 1, 1) AS shard, key + 10000000 AS key, CASE WHEN key % 2 = 0 THEN value END AS value FROM c WHERE namespace = 'MACHINERY' AND key % 25 = 1),
m AS (SELECT *, 1 AS put FROM c WHERE namespace <> 'FURNITURE' UNION ALL SELECT *, 2 FROM new UNION ALL SELECT namespace, shard, key, value, 2 FROM c WHERE namespace = 'FURNITURE' AND key % 3 = 0)
SELECT namespace, count(*)::BIGINT AS rows, count(value)::BIGINT AS hits, coalesce(sum(value), 0)::BIGINT AS total, count(DISTINCT shard) FILTER (put = 2)::BIGINT AS written FROM m GROUP BY namespace""")
def cache_merge(spark, sf_dir):
    """A cache of customers merged with another: one namespace with new keys, one of misses only that isn't taken, one that is new here, others alike."""
    place = shared.fresh(spark, "caches")
    shard = lambda c: shards.shard_of(F.col(c).cast("string"), 1).alias("shard")
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("namespace"), shard("c_custkey"), F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).cast("long").alias("value"))
    local, remote = (shards.Shards(spark, f"{place}/{n}", CACHE, ["namespace", "shard"]) for n in ("local", "remote"))
    local.put(c.where("namespace <> 'FURNITURE'"))
    more = c.where("namespace = 'MACHINERY' AND key % 25 = 1").select("namespace", (F.col("key") + 10_000_000).alias("key"), F.when(F.col("key") % 2 == 0, F.col("value")).alias("value")).select("namespace", shard("key"), "key", "value")
    blind = c.where("namespace = 'BUILDING'").select("namespace", "key", "value").select("namespace", (F.col("key") + 20_000_000).alias("key")).select("namespace", shard("key"), "key", F.lit(None).cast("long").alias("value"))
    remote.put(c.where("namespace = 'AUTOMOBILE' OR namespace = 'HOUSEHOLD'").unionByName(c.where("namespace = 'MACHINERY'")).unionByName(more).unionByName(blind).unionByName(c.where("namespace = 'FURNITURE' AND key % 3 = 0")))
    put = shards.pull(remote, local, "namespace", "key", "value").groupBy("namespace").agg(F.count(F.lit(1)).alias("written"))
    rows = local.read().groupBy("namespace").agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("hits"), F.coalesce(F.sum("value"), F.lit(0)).alias("total"))
    return rows.join(put, "namespace", "left").select("namespace", "rows", "hits", "total", F.coalesce("written", F.lit(0)).alias("written"))


YEARLY = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("price", T.LongType())])


@query("""
WITH o AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderkey AS id, floor(o_totalprice)::BIGINT AS price FROM orders),
t AS (SELECT year, count(*) AS n, sum(CASE WHEN year = 1993 THEN price + 1 WHEN year = 1992 THEN price ELSE price END) AS price FROM o WHERE year <> 1997 GROUP BY year)
SELECT year, n::BIGINT AS rows, price::BIGINT AS price, year IN (1993, 1996) AS copied FROM t""")
def pool_sync(spark, sf_dir):
    """Orders by year in two places: years alike are skipped, a changed and a missing one copied, one that isn't asked for isn't."""
    place = shared.fresh(spark, "pools")
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("int").alias("year"), F.col("o_orderkey").alias("id"), F.floor("o_totalprice").cast("long").alias("price"))
    here, there = (shards.Shards(spark, f"{place}/{n}", YEARLY, ["year"], gate="g1") for n in ("here", "there"))
    there.put(o.withColumn("price", F.when(F.col("year") == 1993, F.col("price") + 1).otherwise(F.col("price"))))
    here.put(o.where("year NOT IN (1996, 1997)"))
    copied = shards.copy(there, here, only=F.col("year").isin(*tables.parse_years("1992-1994,1996"))).select("year", F.lit(True).alias("copied"))
    rows = here.read().groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.sum("price").alias("price"))
    return rows.join(copied, "year", "left").select("year", "rows", "price", F.coalesce("copied", F.lit(False)).alias("copied"))
