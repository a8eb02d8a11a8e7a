"""Scanning the files of a manifest into a pool, each file committed by its ledger row.

A run writes what its files keep to a folder of its own, partitioned by source; nothing reads
it until the ledger names it.  The ledger gets a row per file and run, with the run's number:
the last row of a file says which run's rows are the file's.  So a file that is scanned again
replaces its rows by the new ones, or by none, and a run that ends early leaves the pool as it
was.  clean() deletes the folders that no last row names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables
from .exports import Refused, _fs, exists

LEDGER = "run bigint, url string, source string, status string, content_length bigint, records bigint, kept bigint, malformed bigint, gate string"
#: Rows of a run: kept, read but not kept, not read.
KEPT, REST, BAD = "kept", "rest", "bad"


def source_name(url: Column) -> Column:
    """A folder name that stands for the whole path: its last two parts, readable, and a digest of all of it."""
    last = F.regexp_replace(F.regexp_extract(url, r"([^/]*/?[^/]+?)(\.[A-Za-z0-9]+)*/?\z", 1), "[^A-Za-z0-9]+", "-")
    return F.concat(F.regexp_replace(last, r"\A-+|-+\z", ""), F.lit("-"), F.substring(F.md5(url), 1, 12))


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """All rows of the ledger, oldest run first by number."""
    path = f"{store}/ledger"
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def last_rows(rows: DataFrame, done: bool = False) -> DataFrame:
    """The last row of each file; done: the last that says so, as a failed scan leaves what was there."""
    rest = [c for c in rows.columns if c != "url"]
    rows = rows.where("status = 'done'") if done else rows
    return rows.groupBy("url").agg(F.max_by(F.struct(*rest), "run").alias("r")).select("url", "r.*")


def read(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The pool's rows with `source`: of each file those of its last finished run."""
    path = f"{store}/pool"
    whole = T.StructType([*schema.fields, T.StructField("run", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("source", T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, whole["source"]]))
    current = last_rows(ledger(spark, store), done=True).select("run", "source")
    return spark.read.schema(whole).parquet(path).where(F.col("kind") == KEPT).join(current, ["run", "source"], "left_semi").drop("run", "kind")


def one_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"\Afile:/+", "file:/")


def records(spark: SparkSession, urls: list[str], kind: str, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """The records of these files with `_url` and `_bad`: JSON lines, a record that can't be read costs itself only, or parquet, a column that a file lacks is null.

    lenient: a file that breaks off is read as far as it goes.
    """
    at, spark_read = one_slash(F.col("_metadata.file_path")).alias("_url"), spark.read.option("ignoreCorruptFiles", lenient)
    if kind == "parquet":
        return spark_read.schema(schema).parquet(*urls).select("*", at, F.lit(False).alias("_bad"))
    parsed = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark_read.text(urls).where(F.length(F.trim("value")) > 0)
    rows = lines.select(F.from_json("value", parsed, {"columnNameOfCorruptRecord": "_bad"}).alias("r"), at)
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields], "_url", F.col("r._bad").isNotNull().alias("_bad"))


def scan(spark: SparkSession, manifest: DataFrame, store: str, schema: T.StructType, gate: Column, project: list[Column], kind: str = "json", gate_id: str = "", force: bool = False) -> DataFrame:
    """Read the files of a manifest that the ledger doesn't have, keep what passes the gate, and return the ledger's new rows.

    manifest: url, content_length, record_count or null.  One job reads all files once and
    writes kept rows by source; of the others it writes that they were there, in columns of
    nulls, so that counting them reads no file again.  A file is `done` if it was read to its
    end: if the manifest knows how many records it has, they must all be there, else it is
    `short`; a file that isn't there is `missing`.  Neither replaces what an earlier run kept,
    and both are scanned again next time.  Without numbers of records a file that can't be read
    ends the run, whose rows then nothing names.  A ledger of another gate is refused unless forced.
    """
    known = ledger(spark, store)
    other = known.where((F.col("gate") != gate_id) & (F.col("status") == "done")).select("gate").first()
    if other and not force:
        raise Refused(f"the ledger of {store} was written under gate {other.gate!r}, not {gate_id!r}: rows that it rejected aren't stored")
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    if "record_count" not in manifest.columns:
        manifest = manifest.withColumn("record_count", F.lit(None).cast("long"))
    # a short or missing file has a last row that isn't done; what it was before doesn't matter
    todo = tables.to_scan(manifest, last_rows(known)).select("url", "content_length", "record_count").distinct()
    files = todo.orderBy("url").collect()  # as many as the manifest has files
    if not files:
        return spark.createDataFrame([], LEDGER)
    there = [f for f in files if exists(spark, f.url)]
    gone = {f.url for f in files} - {f.url for f in there}
    todo = todo.withColumn("source", source_name(F.col("url"))).withColumn("gone", F.col("url").isin(*gone) if gone else F.lit(False))
    counts = None
    if there:
        place = f"{store}/pool/run={run}"
        names = spark.createDataFrame([(_uri(spark, f.url), f.url) for f in there], "_url string, url string").select(one_slash(F.col("_url")).alias("_url"), source_name(F.col("url")).alias("source"))
        counted = all(f.record_count is not None for f in there)
        rows = records(spark, [f.url for f in there], kind, schema, lenient=counted).join(names, "_url")
        rows = rows.withColumn("kind", F.when(F.col("_bad"), BAD).when(F.coalesce(gate, F.lit(False)), KEPT).otherwise(REST))
        only = lambda c: F.when(F.col("kind") == KEPT, c)
        columns = rows.select(*project).columns
        rows.select(*[only(c).alias(n) for c, n in zip(project, columns, strict=True)], "kind", "source").write.mode("overwrite").partitionBy("kind", "source").parquet(place)
        if exists(spark, place):
            of = lambda k: F.count_if(F.col("kind") == k)
            staged = spark.read.schema("kind string, source string").parquet(place)
            counts = staged.groupBy("source").agg(F.count(F.lit(1)).alias("records"), of(KEPT).alias("kept"), of(BAD).alias("malformed"))
    counts = spark.createDataFrame([], "source string, records long, kept long, malformed long") if counts is None else counts
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    status = F.when(F.col("gone"), "missing").when(F.coalesce("records", F.lit(0)) < F.col("record_count"), "short").otherwise("done")
    out = todo.join(counts, "source", "left").select(F.lit(run).cast("long").alias("run"), "url", "source", status.alias("status"), "content_length", n("records"), n("kept"), n("malformed"), F.lit(gate_id).alias("gate"))
    out.coalesce(1).write.mode("append").parquet(f"{store}/ledger")
    for k in (REST, BAD):
        _delete(spark, f"{store}/pool/run={run}/kind={k}")
    return ledger(spark, store).where(F.col("run") == run)


def _uri(spark: SparkSession, path: str) -> str:
    """A path as Spark tells it for the rows of its file."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().toString()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def clean(spark: SparkSession, store: str) -> int:
    """Delete what no last finished row names; how many folders went."""
    current = {(r.run, r.source) for r in last_rows(ledger(spark, store), done=True).select("run", "source").collect()}
    fs, p = _fs(spark, f"{store}/pool")
    paths = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{store}/pool/run=*/kind=*/source=*")) or []
    old = [s.getPath() for s in paths if (int(s.getPath().getParent().getParent().getName()[4:]), s.getPath().getName()[7:]) not in current]
    for path in old:
        fs.delete(path, True)
    return len(old)
