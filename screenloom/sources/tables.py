"""Reading and writing the engine's tables: pools, stage CSVs and release-partitioned stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POOL = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "doi", "title", "display_name")] + [T.StructField("publication_year", T.IntegerType())] + [T.StructField(n, T.StringType()) for n in ("type", "authorships", "primary_location", "open_access", "concepts", "abstract_text")] + [T.StructField(n, T.BooleanType()) for n in ("hit_token_title", "hit_token_abstract", "hit_concept")])


def read_pool(spark: SparkSession, path: str, schema: T.StructType = POOL) -> DataFrame:
    """A parquet pool by a fixed schema (columns that a file lacks are null), with arrival order as file_name and row_index."""
    return spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if it has fewer: one file is one task, however much work its texts are.

    A table of many files is left as it is, so that nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(url, content_length, record_count) of a manifest {entries or files: [{url, meta}]}; s3 as https; empty or malformed raises."""
    entry = "array<struct<url:string,meta:struct<content_length:bigint,record_count:bigint>>>"
    raw = spark.read.schema(f"entries {entry}, files {entry}").json(path, multiLine=True)
    out = raw.select(F.explode(F.coalesce("entries", "files")).alias("e")).select(F.regexp_replace("e.url", r"\As3://([^/]+)/", "https://$1.s3.amazonaws.com/").alias("url"), "e.meta.content_length", "e.meta.record_count")
    if out.where("url IS NOT NULL").isEmpty():
        raise ValueError(f"no files in manifest {path}")
    return out


def read_stage_csv(spark: SparkSession, path: str, columns: list[str], longest: int = 50_000) -> DataFrame:
    """A stage's CSV, all text, a byte-order mark dropped, bad lines skipped and cells cut at `longest` characters."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', mode="DROPMALFORMED", enforceSchema=True, encoding="UTF-8")
    return df.select(*[F.substring(c, 1, longest).alias(c) for c in columns])


def write_stage_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Columns in their declared order, null as an empty cell."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.mode("overwrite").csv(path, header=True, emptyValue="", escape='"')


def replace_partition(df: DataFrame, path: str, by: list[str]) -> None:
    """Write partitions, each replacing what it had before (a rescan or a new run of a release)."""
    df.write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").parquet(path)


def to_scan(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of the manifest to scan: unknown to the ledger, not done, or of another known size."""
    known = ledger.select("url", "status", F.col("content_length").alias("_was"))
    changed = (F.col("content_length") != F.col("_was")) & F.col("content_length").isNotNull() & F.col("_was").isNotNull()
    return manifest.join(known, "url", "left").where(F.col("status").isNull() | (F.col("status") != "done") | F.coalesce(changed, F.lit(False))).drop("_was")


def parse_years(text: str) -> list[int]:
    """`2019,2021-2023` as a list of years."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = part.partition("-")
        if not a.isdigit() or b and not b.isdigit() or b and int(b) < int(a):
            raise ValueError(f"years {part!r}")
        out |= set(range(int(a), int(b or a) + 1))
    return sorted(out)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose keys aren't there yet."""
    spark = df.sparkSession
    try:
        there = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = None
    (df if there is None else df.join(there.select(*keys), keys, "left_anti")).write.mode("append").parquet(path)
