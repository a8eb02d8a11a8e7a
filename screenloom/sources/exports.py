"""Files that leave or feed the engine: exports with manifests, scans with ledgers, overlays and a key-value store.

A folder is written whole before the file that names it, so that a reader who goes by
manifests, ledgers or pointers never sees part of it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.folds import content_digest
from .tables import read_stage_csv

#: Fixed value: what a spreadsheet looks for at the head of a file in UTF-8.
MARK = "﻿"
YEARS = ("year_r", "year_o")


class Refused(ValueError):
    """What was asked for would break a file that others rely on."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """A small file, moved to its name when it is whole."""
    fs, p = _fs(spark, path)
    if fs.exists(p) and not overwrite:
        raise Refused(f"{path} exists already")
    _, part = _fs(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{path}.part", path, overwrite)


def move(spark: SparkSession, old: str, new: str, overwrite: bool = False) -> None:
    """Rename a file or folder in one step; overwrite: a file that is there is replaced in the same step, so that a reader finds the old one or the new one."""
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    _, a = _fs(spark, old)
    fs, b = _fs(spark, new)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b, options)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def check_columns(df: DataFrame, required: list[str]) -> None:
    if missing := [c for c in required if c not in df.columns]:
        raise Refused(f"missing columns: {', '.join(missing)}")


def check_years(df: DataFrame, columns: tuple[str, ...] = YEARS) -> None:
    """Raises if a year reads like `2018.0`, a number gone through a float."""
    there = [c for c in columns if c in df.columns]
    bad = df.agg(*[F.count_if(F.col(c).cast("string").rlike(r"\A[0-9]+\.0\z")).alias(c) for c in there]).first() if there else ()
    if any(bad):
        raise Refused(f"years written as floats: {', '.join(f'{c} in {n} rows' for c, n in zip(there, bad, strict=True) if n)}")


def export_csv(df: DataFrame, path: str, columns: list[str], order: list[Column], created_at: str, about: dict | None = None) -> dict:
    """Write columns in their order, rows in a total order, null as empty, each file with a byte-order mark; then the manifest.

    The manifest `<path>.manifest.json` has rows, columns, the digest of the rows and what
    `about` says, and can't be replaced: an export under a name stays what it was.
    """
    spark = df.sparkSession
    check_columns(df, columns)
    check_years(df)
    if exists(spark, f"{path}.manifest.json"):
        raise Refused(f"{path}.manifest.json exists already; choose another name")
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    text = df.orderBy(*order).select(*plain)
    text.withColumnRenamed(columns[0], MARK + columns[0]).write.mode("overwrite").csv(path, header=True, emptyValue="", escape='"')
    # counted and digested as it can be read back: df is computed once
    back = _read_csv(spark, path, columns)
    manifest = {**(about or {}), "rows": back.count(), "columns": columns, "sha256": content_digest(back, F.to_json(F.struct(*columns))).first()[0], "created_at": created_at}
    write_text(spark, f"{path}.manifest.json", json.dumps(manifest, indent=1, sort_keys=True))
    return manifest


def _read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', enforceSchema=True).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An export's rows by its manifest; raises if their number or digest isn't the manifest's."""
    manifest = json.loads(read_text(spark, f"{path}.manifest.json"))
    columns = manifest["columns"]
    df = _read_csv(spark, path, columns)
    if content_digest(df, F.to_json(F.struct(*columns))).first()[0] != manifest["sha256"]:
        raise Refused(f"{path} isn't what its manifest describes")
    return df


def mirror(spark: SparkSession, csv: str, parquet: str, columns: list[str]) -> bool:
    """Copy a stage's CSV to parquet, all text, if it is newer than the copy or there is none; was it copied?"""
    files = lambda path: spark.read.format("binaryFile").load(path).agg(F.max("modificationTime"), F.count(F.lit(1))).first()
    newest, n = files(csv)
    if not n:
        return False
    if exists(spark, f"{parquet}/_SUCCESS") and (copied := files(parquet)[0]) and copied >= newest:
        return False
    read_stage_csv(spark, csv, columns).write.mode("overwrite").parquet(parquet)
    return True


#: Columns of an overlay's chunks.
OVERLAY = T.StructType([T.StructField("work_id", T.LongType()), T.StructField("abstract_text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("fetched_at", T.StringType())])


def overlay_chunks(spark: SparkSession, folder: str) -> list[str]:
    """The chunks (folders chunk-*) in order of name."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("chunk-")) if fs.exists(p) else []


def add_chunk(df: DataFrame, folder: str) -> str | None:
    """Append rows as the next chunk; nothing for no rows."""
    if df.isEmpty():
        return None
    path = f"{folder}/chunk-{len(overlay_chunks(df.sparkSession, folder)):05d}"
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OVERLAY]).write.parquet(path)
    return path


def overlay_errors(spark: SparkSession, folder: str) -> list[str]:
    """What keeps an overlay from being frozen: other columns or types, rows without a work, works in more than one row.

    Repeated works are counted in all and the first twenty are named.
    """
    chunks = overlay_chunks(spark, folder)
    if not chunks:
        return [f"no chunks under {folder}"]
    out, good, expected = [], None, [(f.name, f.dataType) for f in OVERLAY]
    for path in chunks:
        df = spark.read.parquet(path)
        name = path.rsplit("/", 1)[1]
        if [(f.name, f.dataType) for f in df.schema] != expected:
            out.append(f"{name}: columns {df.schema.simpleString()}")
            continue
        one = df.select("work_id", F.lit(name).alias("chunk"))
        good = one if good is None else good.unionByName(one)
    if good is not None:
        out += [f"{r.chunk}: {r.n} rows without work_id" for r in good.where("work_id IS NULL").groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).orderBy("chunk").collect()]
        twice = good.where("work_id IS NOT NULL").groupBy("work_id").agg(F.count(F.lit(1)).alias("n"), F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("n > 1")
        if n := twice.count():
            out.append(f"{n} works in more than one row: " + ", ".join(f"{r.work_id} ({r.a}, {r.b})" for r in twice.orderBy("work_id").limit(20).collect()))
    return out


def freeze_overlay(spark: SparkSession, folder: str, pool: str | None, created_at: str) -> dict:
    """Check an overlay, write its manifest under the name of its digest, and point overlay_manifest.json at it.

    The same chunks give the same manifest; older manifests stay.
    """
    if errors := overlay_errors(spark, folder):
        raise Refused("overlay can't be frozen:\n" + "\n".join(errors))
    whole = spark.read.schema(OVERLAY).parquet(*overlay_chunks(spark, folder))
    line = F.to_json(F.struct(*[f.name for f in OVERLAY]))
    # one job for all chunks: lines are folded by prefixes of their hash, and those again
    named = whole.select(F.element_at(F.split(F.regexp_replace("_metadata.file_path", r"/[^/]*\z", ""), "/"), -1).alias("name"), F.sha2(line, 256).alias("h"))
    joined = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256)
    parts = named.groupBy("name", F.substring("h", 1, 4).alias("p")).agg(F.concat("p", joined("h")).alias("d"), F.count(F.lit(1)).alias("n"))
    files = [r.asDict() for r in parts.groupBy("name").agg(F.sum("n").alias("rows"), joined("d").alias("sha256")).orderBy("name").collect()]  # a row for each chunk
    sources = {r.s: r.n for r in whole.groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    digest = spark.range(1).select(F.sha2(F.lit("".join(f"{f['name']}:{f['sha256']}\n" for f in files)), 256)).first()[0]
    manifest = {"overlay_hash": digest, "rows": sum(f["rows"] for f in files), "files": files, "sources": dict(sorted(sources.items())), "parent_pool": pool, "created_at": created_at}
    name = f"overlay_manifest-{digest[:12]}.json"
    if not exists(spark, f"{folder}/{name}"):
        write_text(spark, f"{folder}/{name}", json.dumps(manifest, indent=1, sort_keys=True))
    write_text(spark, f"{folder}/overlay_manifest.json", json.dumps({"overlay_hash": digest, "manifest": name}, sort_keys=True), overwrite=True)
    return manifest


def overlay_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(work_id, abstract_text) of a frozen overlay, works without text left out."""
    return spark.read.schema(OVERLAY).parquet(*overlay_chunks(spark, folder)).where(~X.is_blank(F.col("abstract_text"))).select("work_id", "abstract_text")


KEPT = "namespace string, key string, value string, at timestamp"


class Store:
    """Values by namespace and key, partitioned by namespace; a key that was tried without success has a null value.

    Rows are appended and the latest wins; drop() removes a namespace's folder.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], KEPT)
        all_rows = self.spark.read.schema(KEPT).parquet(self.path)
        return all_rows.groupBy("namespace", "key").agg(F.max_by(F.struct("value", "at"), F.struct("at", "value")).alias("v")).select("namespace", "key", "v.*")

    def put(self, rows: DataFrame) -> None:
        """Append (namespace, key, value, at); they replace earlier ones."""
        rows.select("namespace", "key", "value", "at").write.mode("append").partitionBy("namespace").parquet(self.path)

    def fill(self, rows: DataFrame) -> None:
        """Append only what has no row yet."""
        self.put(rows.join(self.rows().select("namespace", "key"), ["namespace", "key"], "left_anti"))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """keys (namespace, key) with `tried` and `value`."""
        return keys.join(self.rows().select("namespace", "key", "value", F.lit(True).alias("tried")), ["namespace", "key"], "left").withColumn("tried", F.coalesce("tried", F.lit(False)))

    def drop(self, namespace: str) -> None:
        fs, p = _fs(self.spark, f"{self.path}/namespace={namespace}")
        fs.delete(p, True)
