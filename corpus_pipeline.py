"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a
stage returns to the shared folder and gives the next stage the table read back.
All but the last return the columns of `documents`.

Every row is judged by itself: rows without an identifier, or sharing one, are rows like
others.  Of rows equal in text one stays; null and empty texts have nothing to be
compared and are judged by the classifier alone.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm import bpe, decontam, fm, jaccard, queries, substrings
from screenloom.llm.exchange import kept, scratch, written

#: The key of a row inside a stage.
ROW = "_row_key"
#: Rows that go to Python in one batch, and text bytes of a chunk that a task holds: stages follow each other in the same
#: executors, whose workers keep the memory that an earlier stage took.
BATCH_ROWS, CHUNK_BYTES = 2000, 3 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(spark: SparkSession) -> None:
    """Bounds the batches of this session that go to Python by BATCH_ROWS."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least the threshold; the classifier learns from the labels outside the held-out fold."""
    bounded(spark)
    labels = queries.table(spark, sf_dir, "labels").where(queries.fold("doc_id", fm.FOLDS) != fm.HELD_OUT)
    machine = fm.train(docs, labels)
    return fm.score_quality(docs, machine, name="_score").where(F.col("_score") >= fm.THRESHOLD).select(*docs.columns)


def with_row_key(docs: DataFrame) -> DataFrame:
    """docs with ROW, a key of each row: doc_id for the first row that has it; rows without an identifier, or
    repeating one, get numbers beyond the largest identifier."""
    rows, ids, top = docs.agg(F.count(F.lit(1)), F.countDistinct("doc_id"), F.coalesce(F.max("doc_id"), F.lit(-1))).first()
    if rows == ids:
        return docs.withColumn(ROW, F.col("doc_id"))
    numbered = written(docs.withColumn(ROW, F.monotonically_increasing_id()))
    first = numbered.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(ROW).alias(ROW)).select(ROW, F.lit(True).alias("_first"))
    return written(numbered.join(first, ROW, "left").withColumn(ROW, F.when(F.col("_first"), F.col("doc_id")).otherwise(F.col(ROW) + (top + 1))).drop("_first"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by similar shingles, the one with the smallest identifier.

    A row without an identifier comes after all that have one; of rows with the same identifier each is judged by its own text.
    """
    bounded(spark)
    rows = with_row_key(docs)
    groups = jaccard.link_documents(rows, key=ROW, chunk_bytes=CHUNK_BYTES)
    gone = groups.where(F.col("component_id") != F.col(ROW)).select(ROW)
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that start in an earlier row, in the order of identifiers; rows of which nothing is left go."""
    bounded(spark)
    out = substrings.remove_repeats(with_row_key(docs), key=ROW, chunk_bytes=CHUNK_BYTES).where("n_removed = 0 OR n_removed < n_words")
    return out.select(*[F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    bounded(spark)
    return decontam.without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text (little-endian unsigned 32-bit integers), their number, and checksums of them and of the decoded bytes."""
    bounded(spark)
    out = bpe.round_trip(docs.select("doc_id", "text"))
    return out.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", remove_repeated_passages),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; tables made on the way are deleted when the next stage has been written, but for the one that the result reads."""
    docs, path = queries.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with scratch(spark, path):
            docs, path = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
