"""Rows of the export put together from works, their targets and outcomes; samples and versions of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def side(doi: Column, work: Column, title: Column) -> Column:
    """One side of a pair: its identifier, else its work number, else its title; empty for none."""
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    plain = F.lower(F.trim(F.regexp_replace(empty(title), r"\s+", " ")))
    w = T.work_id(work)
    return F.when(empty(doi) != "", empty(doi)).when(w.isNotNull(), F.concat(F.lit("oa:W"), w)).when(plain != "", F.concat(F.lit("t:"), plain)).otherwise("")


def union_targets(targets: DataFrame, work: str = "work_id") -> DataFrame:
    """Targets found in several readings of a work, one row each: those with the same key or the same identifier are one.

    targets: work, stage and position (order of reading), key, doi, settled, outcome.  The
    last reading counts whole, but an unsettled outcome doesn't replace a settled one.
    Returns the columns with `place`, where the target was first seen.
    """
    order = F.struct("stage", "position")
    rows = targets.withColumn("_doi", T.clean_doi(F.col("doi"))).withColumn("_at", order)
    by = lambda *keys: Window.partitionBy(work, *keys)  # noqa: E731  a work's targets
    first = lambda df, key: df.withColumn("_first", F.when(F.col(key).isNotNull(), F.min("_first").over(by(key))).otherwise(F.col("_first")))
    rows = first(first(first(rows.withColumn("_first", F.col("_at")), "key"), "_doi"), "key")
    kept = [c for c in targets.columns if c not in (work, "settled", "outcome")]
    g = rows.groupBy(work, "_first").agg(F.max_by(F.struct(*kept), "_at").alias("_row"), F.max_by(F.struct("settled", "outcome"), F.struct("settled", "_at")).alias("_said"))
    return g.select(work, F.col("_first").alias("place"), "_row.*", "_said.*")


def assemble(works: DataFrame, targets: DataFrame, work: str = "work_id") -> DataFrame:
    """A row for each target of a work, and one for each work without any.

    works: work, doi_r, oa_work_id_r, title_r, record_type, ending (the link method where
    nothing was found) and error; targets: work, rank, doi, openalex_id, title, year,
    method, confidence, evidence, outcome.  A single target's pair is told by identifiers
    of both sides alone; of several, each falls back to its own work and title.
    """
    n = targets.groupBy(work).agg(F.count(F.lit(1)).alias("n_originals"))
    rows = works.join(n, work, "left").join(targets, work, "left")
    doi_r, doi_o = F.coalesce(T.clean_doi(F.col("doi_r")), F.lit("")), F.coalesce(T.clean_doi(F.col("doi")), F.lit(""))
    many = F.col("n_originals") > 1
    own = lambda c: F.when(many, F.col(c))
    left, right = side(doi_r, F.col("oa_work_id_r"), F.col("title_r")), side(doi_o, own("openalex_id"), own("title"))
    linked = F.col("n_originals").isNotNull()
    return rows.select(
        work, F.md5(F.concat_ws("|", left, right)).alias("pair_id"), doi_r.alias("doi_r"), doi_o.alias("doi_o"),
        F.coalesce(F.when(many, F.concat(F.lit("W"), T.work_id(F.col("openalex_id")))), F.lit("")).alias("oa_work_id_o"), F.coalesce("title", F.lit("")).alias("title_o"), T.year_text(F.col("year")).alias("year_o"),
        F.when(linked, F.coalesce("method", F.lit("target_pending"))).otherwise(F.col("ending")).alias("link_method"), F.coalesce(F.when(linked, F.col("evidence")).otherwise(F.col("error")), F.lit("")).alias("link_evidence"),
        F.when(linked & F.col("confidence").isin("high", "low"), F.col("confidence")).otherwise("low").alias("link_confidence"),
        F.when(linked, F.coalesce("outcome", F.lit(""))).when(F.col("ending") == "api_error", "api_error").otherwise("").alias("outcome"),
        F.coalesce("record_type", F.lit("")).alias("type"), F.coalesce("rank", F.lit(1)).cast("long").alias("original_rank"), F.coalesce("n_originals", F.lit(1)).alias("n_originals"),
    )


def total_order(rank: str = "original_rank", position: str = "position", work: str = "work_id") -> list[Column]:
    """What rows of an export are sorted by, so that two exports of the same rows are the same file: work, rank (its position where that isn't a number) and position."""
    return [F.col(work), F.coalesce(T.whole(F.col(rank)), (F.col(position) + 1).cast("int")), F.col(position)]


def draws(df: DataFrame, key: str, seed: str, sizes: dict[str, int]) -> DataFrame:
    """(draw, key): disjoint seeded samples of the distinct keys, each of its size, or what is left; the same for any order of rows.

    As many rows as the samples have are taken by a top-k before they are numbered.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    picked = df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_h", h).orderBy("_h", key).limit(sum(sizes.values()))
    n = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_h", key))
    name, upto = F.lit(None).cast("string"), sum(sizes.values())
    for s, k in reversed(sizes.items()):
        upto -= k
        name = F.when((n > upto) & (n <= upto + k), s).otherwise(name)
    return picked.select(name.alias("draw"), key).where("draw IS NOT NULL")


def patches(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, patch): for each key of both versions the columns whose text differs, with their new text; rows without a change or key are left out."""
    columns = [c for c in before.columns if c != key and c in after.columns]
    renamed = after.select(key, F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).alias("_new"))
    old = before.where(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "").select(key, F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).alias("_old"))
    changed = F.array_compact(F.array(*[F.when(F.col(f"_old.{c}") != F.col(f"_new.{c}"), F.struct(F.lit(c).alias("column"), F.col(f"_new.{c}").alias("value"))) for c in columns]))
    return old.join(renamed, key).select(key, F.map_from_entries(changed).alias("patch")).where(F.size("patch") > 0)


def apply_patches(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """rows with the columns of their patch replaced."""
    out = rows.join(changes.select(key, F.col("patch").alias("_patch")), key, "left")
    return out.select(*[F.coalesce(F.try_element_at("_patch", F.lit(c)).cast(rows.schema[c].dataType), F.col(c)).alias(c) if c != key else F.col(c) for c in rows.columns])
