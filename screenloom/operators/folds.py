"""First-wins and latest-wins folds over append-only rows, votes and their gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Of the rows of each key the first in this order, whole; aggregated before any shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def latest_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Of the rows of each key the last in this order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def one_vote_each(votes: DataFrame, work: str, voter: str, order: list[str], claim: str) -> DataFrame:
    """The latest answer of each voter; answers without a voter count only from the work's latest claim."""
    named = latest_by(votes.where(F.col(voter).isNotNull()), [work, voter], order)
    unnamed = votes.where(F.col(voter).isNull())
    last = unnamed.groupBy(work).agg(F.max_by(claim, F.struct(*order)).alias(claim))
    return named.unionByName(unnamed.join(last, [work, claim], "left_semi").select(*named.columns))


def vote_gate(votes: Column, none: str = "none") -> Column:
    """discard if all of two votes or more say none; null with fewer than two votes; else proceed."""
    return F.when(F.size(votes) < 2, F.lit(None)).when(F.forall(votes, lambda v: v == none), "discard").otherwise("proceed")


def overlay(base: DataFrame, extra: DataFrame, key: str, column: str) -> DataFrame:
    """base with `column` replaced by a non-empty value of extra (one row per key)."""
    new = extra.select(key, F.col(column).alias("_new"))
    return base.join(new, key, "left").withColumn(column, F.when(F.length("_new") > 0, F.col("_new")).otherwise(F.col(column))).drop("_new")


def resolve_alias(df: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """df with the key replaced by its canonical one, in one hop; aliases: (old, canonical).

    A table of aliases may be large, so that Spark chooses the join by its size.
    """
    hop = aliases.select(F.col("old").alias(key), F.col("canonical").alias("_canonical"))
    return df.join(hop, key, "left").withColumn(key, F.coalesce("_canonical", key)).drop("_canonical")


def without(df: DataFrame, others: list[tuple[DataFrame, str]]) -> DataFrame:
    """df without rows whose key is in any of these (frame, key): one anti join per key."""
    for other, key in others:
        df = df.join(other.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return df


def dominant(df: DataFrame, keys: list[str], score: str, item: str, least: float, ratio: float) -> DataFrame:
    """Of each key the best item, if its score is at least `least` and `ratio` times the second's; a row per key and item.

    By maxima joined back, so that no task sorts a key's rows.
    """
    top = df.groupBy(*keys).agg(F.max(score).alias("_top"))
    best = df.join(top, keys).where(F.col(score) == F.col("_top")).groupBy(*keys).agg(F.min(F.struct(item, *[c for c in df.columns if c not in keys and c != item])).alias("_best"))
    rest = df.join(best.select(*keys, F.col(f"_best.{item}").alias("_item")), keys).where(~F.col(item).eqNullSafe(F.col("_item"))).groupBy(*keys).agg(F.max(score).alias("second"))
    out = best.select(*keys, "_best.*").join(rest, keys, "left").withColumn("second", F.coalesce("second", F.lit(0.0)))
    return out.where((F.col(score) >= least) & (F.col(score) >= ratio * F.col("second"))).select(*df.columns, "second")


def suffixed(df: DataFrame, base: str, order: list[str], name: str = "key", given: DataFrame | None = None) -> DataFrame:
    """Rows of an equal base told apart: the first as it is, then b, c, ... and after z the number.

    given: (key) of rows that have one already, whose places are taken.
    """
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    df = df.withColumn("_n", n)
    if given is not None:
        # a key is its base, or that with a letter or number after it
        bases = F.array_distinct(F.array("key", F.regexp_replace("key", r"[b-z]\z", ""), F.regexp_replace("key", r"(?:2[7-9]|[3-9][0-9]|[1-9][0-9]{2,})\z", "")))
        taken = given.select("key").distinct().select(F.explode(bases).alias(base)).groupBy(base).agg(F.count(F.lit(1)).alias("_taken"))
        df = df.join(taken, base, "left").withColumn("_n", F.col("_n") + F.coalesce("_taken", F.lit(0))).drop("_taken")
    return df.withColumn(name, F.concat(base, F.when(F.col("_n") == 1, "").when(F.col("_n") <= 26, F.chr(F.col("_n") + 96)).otherwise(F.col("_n").cast("string")))).drop("_n")


#: Rows of a prefix in content_digest, on average.
PER_PREFIX = 50_000


def shard_digests(df: DataFrame, key: str, lines: Column, width: int = 2) -> DataFrame:
    """(shard, rows, digest): rows dealt by the first characters of their key's md5; the digest of a shard is the same for any order of its rows.

    A sum of hashes, so that each task sends one row per shard.
    """
    part = lambda at: F.conv(F.substring(F.md5(lines), at, 15), 16, 10).cast("decimal(38,0)")
    g = df.groupBy(F.substring(F.md5(F.col(key).cast("string")), 1, width).alias("shard")).agg(F.count(F.lit(1)).alias("rows"), F.sum(part(1)).alias("a"), F.sum(part(16)).alias("b"))
    return g.select("shard", "rows", F.md5(F.concat_ws(":", "rows", "a", "b")).alias("digest"))


def changed_shards(before: DataFrame, after: DataFrame) -> DataFrame:
    """(shard, why) of shards (shard, digest) to copy: new, gone or changed."""
    both = before.select("shard", F.col("digest").alias("_was")).join(after.select("shard", "digest"), "shard", "full")
    return both.where(~F.col("_was").eqNullSafe(F.col("digest"))).select("shard", F.when(F.col("_was").isNull(), "new").when(F.col("digest").isNull(), "gone").otherwise("changed").alias("why"))


def content_digest(df: DataFrame, lines: Column) -> DataFrame:
    """One row, `fingerprint`: sha256 over the lines' sha256 in order, the same however the rows are dealt.

    Rows are first folded to one digest for each prefix of their hash, as many as keep a
    prefix under PER_PREFIX rows, and those again, so that no task holds many lines.
    """
    hashed = df.select(F.sha2(lines, 256).alias("h"))
    n, width = df.count(), 3
    while n > PER_PREFIX * 16**width:
        width += 1
    parts = hashed.groupBy(F.substring("h", 1, width).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("d"))
    for shorter in range(width - 1, 2, -1):
        parts = parts.groupBy(F.substring("p", 1, shorter).alias("q")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda x: x["d"]), "\n"), 256).alias("d")).withColumnRenamed("q", "p")
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda x: x["d"]), "\n"), 256).alias("fingerprint"))


def joined_texts(df: DataFrame, keys: list[str], order: list[str], texts: dict[str, Column], sep: str = " | ", once: bool = False) -> DataFrame:
    """For each key the texts joined in order, empty and null ones left out; once: a text that comes again is left out.

    With `once` a key's rows are first folded to one for each text, so that a key of very many
    rows with few texts is spread by its texts; then, as ever, tasks send lists of (order,
    text) that are merged and put in order: the joined text alone is as large as they.
    """
    out = None
    for name, text in texts.items():
        rows = df.select(*keys, F.struct(*order).alias("_order"), F.trim(text).alias("_text")).where(F.length("_text") > 0)
        rows = rows.groupBy(*keys, "_text").agg(F.min("_order").alias("_order")) if once else rows
        one = rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_text"))), lambda x: x["_text"]), sep).alias(name))
        out = one if out is None else out.join(one, keys, "full")
    return out


#: Fixed value: what settles nothing.
UNSETTLED = "cannot_be_determined"


def fold_axes(df: DataFrame, keys: list[str], order: list[str], axes: dict[str, tuple[str, str, str]], sep: str = " | ", once: bool = False) -> DataFrame:
    """Verdicts of several rows of a key on each axis as one; axes: column -> (value of a conflict, column of quotes, column of their sources).

    One settled value carries the axis, two that differ are its conflict, and without a settled
    one the first value that isn't empty stays.  Quotes are joined in order, each with its
    source in the same place; once: a quote with the same source that comes again is left out.
    """
    by = F.struct(*order)
    said = lambda c: F.when(F.length(c) > 0, F.col(c))
    settled = lambda c: F.when((F.length(c) > 0) & (F.col(c) != UNSETTLED), F.col(c))
    values = df.groupBy(*keys).agg(*[x for c in axes for x in (F.min(settled(c)).alias(f"_lo_{c}"), F.max(settled(c)).alias(f"_hi_{c}"), F.min_by(said(c), F.when(said(c).isNotNull(), by)).alias(f"_any_{c}"))])
    value = lambda c, conflict: F.when(F.col(f"_lo_{c}") != F.col(f"_hi_{c}"), conflict).otherwise(F.coalesce(f"_lo_{c}", f"_any_{c}", F.lit(""))).alias(c)
    out = values.select(*keys, *[value(c, conflict) for c, (conflict, _, _) in axes.items()])
    for _, quote, source in axes.values():
        rows = df.select(*keys, by.alias("_order"), F.trim(quote).alias("q"), F.trim(F.coalesce(source, F.lit(""))).alias("s")).where(F.length("q") > 0)
        rows = rows.groupBy(*keys, "q", "s").agg(F.min("_order").alias("_order")) if once else rows
        listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_order", "q", "s"))).alias("_l"))
        joined = lambda f: F.array_join(F.transform("_l", lambda x: x[f]), sep)
        out = out.join(listed.select(*keys, joined("q").alias(quote), joined("s").alias(source)), keys, "left").fillna("", [quote, source])
    return out
