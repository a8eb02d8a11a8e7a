"""Releases: content-addressed runs of the rules, stored as partitions of one table each.

The store has folders routing/, evaluations/ and domains/, partitioned by
release_id, and releases/ with a row per run.  Writing a release again replaces its
partitions; the row in releases/ is written last, so that a release is whole or not there.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import append_new, replace_partition
from . import rules as R


@dataclass(frozen=True)
class Inputs:
    """Digests of everything that a routing depends on."""

    bundle: str
    pool: str
    aliases: str = ""
    overlay: str = ""
    conventions: str = ""
    engine: str = "1"

    @property
    def release_id(self) -> str:
        return R.digest(asdict(self))


class Mismatch(ValueError):
    """A release was made of other inputs than those at hand."""


def pool_digest(pool: DataFrame) -> str:
    """Of a pool read from files: sha256 over (file, size, rows) in order; rows of a file are counted before anything is gathered."""
    files = pool.groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    lines = files.select(F.concat_ws(":", "name", "size", "rows").alias("line"))
    return lines.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256)).first()[0]


def build(pool: DataFrame, rules: list[R.Rule], columns: R.Pool, store: str, inputs: Inputs, created_at: str) -> str:
    """Route the pool and store the release; its id."""
    recover(pool.sparkSession, store)
    release = inputs.release_id
    work = columns.work
    routed = R.match_flags(R.route(pool, rules, columns), rules, columns, "domain").withColumn("release_id", F.lit(release))
    replace_partition(routed.select(work, "pile", "pending_reason", "rule_id", "precedence", "live", "evidence", "release_id"), f"{store}/routing", ["release_id"])
    digests = F.create_map(*[F.lit(x) for r in rules for x in (r.id, r.digest)]) if rules else F.lit(None).cast("map<string,string>")
    replace_partition(R.evaluations(routed.select(work, "matched", "release_id"), work).withColumn("rule_digest", F.try_element_at(digests, F.col("rule_id"))).withColumn("release_id", F.lit(release)), f"{store}/evaluations", ["release_id"])
    replace_partition(routed.select(work, F.explode("domains").alias("rule_id"), "release_id"), f"{store}/domains", ["release_id"])
    row = pool.sparkSession.createDataFrame([(release, created_at, *asdict(inputs).values())], "release_id string, created_at string, " + ", ".join(f"{k} string" for k in asdict(inputs)))
    append_new(row, f"{store}/releases", ["release_id"])
    return release


def read(spark: SparkSession, store: str, table: str, release: str) -> DataFrame:
    """One release's rows of routing, evaluations or domains: only its partition is read."""
    return spark.read.parquet(f"{store}/{table}").where(F.col("release_id") == release)


#: What a pile's works are called and how sure that is; `named`: a rule's vocabulary names them instead.
POLICY = {"discard": ("false_positive", "high", False), "screen_expensive": ("needs_review", "high", True), "screen_cheap": ("needs_review", "medium", True)}


def export_rows(pool: DataFrame, routing: DataFrame, rules: list[R.Rule], pile: str, release: str, work: str = "work_id", year: str = "publication_year", from_year: int | None = None, to_year: int | None = None) -> DataFrame:
    """A pile's works with status, method, evidence and confidence; raises for a pile that isn't exported, as pending.

    A work without a year fails either bound.
    """
    if pile not in POLICY:
        raise ValueError(f"pile {pile} isn't exported")
    status, confidence, named = POLICY[pile]
    own = routing.where(F.col("pile") == pile).select(work, "rule_id", "precedence", "evidence", F.array_join("live", "|").alias("matched_rules"))
    words = F.broadcast(R.as_table(pool.sparkSession, rules).select("rule_id", "vocabulary"))  # as many rows as rules
    rows = pool.join(own, work).join(words, "rule_id", "left")
    if from_year is not None or to_year is not None:
        y = F.col(year).cast("int")
        rows = rows.where((y >= from_year if from_year is not None else y.isNotNull()) & (y <= to_year if to_year is not None else y.isNotNull()))
    called = F.coalesce("vocabulary", F.lit(status)) if named else F.lit(status)
    evidence = F.concat(F.lit("rule:"), "rule_id", F.when(F.coalesce("evidence", F.lit("")) != "", F.concat(F.lit("; "), "evidence")).otherwise(""))
    kept = [c for c in pool.columns if c in (work, "title", year)]
    return rows.select(*kept, called.alias("paper_type"), F.lit(f"engine:{release[:12]}").alias("filter_method"), evidence.alias("filter_evidence"), F.lit(confidence).alias("filter_confidence"), F.col("rule_id").alias("route_rule"), F.col("precedence").alias("route_precedence"), "matched_rules")


def recover(spark: SparkSession, store: str) -> None:
    """Finish what a drop_release that broke off had begun: its rows stand beside until they are in place."""
    from ..sources.exports import _fs, exists, move

    here, new, old = (f"{store}/releases{x}" for x in ("", ".new", ".old"))
    if not exists(spark, here) and exists(spark, f"{new}/_SUCCESS"):
        move(spark, new, here)
    elif not exists(spark, here) and exists(spark, old):
        move(spark, old, here)
    for rest in (new, old):
        fs, p = _fs(spark, rest)
        fs.delete(p, True)


def drop_release(spark: SparkSession, store: str, release: str) -> None:
    """Remove a release: first its row in releases/, by rows written beside and then moved, so that a step that fails leaves the old ones or the new ones; then its partitions."""
    from ..sources.exports import _fs, move

    recover(spark, store)
    here, new, old = (f"{store}/releases{x}" for x in ("", ".new", ".old"))
    spark.read.parquet(here).where(F.col("release_id") != release).coalesce(1).write.mode("overwrite").parquet(new)
    move(spark, here, old)
    move(spark, new, here)
    for path in (old, *(f"{store}/{table}/release_id={release}" for table in ("routing", "evaluations", "domains"))):
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def resolve(releases: DataFrame, prefix: str) -> str:
    """The release that the prefix names; raises if there is none or more than one."""
    found = [r.release_id for r in releases.where(F.col("release_id").startswith(prefix)).select("release_id").distinct().limit(2).collect()]
    if len(found) != 1:
        raise LookupError(f"{'no' if not found else 'more than one'} release begins with {prefix!r}")
    return found[0]


def latest(releases: DataFrame) -> str | None:
    """The newest release by time, ties by id; times that can't be read are oldest."""
    from ..functions.text import utc

    return releases.agg(F.max_by("release_id", F.struct(F.coalesce(utc(F.col("created_at")), F.timestamp_seconds(F.lit(0))), "release_id"))).first()[0]


def check_binding(releases: DataFrame, release: str, **now: str) -> None:
    """Raises Mismatch naming each input (bundle, aliases, overlay, ...) that isn't the release's."""
    row = releases.where(F.col("release_id") == release).first()
    if row is None:
        raise Mismatch(f"no release {release}")
    changed = [k for k, v in now.items() if row[k] != v]
    if changed:
        raise Mismatch(f"release {release[:12]} was made with other {', '.join(changed)}")
