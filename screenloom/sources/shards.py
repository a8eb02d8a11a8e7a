"""Tables in shards with a manifest: exchanging caches and pools between two places, a changed shard at a time.

A shard is the rows of equal values in some columns.  Writing puts shards under a run of their
own and then appends to the manifest a row for each, with its number of rows and a digest that
doesn't depend on their order; the last row of a shard says where it is.  Two places are
compared by their manifests, and only shards that differ are read and written.  Nothing is
moved or deleted before the manifest says so, so that whoever reads sees a shard as it was or
as it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exports import Refused, exists


def shard_of(key: Column, digits: int = 2) -> Column:
    """A shard's name by the first hex digits of the key's digest."""
    return F.substring(F.md5(key), 1, digits)


@dataclass(frozen=True)
class Shards:
    """A table at a path, in shards by the columns `by`; gate: what admitted its rows, if anything did."""

    spark: SparkSession
    path: str
    schema: T.StructType
    by: list[str]
    gate: str = ""
    #: Fields of the manifest behind `by`.
    facts: tuple[str, ...] = field(default=("run", "rows", "digest", "gate"), init=False)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema if f.name not in self.by]

    def history(self) -> DataFrame:
        """All rows of the manifest."""
        kinds = T.StructType([self.schema[c] for c in self.by] + [T.StructField("run", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("gate", T.StringType())])
        path = f"{self.path}/manifest"
        return self.spark.read.schema(kinds).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], kinds)

    def manifest(self) -> DataFrame:
        """The last row of each shard, empty ones left out."""
        last = self.history().groupBy(*self.by).agg(F.max_by(F.struct(*self.facts), "run").alias("m"))
        return last.select(*self.by, *[F.col("m")[c].alias(c) for c in self.facts]).where("rows > 0")

    def read(self, shards: DataFrame | None = None) -> DataFrame:
        """The rows, or those of some shards only: the others' files aren't opened."""
        current = self.manifest().select(*self.by, "run")
        current = current if shards is None else current.join(shards.select(*self.by).distinct(), self.by, "left_semi")
        if not exists(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField("run", T.LongType())])
        rows = self.spark.read.schema(whole).parquet(f"{self.path}/data").join(current, [*self.by, "run"], "left_semi")
        return rows.select(*[f.name for f in self.schema])

    def digests(self, rows: DataFrame) -> DataFrame:
        """(by, rows, digest) of each shard of these rows: sums of two hashes of a row, which no order changes."""
        line = F.to_json(F.struct(*sorted(self.columns)), {"ignoreNullFields": "false"})
        total = lambda c: F.sum(c.cast("decimal(20,0)")).cast("string")
        both = rows.select(*self.by, line.alias("_line")).groupBy(*self.by).agg(F.count(F.lit(1)).alias("rows"), total(F.xxhash64("_line")).alias("_a"), total(F.xxhash64(F.reverse("_line"))).alias("_b"))
        return both.select(*self.by, "rows", F.concat_ws(":", "rows", "_a", "_b").alias("digest"))

    def put(self, rows: DataFrame, emptied: DataFrame | None = None) -> DataFrame:
        """Replace the shards that these rows are of, and those of `emptied` by nothing; the manifest's new rows."""
        run = (self.history().agg(F.max("run")).first()[0] or 0) + 1
        place = f"{self.path}/data/run={run}"
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.mode("overwrite").partitionBy(*self.by).parquet(place)
        there = self.digests(self.spark.read.schema(self.schema).parquet(place)) if exists(self.spark, place) else self.digests(self.spark.createDataFrame([], self.schema))
        if emptied is not None:
            gone = emptied.select(*self.by).distinct().join(there, self.by, "left_anti")
            there = there.unionByName(gone.select(*self.by, F.lit(0).cast("long").alias("rows"), F.lit("").alias("digest")))
        new = there.select(*self.by, F.lit(run).cast("long").alias("run"), "rows", "digest", F.lit(self.gate).alias("gate"))
        new.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return self.history().where(F.col("run") == run)


def differing(here: Shards, there: Shards) -> DataFrame:
    """(by, mine, theirs) of shards whose digests differ; null where a side has none."""
    mine, theirs = here.manifest().select(*here.by, F.col("digest").alias("mine")), there.manifest().select(*here.by, F.col("digest").alias("theirs"))
    return mine.join(theirs, here.by, "full").where(~F.col("mine").eqNullSafe(F.col("theirs")))


def check_gates(source: Shards, target: Shards, force: bool = False) -> None:
    """Raises if the two places were filled under different gates."""
    gates = {r.gate for r in source.manifest().select("gate").distinct().unionByName(target.manifest().select("gate").distinct()).collect() if r.gate}
    if len(gates) > 1 and not force:
        raise Refused(f"{source.path} and {target.path} were filled under different gates: {', '.join(sorted(gates))}")


def copy(source: Shards, target: Shards, only: Column | None = None, force: bool = False) -> DataFrame:
    """Make the target's shards those of the source, or some of them; the manifest's new rows.

    Shards of equal digests are skipped.  Shards that only the target has stay.  Refused where
    gates differ, and where a shard would lose rows, unless forced.
    """
    check_gates(source, target, force)
    todo = differing(target, source).where(F.col("theirs").isNotNull())
    todo = todo if only is None else todo.where(only)
    if not force:
        sizes = target.manifest().select(*target.by, F.col("rows").alias("had")).join(source.manifest().select(*target.by, "rows"), target.by).join(todo.select(*target.by), target.by, "left_semi")
        if losing := sizes.where("rows < had").limit(20).collect():
            raise Refused("shards would lose rows: " + ", ".join("/".join(str(r[c]) for c in target.by) + f" ({r.had} to {r.rows})" for r in losing))
    return target.put(source.read(todo))


def unproven(store: Shards, namespace: str, value: str) -> DataFrame:
    """Namespaces of which a store has misses (null values) and no value: whoever filled it may not have had access."""
    return store.read().groupBy(namespace).agg(F.count(value).alias("_hits"), F.count(F.lit(1)).alias("_n")).where("_hits = 0 AND _n > 0").select(namespace)


def pull(remote: Shards, local: Shards, namespace: str, key: str, value: str, guarded: list[str] | None = None) -> DataFrame:
    """Merge a remote cache into the local one; the manifest's new rows.

    Only shards that differ are read on either side, and only those whose rows change are
    written.  A row that is there locally stays; of the remote's others all come, but for
    misses of a namespace that the remote has misses of only, where it may have lacked access:
    this holds for namespaces in `guarded`, or for all.
    """
    todo = differing(local, remote).where(F.col("theirs").isNotNull()).select(*local.by)
    blind = unproven(remote, namespace, value)
    blind = blind if guarded is None else blind.where(F.col(namespace).isin(*guarded))
    fresh = remote.read(todo).join(blind.withColumn("_blind", F.lit(True)), namespace, "left").where(F.col(value).isNotNull() | F.col("_blind").isNull()).drop("_blind")
    keys = list(dict.fromkeys([*local.by, namespace, key]))
    fresh = fresh.join(local.read(todo).select(*keys), keys, "left_anti")
    gaining = fresh.select(*local.by).distinct()
    return local.put(fresh.unionByName(local.read(gaining)))
