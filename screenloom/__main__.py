"""Command line: list rules, route a pool, compare two bundles, export piles, claim and release works, and show a store's state.

    python -m screenloom specs --rules RULES
    python -m screenloom route --pool POOL --rules RULES --store STORE --at TIME
    python -m screenloom diagnose --pool POOL --rules RULES --other RULES
    python -m screenloom export --pool POOL --rules RULES --store STORE --release PREFIX --pile PILE --out PATH --at TIME
    python -m screenloom export-csv --pool POOL --rules RULES --store STORE --release PREFIX --out PATH --at TIME
    python -m screenloom worklist --store STORE --release PREFIX --pile PILE [--decided PARQUET]
    python -m screenloom screen --store STORE --release PREFIX --pile PILE --tier TIER --at TIME [--decided PARQUET] [--limit N] [--claim ID --run]
    python -m screenloom release-claim --store STORE --at TIME [--claim ID]
    python -m screenloom reconcile --verdicts PARQUET --stored PARQUET [--out PARQUET]
    python -m screenloom status --store STORE

Without --run, screen shows the works that it would claim; without --claim, release-claim lists
open claims; without --out, reconcile counts what it would mark. Claims are events in store/claims.
A pool is parquet with the columns of plans.rules.Pool; rules are a folder of JSON files.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import claims as C
from .plans import release as L
from .plans import rules as R
from .sources import exports


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="screenloom")
    sub = p.add_subparsers(dest="command", required=True)
    needs = {"route": ("pool", "rules", "store", "at"), "diagnose": ("pool", "rules", "other"), "export": ("pool", "rules", "store", "release", "pile", "out", "at"), "worklist": ("store", "release", "pile"), "status": ("store",)}
    needs |= {"specs": ("rules",), "export-csv": ("pool", "rules", "store", "release", "out", "at"), "screen": ("store", "release", "pile", "tier", "at"), "release-claim": ("store", "at"), "reconcile": ("verdicts", "stored")}
    more = {"worklist": ("decided",), "screen": ("decided", "claim"), "release-claim": ("claim",), "reconcile": ("out",)}
    for name, options in needs.items():
        one = sub.add_parser(name)
        for o in options:
            one.add_argument(f"--{o}", required=True)
        for o in more.get(name, ()):
            one.add_argument(f"--{o}")
        if name == "screen":
            one.add_argument("--limit", type=int)
            one.add_argument("--run", action="store_true")
        if name in ("export", "export-csv"):
            one.add_argument("--from-year", type=int)
            one.add_argument("--to-year", type=int)
    return p


def read_claims(spark: SparkSession, store: str) -> DataFrame:
    path = f"{store}/claims"
    return spark.read.schema(C.SCHEMA).parquet(path) if exports.exists(spark, path) else spark.createDataFrame([], C.SCHEMA)


def add_claim(event: DataFrame, store: str) -> None:
    event.coalesce(1).write.mode("append").parquet(f"{store}/claims")


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    """What a command shows, as rows."""
    a = parser().parse_args(argv)
    if a.command == "route":
        pool, rules = spark.read.parquet(a.pool), R.load_folder(a.rules)
        inputs = L.Inputs(R.bundle_digest(rules), L.pool_digest(pool))
        release = L.build(pool, rules, R.Pool(), a.store, inputs, a.at)
        return L.read(spark, a.store, "routing", release).groupBy("release_id", "pile").agg(F.count(F.lit(1)).alias("works"))
    if a.command == "diagnose":
        both = R.route_two(spark.read.parquet(a.pool), R.load_folder(a.rules), R.load_folder(a.other))
        return both.groupBy(F.col("pile_a").alias("was"), F.col("pile_b").alias("becomes")).agg(F.count(F.lit(1)).alias("works"))
    if a.command == "specs":
        rules = R.load_folder(a.rules)
        return R.as_table(spark, rules).withColumn("bundle", F.lit(R.bundle_digest(rules)))
    if a.command == "reconcile":
        verdicts = spark.read.parquet(a.verdicts)
        marked = C.mark_uploaded(verdicts, spark.read.parquet(a.stored))
        if a.out:
            marked.write.mode("errorifexists").parquet(a.out)
        return marked.groupBy("response_state").agg(F.count(F.lit(1)).alias("verdicts"))
    if a.command == "release-claim":
        events = read_claims(spark, a.store)
        if a.claim:
            add_claim(C.follow(events, a.claim, "release", a.at), a.store)
            return C.state(read_claims(spark, a.store).where(F.col("claim") == a.claim))
        return C.state(events).where(F.col("state") == "active").withColumn("expired", F.col("expires_at") <= F.lit(a.at).cast("timestamp"))
    L.recover(spark, a.store)
    releases = spark.read.parquet(f"{a.store}/releases")
    if a.command == "status":
        return releases.join(spark.read.parquet(f"{a.store}/routing").groupBy("release_id").agg(F.count(F.lit(1)).alias("works")), "release_id", "left").select("release_id", "created_at", "works")
    release = L.resolve(releases, a.release)
    routing = L.read(spark, a.store, "routing", release)
    if a.command == "worklist":
        todo = routing.where(F.col("pile") == a.pile).select("work_id")
        return todo.join(spark.read.parquet(a.decided).select("work_id"), "work_id", "left_anti") if a.decided else todo
    if a.command == "screen":
        todo = routing.where(F.col("pile") == a.pile).select(F.col("work_id").alias("work"))
        todo = todo.join(spark.read.parquet(a.decided).select(F.col("work_id").alias("work")), "work", "left_anti") if a.decided else todo
        events = read_claims(spark, a.store)
        todo = todo.join(C.live(events, a.tier, a.at).select("work"), "work", "left_anti")
        todo = todo.orderBy("work").limit(a.limit) if a.limit is not None else todo
        if not a.run:
            return todo
        if not a.claim or todo.isEmpty():
            raise SystemExit("a claim needs an id (--claim) and works that aren't decided")
        add_claim(C.claim(events, todo, a.claim, a.tier, a.at), a.store)
        return C.state(read_claims(spark, a.store).where(F.col("claim") == a.claim))
    pool, rules = spark.read.parquet(a.pool), R.load_folder(a.rules)
    L.check_binding(releases, release, bundle=R.bundle_digest(rules), pool=L.pool_digest(pool))
    piles = [a.pile] if a.command == "export" else list(R.SCREENS)
    rows = reduce(DataFrame.unionByName, [L.export_rows(pool, routing, rules, p, release, from_year=a.from_year, to_year=a.to_year) for p in piles])
    manifest = exports.export_csv(rows, a.out, rows.columns, [F.col("work_id")], a.at, {"release_id": release, "pile": ",".join(piles)})
    return spark.createDataFrame([(a.out, manifest["rows"], manifest["sha256"])], "path string, rows long, sha256 string")


def main() -> None:
    spark = SparkSession.builder.appName("screenloom").getOrCreate()
    try:
        import sys

        run(spark, sys.argv[1:]).show(1000, truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
