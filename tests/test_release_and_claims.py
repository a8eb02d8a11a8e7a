"""Releases, claims, tiers and parsing."""

import random

import pytest
from pyspark.sql import functions as F

from screenloom.functions import parse
from screenloom.operators import claims
from screenloom.plans import release
from screenloom.plans import rules as R
from tests_data import CONTENTS, MATCHES, SCHEMA, WORKS


def test_release(spark, tmp_path):
    pool, rules, store = spark.createDataFrame(WORKS, SCHEMA), R.load(CONTENTS), f"{tmp_path}/store"
    pool.write.parquet(f"{tmp_path}/pool")
    digest = release.pool_digest(spark.read.parquet(f"{tmp_path}/pool"))
    assert len(digest) == 64 and digest == release.pool_digest(spark.read.parquet(f"{tmp_path}/pool"))
    one = release.Inputs(R.bundle_digest(rules), digest)
    two = release.Inputs(R.bundle_digest(rules[1:]), digest)
    for _ in range(2):  # again: replaced, not doubled
        first = release.build(pool, rules, R.Pool(), store, one, "2024-01-01T00:00:00Z")
    second = release.build(pool, rules[1:], R.Pool(), store, two, "2024-01-02T00:00:00Z")
    assert release.read(spark, store, "routing", first).count() == 8 and release.read(spark, store, "evaluations", first).count() == MATCHES
    assert release.read(spark, store, "routing", second).where("pile = 'discard'").count() == 1
    rows = release.export_rows(pool, release.read(spark, store, "routing", first), rules, "screen_cheap", first, from_year=2000).collect()
    assert {(r.work_id, r.paper_type, r.filter_confidence) for r in rows} == {(106, "reproduction", "medium"), (108, "replication", "medium")} and rows[0].filter_method == f"engine:{first[:12]}"
    with pytest.raises(ValueError):
        release.export_rows(pool, release.read(spark, store, "routing", first), rules, "pending", first)
    plan = release.read(spark, store, "routing", first)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(release_id" in plan
    releases = spark.read.parquet(f"{store}/releases")
    assert releases.count() == 2 and release.latest(releases) == second and release.resolve(releases, first[:10]) == first
    with pytest.raises(LookupError):
        release.resolve(releases, "")
    release.check_binding(releases, first, bundle=one.bundle)
    with pytest.raises(release.Mismatch, match="no release"):
        release.check_binding(releases, "none")
    with pytest.raises(release.Mismatch, match="bundle"):
        release.check_binding(releases, first, bundle=two.bundle, pool=digest)
    release.drop_release(spark, store, second)
    assert spark.read.parquet(f"{store}/releases").count() == 1 and spark.read.parquet(f"{store}/routing").count() == 8


def test_claims(spark):
    none = spark.createDataFrame([], claims.SCHEMA)
    batch = lambda *w: spark.createDataFrame([(x,) for x in w], "work long")
    log = none.unionByName(claims.claim(none, batch(1, 2, 2), "a", "cheap", "2024-01-01 00:00:00"))
    with pytest.raises(claims.Conflict, match="2"):
        claims.claim(log, batch(2, 3), "b", "cheap", "2024-01-01 05:00:00")
    log = log.unionByName(claims.claim(log, batch(2, 3), "b", "expensive", "2024-01-01 05:00:00")).unionByName(claims.follow(log, "a", "renew", "2024-01-01 05:00:00"))
    assert claims.live(log, "cheap", "2024-01-01 10:00:00").count() == 2
    with pytest.raises(ValueError, match="expired"):
        claims.follow(log, "a", "renew", "2024-01-01 12:00:00")
    assert claims.live(log, "cheap", "2024-01-01 12:00:00").count() == 0
    log = log.unionByName(claims.follow(log, "b", "release", "2024-01-01 06:00:00"))
    assert {r.claim: r.state for r in claims.state(log).collect()} == {"a": "active", "b": "released"}
    with pytest.raises(ValueError, match="active"):
        claims.follow(log, "b", "finish", "2024-01-01 07:00:00")
    rows = claims.supersede(spark.createDataFrame([(1, None), (2, 9)], "id long, superseded_by long"), spark.createDataFrame([(1, 5), (2, 5)], "id long, by long"))
    assert {r.id: r.superseded_by for r in rows.collect()} == {1: 5, 2: 9}


def test_tiers(spark):
    judge = lambda works: works.withColumn("votes", F.array(F.lit("none"), F.when(F.col("work_id") == 1, "none").otherwise("yes")))
    from screenloom.operators.folds import vote_gate

    claims.register_tier(claims.Tier("test", ("screen_cheap",), judge, lambda v: v.select("work_id", vote_gate(F.col("votes")).alias("decision"))))
    with pytest.raises(ValueError):
        claims.register_tier(claims.tier("test"))
    with pytest.raises(LookupError):
        claims.tier("other")
    routed = spark.createDataFrame([(1, "screen_cheap"), (2, "screen_cheap"), (3, "screen_cheap"), (4, "discard")], "work_id long, pile string")
    done = spark.createDataFrame([(3,)], "work_id long")
    assert {r.work_id: r.decision for r in claims.run_tier("test", routed, done).collect()} == {1: "discard", 2: "proceed"}


def lcs(a, b):
    rows = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, rows[j] = rows[j], max(rows[j], rows[j - 1], last + (x == y))
    return rows[-1]


def test_parsing(spark):
    assert parse.partial_ratio("effect of sleep", "the effect of sleep on memory") == 100 and parse.partial_ratio("", "x") == 0 and parse.partial_ratio("abcd", "xxabzdxx") == 75
    for a, b in (("sleep well", "they slept very well"), ("abc", "zabz"), ("aaaa", "bbbbbbb"), ("short", "longer than short"), ("a b c d e", "e d c b a")):
        parts = [b[max(0, i) : i + len(a)] for i in range(1 - len(a), len(b))]
        plain = max(200 * lcs(a, p) / (len(a) + len(p)) for p in parts)
        assert abs(parse.partial_ratio(a, b) - plain) < 1e-9 and parse.nearly_in(a, b, 70) == (plain >= 70)
    dice = random.Random(5)
    some = ["", "a", "ab ab", "sleep well", "x" * 64, "y" * 65, *("".join(dice.choice("abcd é") for _ in range(dice.randint(1, 90))) for _ in range(60))]
    pairs = [(dice.choice(some), dice.choice(some)) for _ in range(300)] + [(None, "a"), ("a", None)]
    assert all(abs(x - parse.partial_ratio(a, b)) < 1e-9 for x, (a, b) in zip(parse.partial_ratios(pairs), pairs, strict=True))
    lists = [[["sleep well", "zzz"], []], None, [["they slept"], ["z" * 70, "they slept very well " * 4]]]
    texts = ["they slept very well", "x", "they slept very well " * 5]
    far = [[q for q in x if parse.partial_ratio(q, texts[i]) < 80] for i in (0, 2) for x in lists[i]]
    want = [min((parse.partial_ratio(q, texts[0 if n < 2 else 2]) for q in x), default=None) for n, x in enumerate(far)]
    assert parse.worst_ratios(lists, texts, 80) == [want[:2], None, want[2:]] and want[0] is not None and want[2] is None
    assert parse.quote_found("A  Quoted titel", "it has a quoted title in it") and not parse.quote_found("something else", "it has a quoted title") and not parse.quote_found("", "x")
    assert parse.token_set_ratio("Sleep and memory", "memory and sleep: again") == 100 and parse.token_set_ratio("a", None) == 0
    assert parse.fold_title("Eﬀect of Naï-\nve  Café") == "effect of naive cafe"
    row = spark.createDataFrame([("some text", None)], "t string, n string").select(parse.partial_ratio_of("t", "n").alias("p"), parse.fold_title_of("n").alias("f"), parse.token_set_ratio_of("n", "t").alias("k")).first()
    assert row.p == 0 and row.f == "" and row.k == 0
