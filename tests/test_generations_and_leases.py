"""Equivalent generations, budgets, uploads, and leases as streaming state."""

import datetime as dt
import random

from pyspark.sql import functions as F

from screenloom.operators import claims
from screenloom.streaming import leases


def test_generation_classes(spark):
    pairs = [("g2", "g1"), ("g3", "g2"), ("x1", "x2"), ("y", "y"), ("g9", "g3"), (None, "z"), *[(f"c{i:02}", f"c{i + 1:02}") for i in range(40)]]
    classes = claims.generation_classes(spark.createDataFrame(pairs, "a string, b string"))
    got = {r["generation"]: r["class"] for r in classes.collect()}
    assert got == {g: "g1" for g in ("g1", "g2", "g3", "g9")} | {"x1": "x1", "x2": "x1", "y": "y"} | {f"c{i:02}": "c00" for i in range(41)}
    verdicts = spark.createDataFrame([(1, "g1"), (2, "g9"), (3, "x1"), (4, "new"), (5, None)], "id int, generation string")
    ids = lambda g: sorted(r.id for r in claims.answering(verdicts, classes, g).collect())
    assert ids("g3") == [1, 2] and ids("new") == [4] and ids("x2") == [3] and ids("none") == []


def test_budget(spark):
    dice = random.Random(1)
    data = [(i, dice.choice([None, 0, 5, 7, -3])) for i in range(200)]
    df = spark.createDataFrame(data, "work_id long, cost long").repartition(6)
    for bound, spent in ((100, 0), (0, 0), (50, 49), (10**9, 0)):
        total, want = spent, {}
        for i, c in data:
            want[i] = (total, total < bound)
            total += max(c or 0, 0)
        got = {r.work_id: (r.spent_before, r.decided) for r in claims.affordable(df, "cost", ["work_id"], bound, spent).collect()}
        assert got == want
    claims.register_tier(claims.Tier("budgeted", ("a",), judge=lambda w: w.withColumn("vote", F.lit("yes")), decide=lambda v: v))
    routed = df.withColumn("pile", F.when(F.col("work_id") % 2 == 0, "a").otherwise("b"))
    done = spark.createDataFrame([(0,)], "work_id long")
    ids = sorted(r.work_id for r in claims.run_tier("budgeted", routed, done, budget=20).collect())
    total, want = 0, []
    for i, c in data[2::2]:
        if total < 20:
            want.append(i)
        total += max(c or 0, 0)
    assert ids == want


def test_mark_uploaded(spark):
    rows = spark.createDataFrame([(1, "h1", claims.PENDING), (2, "h2", claims.PENDING), (3, "h1", "other"), (4, None, claims.PENDING), (5, "", claims.PENDING)], "id int, response_hash string, response_state string")
    stored = spark.createDataFrame([("h1",), ("h1",), (None,), ("",)], "response_hash string")
    out = claims.mark_uploaded(rows, stored)
    assert out.columns == rows.columns
    assert {r.id: r.response_state for r in out.collect()} == {1: claims.UPLOADED, 2: claims.PENDING, 3: "other", 4: claims.PENDING, 5: claims.PENDING}


def test_leases_run_out_and_are_renewed(spark, tmp_path):
    leases.configure(spark)
    base = dt.datetime(2024, 1, 1, 12)
    minute = lambda m: base + dt.timedelta(minutes=m)
    batches = [
        [("a", "claim", 0, 60), ("b", "claim", 0, 60), ("c", "claim", 1, 30), ("d", "claim", 1, 90)],
        [("b", "renew", 20, 120), ("b", "renew", 21, 90), ("c", "finish", 25, 30), ("d", "release", 26, 90), ("never", "renew", 26, 90)],
        [("tick", "claim", 70, 1000)],  # the watermark passes a's end
        [("a", "renew", 71, 200), ("tick", "renew", 125, 1000)],
        [("b", "finish", 130, 200), ("tick", "renew", 140, 1000)],
    ]
    source = str(tmp_path / "in")
    schema = "claim string, kind string, at timestamp, expires_at timestamp"
    rows = lambda b: spark.createDataFrame([(c, k, minute(m), minute(e)) for c, k, m, e in b], schema).coalesce(1)
    rows(batches[0]).write.mode("append").json(source)
    query = leases.lease_states(spark.readStream.schema(schema).json(source)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").start()
    try:
        query.processAllAvailable()
        for b in batches[1:]:
            rows(b).write.mode("append").json(source)
            query.processAllAvailable()
        query.processAllAvailable()
    finally:
        query.stop()
    got = {(r.claim, r.state, round((r.at - base).total_seconds() / 60)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", "active", 0), ("b", "active", 0), ("c", "active", 1), ("d", "active", 1), ("c", "finished", 25), ("d", "released", 26), ("tick", "active", 70), ("a", "expired", 60), ("b", "expired", 120)}


def test_stale_and_tampered_verdicts_and_pending_responses(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    verdicts = spark.createDataFrame([(1, 10, "h1", t(5)), (2, 11, "old", t(5)), (3, 12, None, t(5)), (4, 13, "", t(5)), (5, 14, "h", t(5)), (6, 15, None, t(5))], "work_id int, id int, question_hash string, at timestamp")
    questions = spark.createDataFrame([(1, "h1", t(9)), (2, "new", t(1)), (3, "x", t(9)), (4, "x", t(5)), (6, "x", None)], "work_id int, question_hash string, text_at timestamp")
    assert sorted((r.id, r.reason) for r in claims.stale(verdicts, questions).collect()) == [(11, "question moved"), (12, "text is newer")]
    before = spark.createDataFrame([(1, "a", None, "p"), (2, "b", 1, "p"), (3, None, 2, "p"), (4, "d", 3, "p")], "id int, verdict string, n int, response_state string")
    after = spark.createDataFrame([(1, "a", None, "u"), (2, "c", 9, "p"), (3, None, None, "p"), (9, "new", 1, "p")], "id int, verdict string, n int, response_state string")
    assert sorted(map(tuple, claims.tampered(before, after).collect())) == [(2, "verdict,n"), (3, "n"), (4, "deleted")]
    pending = spark.createDataFrame([(1, "h", claims.PENDING), (2, "h", claims.PENDING), (3, "g", claims.PENDING), (4, "k", claims.UPLOADED), (5, None, claims.PENDING)], "id int, response_hash string, response_state string")
    blobs = spark.createDataFrame([("h",), ("h",), ("k",)], "response_hash string")
    assert sorted(map(tuple, claims.reconcile(pending, blobs).collect())) == [("g", 1, 3, False), ("h", 2, 1, True)]
    event = lambda c, kind, at, end, works: (c, "t", kind, works, t(at), t(end))
    events = spark.createDataFrame([event("a", "claim", 1, 3, [1, 2]), event("a", "renew", 2, 6, [1, 2]), event("b", "claim", 1, 3, [3]), event("c", "claim", 1, 3, [4]), event("c", "finish", 2, 3, [4])], claims.SCHEMA)
    assert [tuple(r) for r in claims.expired(events, "2024-01-04").collect()] == [("b", "t", t(3), 1)]
    batch = spark.createDataFrame([(1,), (1,), (3,), (4,), (9,)], "work long")
    assert [tuple(r) for r in claims.conflicts(batch, events, "t", "2024-01-04").collect()] == [(1, "a")] and claims.conflicts(batch, events, "u", "2024-01-04").count() == 0
