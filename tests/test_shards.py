"""Sharded tables: merging caches, copying pools, refusals, and readers in between."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenloom.sources import exports, shards

SCHEMA = T.StructType([T.StructField("ns", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])


@pytest.fixture
def two(spark, tmp_path):
    return [shards.Shards(spark, f"{tmp_path}/{n}", SCHEMA, ["ns", "shard"], gate=g) for n, g in (("here", "a"), ("there", "b"))]


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def held(store):
    return sorted(map(tuple, store.read().collect()), key=str)


def test_put_replaces_shards_and_empties_them(spark, two):
    here, _ = two
    assert held(here) == [] and here.manifest().count() == 0
    here.put(rows(spark, ("a", 1, "x", "1"), ("a", 2, "y", None), ("b", 1, "z", "3")))
    first = {(r.ns, r.shard): r.digest for r in here.manifest().collect()}
    here.put(rows(spark, ("a", 2, "y", None), ("a", 1, "x", "9")), emptied=spark.createDataFrame([("b", 1)], "ns string, shard int"))
    assert held(here) == [("a", 1, "x", "9"), ("a", 2, "y", None)]
    now = {(r.ns, r.shard): (r.digest, r.run) for r in here.manifest().collect()}
    assert now["a", 2] == (first["a", 2], 2) and now["a", 1][0] != first["a", 1] and ("b", 1) not in now
    # a run whose manifest was never written isn't seen
    rows(spark, ("a", 1, "lost", "1")).write.partitionBy("ns", "shard").parquet(f"{here.path}/data/run=3")
    assert held(here) == [("a", 1, "x", "9"), ("a", 2, "y", None)]


def test_digests_tell_order_apart_from_content(spark, two):
    here, _ = two
    data = [("a", 1, f"k{i}", str(i)) for i in range(50)]
    one, other = (here.digests(rows(spark, *d).repartition(n)).first().digest for d, n in ((data, 3), (data[::-1], 7)))
    changed = here.digests(rows(spark, *data[:-1], ("a", 1, "k49", None))).first().digest
    twice = here.digests(rows(spark, *data, data[0])).first().digest
    assert one == other and len({one, changed, twice}) == 3


def test_pull_merges_changed_shards_only(spark, two):
    here, there = two
    here.put(rows(spark, ("a", 1, "x", "mine"), ("a", 2, "y", "1"), ("c", 1, "z", None)))
    there.put(rows(spark, ("a", 1, "x", "theirs"), ("a", 1, "n", "new"), ("a", 1, "m", None), ("a", 2, "y", "1"), ("b", 1, "q", None), ("c", 1, "z", "late")))
    put = shards.pull(there, here, "ns", "k", "v")
    assert {(r.ns, r.shard) for r in put.collect()} == {("a", 1)}
    assert held(here) == [("a", 1, "m", None), ("a", 1, "n", "new"), ("a", 1, "x", "mine"), ("a", 2, "y", "1"), ("c", 1, "z", None)]
    assert {(r.ns, r.shard) for r in shards.pull(there, here, "ns", "k", "v", guarded=["c"]).collect()} == {("b", 1)}
    assert shards.pull(there, here, "ns", "k", "v", guarded=[]).count() == 0


def test_copy_skips_equal_shards_and_refuses(spark, two):
    here, there = two
    there.put(rows(spark, ("a", 1, "x", "1"), ("a", 2, "y", "2"), ("b", 1, "z", "3")))
    assert shards.copy(there, here, only=F.col("ns") == "a").count() == 2
    with pytest.raises(exports.Refused, match="different gates: a, b"):
        shards.copy(there, here)
    same = shards.Shards(spark, here.path + "-2", SCHEMA, ["ns", "shard"], gate="b")
    same.put(rows(spark, ("a", 1, "x", "1"), ("a", 1, "more", "1"), ("own", 1, "o", "1")))
    with pytest.raises(exports.Refused, match=r"a/1 \(2 to 1\)"):
        shards.copy(there, same)
    assert {(r.ns, r.shard) for r in shards.copy(there, same, force=True).collect()} == {("a", 1), ("a", 2), ("b", 1)}
    assert shards.copy(there, same).count() == 0 and ("own", 1, "o", "1") in held(same)
