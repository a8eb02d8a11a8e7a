"""Places, running sums and trailing windows over many parts, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from screenloom.operators import running


@pytest.mark.parametrize("n,parts,rows", [(500, 7, 50), (40, 16, 50), (200, 9, 3), (1, 4, 5), (0, 3, 5), (60, 60, 20)])
def test_sums_and_windows(spark, n, parts, rows):
    dice = random.Random(n)
    data = [(i, dice.randrange(6), dice.choice([None, 1, -4, 10**12])) for i in range(n)]
    df = spark.createDataFrame(data, "id long, at int, v long").repartition(5)
    out = running.in_order(df, ["at", "id"], parts).trailing(rows, last=lambda w: F.sum("v").over(w), first=lambda w: F.first("id").over(w)).running(total=F.col("v"), n=F.lit(1)).rows
    got = sorted((r["_place"], r["id"], r["last"], r["first"], r["total"], r["n"]) for r in out.collect())
    ranked, total, want = sorted(data, key=lambda r: (r[1], r[0])), 0, []
    for k, (i, _, v) in enumerate(ranked):
        total += v or 0
        window = ranked[max(0, k - rows + 1) : k + 1]
        seen = [x[2] for x in window if x[2] is not None]
        want.append((k + 1, i, sum(seen) if seen else None, window[0][0], total, k + 1))
    assert got == want


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("part"))
    assert [(r.k, r.row) for r in running.numbered(df, [F.desc("k")]).orderBy("row").collect()] == [(999 - i, i + 1) for i in range(1000)]
    with pytest.raises(ValueError):
        running.in_order(df, ["k"]).trailing(0)
