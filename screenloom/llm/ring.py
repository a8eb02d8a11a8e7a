"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many points on a ring, and a key belongs to the first point
clockwise of its hash.  A shard takes keys up to its bound; keys beyond it go on
clockwise to the next shard with room.  With bounds of floor(n / shards) or one
more, the counts of any two shards differ by at most one.

Only counts per point and salt, as many as the ring has, reach the driver.  There
they are dealt to shards; a key finds its place by its rank within (point, salt).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .words import stream

SHARDS = 16
#: Points of a shard, and parts into which the keys of each point are dealt for ranking.
POINTS, SALTS = 64, 16
#: Hashes are below TOP; the ring is cut in slices to find a hash's point by an equal slice.
TOP, SLICES = 1 << 62, 1 << 12
#: Places listed at once for equal rows.
LISTED = 4096


def ring(shards: int, points: int) -> list[tuple[int, int]]:
    """(position, shard) in order; a shard's points don't depend on how many shards there are."""
    return sorted((int(p) % TOP, s) for s in range(shards) for p in stream(1000 + s, points))


def deal_loads(owners: list[int], loads: list[int], bounds: list[int]) -> list[list[tuple[int, int]]]:
    """For each point, (shard, keys) in the order of its keys.

    Round by round: at first every key is at its own point's shard, and a shard with
    room takes from its points in ring order.  What is left at a point moves on
    clockwise to the next point, past full shards.
    """
    room, taken, n = list(bounds), [[] for _ in owners], len(owners)
    waiting = [(p, p, k) for p, k in enumerate(loads) if k]
    while waiting:
        later = []
        for home, at, k in sorted(waiting, key=lambda x: (x[1], x[0])):
            s = owners[at]
            if got := min(k, room[s]):
                room[s] -= got
                taken[home].append((s, got))
            if k > got:
                step = 1
                while not room[owners[(at + step) % n]]:
                    step += 1
                later.append((home, (at + step) % n, k - got))
        # a shard may have filled since: those waiting for it go on in the next round
        waiting = later
    return taken


def arcs(positions: list[int]) -> list[tuple[int, int, int, int]]:
    """(slice, low, high, point): hashes in low < h <= high of that slice of the ring belong to the point."""
    width = TOP // SLICES
    out = []
    for point, (a, b) in enumerate(zip([-1, *positions], [*positions, TOP], strict=True)):
        point %= len(positions)
        for i in range(max(a + 1, 0) // width, min(b, TOP - 1) // width + 1):
            low, high = max(a, i * width - 1), min(b, (i + 1) * width - 1)
            if low < high:
                out.append((i, low, high, point))
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, points: int = POINTS, salts: int = SALTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard and slot (its place in the shard, gapless from 0) for every row.

    size: UTF-8 bytes of the text plus 1; text_crc32: of the same bytes.
    Null text: size 1, the checksum of no bytes.  Null key: hashed as no text, a key
    like others.  Rows with the same key share a point, and are dealt on with it.
    Empty table: empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    at, spark = ring(shards, points), docs.sparkSession
    found = F.broadcast(spark.createDataFrame(arcs([p for p, _ in at]), "slice int, after long, upto long, point int"))
    hashed = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit("ring")), F.lit(TOP))
    rows = rows.withColumn("h", hashed).withColumn("slice", F.shiftright("h", TOP.bit_length() - SLICES.bit_length()).cast("int"))
    rows = rows.join(found, "slice").where("after < h AND h <= upto").drop("slice", "h", "after", "upto")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("key", "size", "text_crc32", F.lit("salt")), F.lit(salts)).cast("int"))

    counts = defaultdict(int)
    for r in rows.groupBy("point", "salt").agg(F.sum("copies").alias("n")).collect():
        counts[r.point, r.salt] = r.n
    owners = [s for _, s in at]
    loads = [sum(counts[p, s] for s in range(salts)) for p in range(len(at))]
    total = sum(loads)
    dealt = deal_loads(owners, loads, [total // shards + (s < total % shards) for s in range(shards)])

    # of each point: its keys from rank `low` on go to `shard`, at `slot` and after
    filled, spans = [0] * shards, []
    for p, parts in enumerate(dealt):
        low = 0
        for s, k in parts:
            spans.append((p, low, low + k, s, filled[s]))
            low, filled[s] = low + k, filled[s] + k
    before = [(p, s, sum(counts[p, x] for x in range(s))) for p in range(len(at)) for s in range(salts) if counts[p, s]]

    before_df = F.broadcast(spark.createDataFrame(before or [(0, 0, 0)], "point int, salt int, before long"))
    spans_df = F.broadcast(spark.createDataFrame(spans or [(0, 0, 0, 0, 0)], "point int, low long, high long, shard int, slot0 long"))
    order = Window.partitionBy("point", "salt").orderBy("key", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(before_df, ["point", "salt"]).withColumn("rank", F.sum("copies").over(order) - F.col("copies") + F.col("before"))
    # equal rows are listed in steps, so that no list is long
    steps = placed.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(LISTED).cast("long"))))
    one = steps.withColumn("i", F.explode(F.sequence("step", F.least(F.col("step") + LISTED, "copies") - 1))).withColumn("rank", F.col("rank") + F.col("i"))
    out = one.join(spans_df, "point").where("rank >= low AND rank < high")
    return out.select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("low")).alias("slot"))


def loads_moved(before: np.ndarray, after: np.ndarray) -> float:
    """The fraction of keys whose shard changed."""
    return float((before != after).mean()) if len(before) else 0.0
