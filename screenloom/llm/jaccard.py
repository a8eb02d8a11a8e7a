"""N-gram Jaccard join by a blocked sparse matrix product.

The matrix has a row per document and a column per word shingle; equal sets are one
row.  Columns are ordered from rare to frequent by the corpus counts of a sketch
(exchange.py).  Two sets with a similarity of at least t share a column among the first
n - ceil(t * n) + 1 of each, so the product is taken in two passes: over these columns,
those unique in the corpus left out, and then, for pairs that stand, over all columns.

Pass 1: blocks of columns are multiplied, each task adding up overlaps of the pairs of
rows that share its columns, and the sums of all blocks are added.  Rows of a column
are in order of size, and a row meets only those whose size and rank bound the overlap
high enough, so that pairs that can't be similar aren't made; a column of very many
rows is cut in strips, and each pair of strips is a task's.  What pass 1 has counted and
what the rest can add at most discards further pairs.
Pass 2: the overlaps of the pairs left are added up over all columns, a block of pairs
at a time.

Groups of copies aren't multiplied out: first every row of a column is paired with the
column's pivot only; then pass 1 makes pairs across the components found so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .words import sequences, split, stream, windows, word_hashes

WORDS, PERCENT = 5, 75
#: Pairs of rows multiplied at once in a task.
BLOCK = 512
#: Entries of a block of columns, and of a strip of a column with more rows; pairs of entries looked at at once.
ENTRIES, STRIP, AT_ONCE = 50_000, 20_000, 1 << 20
MARK = stream(41, 1)[0]


def needed(percent: int, n: np.ndarray) -> np.ndarray:
    """ceil(percent / 100 * n)"""
    return (percent * n + 99) // 100


def _sets(texts: pa.Array, size: int):
    """(row, shingle) of the distinct shingles of each text, sorted by both, and the number of rows."""
    words = split(texts, lower=True)
    hashes = word_hashes(words)
    at, shingles = windows(words, hashes, size)
    rows = words.row[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    rows, shingles = np.concatenate([rows, short]), np.concatenate([shingles, sequences(words, hashes, short)])
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    return rows[new], shingles[new], len(texts)


def signatures(docs: DataFrame, key: str, text: str, words: int, percent: int, chunk_bytes: int) -> DataFrame:
    """Of every document: n (set size), sig1 and sig2 (of the set), rare (shingles unique in the corpus, per million),
    tokens and places (shingles to multiply and their rank), grams (the whole set, if there are any such)."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    size, dealt = X.deal(docs, "text", chunk_bytes)
    shift = np.uint64(64 - size.bits)

    def ask(table: pa.Table) -> pa.Table:
        _, shingles, _ = _sets(X.field(table, "text"), words)
        cells, counts = np.unique(shingles >> shift, return_counts=True)
        return X.blocks(table["chunk"][0].as_py(), cells, size.bits, size.shards, counts=counts)

    def sign(table: pa.Table, told: pa.Table) -> pa.Table:
        rows, shingles, n = _sets(X.field(table, "text"), words)
        _, inverse = np.unique(shingles >> shift, return_inverse=True)
        df = X.answers(told).astype(np.int64)[inverse] if len(rows) else np.empty(0, np.int64)
        sizes = np.bincount(rows, minlength=n)
        first = np.append(0, np.cumsum(sizes))
        order = np.lexsort((shingles, df, rows))
        rank = np.arange(len(rows)) - first[rows]
        use = (rank < (sizes - needed(percent, sizes) + 1)[rows]) & (df[order] >= 2)
        chosen, token, place = rows[use], shingles[order][use], rank[use]
        ends = np.append(np.searchsorted(chosen, np.arange(n)), len(chosen))
        with np.errstate(over="ignore"):
            sums = [np.add.reduceat(np.append(v, np.uint64(0)), first[:-1]) if n else np.empty(0, np.uint64) for v in (shingles, (shingles ^ MARK) * (shingles | np.uint64(1)))]
        rare = np.bincount(rows, df == 1, n) * 1e6 // np.maximum(sizes, 1) if n else np.empty(0)
        has = np.diff(ends) > 0
        cut = lambda v, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind))
        return pa.table({
            "id": X.field(table, "id"), X.COPIES: X.field(table, X.COPIES), "n": pa.array(sizes, pa.int64()),
            "sig1": pa.array(np.where(sizes > 0, sums[0], 0).view(np.int64)), "sig2": pa.array(np.where(sizes > 0, sums[1], 0).view(np.int64)),
            "rare": pa.array(rare.astype(np.int32), pa.int32()), "tokens": cut(token.view(np.int64), pa.int64()), "places": cut(place.astype(np.int32), pa.int32()),
            "grams": pa.array([X.pack_sorted(shingles[a:b]) if h else None for a, b, h in zip(first[:-1], first[1:], has, strict=True)], pa.binary()),
        })

    counts = X.count(dealt, ask)
    out = dealt.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(sign, f"id long, {X.COPIES} long, n long, sig1 long, sig2 long, rare int, tokens array<long>, places array<int>, grams binary")
    return X.unfold(out, size)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for ids in links (a, b), by alternating stars.

    Every round is a few grouped minima and joins on the edges; rounds grow with
    the logarithm of the longest chain.
    """
    edges = X.settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    was = mark(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = X.settle(small.distinct())
        now = mark(edges)
        if now == was:
            break
        was = now
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _bounded(percent: int, n: Column, m: Column, i: Column, j: Column) -> Column:
    """Could sets of n and m shingles, equal in a shingle of ranks i and j, be similar enough?

    If it is the first that they share, at most 1 + min(n - 1 - i, m - 1 - j) are shared;
    a later shared shingle gives a smaller bound, but then the first one proposes the pair.
    """
    most = F.least(n - i, m - j)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (100 * most >= percent * (n + m - most))


def largest(percent: int, n, place):
    """The largest set that a set of n shingles can be similar to, if the one of rank `place` is the first that they share.

    They share n - place at most, call it o; a similar set of m has (100 + percent) * o >= percent * (n + m).
    """
    return (100 + percent) * (n - place) // percent - n


def entry_pairs(column: np.ndarray, n: np.ndarray, most: np.ndarray, part: np.ndarray, own: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries (x, y) of the same column and other parts, whose sizes allow each other: n of y from percent of n of x to n of x.

    The largest part of a column is met by the others only, so that copies aren't paired with each other.
    own: strip of each entry; entries of the same strip meet only where `own` is negative.
    """
    # the largest part of each column
    pairs = np.unique(np.column_stack([column, part]), axis=0, return_inverse=True, return_counts=True)
    times = pairs[2][pairs[1].reshape(-1)]
    top = np.zeros(int(column.max(initial=-1)) + 1, np.int64)
    np.maximum.at(top, column, times)
    lead = np.full(len(top), np.iinfo(np.int64).max)
    np.minimum.at(lead, column[times == top[column]], part[times == top[column]])
    large = part == lead[column]
    wide = int(n.max(initial=0)) + 2
    key = column * wide + n
    order = np.argsort(key, kind="stable")
    sides = [order[~large[order]], order[large[order]]]
    least, other = (percent * n + 99) // 100, np.minimum(most, n)
    # (rows, rows they meet, from size, to size, are both the same list?)
    larger = np.minimum(most, 100 * n // percent)
    for rows, those, low, high, same in ((sides[0], sides[0], least, other, True), (sides[0], sides[1], least, larger, False)):
        begin = np.searchsorted(key[those], column[rows] * wide + low[rows])
        end = np.searchsorted(key[those], column[rows] * wide + np.minimum(high[rows], wide - 1), "right")
        if same:
            end = np.minimum(end, np.arange(len(rows)))
        reach = np.maximum(end - begin, 0)
        a = 0
        sums = np.append(0, np.cumsum(reach))
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(sums, sums[a] + AT_ONCE, "right")) - 1)
            span = reach[a:b]
            x = np.repeat(rows[a:b], span)
            y = those[np.repeat(begin[a:b] - np.cumsum(span) + span, span) + np.arange(len(x))]
            keep = (part[x] != part[y]) & (n[x] <= most[y]) & ((own[x] < 0) | (own[x] != own[y]))
            yield x[keep], y[keep]
            a = b


def multiply_columns(table: pa.Table, percent: int) -> pa.Table:
    """(a, b, shared, place_a, place_b, n_a, n_b) of one block of columns: pairs of rows, how many columns they share, the ranks of the last in each, and their sizes.

    A column counts for a pair if it could be the first that they share; those before such a one could be as well, so that none is left out.
    """
    take = lambda c: table[c].to_numpy()
    _, column = np.unique(np.column_stack([take("token"), take("strip_a"), take("strip_b")]), axis=0, return_inverse=True)
    column, ids, n, place = column.reshape(-1), take("id"), take("n"), take("place").astype(np.int64)
    own = np.where(take("strip_a") == take("strip_b"), -1, take("strip"))
    found = [np.empty((0, 6), np.int64)]
    for x, y in entry_pairs(column, n, largest(percent, n, place), take("c"), own, percent):
        shared = np.minimum(n[x] - place[x], n[y] - place[y])
        keep = (100 + percent) * shared >= percent * (n[x] + n[y])
        x, y = x[keep], y[keep]
        x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
        order = np.lexsort((ids[y], ids[x]))
        x, y = x[order], y[order]
        new = np.flatnonzero(np.append(True, (ids[x[1:]] != ids[x[:-1]]) | (ids[y[1:]] != ids[y[:-1]]))) if len(x) else np.empty(0, np.int64)
        if len(new):
            found.append(np.column_stack([ids[x[new]], ids[y[new]], np.diff(np.append(new, len(x))), np.maximum.reduceat(place[x], new), np.maximum.reduceat(place[y], new), n[x[new]] * (1 << 32) + n[y[new]]]))
    out = np.concatenate(found)
    return pa.table({"a": out[:, 0], "b": out[:, 1], "shared": out[:, 2], "place_a": out[:, 3], "place_b": out[:, 4], "n_a": out[:, 5] >> 32, "n_b": out[:, 5] & 0xFFFFFFFF})


def candidate_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of rows of different parts that may be similar, by the product of the columns in entries (token, id, n, place, c).

    A column is worth multiplying if it has several parts, and an entry if its size
    and another's allow each other; the sums of all blocks discard pairs whose overlap
    so far and what the columns after the last shared one can add is too small.
    """
    entries = entries.withColumn("most", F.floor((100 + percent) * (F.col("n") - F.col("place")) / percent) - F.col("n"))
    stats = entries.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("small"), F.max("most").alias("reach"), F.count(F.lit(1)).alias("m")).where("lo <> hi AND small <= reach")
    worth = entries.join(stats, "token").where("small <= most AND n <= reach").select("token", "id", "n", "place", "c", "m")
    worth = X.settle(worth)
    blocks = max(1, worth.count() // ENTRIES)
    strips = F.ceil(F.col("m") / STRIP)
    strip = F.pmod(F.xxhash64("id"), strips).cast("int")
    cut = worth.withColumn("strip", strip).withColumn("j", F.explode(F.sequence(F.lit(0), (strips - 1).cast("int"))))
    cut = cut.withColumn("strip_a", F.least("strip", "j")).withColumn("strip_b", F.greatest("strip", "j"))
    slot = F.when(strips > 1, F.xxhash64("token", "strip_a", "strip_b")).otherwise(F.pmod(F.xxhash64("token"), F.lit(blocks)))
    blocked = cut.select(slot.alias("slot"), "token", "id", "n", "place", "c", "strip", "strip_a", "strip_b")
    sums = blocked.groupBy("slot").applyInArrow(lambda t: multiply_columns(t, percent), "a long, b long, shared long, place_a long, place_b long, n_a long, n_b long")
    sums = sums.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"), F.max("place_a").alias("i"), F.max("place_b").alias("j"))
    most_shared = F.col("shared") + F.least(F.col("n_a") - F.col("i"), F.col("n_b") - F.col("j")) - 1
    return sums.where((100 + percent) * most_shared >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity: (a, b), by the product over all columns."""
    left, right = (sets.select(F.col("id").alias(k), F.col("grams").alias(f"g{k}")) for k in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ga", "gb")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                keep = overlaps(part["ga"].to_pylist(), part["gb"].to_pylist(), percent)
                yield pa.record_batch({"a": part["a"].filter(keep), "b": part["b"].filter(keep)})

    return both.mapInArrow(multiply, "a long, b long")


def overlaps(left: list[bytes], right: list[bytes], percent: int) -> pa.Array:
    """Which pairs of packed sets are similar: the product of two sparse blocks, row by row.

    An entry is (pair, shingle); those in both blocks are found by one sort and
    added up by pair.
    """
    sides = [[X.unpack_sorted(g) for g in side] for side in (left, right)]
    n, m = (np.array([len(g) for g in side]) for side in sides)
    pair = np.concatenate([np.repeat(np.arange(len(left)), k) for k in (n, m)])
    shingle = np.concatenate([*sides[0], *sides[1]])
    order = np.lexsort((shingle, pair))
    pair, shingle = pair[order], shingle[order]
    same = (pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])
    overlap = np.bincount(pair[1:][same], minlength=len(left))
    return pa.array(100 * overlap >= percent * (n + m - overlap))


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text", chunk_bytes: int = X.CHUNK_BYTES) -> DataFrame:
    """Connected groups of documents whose sets of word shingles have a Jaccard similarity of percent / 100 or more.

    Returns key, n_shingles and component_id (the smallest key reachable), a row per
    input row.  Lower-cases A-Z; a text of fewer words than a shingle is one shingle.

    Null or empty text: no shingles, linked with nothing.  Null key: no component.
    Rows with the same key are linked, repeated rows are rows of the result.  Further
    columns don't matter.  Empty table: empty result.
    """
    signed = X.written(signatures(docs, key, text, words, percent, chunk_bytes))
    full = signed.where("n > 0 AND id IS NOT NULL")
    classes = full.groupBy("sig1", "sig2", "n").agg(F.min("id").alias("rep"))
    rows = signed.where("grams IS NOT NULL AND id IS NOT NULL").join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id", "sig1", "sig2"])
    entries = X.settle(rows.select("id", "n", "rare", F.explode(F.arrays_zip("tokens", "places")).alias("t")).select("id", "n", "rare", F.col("t.tokens").alias("token"), F.col("t.places").alias("place")))
    sets = rows.select("id", "grams")

    pivots = entries.groupBy("token").agg(F.min(F.struct("rare", "id", "n", "place")).alias("p"), F.count(F.lit(1)).alias("m")).where("m > 1")
    star = entries.join(pivots, "token").where(F.col("id") != F.col("p.id")).where(_bounded(percent, F.col("n"), F.col("p.n"), F.col("place"), F.col("p.place")))
    star = star.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()
    links = X.settle(_linked(star, sets, percent))
    found = X.settle(components(links))

    placed = entries.join(found, "id", "left").select("token", "id", "n", "place", F.coalesce("component", "id").alias("c"))
    rest = candidate_pairs(placed, percent).join(star, ["a", "b"], "left_anti")
    more = X.settle(_linked(rest, sets, percent))
    # rows with the same key and different texts are one document
    several = full.groupBy("id").agg(F.min(F.struct("sig1", "sig2", "n")).alias("x"), F.max(F.struct("sig1", "sig2", "n")).alias("y")).where("x <> y").select("id")
    again = full.join(several, "id", "left_semi").join(classes, ["sig1", "sig2", "n"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    whole = components(links.unionByName(more).unionByName(again))

    by_class = classes.join(whole, classes["rep"] == whole["id"], "left").select("sig1", "sig2", "n", F.coalesce("component", "rep").alias("component_id"))
    several_or_linked = by_class.join(full.groupBy("sig1", "sig2", "n").agg(F.max("id").alias("last")), ["sig1", "sig2", "n"]).where("last <> component_id").drop("last")
    out = signed.select("id", "n", "sig1", "sig2").join(several_or_linked, ["sig1", "sig2", "n"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
