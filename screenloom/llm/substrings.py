"""Substring deduplication with a count-min prefilter.

Pass 1: each chunk of documents makes a count-min sketch of its word windows: DEPTH
rows of counters, as wide as keeps the share of windows wrongly estimated repeated
under ERROR.  A chunk fills a small part of a row only, so that its sketch is sent
as the cells that aren't zero; the sketches are added up by ranges of cells, and each
chunk learns the sums of its own cells.  The least of a window's DEPTH sums never
undercounts, so a window estimated once is dismissed and no repeated window is lost.
Pass 2: the windows estimated repeated, and only they, are grouped exactly by a
96-bit hash, pre-aggregated to the smallest document of each chunk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .words import mix, split, stream, text_bytes, windows, word_hashes

WINDOW = 13
#: Rows of the sketch, and the share of windows that occur once but may be estimated repeated.
DEPTH, ERROR = 2, 0.01
#: Bytes of a word and the space after it, at least on average: more words than that raise the error, but lose nothing.
WORD_BYTES = 4
MARKS = stream(61, 8)
#: Stands for a null identifier: larger than any other.
LAST = np.iinfo(np.int64).max
LOW = np.uint64(0xFFFFFFFF)


def _ids(table: pa.Table, key: str) -> np.ndarray:
    ids = X.field(table, key)
    return ids.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def width_bits(text_bytes: int, depth: int = DEPTH, error: float = ERROR) -> int:
    """Of a cell's number in a row: a window meets another in each of `depth` rows with a chance of `error` at most."""
    full = error ** (1 / depth)  # of a row's cells
    return max(16, math.ceil(math.log2(max(1, text_bytes / WORD_BYTES) / -math.log1p(-full))))


def sketch_cells(first: np.ndarray, bits: int, depth: int = DEPTH) -> np.ndarray:
    """The cells of each window: row by row, numbered through."""
    return np.concatenate([(mix(first ^ MARKS[r]) >> np.uint64(64 - bits)) + np.uint64(r << bits) for r in range(depth)])


def _windows(texts: pa.Array, window: int):
    words = split(texts)
    return words, *windows(words, word_hashes(words), window)


def estimates(first: np.ndarray, told: pa.Table, bits: int) -> np.ndarray:
    """The count of each window: the least of its cells' sums."""
    if not len(first):
        return np.empty(0, np.int64)
    _, inverse = np.unique(sketch_cells(first, bits), return_inverse=True)
    return X.answers(told).astype(np.int64)[inverse].reshape(DEPTH, -1).min(0)


def _repeated(words, at, first, told: pa.Table, window: int, bits: int):
    """Of windows estimated repeated: where they begin and both hashes."""
    keep = estimates(first, told, bits) >= 2
    where = at[keep]
    second = np.empty(0, np.uint64)
    if len(where):
        every, hashes = windows(words, word_hashes(words, 1), window, 1)
        second = hashes[np.searchsorted(every, where)] & LOW
    return where, first[keep], second


def _groups(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray):
    """Distinct windows in order, their smallest document, and each window's place among them."""
    order, begin, group = X.merged([h1], [h2])
    return h1[order][begin], h2[order][begin], np.minimum.reduceat(ids[order], begin), group


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", chunk_bytes: int = X.CHUNK_BYTES) -> DataFrame:
    """Take out words covered by a window that also starts in a document with a smaller key.

    Returns the columns of docs, with what is left of the text, and `n_words` and
    `n_removed` (long; columns of these names are replaced).  The white space
    after a removed word goes with it.

    Null text: stays null, no words.  Null key: counts as the largest key.
    Rows with the same key are one document.  Texts of fewer words than a window
    are unchanged.  An empty table gives an empty result.
    """
    docs = docs.drop("n_words", "n_removed", X.COPIES)
    size, dealt = X.deal(docs, text, chunk_bytes)
    bits, shards = width_bits(size.text_bytes), size.shards
    total_bits = bits + (DEPTH - 1).bit_length()

    def sketch(table: pa.Table) -> pa.Table:
        *_, first = _windows(X.field(table, text), window)
        keys, counts = np.unique(sketch_cells(first, bits), return_counts=True)
        return X.blocks(table["chunk"][0].as_py(), keys, total_bits, shards, counts=counts)

    sums = X.count(dealt, sketch)

    def candidates(name: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return X.blocks(0, np.empty(0, np.uint64), 64, shards, second=np.empty(0, np.uint64), least=np.empty(0, np.uint64))
        words, at, first = _windows(X.field(table, text), window)
        where, h1, h2 = _repeated(words, at, first, told, window, bits)
        if len(where):
            h1, h2, least, _ = _groups(h1, h2, _ids(table, key)[words.row[where]])
        else:
            least = np.empty(0, np.int64)
        return X.blocks(name[0].as_py(), h1, 64, shards, second=h2, least=least.view(np.uint64))

    def group(table: pa.Table) -> pa.Table:
        runs = [X.unpack_sorted(x) for x in table["keys"].to_pylist()]
        second = [X.unpack(x) for x in table["second"].to_pylist()]
        least = np.concatenate([X.unpack(x) for x in table["least"].to_pylist()]).view(np.int64)
        order, begin, place = X.merged(runs, second)
        earlier = np.minimum.reduceat(least[order], begin)[place] < least
        at = np.cumsum([0, *map(len, runs)])
        return pa.table({"chunk": table["chunk"], "shard": table["shard"], "answer": pa.array([X.pack(earlier[a:b].astype(np.uint64)) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    asked = dealt.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(candidates, "chunk int, shard int, keys binary, second binary, least binary")
    earlier = asked.groupBy("shard").applyInArrow(group, X.ANSWERS)
    told = sums.withColumn("part", F.lit(0)).unionByName(earlier.withColumn("part", F.lit(1)))

    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        row = table["row"].combine_chunks()
        texts = X.field(table, text)
        words, at, first = _windows(texts, window)
        parts = told["part"].to_numpy()
        where, h1, h2 = _repeated(words, at, first, told.filter(pa.array(parts == 0)), window, bits)
        gone = np.zeros(len(words) + 1, np.int64)
        if len(where):
            ids = _ids(table, key)[words.row[where]]
            *_, least, place = _groups(h1, h2, ids)
            flags = X.answers(told.filter(pa.array(parts == 1)))[place] > 0
            starts = where[flags | (ids > least[place])]
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + window, -1)
        covered = np.cumsum(gone[:-1]) > 0
        removed = np.add.reduceat(np.append(covered, False).astype(np.int64), words.first[:-1]) if len(texts) else np.empty(0, np.int64)
        removed[words.counts == 0] = 0
        left: list[str | None] = [None] * len(texts)
        for r in np.flatnonzero(removed):
            a, b = words.first[r], words.first[r + 1]
            keep, origin, whole = ~covered[a:b], words.offsets[r], text_bytes(words, r)
            begins = words.start[a:b] - origin
            ends = np.append(begins[1:], len(whole))
            edges = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            left[r] = (b"" if removed[r] == b - a else whole[: begins[0]] + b"".join(whole[begins[i] : ends[j - 1]] for i, j in edges)).decode()
        new = pa.array(left, pa.string())
        return pa.table({"row": row, "left": pc.if_else(pa.array(removed > 0), new, texts.cast(pa.string())), "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    schema = dealt.select("row").schema.add("left", "string").add("n_words", "long").add("n_removed", "long")
    out = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(remove, schema)
    return X.unfold(out.select(*[F.col("left").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns], "n_words", "n_removed", F.col("row")[X.COPIES].alias(X.COPIES)), size)
