"""Phrases of two to four words that occur together more often than their parts would.

Stripes: a prefix keys a counter of what follows it.  The stripe of the empty prefix counts
words, so that its total is the number of word occurrences; the stripe of a word counts the
words after it, and so on.  A phrase of k words stands in the stripe of its first k - 1 words
under the number of its last k - 1 words, which says as much as its last word.  Stripes of
all chunks are merged elementwise, a level at a time: only what is frequent gets a number, and
only two frequent phrases that overlap can make a longer one, so that the stripes of the next
level have no other entries.  A stripe is cut in strips by a hash of prefix and entry, so that
no prefix is hot; a chunk of texts sends one entry for each distinct phrase.

From the merged stripes come a phrase's count, the totals of all its prefixes and suffixes,
carried along from level to level, and the largest count of a phrase longer by one word.
Numbers are exact, no hash stands for a phrase.  Texts are read once and not shuffled: what
moves on is where frequent phrases begin.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import CHUNK_BYTES, Size, answers, gathered, measure, pack, unpack, written
from .words import LOWER, mix, raw

#: Words of the longest phrase; least count of a phrase; hundredths of a phrase's count from which a longer one stands for it; what scores are parts of.
WORDS, LEAST, SHARE, SCALE = 4, 30, 80, 2_000_000
#: Language of texts without one.
UNKNOWN = "und"
#: Strips of a language in the first step of ranking.
STRIPS = 64
#: Shards that are never too many; text bytes for each of more.
FEW, SHARD_BYTES = 32, 16 << 20

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(10, 14)]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True

#: What a chunk puts out at each level: where its phrases begin and which they are, or a strip of its stripes for a shard.
STATE = "chunk long, shard int, starts binary, which binary, langs array<string>, words array<string>, p binary, s binary, counts binary"
#: What a shard puts out: the numbers of a chunk's phrases in their order (0: not frequent), or a frequent phrase, or, under number 0, a language's words.
MERGED = "chunk long, shard int, answer binary, id long, p long, s long, lang string, word string, a long"


def positions(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row of each word, place of each word): places of neighbours in one piece follow each other, others don't."""
    data, at = raw(texts)
    data = LOWER[data]
    inside = ~GAP[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = at[(at > 0) & (at < len(data))]
        begins[edge] |= inside[edge]
        ends[edge - 1] |= inside[edge - 1]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    row = np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(start, at)))
    breaks = np.cumsum(BREAK[data], dtype=np.int64)[start] if len(start) else np.empty(0, np.int64)
    new = np.zeros(len(start), bool)
    new[1:] = (np.diff(breaks) > 0) | (np.diff(row) > 0)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return words, row, np.arange(len(start)) + np.cumsum(new)


def in_order(shard: np.ndarray, which: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of keys by shard, which with keys so numbered, where each shard begins and the end)."""
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return order, place[which], np.searchsorted(shard[order], np.arange(shards + 1))


def state(chunk: int, starts: np.ndarray, which: np.ndarray) -> pa.Table:
    gaps = pack(np.diff(starts, prepend=0))
    return pa.table({"chunk": pa.array([chunk], pa.int64()), "starts": pa.array([gaps], pa.binary()), "which": pa.array([pack(which)], pa.binary())})


def shaped(tables: list[pa.Table], names: dict[str, pa.DataType]) -> pa.Table:
    """All rows with all columns, null where a table has none."""
    whole = [pa.table({n: t[n].cast(k) if n in t.column_names else pa.nulls(t.num_rows, k) for n, k in names.items()}) for t in tables]
    return pa.concat_tables(whole).combine_chunks() if whole else pa.table({n: pa.nulls(0, k) for n, k in names.items()})


_B, _I, _L, _S = pa.binary(), pa.int32(), pa.int64(), pa.string()
_STATE = {"chunk": _L, "shard": _I, "starts": _B, "which": _B, "langs": pa.list_(_S), "words": pa.list_(_S), "p": _B, "s": _B, "counts": _B}
_MERGED = {"chunk": _L, "shard": _I, "answer": _B, "id": _L, "p": _L, "s": _L, "lang": _S, "word": _S, "a": _L}


def first_level(chunk: int, rows: pa.Table, shards: int) -> pa.Table:
    """The stripe of the empty prefix over a chunk of texts, for each language."""
    words, row, starts = positions(rows["text"])
    coded = words.dictionary_encode()
    tongue = pc.fill_null(rows["lang"].combine_chunks(), UNKNOWN).dictionary_encode()
    tongue = tongue.combine_chunks() if isinstance(tongue, pa.ChunkedArray) else tongue
    names, vocabulary = tongue.dictionary.to_pylist(), coded.dictionary
    size = max(1, len(vocabulary))
    keys, which, counts = np.unique(np.asarray(tongue.indices)[row].astype(np.int64) * size + np.asarray(coded.indices), return_inverse=True, return_counts=True)
    seeds = [crc32(n.encode()) for n in names]
    spelled = vocabulary.take(pa.array(keys % size))
    shard = np.fromiter((crc32(w.encode(), seeds[k]) % shards for w, k in zip(spelled.to_pylist(), keys // size, strict=True)), np.int64, len(keys))
    order, which, at = in_order(shard, which, shards)
    full = np.flatnonzero(np.diff(at))
    listed = lambda values: pa.ListArray.from_arrays(pa.array(np.append(at[full], len(keys)), pa.int32()), values.take(pa.array(order)).cast(_S))
    counts = counts[order]
    strips = pa.table({"chunk": pa.array([chunk] * len(full), _L), "shard": pa.array(full, _I), "langs": listed(tongue.dictionary.take(pa.array(keys // size))), "words": listed(spelled), "counts": pa.array([pack(counts[at[k] : at[k + 1]]) for k in full], _B)})
    return shaped([state(chunk, starts, which), strips], _STATE)


def next_level(chunk: int, starts: np.ndarray, ids: np.ndarray, shards: int, go_on: bool) -> pa.Table:
    """Stripes of a chunk one level down: ids are those of the phrases at `starts`, 0 for phrases that aren't frequent."""
    starts, ids = starts[ids > 0], ids[ids > 0]
    known, own = np.unique(ids, return_inverse=True)
    at = np.flatnonzero(np.diff(starts) == 1)
    keys, which, counts = np.unique(own[at] * len(known) + own[at + 1], return_inverse=True, return_counts=True)
    p, s = known[keys // max(1, len(known))], known[keys % max(1, len(known))]
    with np.errstate(over="ignore"):
        shard = (mix(p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + s.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order, which, cut = in_order(shard, which, shards)
    p, s, counts, full = p[order], s[order], counts[order], np.flatnonzero(np.diff(cut))
    parts = lambda v: (v[cut[k] : cut[k + 1]] for k in full)
    gaps = pa.array([pack(np.diff(x, prepend=0)) for x in parts(p)], _B)
    strips = pa.table({"chunk": pa.array([chunk] * len(full), _L), "shard": pa.array(full, _I), "p": gaps, "s": pa.array(map(pack, parts(s)), _B), "counts": pa.array(map(pack, parts(counts)), _B)})
    return shaped([state(chunk, starts[at], which), strips] if go_on else [strips], _STATE)


def numbered(table: pa.Table, inverse: np.ndarray, counts: np.ndarray, ends: np.ndarray, least: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    """Elementwise sums of strips: (totals, frequent entries, their numbers, what each chunk gets)."""
    totals = np.bincount(inverse, counts).astype(np.int64)
    often = np.flatnonzero(totals >= least)
    shard = table["shard"][0].as_py()
    number = np.zeros(len(totals), np.int64)
    number[often] = np.arange(len(often)) * shards + shard + 1
    told = number[inverse]
    return totals, often, number[often], pa.table({"chunk": table["chunk"], "shard": table["shard"], "answer": pa.array([pack(told[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], _B)})


def merge_words(table: pa.Table, least: int, shards: int) -> pa.Table:
    table = table.combine_chunks()
    langs, words = (pc.list_flatten(table[c]).combine_chunks().dictionary_encode() for c in ("langs", "words"))
    langs, words = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (langs, words))
    size = max(1, len(words.dictionary))
    keys, inverse = np.unique(np.asarray(langs.indices).astype(np.int64) * size + np.asarray(words.indices), return_inverse=True)
    parts = [unpack(x).astype(np.int64) for x in table["counts"].to_pylist()]
    totals, often, ids, told = numbered(table, inverse, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), least, shards)
    tongue = lambda k: langs.dictionary.take(pa.array(k // size))
    phrases = pa.table({"id": ids, "lang": tongue(keys[often]), "word": words.dictionary.take(pa.array(keys[often] % size)), "a": totals[often]})
    spoken = np.bincount(keys // size, totals, len(langs.dictionary)).astype(np.int64)
    return shaped([told, phrases, pa.table({"id": np.zeros(len(spoken), np.int64), "lang": langs.dictionary, "a": spoken})], _MERGED)


def merge_phrases(table: pa.Table, least: int, shards: int, go_on: bool) -> pa.Table:
    p = [np.cumsum(unpack(x), dtype=np.uint64).astype(np.int64) for x in table["p"].to_pylist()]
    ends = np.cumsum([0, *map(len, p)])
    p, s, counts = np.concatenate(p), *(np.concatenate([unpack(x) for x in table[c].to_pylist()]).astype(np.int64) for c in ("s", "counts"))
    order = np.lexsort((s, p))
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p[order]) != 0) | (np.diff(s[order]) != 0)
    inverse = np.empty(len(p), np.int64)
    inverse[order] = np.cumsum(new) - 1
    totals, often, ids, told = numbered(table, inverse, counts, ends, least, shards)
    first = order[new][often]
    phrases = pa.table({"id": ids, "p": p[first], "s": s[first], "a": totals[often]})
    return shaped([told, phrases] if go_on else [phrases], _MERGED)


def shards_of(size: Size) -> int:
    """As many shards as chunks, but above FEW those of SHARD_BYTES of text at least: a chunk sends each shard a block, which costs its time however short."""
    return min(size.shards, max(FEW, -(-size.text_bytes // max(size.chunk_bytes, SHARD_BYTES))))


def levels(docs: DataFrame, words: int = WORDS, least: int = LEAST, chunk_bytes: int = CHUNK_BYTES) -> list[DataFrame]:
    """What the shards put out for each length: frequent phrases, at the first with the words of each language under number 0.

    docs: lang, text.  Null texts are empty; a null language is UNKNOWN.
    """
    size = measure(docs, "text", chunk_bytes)
    shards, chunk = shards_of(size), size.chunk_bytes

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in gathered(batches, "text", chunk):
            yield from first_level(number, rows, shards).to_batches()

    def follow(go_on: bool):
        def run(places: pa.Table, told: pa.Table) -> pa.Table:
            if not places.num_rows or not told.num_rows:
                return shaped([], _STATE)
            one = places.to_pylist()[0]
            ids = answers(told).astype(np.int64)[unpack(one["which"]).astype(np.int64)]
            return next_level(one["chunk"], np.cumsum(unpack(one["starts"]), dtype=np.uint64).astype(np.int64), ids, shards, go_on)

        return run

    def merge(k: int):
        if k == 1:
            return lambda strips: merge_words(strips, least, shards)
        return lambda strips: merge_phrases(strips, least, shards, k < words)

    held, out = written(docs.select("lang", "text").mapInArrow(begin, STATE)), []
    for k in range(1, words + 1):
        merged = written(held.where("shard IS NOT NULL").groupBy("shard").applyInArrow(merge(k), MERGED))
        out.append(merged.where("id IS NOT NULL").select("id", "p", "s", "lang", "word", "a"))
        if k < words:
            places = held.where("shard IS NULL").select("chunk", "starts", "which").groupBy("chunk")
            told = merged.where("chunk IS NOT NULL").select("chunk", "shard", "answer").groupBy("chunk")
            held = written(places.cogroup(told).applyInArrow(follow(k + 1 < words), STATE))
    return out


def weakest(k: int, scale: int = SCALE) -> Column:
    """The cut of a phrase of k words with the lowest score, the earliest among equals: (score, k, l, r)."""
    exact = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    cuts = []
    for j in range(1, k):
        left, right = F.get("pre", F.lit(j - 1)), F.get("suf", F.lit(k - j - 1))
        score = F.call_function("div", F.lit(scale).cast("decimal(10,0)") * exact("a"), exact(left) + exact(right))
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("k"), left.alias("l"), right.alias("r")))
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def mine(docs: DataFrame, words: int = WORDS, least: int = LEAST, share: int = SHARE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase of two to `words` words, but for those that a longer one stands for.

    docs has lang and text; other columns aren't read.  a: occurrences of the phrase in its
    language, `least` or more; l, r: of the parts of its weakest cut, floor(SCALE * a / (l + r))
    its score; n: words of the language.  A phrase goes if one that is longer by a word, and
    holds it, has `share` hundredths of its count; any longer one that has is held by such.
    Null and empty texts have no words; a null language is UNKNOWN; repeated rows count each
    time.  An empty table gives no phrases.
    """
    found = levels(docs, words, least, chunk_bytes)
    spoken = found[0].where("id = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    none = F.array().cast("array<bigint>")
    phrases = [written(found[0].where("id > 0").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", none.alias("pre"), none.alias("suf")))]
    for level in found[1:]:
        p, s = (phrases[-1].select(*[F.col(c).alias(f"{side}_{c}") for c in ("id", "lang", "phrase", "last", "a", "pre", "suf")]) for side in "ps")
        both = level.join(p, F.col("p") == F.col("p_id")).join(s, F.col("s") == F.col("s_id"))
        totals = [F.array_append("p_pre", F.col("p_a")).alias("pre"), F.array_append("s_suf", F.col("s_a")).alias("suf")]
        phrases.append(written(both.select("id", "p", "s", F.col("p_lang").alias("lang"), F.concat_ws(" ", "p_phrase", "s_last").alias("phrase"), F.col("s_last").alias("last"), "a", *totals)))
    out = []
    for k, own in enumerate(phrases[1:], 2):
        if k < words:
            longer = phrases[k].select(F.explode(F.array("p", "s")).alias("id"), F.col("a").cast("decimal(19,0)").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
            own = own.join(longer, "id", "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a").cast("decimal(19,0)"), F.lit(True)))
        out.append(own.select("lang", "phrase", "a", weakest(k).alias("cut")))
    return reduce(DataFrame.unionByName, out).join(spoken, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(phrases: DataFrame, most: int) -> DataFrame:
    """The first `most` phrases of each language by score, count and spelling, with their rank; in two steps, so that one task gets STRIPS * most rows of a language at most."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = phrases.withColumn("_strip", F.pmod(F.xxhash64("phrase"), F.lit(STRIPS))).withColumn("rank", place("lang", "_strip")).where(F.col("rank") <= most)
    return first.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= most).drop("_strip")
