"""Aligning the tokens of two tokenizers over the same text.

Byte-level BPE (A) gets a space and the text, a sentence-piece BPE (B) the text, which it
puts a space before: both cut the same bytes.  Neither has a token that spans a space after a
visible character: A's splitting pattern never matches across it, B has no piece with a space
behind another character (checked on its vocabulary).  So a text is a row of parts that are
cut there; equal parts have equal tokens, whatever stands around them, and tokens of
different parts never overlap.  A batch encodes its distinct parts, and pandas.merge_asof,
keyed by the part of the documents, gives each token start the other side's covering token;
both directions together are the overlaps, and ends that both have cut groups.

A batch sends counts of its distinct pairs of ids, weighted by how often its parts occur, in
blocks to shards by B's id, so that a shard sees all pairs of an id and knows the largest
count; a batch gets one answer block per shard back.  Texts are read and encoded once and
not shuffled.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import CHUNK_BYTES, blocks, gathered, measure, merged, pack, unpack, unpack_sorted, written
from .words import raw

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bits of an id of A, and of B; an odd number spreads B's ids over the shards.
A_BITS, B_BITS, SPREAD = 17, 17, 0x9E3B
#: B's mark for a space, in UTF-8.
MARK = "▁".encode()
#: Parts encoded in one call of a tokenizer.
AT_ONCE = 1 << 14


@dataclass(frozen=True)
class Spelling:
    """The bytes of every token of a tokenizer, one after another; at[i]..at[i+1]: those of id i."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Spelling:
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)]))

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.at[ids + 1] - self.at[ids]

    def bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of these tokens joined."""
        n = self.lengths(ids)
        ends = np.cumsum(n)
        return self.data[np.repeat(self.at[ids] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]


@functools.cache
def byte_bpe(path: str):
    """(encode, spelling) of a byte-level BPE file; encode: ids of each of these strings."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    # byte-level alphabets show printable bytes as themselves, the others in order from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else b""
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], Spelling.of(tokens)


@functools.cache
def piece_bpe(path: str):
    """(encode, spelling) of a sentence-piece file that puts a space before its text; encode gets strings without it."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else b"" if pieces.is_control(i) or pieces.is_unknown(i) else piece.replace(MARK.decode(), " ").encode())
    if any(b" " in t.lstrip(b" ") for t in tokens):
        raise ValueError(f"{path}: a piece holds a space behind another character; texts can't be cut there")
    space = [pieces.piece_to_id(MARK.decode())]  # of a part that is a space alone
    return lambda texts: [ids or space for ids in pieces.encode(texts, num_threads=1)], Spelling.of(tokens)


def parts(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin of each part and the end, first part of each row and their number) of texts with a space before each.

    A part begins at a space after a character that is surely visible.  Null and empty texts have no part.
    """
    data, at = raw(texts)
    size = np.diff(at)
    extra = np.cumsum(size > 0)
    out = np.full(len(data) + (extra[-1] if len(extra) else 0), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(extra, size)] = data
    at = np.append(0, at[1:] + extra)
    before = out[:-1]
    visible = (before > 32) & (before != 127)
    # the last byte of a white-space character of more than one byte
    two, three = np.append(0, out)[:-2], np.append([0, 0], out)[:-3]
    visible &= (before < 128) | ~((two == 0xC2) | np.isin(three, [0xE1, 0xE2, 0xE3]) & np.isin(two, [0x9A, 0xA0, 0x80, 0x81]))
    cut = np.zeros(len(out), bool)
    cut[1:] = (out[1:] == 32) & visible
    cut[at[:-1][np.diff(at) > 0]] = True
    begin = np.flatnonzero(cut)
    return out, np.append(begin, len(out)), np.searchsorted(begin, at)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, where each list begins and the end)."""
    at = np.cumsum([0, *map(len, ids)])
    return np.fromiter((i for x in ids for i in x), np.int64, at[-1]), at


def encoded(distinct: list[str], a, b) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    steps = range(0, len(distinct), AT_ONCE)
    return flat([x for i in steps for x in a(distinct[i : i + AT_ONCE])]), flat([x for i in steps for x in b([t[1:] for t in distinct[i : i + AT_ONCE]])])


def same(spelling: Spelling, ids: np.ndarray, at: np.ndarray, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of each part: are its tokens, joined, its bytes?"""
    lengths = spelling.lengths(ids)
    total = np.append(0, np.cumsum(lengths))[at]
    right = np.diff(total) == np.diff(begin)
    spelled = spelling.bytes(ids[np.repeat(right, np.diff(at))])
    given = data[np.repeat(right, np.diff(begin))]
    sizes = np.diff(begin)[right]
    wrong = np.bincount(np.repeat(np.flatnonzero(right), sizes)[spelled != given], minlength=len(right))
    return right & (wrong == 0)


def overlaps(a_at: np.ndarray, a_start: np.ndarray, b_at: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of A's tokens, of B's) of all pairs that overlap: starts are bytes of the joined parts, so in order; at: each part's first token and the end."""
    frame = lambda at, start, name: pd.DataFrame({"start": start, "part": np.repeat(np.arange(len(at) - 1), np.diff(at)), name: np.arange(len(start))})
    a, b = frame(a_at, a_start, "a"), frame(b_at, b_start, "b")
    covered = pd.merge_asof(a, b, on="start", by="part")
    covering = pd.merge_asof(b, a, on="start", by="part")
    fresh = covering["start"].to_numpy() != a_start[covering["a"].to_numpy()]
    left, right = np.append(covered["a"], covering["a"][fresh]), np.append(covered["b"], covering["b"][fresh])
    order = np.lexsort((right, left))
    return left[order].astype(np.int64), right[order].astype(np.int64)


def group_ends(a_at: np.ndarray, a_end: np.ndarray, b_at: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token of A, and of B: does its end close a group?"""
    return np.isin(a_end, b_end, assume_unique=True), np.isin(b_end, a_end, assume_unique=True)


def spelled_groups(a: np.ndarray, a_at: np.ndarray, a_last: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_last: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2` of each part."""
    group_a, group_b = (np.cumsum(x) - x for x in (a_last, b_last))
    group, side = np.append(group_a, group_b), np.repeat([0, 1], [len(a), len(b)])
    order = np.lexsort((side, group))
    ids, last, side = np.append(a, b)[order], np.append(a_last, b_last)[order], side[order]
    digits = 1 + sum((ids >= 10**i).astype(np.int64) for i in range(1, 7))
    ends = np.cumsum(digits + 1)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    out[ends - 1] = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(","))
    for i in range(7):
        has = digits > i
        out[ends[has] - 2 - i] = 48 + ids[has] // 10**i % 10
    cut = np.append(0, ends)[(a_at + b_at)]
    text = out.tobytes()
    return [text[x : max(x, y - 1)] for x, y in zip(cut[:-1], cut[1:], strict=True)]


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A's and B's id as one number, by B's id in spread order."""
    return ((b.astype(np.uint64) * np.uint64(SPREAD) % np.uint64(1 << B_BITS)) << np.uint64(A_BITS)) | a.astype(np.uint64)


def best_of(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Of sorted distinct keys: is the total the largest of its B id?"""
    new = np.append(True, np.diff(keys >> np.uint64(A_BITS)) > 0)
    most = np.maximum.reduceat(totals, np.flatnonzero(new)) if len(keys) else totals
    return totals == most[np.cumsum(new) - 1] if len(keys) else np.empty(0, bool)


def summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between at[i] and at[i+1]."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[at[1:]] - total[at[:-1]]


_COLUMNS = "a binary, a_n binary, b binary, b_n binary, part binary, row_n binary"
_ROWS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The alignment of every text: key, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups.

    groups is `a1,a2|b1;a3|b2,b3`: the ids of both sides between two byte offsets where tokens
    of both end.  A link is a pair of tokens whose bytes overlap; the count of its pair of ids
    is that of all such links of the corpus, n_best are the links whose count is the largest of
    their B id, ties included, and count_sum is the sum of counts over links.

    Null and empty texts, and those whose tokens don't spell the space and the text (they hold
    B's own mark for a space), have no tokens: zeros and an empty string.  Null and repeated
    keys are rows like others.  Further columns aren't read.  An empty table gives no rows.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    a_path, b_path = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
    size = measure(docs, "text", chunk_bytes)
    shards = min(1 << B_BITS, 1 << max(3, (size.shards - 1).bit_length()))
    asked = f"chunk long, shard int, keys binary, counts binary, ids array<{kind}>, {_COLUMNS}"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_bpe(a_path), piece_bpe(b_path)
        for number, rows in gathered(batches, "text", size.chunk_bytes):
            yield from asking(number, rows, a, b, shards).to_batches()

    held = written(docs.mapInArrow(ask, asked))
    told = held.where("shard IS NOT NULL").select("chunk", "shard", "keys", "counts").groupBy("shard").applyInArrow(pair_totals, "chunk long, shard int, best binary, answer binary")
    chunks = held.where("shard IS NULL").select("chunk", "ids", *[c.split()[0] for c in _COLUMNS.split(", ")])

    def finish(chunk: pa.Table, told: pa.Table) -> pa.Table:
        return finished(chunk, told, a_path, b_path)

    out = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(finish, f"id {kind}, {', '.join(f'{c} long' for c in _ROWS)}, groups string")
    return out.withColumnRenamed("id", key)


def asking(number: int, rows: pa.Table, a, b, shards: int) -> pa.Table:
    """A batch as one row, and the blocks of its pairs of ids."""
    data, begin, first = parts(rows["text"])
    offsets = pa.py_buffer(begin.astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_string(), len(begin) - 1, [None, offsets, pa.py_buffer(data)]).dictionary_encode()
    part = np.asarray(coded.indices).astype(np.int64)
    (a_ids, a_at), (b_ids, b_at) = encoded(coded.dictionary.to_pylist(), a[0], b[0])
    own, own_at = raw(coded.dictionary)
    right = same(a[1], a_ids, a_at, own, own_at) & same(b[1], b_ids, b_at, own, own_at)
    # a text with a part that isn't spelled has no tokens
    row = np.repeat(np.arange(rows.num_rows), np.diff(first))
    wrong = np.bincount(row, ~right[part], rows.num_rows) > 0 if len(part) else np.zeros(rows.num_rows, bool)
    part = part[~wrong[row]]
    weight = np.bincount(part, minlength=len(right))
    left, over = linked(a_ids, a_at, b_ids, b_at, a[1], b[1], weight > 0)
    keys, inverse = np.unique(pair_keys(a_ids[left], b_ids[over]), return_inverse=True)
    of = np.repeat(np.arange(len(right)), np.diff(a_at))[left]
    counts = np.bincount(inverse, weight[of], len(keys)).astype(np.int64)
    out = blocks(0, keys, A_BITS + B_BITS, shards, counts=counts)
    out = out.set_column(0, "chunk", pa.array([number] * len(out), pa.int64()))
    packed = lambda v: pa.array([pack(v)], pa.binary())
    n_parts = np.where(wrong, 0, np.diff(first))
    whole = pa.table({
        "chunk": pa.array([number], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows["id"].combine_chunks()),
        "a": packed(a_ids), "a_n": packed(np.diff(a_at)), "b": packed(b_ids), "b_n": packed(np.diff(b_at)), "part": packed(part), "row_n": packed(n_parts),
    })
    names = {"chunk": pa.int64(), "shard": pa.int32(), "keys": pa.binary(), "counts": pa.binary(), "ids": whole["ids"].type} | {c: pa.binary() for c in ("a", "a_n", "b", "b_n", "part", "row_n")}
    return pa.concat_tables([pa.table({n: t[n] if n in t.column_names else pa.nulls(len(t), k) for n, k in names.items()}) for t in (whole, out)])


def linked(a_ids, a_at, b_ids, b_at, a_spelling: Spelling, b_spelling: Spelling, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """overlaps() of the parts that are used, as places among all tokens."""
    a_use, b_use = (np.flatnonzero(np.repeat(use, np.diff(at))) for at in (a_at, b_at))
    ends = [np.cumsum(s.lengths(ids[u])) for s, ids, u in ((a_spelling, a_ids, a_use), (b_spelling, b_ids, b_use))]
    starts = [np.append(0, e[:-1])[: len(e)] for e in ends]
    ats = [np.append(0, np.cumsum(np.diff(at) * use)) for at in (a_at, b_at)]
    left, right = overlaps(ats[0], starts[0], ats[1], starts[1])
    return a_use[left], b_use[right]


def pair_totals(table: pa.Table) -> pa.Table:
    """Of all blocks of one shard: every chunk gets the totals of its pairs, and which are the best of their B id."""
    runs = [unpack_sorted(x) for x in table["keys"].to_pylist()]
    counts = np.concatenate([unpack(x) for x in table["counts"].to_pylist()]).astype(np.int64)
    order, begin, group = merged(runs)
    total = np.add.reduceat(counts[order], begin)
    best = best_of(np.concatenate(runs)[order][begin], total)
    at = np.cumsum([0, *map(len, runs)])
    cut = lambda v: pa.array([pack(v[group[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
    return pa.table({"chunk": table["chunk"], "shard": table["shard"], "best": cut(best.astype(np.int64)), "answer": cut(total)})


def finished(chunk: pa.Table, told: pa.Table, a_path: str, b_path: str) -> pa.Table:
    """The rows of one chunk."""
    ids = pc.list_flatten(chunk["ids"]).combine_chunks()
    one = {c: unpack(chunk[c][0].as_py()).astype(np.int64) for c in ("a", "a_n", "b", "b_n", "part", "row_n")}
    a_at, b_at, first = (np.append(0, np.cumsum(one[c])) for c in ("a_n", "b_n", "row_n"))
    part, n_parts = one["part"], len(one["a_n"])
    use = np.bincount(part, minlength=n_parts) > 0
    spellings = byte_bpe(a_path)[1], piece_bpe(b_path)[1]
    left, over = linked(one["a"], a_at, one["b"], b_at, *spellings, use)
    _, inverse = np.unique(pair_keys(one["a"][left], one["b"][over]), return_inverse=True)
    told = told.sort_by("shard")
    best, total = (np.concatenate([np.empty(0, np.int64), *(unpack(x).astype(np.int64) for x in told[c].to_pylist())])[inverse] for c in ("best", "answer"))
    of = np.repeat(np.arange(n_parts), one["a_n"])[left]
    per = {"n_a": one["a_n"], "n_b": one["b_n"], "n_links": np.bincount(of, minlength=n_parts), "n_best": np.bincount(of, best, n_parts).astype(np.int64)}
    sums = np.zeros(n_parts, np.int64)
    np.add.at(sums, of, total)
    a_use, b_use = (np.repeat(use, one[c]) for c in ("a_n", "b_n"))
    a, b = one["a"][a_use], one["b"][b_use]
    ats = [np.append(0, np.cumsum(one[c] * use)) for c in ("a_n", "b_n")]
    ends = [np.cumsum(s.lengths(x)) for s, x in zip(spellings, (a, b), strict=True)]
    a_last, b_last = group_ends(ats[0], ends[0], ats[1], ends[1])
    per["n_groups"], per["count_sum"] = summed(a_last, ats[0]), sums
    text = spelled_groups(a, ats[0], a_last, b, ats[1], b_last)
    groups = [b";".join([text[k] for k in part[i:j]]) for i, j in zip(first[:-1], first[1:], strict=True)]
    return pa.table({"id": ids} | {c: pa.array(summed(per[c][part], first), pa.int64()) for c in _ROWS} | {"groups": pa.array(groups, pa.binary()).cast(pa.string())})
