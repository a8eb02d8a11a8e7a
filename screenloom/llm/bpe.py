"""Byte-level BPE encoding and decoding with the tiktoken library.

A text is cut where white space follows another character.  No match of the
splitting pattern holds such a place, and no match looks back, so the parts'
tokens in a row are the text's tokens, however long the text is.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exchange import spread

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a part, and text bytes handled between two results.
PART_CHARS, STEP_BYTES = 1 << 16, 2 << 20


@functools.cache
def encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about so many characters, cut before a space or line end after a visible character."""
    at = 0
    while len(text) - at > most:
        end = at + most
        while end < len(text) and not (text[end] in " \n" and text[end - 1].isprintable() and not text[end - 1].isspace()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def token_ids(encode: tiktoken.Encoding, text: str) -> np.ndarray:
    if len(text) <= PART_CHARS:
        return np.array(encode.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(encode.encode_ordinary(p), "<u4") for p in parts(text)])


def _add(df: DataFrame, source: str, kind: T.DataType, names: list[str], make) -> DataFrame:
    """df with binary columns computed from another in one pass; make gives a value for each name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch["_in"], STEP_BYTES):
                part = batch.slice(a, b - a)
                made = zip(*map(make, part["_in"].to_pylist()), strict=True)
                yield pa.record_batch({"_row": part["_row"]} | {n: pa.array(v, pa.binary()) for n, v in zip(out, made, strict=True)})

    keep, out = [c for c in df.columns if c not in names], [f"_out{i}" for i in range(len(names))]
    rows = df.select(F.struct(*keep).alias("_row"), F.col(source).cast(kind).alias("_in"))
    schema = rows.select("_row").schema
    for n in out:
        schema = schema.add(n, "binary")
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("_row")[c].alias(c) for c in keep], *[F.col(n).alias(name) for n, name in zip(out, names, strict=True)])


def encode(docs: DataFrame, path: str | None = None, text: str = "text", name: str = "ids") -> DataFrame:
    """docs with `ids`: the token ids of each text as little-endian unsigned 32-bit integers.

    A column of that name is replaced.  Null or empty text: no ids, an empty value.
    Other columns, null and repeated keys are carried along.  Empty table: empty result.
    """
    path = path or public_tokenizers.path(RANKS)
    return _add(docs, text, T.StringType(), [name], lambda x: (_ids(path, x).tobytes(),))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """docs with `decoded`: the bytes that the ids stand for.  Null ids: no bytes."""
    path = path or public_tokenizers.path(RANKS)
    return _add(docs, ids, T.BinaryType(), [name], lambda x: (_bytes(path, np.frombuffer(x or b"", "<u4")),))


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """docs with `ids` and `decoded`, as encode and decode give them, in one pass over the texts."""
    path = path or public_tokenizers.path(RANKS)

    def both(x: str | None) -> tuple[bytes, bytes]:
        ids = _ids(path, x)
        return ids.tobytes(), _bytes(path, ids)

    return _add(docs, text, T.StringType(), ["ids", "decoded"], both)


def _ids(path: str, text: str | None) -> np.ndarray:
    return token_ids(encoding(path), text or "")


def _bytes(path: str, ids: np.ndarray) -> bytes:
    return encoding(path).decode_bytes(ids.tolist())
