"""Counting keys over the whole corpus in compact blocks.

Documents are dealt into chunks by a hash of their text, so that copies ask for the
same keys once.  Texts whose copies would outgrow a chunk together are dealt by the whole
row, and their rows that are equal in every column are one row with their number.  A chunk sends
every shard one block with its distinct keys of that shard's range, sorted and
stored as differences; the shard merges the blocks of all chunks and sends each
chunk one block back with an answer for each of its keys, in the same order.
A key that occurs in every document costs one entry per chunk, so no key is hot,
and a chunk or shard holds a bounded part of the corpus.

Chunks and shards grow with the square root of the input, so that a block stays
a few kilobytes long at any size.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes of a chunk: at least CHUNK_BYTES, and ROOT times the square root of all bytes.
CHUNK_BYTES, ROOT = 4 << 20, 50


#: How many equal rows a row stands for.
COPIES = "_copies"
#: Bytes that a row counts besides its text, and places listed at once where copies become rows again.
ROW_BYTES, LISTED = 64, 4096


@dataclass(frozen=True)
class Size:
    """chunks, shards: how many; chunk_bytes: of text in a chunk; texts, text_bytes: of the corpus; folded: are there rows with copies?"""

    chunks: int
    shards: int
    chunk_bytes: int
    texts: int
    text_bytes: int
    folded: bool = False

    @property
    def key_bits(self) -> int:
        """Of a hash that tells all n-grams of the corpus apart: with an n-gram per eight bytes at most, one corpus in sixteen has two that share one, up to some 20 GB."""
        return min(64, max(32, 2 * self.text_bytes.bit_length() - 3))

    @property
    def bits(self) -> int:
        """Of a cell's number in a sketch with 32 cells per text byte, some 200 per word, so that few distinct keys share one at any size of the corpus."""
        return min(62, max(20, self.text_bytes.bit_length() + 5))


def measure(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> Size:
    """Sizes for an exchange over these texts, from their total length."""
    n, total = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    chunk = max(chunk_bytes, int(ROOT * total**0.5))
    chunks = max(1, -(-total // chunk))
    return Size(chunks, max(8, chunks), chunk, n, total)


def deal(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple[Size, DataFrame]:
    """(sizes, (chunk, row)): every row as a struct with COPIES, dealt by a hash of the text.

    Texts whose rows exceed a chunk together are dealt by a hash of the row, equal rows
    folded to one; they are aggregated before any shuffle.  There are fewer such texts
    than chunks, so that their hashes are a small table.  Columns of maps have no hash:
    rows that differ in them only aren't told apart in dealing, nor folded.
    """
    size = measure(docs, text, chunk_bytes)
    own = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    h = F.xxhash64(text)
    weight = F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES)
    limit = max(size.chunk_bytes, ROW_BYTES * size.texts // size.chunks)
    heavy = docs.groupBy(h.alias("_h")).agg(weight.alias("w"), F.count(F.lit(1)).alias("n")).where((F.col("w") > limit) & (F.col("n") > 1)).select("_h")
    chunk = lambda *c: F.pmod(F.xxhash64(*c), F.lit(size.chunks)).cast("int").alias("chunk")
    one = lambda df: df.select("*", F.lit(1).cast("long").alias(COPIES))
    heavy = settle(heavy)
    if heavy.isEmpty():
        return size, one(docs).select(chunk(text), F.struct("*").alias("row"))
    heavy, marked = F.broadcast(heavy), docs.withColumn("_h", h)
    many = marked.join(heavy, "_h", "left_semi").select(*docs.columns)
    many = many.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias(COPIES)) if len(own) == len(docs.columns) else one(many)
    few = one(marked.join(heavy, "_h", "left_anti").select(*docs.columns))
    return replace(size, folded=True), few.select(chunk(text), F.struct("*").alias("row")).unionByName(many.select(chunk(*own), F.struct("*").alias("row")))


def unfold(df: DataFrame, size: Size) -> DataFrame:
    """Each row as often as COPIES says, without that column."""
    if size.folded:
        # in steps, so that no list is long
        df = df.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(COPIES) - 1, F.lit(LISTED).cast("long"))))
        df = df.withColumn("_at", F.explode(F.sequence("_at", F.least(F.col("_at") + LISTED, COPIES) - 1))).drop("_at")
    return df.drop(COPIES)


def pack(values: np.ndarray, dense: bool = False) -> bytes:
    """Non-negative integers as byte planes of the least width; dense: as they are, else compressed."""
    if not len(values):
        return b"\0"
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    if dense:
        return bytes([width]) + planes
    return bytes([128 + width]) + len(values).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(block: bytes) -> np.ndarray:
    width = block[0] & 127
    if not width:
        return np.empty(0, np.uint64)
    if block[0] & 128:
        n = int.from_bytes(block[1:5], "little")
        planes = np.frombuffer(pa.decompress(block[5:], n * width, "zstd"), np.uint8).reshape(width, n)
    else:
        planes = np.frombuffer(block, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)), True) if len(keys) else b"\0"


def unpack_sorted(block: bytes) -> np.ndarray:
    return np.cumsum(unpack(block), dtype=np.uint64)


def bounds(bits: int, shards: int) -> np.ndarray:
    """The first key of each shard, over numbers of that many bits."""
    return np.array([(i << bits) // shards for i in range(shards)], np.uint64)


def cut(keys: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Where each shard's part begins in sorted keys, and their number."""
    return np.append(np.searchsorted(keys, bounds(bits, shards)), len(keys))


def blocks(chunk: int, keys: np.ndarray, bits: int, shards: int, every: bool = False, **columns: np.ndarray) -> pa.Table:
    """A row for each shard with any of these sorted keys, or for `every` one: chunk, shard, keys and the further columns, packed."""
    at, low = cut(keys, bits, shards), bounds(bits, shards)
    full = np.arange(shards) if every else np.flatnonzero(np.diff(at))
    out = {"chunk": pa.array([chunk] * len(full), pa.int32()), "shard": pa.array(full, pa.int32()), "keys": pa.array([pack_sorted(keys[at[s] : at[s + 1]] - low[s]) for s in full], pa.binary())}
    return pa.table(out | {k: pa.array([pack(v[at[s] : at[s + 1]]) for s in full], pa.binary()) for k, v in columns.items()})


def merged(runs: list[np.ndarray], more: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted runs: the order that sorts all, where each distinct key begins in it, and each entry's distinct key."""
    keys = np.concatenate(runs)
    order = np.argsort(keys, kind="stable") if more is None else np.lexsort((np.concatenate(more), keys))
    new = np.ones(len(keys), bool)
    ranked = keys[order]
    new[1:] = ranked[1:] != ranked[:-1]
    if more is not None:
        ranked = np.concatenate(more)[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


ANSWERS = "chunk int, shard int, answer binary"


def totals(table: pa.Table) -> pa.Table:
    """Of all blocks of one shard: every chunk gets the total of each of its keys."""
    runs = [unpack_sorted(x) for x in table["keys"].to_pylist()]
    counts = np.concatenate([unpack(x) for x in table["counts"].to_pylist()]).astype(np.int64)
    order, begin, group = merged(runs)
    total = np.add.reduceat(counts[order], begin)[group]
    at = np.cumsum([0, *map(len, runs)])
    return pa.table({"chunk": table["chunk"], "shard": table["shard"], "answer": pa.array([pack(total[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())})


def answers(table: pa.Table, column: str = "answer") -> np.ndarray:
    """The answers to a chunk's sorted keys, in their order."""
    table = table.sort_by("shard")
    parts = [unpack(x) for x in table[column].to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def count(dealt: DataFrame, ask: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """ask gives the blocks (keys, counts) of one chunk; the result has the totals for each chunk, packed."""
    asked = dealt.groupBy("chunk").applyInArrow(ask, "chunk int, shard int, keys binary, counts binary")
    return asked.groupBy("shard").applyInArrow(totals, ANSWERS)


def release() -> None:
    """Gives memory that is free back to the system: workers outlive their tasks, and what one has taken for a chunk is missing for others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def field(table: pa.Table, name: str) -> pa.Array:
    """A field of the struct column `row`."""
    release()
    rows = table["row"].combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks) if rows.num_chunks else pa.array([], table["row"].type)
    return rows.field(name) if not rows.offset and not rows.null_count else pc.struct_field(rows, name)


def spread(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes of text each, or one row."""
    from .words import raw

    release()
    _, at = raw(texts)
    a = 0
    while a < len(at) - 1:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield a, b
        a = b


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of chunks with at most so many bytes of that text column, or one row; numbers are unique over all tasks."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for a, b in spread(batch[column], most):
            part = batch.slice(a, b - a)
            n = (pc.sum(pc.binary_length(part[column])).as_py() or 0) + ROW_BYTES * part.num_rows
            if held and size + n > most:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
            held.append(part)
            size += n
    if held:
        yield number, pa.Table.from_batches(held)


def shared(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or that of the context.

    Only where everything runs in one process may it be a temporary folder of our own.
    """
    context = spark.sparkContext._jsc.sc()
    path = spark.conf.get("spark.checkpoint.dir", None) or (context.getCheckpointDir().get() if context.getCheckpointDir().isDefined() else None)
    if not path:
        if not context.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="screenloom-")
    if context.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """A checkpoint of these rows: computed once, and kept when an executor is lost."""
    shared(df.sparkSession)
    return df.checkpoint()


#: Folders written inside each open scratch().
_SCOPES: list[list[str]] = []


def written(df: DataFrame) -> DataFrame:
    """These rows as a table in the shared folder; inside scratch() it goes when that ends."""
    out, path = kept(df)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return out


def kept(df: DataFrame) -> tuple[DataFrame, str]:
    """These rows as a table in the shared folder that stays, and its path."""
    path = f"{shared(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch(spark: SparkSession, *paths: str | None) -> Iterator[None]:
    """Deletes the tables written() inside, and these, when it ends: what is read later must be kept()."""
    _SCOPES.append([p for p in paths if p])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
