"""A chunk's stripes are cut for the shards in one pass, however many shards there are."""

from time import perf_counter

import numpy as np
from screenloom.llm import phrases
from screenloom.llm.exchange import Size, unpack


def stripes(table):
    """{(p, s): count} of a chunk's strips."""
    out = {}
    for row in table.to_pylist():
        if row["p"] is not None:
            p = np.cumsum(unpack(row["p"]), dtype=np.uint64).tolist()
            for k in zip(p, unpack(row["s"]).tolist(), unpack(row["counts"]).tolist(), strict=True):
                assert out.setdefault(k[:2], k[2]) == k[2]
    return out


def test_work_of_a_chunk_does_not_grow_with_shards():
    ids = np.random.default_rng(5).integers(1, 3000, 300_000)
    starts = np.arange(len(ids))
    seconds, found = {}, {}
    for shards in (8, 1500):
        began = perf_counter()
        table = phrases.next_level(3, starts, ids, shards, True)
        seconds[shards], found[shards] = perf_counter() - began, stripes(table)
    assert found[8] == found[1500] and sum(found[8].values()) == len(ids) - 1
    assert seconds[1500] < 6 * seconds[8]


def test_shards_grow_with_the_text_not_with_the_chunks():
    size = lambda chunks: Size(chunks, max(8, chunks), 4 << 20, 10, chunks * (4 << 20))
    assert [phrases.shards_of(size(n)) for n in (1, 20, 200, 2000)] == [8, 20, 50, 500]
