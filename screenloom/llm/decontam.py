"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK walk reads a word sequence with a pointer: step j writes the word under
the pointer, which then moves on when a random bit of (j, word) is set.  Two
sequences at a small edit distance soon walk in step again, so their embeddings
have a small Hamming distance.  A table samples COORDINATES steps; windows whose
samples equal an item's become candidates.  TABLES independent ones reach the
target recall.  An exact edit distance of the characters decides each candidate.

Windows go with the size of items.  Items whose numbers of words are within a factor of
the square root of two are a class; its windows have three quarters of the words of the
shortest, and start so often that each passage as long as that holds one.  An item is
entered at all shifts, so that every window inside a passage meets its counterpart word
for word.  A word counts by its first PREFIX bytes, so that most
misspellings leave it as it was.

Edits spread over many words leave few words as they were, but runs of bytes between
them.  So every run of GRAM bytes of a document is looked up too, and an item is a
candidate where enough of its runs lie in order, no farther moved than the edits
allow.  Target: RECALL of the items with up to PERCENT of their characters edited.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import spread
from .words import SPACE, Words, mix, split, stream

#: Edits allowed, percent of the item's characters, and the share of such items to be found.
PERCENT, RECALL = 20, 0.95
PREFIX = 4
#: Walks, tables of each, steps sampled by a table, and how many different words they must have read.
EMBEDDINGS, TABLES, COORDINATES, DISTINCT = 6, 3, 4, 3
#: Words of a window, percent of those of the shortest item of its class.
WINDOW = 75
#: Characters of the pieces that are counted before an edit distance is computed: each edit changes PIECE of them at most.
PIECE = 3
#: Bytes of a run, and how many runs an item must have in a region: one in CHARS of its bytes, FEWEST at least.
GRAM, CHARS, FEWEST = 8, 12, 3
#: Places among all items from which a run is too common to be looked up, unless too few others are left: each item keeps its rarest half at least.
COMMON = 64
#: Pairs of equal runs that are listed at once, and places of runs that are looked up at once.
PAIRS, RUNS = 1 << 22, 1 << 16
#: Items, and bytes of their texts, compared in one pass over the documents; more are compared in further passes.
ITEMS, ITEM_BYTES = 20_000, 4 << 20
STEP_BYTES = 2 << 20
FILTER_BITS = 18


@dataclass
class Length:
    """Items of one length class: words of a window, the stride, and for each embedding its tables.

    A table: (steps sampled, and for each number of samples matched a filter of the
    keys that items have, keys in order, and the entry of each: item and shift).
    """

    window: int
    stride: int
    tables: list[list[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]]


@dataclass
class Grams:
    """Runs of GRAM bytes of the items: a filter of their hashes, the distinct runs in order, where each one's entries
    begin, the entries (item, place in bytes), and for each item how many must be found and how far apart they may have moved."""

    full: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    least: np.ndarray
    band: np.ndarray


@dataclass
class Index:
    ids: list
    texts: list[str]
    n_words: np.ndarray
    pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    classes: list[Length]
    grams: Grams


SEEDS = stream(71, 64)


def symbols(words: Words) -> np.ndarray:
    """A hash of the first PREFIX bytes of each word."""
    out, last = np.zeros(len(words), np.uint64), len(words.data) - 1
    for i in range(PREFIX):
        at = words.start + i
        out |= np.where(at < words.end, words.data[np.minimum(at, last)], 0).astype(np.uint64) << np.uint64(8 * i) if len(words) else out
    return mix(out)


def bits(hashes: np.ndarray, embedding: int, block: int) -> np.ndarray:
    """64 random bits of each word for the steps of a block."""
    return mix(hashes ^ SEEDS[embedding * 8 + block % 8] ^ np.uint64(block // 8))


def reach(window: int) -> int:
    """Steps that a walk spends in a window, as many as sampled at least."""
    return max(2 * window - 2, COORDINATES)


def samples(window: int, embedding: int) -> list[np.ndarray]:
    """The sampled steps of each table: one in each quarter of the steps that a walk spends in the window."""
    span = reach(window)
    rng = np.random.default_rng(1000 * embedding + window)
    edges = np.linspace(0, span, COORDINATES + 1).astype(int)
    return [np.array([rng.integers(a, max(b, a + 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]) for _ in range(TABLES)]


def extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A sampled word appended to a key."""
    with np.errstate(over="ignore"):
        return mix(key * np.uint64(0x9E3779B97F4A7C15) + word)


END = np.uint64(0x5151515151515151)


@dataclass
class Codes:
    """Words by the number of what they are: of each word, END's behind the last; and the hash of each number, END's last."""

    of: np.ndarray
    distinct: np.ndarray


def code(hashes: np.ndarray) -> Codes:
    found = pa.array(hashes, pa.uint64()).dictionary_encode()
    return Codes(np.append(found.indices.to_numpy().astype(np.int64), len(found.dictionary)), np.append(found.dictionary.to_numpy(), END))


def moves(words: Codes, embedding: int, steps: int) -> list[np.ndarray]:
    """For each step whether the pointer moves on from a word, by the word's number; never from END."""
    out = []
    for j in range(steps):
        if j % 64 == 0:
            coins = bits(words.distinct, embedding, j // 64)
            coins[-1] = 0
        out.append(((coins >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int8))
    return out


def walk(words: Codes, start: np.ndarray, window: int, moving: list[np.ndarray], steps: list[np.ndarray], filters: list[list[np.ndarray]] | None, distinct: int | None = None):
    """Walk from every start through `window` words; per table (which starts, key of all samples).

    With filters, a start leaves a table when no item has its samples so far.  Two samples
    of all tables are read on one walk, of starts that a table still has; each table then
    walks on with the few that it has left.
    """
    last, end = len(words.of) - 1, words.of[-1]
    first_keys = extend(np.zeros(len(words.distinct), np.uint64), words.distinct)

    def reading(at: np.ndarray, which: np.ndarray, j: int) -> np.ndarray:
        # the pointer can't have left the window before as many steps as it has words
        return words.of.take(at) if j < window else np.where(at < start[which] + window, words.of[np.minimum(at, last)], end)

    def known(t: int, k: int, keys: np.ndarray) -> np.ndarray:
        return filters[t][k][(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]

    which, at, j = np.arange(len(start)), start.astype(np.int64), 0
    waiting: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    begun: dict[int, tuple] = {}
    while len(begun) < len(steps):
        word = reading(at, which, j)
        for t, s in enumerate(steps):
            if s[0] == j:
                waiting[t] = at.copy(), word, np.ones(len(at), bool) if filters is None else known(t, 0, first_keys).take(word)
            if t in waiting and s[min(1, len(s) - 1)] == j:
                read, first, there = waiting.pop(t)
                some = np.flatnonzero(there)
                keys, seen = first_keys[first[some]], np.ones(len(some), np.int8)
                if len(s) > 1:
                    keys, seen = extend(keys, words.distinct[word[some]]), seen + (read[some] != at[some])
                begun[t] = which[some], at[some], word[some], keys, seen.astype(np.int8)
        if filters is not None and len(waiting) + len(begun) == len(steps):
            wanted = np.logical_or.reduce([there for _, _, there in waiting.values()]) if waiting else np.zeros(len(at), bool)
            if 4 * np.count_nonzero(wanted) < 3 * len(at):
                stay = np.flatnonzero(wanted)
                which, at, word = which[stay], at[stay], word[stay]
                waiting = {t: tuple(x[stay] for x in xs) for t, xs in waiting.items()}
        at += moving[j].take(word)
        j += 1
    out = []
    for t, s in enumerate(steps):
        which, at, word, keys, seen = begun[t]
        for k in range(1, len(s)):
            if k > 1:
                read = at.copy()
                for j in range(int(s[k - 1]), int(s[k])):
                    at += moving[j].take(word)
                    word = reading(at, which, j + 1)
                keys = extend(keys, words.distinct[word])
                seen += read != at
            if filters is not None:
                stay = np.flatnonzero(known(t, k, keys))
                which, at, word, keys, seen = (x[stay] for x in (which, at, word, keys, seen))
            if not len(which):
                break
        # samples of too few different words say little; equal windows have equal walks, so both sides lose them
        enough = seen >= min(distinct or DISTINCT, window, len(s))
        out.append((which[enough], keys[enough]))
    return out


def build(items: list[tuple[object, str]], percent: int = PERCENT) -> Index:
    """The LSH tables of these items (identifier, text); items without words are left out."""
    texts = [" ".join(normal(t)) for _, t in items]
    items = [(i, t) for (i, _), t in zip(items, texts, strict=True) if t]
    texts = [t for _, t in items]
    words = split(pa.array(texts, pa.string()))
    codes, n_words = code(symbols(words)), words.counts
    classes = []
    moving = [moves(codes, e, reach(int(n_words.max(initial=0)))) for e in range(EMBEDDINGS)]
    size = np.floor(2 * np.log2(n_words)).astype(np.int64)
    for c in np.unique(size):
        members = np.flatnonzero(size == c)
        least = int(n_words[members].min())
        window = max(1, WINDOW * least // 100)
        stride = least - window + 1
        entry = np.array([(m, s) for m in members for s in range(int(n_words[m]) - window + 1)])
        start = words.first[entry[:, 0]] + entry[:, 1]
        tables = []
        for e in range(EMBEDDINGS):
            steps = samples(window, e)
            own = []
            for t in range(TABLES):
                filters = []
                for k in range(COORDINATES):
                    ((kept, key),) = walk(codes, start, window, moving[e], [steps[t][: k + 1]], None, 1 if k + 1 < COORDINATES else DISTINCT)
                    full = np.zeros(1 << FILTER_BITS, bool)
                    full[(key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
                    filters.append(full)
                order = np.argsort(key, kind="stable")
                own.append((steps[t], filters, key[order], entry[kept][order]))
            tables.append(own)
        classes.append(Length(window, stride, tables))
    return Index([i for i, _ in items], texts, n_words, [in_order(t) for t in texts], classes, enter_runs(texts, percent))


def pieces(text: str) -> np.ndarray:
    """The PIECE characters from each place as a number."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    n = max(0, len(codes) - PIECE + 1)
    out = np.zeros(n, np.uint64)
    for i in range(PIECE):
        out |= codes[i : i + n] << np.uint64(21 * i)
    return out


def in_order(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of a text in order of their numbers, the place of each, and at the first of equal ones how many there are, else 0."""
    own = pieces(text)
    place = np.argsort(own, kind="stable")
    own = own[place]
    often = np.searchsorted(own, own, "right") - np.searchsorted(own, own)
    often[1:][own[1:] == own[:-1]] = 0
    return own, place, often


def may_hold(item: tuple[np.ndarray, np.ndarray, np.ndarray], region: str, most: int) -> bool:
    """Can a part of the region be `most` edits away from the item with these pieces in_order()?  True: it can or not.

    Edits leave all but PIECE pieces each as they are, and an insertion or deletion moves those behind it
    by one: pieces that are left lie `most` apart at most, measured from their places in the item.
    """
    own, place, often = item
    least = len(own) - PIECE * most
    if least <= 0:
        return True
    there = pieces(region)
    low = np.searchsorted(own, there)
    times = np.searchsorted(own, there, "right") - low
    n, held = int(times.sum()), np.zeros(len(own), bool)
    held[low[times > 0]] = True
    if often[held].sum() < least:
        return False
    entry = np.repeat(low - np.cumsum(times) + times, times) + np.arange(n)
    moved = np.sort(np.repeat(np.arange(len(there)), times) - place[entry])
    return bool((moved[least - 1 :] - moved[: n - least + 1] <= most).any())


def runs(text: np.ndarray) -> np.ndarray:
    """The GRAM bytes from each place of a text as a number."""
    n = max(0, len(text) - GRAM + 1)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.empty(len(padded), np.uint64)
    for i in range(8):
        part = padded[i : i + (len(padded) - i) // 8 * 8].view("<u8")
        out[i::8][: len(part)] = part
    return out[:n] & np.uint64((1 << 8 * GRAM) - 1)


def cell(keys: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Where in a filter of a power of two these numbers are."""
    with np.errstate(over="ignore"):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(full).bit_length())).astype(np.int64)


def enter_runs(texts: list[str], percent: int) -> Grams:
    own = [runs(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    size = np.array([len(x) for x in own], np.int64)
    key = np.concatenate([np.empty(0, np.uint64), *own])
    item, place = np.repeat(np.arange(len(own)), size), np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
    chars = np.array([len(t.encode()) for t in texts], np.int64)
    _, which, often = np.unique(key, return_inverse=True, return_counts=True)
    ranked = np.lexsort((place, often[which], item))
    rank = np.empty(len(key), np.int64)
    rank[ranked] = place  # places of an item are its numbers from 0
    kept = (often[which] <= COMMON) | (rank < -(-size[item] // 2))
    # an item asks for as many runs less as it has lost
    least = np.maximum(FEWEST, chars // CHARS * np.bincount(item[kept], minlength=len(own)) // np.maximum(size, 1))
    key, item, place = key[kept], item[kept], place[kept]
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    full = np.zeros(1 << min(26, max(FILTER_BITS, len(keys).bit_length() + 4)), bool)
    full[cell(keys, full)] = True
    return Grams(full, keys, np.append(first, len(key)), item[order], place[order], least, chars * percent // 100)


def normal(text: str | bytes) -> list:
    """Words, with A-Z as a-z."""
    if isinstance(text, str):
        return [w.decode() for w in text.encode().lower().split()]
    return text.lower().split()


def candidates(words: Words, hashes: np.ndarray, index: Index) -> np.ndarray:
    """Rows of (row, item, place), distinct and in order: where, in words of the row, the item may begin."""
    found = [np.empty((0, 3), np.int64)]
    counts, codes = words.counts, code(hashes)
    windows = []
    for c in index.classes:
        # a window every `stride` words of each row that can hold one
        per_row = np.where(counts >= c.window, (counts - c.window) // c.stride + 1, 0)
        row = np.repeat(np.arange(len(counts)), per_row)
        if len(row):
            windows.append((c, row, (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * c.stride))
    for e in range(EMBEDDINGS if windows else 0):
        moving = moves(codes, e, reach(max(c.window for c, _, _ in windows)))
        for c, row, place in windows:
            tables = c.tables[e]
            hits = walk(codes, words.first[row] + place, c.window, moving, [t[0] for t in tables], [t[1] for t in tables])
            for (which, key), (_, _, keys, entry) in zip(hits, tables, strict=True):
                low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
                times = high - low
                w = np.repeat(which, times)
                got = entry[np.repeat(low, times) + np.arange(len(w)) - np.repeat(np.cumsum(times) - times, times)]
                found.append(np.column_stack([row[w], got[:, 0], place[w] - got[:, 1]]))
    found.append(near(words, index.grams))
    return np.unique(np.concatenate(found), axis=0)


def near(words: Words, grams: Grams) -> np.ndarray:
    """Rows of (row, item, place) where enough of the item's runs of bytes lie as far apart as the allowed edits may bring them."""
    keep = ~SPACE[words.data]
    keep[words.end[words.end < len(keep)]] = True  # one space between words
    origin = np.flatnonzero(keep)
    text = words.data[origin]
    text[SPACE[text]] = 32
    parts = [_known_runs(text[a : a + RUNS + GRAM - 1], grams) for a in range(0, len(text), RUNS)]
    at = np.concatenate([np.empty(0, np.int64), *[p[0] + k * RUNS for k, p in enumerate(parts)]])
    low = np.concatenate([np.empty(0, np.int64), *[p[1] for p in parts]])
    row = np.searchsorted(words.offsets, origin[at], "right") - 1
    whole = origin[at + GRAM - 1] < words.offsets[row + 1]
    at, low, row = at[whole], low[whole], row[whole]
    n, found = len(grams.least), [np.empty((0, 3), np.int64)]
    blocks = max(1, min(n, -(-int((grams.first[low + 1] - grams.first[low]).sum()) // PAIRS)))
    if blocks == 1:
        return _aligned(at, row, grams.first[low], grams.first[low + 1] - grams.first[low], origin, len(text), words, grams)
    # entries of a run stand in order of items: a block of items at a time, so that few pairs are listed at once
    placed = np.repeat(np.arange(len(grams.keys)), np.diff(grams.first)) * n + grams.item
    for a in range(blocks):
        begin, end = (np.searchsorted(placed, low * n + x * n // blocks) for x in (a, a + 1))
        found.append(_aligned(at, row, begin, end - begin, origin, len(text), words, grams))
    return np.concatenate(found)


def _known_runs(text: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of the items begin in a text, and the number of each."""
    keys = runs(text)
    at = np.flatnonzero(grams.full[cell(keys, grams.full)])
    low = np.searchsorted(grams.keys, keys[at])
    same = np.append(grams.keys, np.uint64(0))[low] == keys[at]
    same &= low < len(grams.keys)
    return at[same], low[same]


def _aligned(at: np.ndarray, row: np.ndarray, entry: np.ndarray, times: np.ndarray, origin: np.ndarray, size: int, words: Words, grams: Grams) -> np.ndarray:
    """near() for some of the items: `times` entries from `entry` on for each place in the texts."""
    entry = np.repeat(entry - np.cumsum(times) + times, times) + np.arange(times.sum())
    item, begin, row = grams.item[entry], np.repeat(at, times) - grams.place[entry], np.repeat(row, times)
    if len(row) and (int(row[-1]) + 1) * len(grams.least) <= PAIRS:
        # a row with too few runs of an item in all can't have enough side by side
        pair = row * len(grams.least) + item
        some = np.flatnonzero((np.bincount(pair) >= np.tile(grams.least, int(row[-1]) + 1)[: int(pair.max()) + 1]).take(pair))
        item, begin, row = item[some], begin[some], row[some]
    # in order of row, item and place, with gaps that no band reaches across
    gap = size + 2 * int(grams.band.max(initial=0)) + int(grams.place.max(initial=0)) + 2
    key = (row * len(grams.least) + item) * gap + begin + int(grams.place.max(initial=0))
    order = np.argsort(key)
    key, item, begin, row = key[order], item[order], begin[order], row[order]
    last = np.searchsorted(key, key + grams.band[item], "right")
    hit = np.flatnonzero(last - np.arange(len(key)) >= grams.least[item])
    item, begin, row = item[hit], begin[hit], row[hit]
    word = np.searchsorted(words.start, origin[np.clip(begin, 0, len(origin) - 1)], "right") - 1
    return np.column_stack([row, item, np.maximum(word - words.first[row], 0)])


def matches(words: Words, hashes: np.ndarray, index: Index, percent: int) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, distance, place) of the candidates that stand the exact test."""
    found = candidates(words, hashes, index)
    cut = np.flatnonzero((np.diff(found[:, :2], axis=0) != 0).any(1)) + 1
    asked = []
    for group in np.split(found, cut) if len(found) else []:
        row, item = int(group[0, 0]), int(group[0, 1])
        asked += [(row, item, place, region) for place, region in regions(words, row, index, item, group[:, 2].tolist(), percent)]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    most = [percent * len(index.texts[item]) // 100 for _, item, _, _ in asked]
    for (row, item, place, _), allowed, distance in zip(asked, most, edit_distances([(index.texts[item], region) for _, item, _, region in asked], most), strict=True):
        if distance <= allowed and distance < best.get((row, item), (allowed + 1, 0))[0]:
            best[row, item] = distance, place
    for (row, item), (distance, place) in best.items():
        yield row, item, distance, place


#: Pairs compared at once, and characters of their texts in one step of reading masks.
LANES, READ = 128, 512


def edit_distances(pairs: list[tuple[str, str]], most: list[int]) -> list[int]:
    """edit_distance of each pair (pattern, text), most + 1 if it is larger.

    Patterns stand side by side in one integer, each with a bit of room for its carry, so
    that a step takes as many texts on by a character.
    """
    out = [m + 1 if m < len(p) else len(p) for (p, _), m in zip(pairs, most, strict=True)]
    order = sorted((i for i, (p, t) in enumerate(pairs) if p and t), key=lambda i: len(pairs[i][1]))
    at = 0
    while at < len(order):
        # texts of about the same length
        some = [i for i in order[at : at + LANES] if len(pairs[i][1]) <= 2 * len(pairs[order[at]][1]) + READ]
        at += len(some)
        for i, least in zip(some, _side_by_side([pairs[i] for i in some]), strict=True):
            out[i] = min(out[i], least)
    return out


def _side_by_side(pairs: list[tuple[str, str]]) -> list[int]:
    """The least edit distance of each pattern to a part of its text that isn't empty."""
    width = max(len(p) for p, _ in pairs) // 8 + 1  # bytes of a pattern's place, a bit more than it has at least
    tables, codes, n = [], [], 0
    for pattern, _ in pairs:
        own = {ch: k for k, ch in enumerate(dict.fromkeys(pattern), n + 1)}
        bit = np.zeros((len(own) + 1, 8 * width), bool)
        bit[[own[ch] - n for ch in pattern], np.arange(len(pattern))] = True
        tables.append(np.packbits(bit, axis=1, bitorder="little"))
        codes.append(own)
        n += len(own) + 1
    masks = np.concatenate(tables)
    longest = max(len(t) for _, t in pairs)
    # the first row of each pattern's table is of characters that it lacks
    which = np.zeros((longest, len(pairs)), np.int32)
    for k, ((_, text), own) in enumerate(zip(pairs, codes, strict=True)):
        which[: len(text), k] = [own.get(ch, 0) for ch in text]
    size = width * len(pairs)
    whole = lambda lengths: sum(((1 << m) - 1) << (8 * width * k) for k, m in enumerate(lengths))
    lengths = [len(p) for p, _ in pairs]
    full = whole(lengths)
    byte, shift = np.array([(m - 1) // 8 for m in lengths]), np.array([(m - 1) % 8 for m in lengths], np.uint8)
    score, ends = np.array(lengths, np.int64), np.array([len(t) for _, t in pairs])
    best = score.copy()
    vp, vn = full, 0
    for a in range(0, longest, READ):
        read = masks[which[a : a + READ]].reshape(-1, size)
        more, less = [], []
        for line in read:
            eq = int.from_bytes(line.tobytes(), "little")
            d0 = (((eq & vp) + vp) ^ vp) | eq | vn
            hp, hn = vn | (full & ~(d0 | vp)), d0 & vp
            more.append(hp.to_bytes(size, "little"))
            less.append(hn.to_bytes(size, "little"))
            hp, hn = hp << 1, hn << 1
            vp, vn = (hn | (full & ~(d0 | hp))) & full, hp & d0 & full
        up, down = (((np.frombuffer(b"".join(x), np.uint8).reshape(-1, len(pairs), width)[:, np.arange(len(pairs)), byte] >> shift) & 1).astype(np.int64) for x in (more, less))
        scores = score + np.cumsum(up - down, axis=0)
        score = scores[-1]
        # behind a text's end no score counts
        best = np.minimum(best, np.where(np.arange(a, a + len(scores))[:, None] < ends, scores, best).min(axis=0))
    return best.tolist()


def edit_distance(pattern: str, text: str, most: int) -> tuple[int, int]:
    """(distance, end): the least edit distance of the pattern to any substring of the text, and where the first such ends.

    By bit-parallel dynamic programming, a column of the matrix per integer; (most + 1, 0) if it is larger.
    """
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(pattern):
        masks[ch] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score, best, end = full, 0, m, most + 1, 0
    if m <= most:
        best = m
    for at, ch in enumerate(text, 1):
        eq = masks.get(ch, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = vn | (full & ~(d0 | vp)), d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1, hn << 1
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0 & full
        if score < best:
            best, end = score, at
    return best, end


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """A row for each document and benchmark item that it holds, at most `percent` of the item's characters edited.

    Returns key, item_key, distance (least edit distance, of texts in lower case A-Z
    with one space between words), item_chars and place (the word where it may begin).

    Null or empty text of either side: no match.  Null keys: matches are returned with
    the null.  Rows with the same key: a row each.  Empty tables: empty result.
    """
    items = benchmark.select(F.col(item_key).alias("id"), F.col(item_text).alias("text"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind, item_kind = rows.schema["key"].dataType.simpleString(), items.schema["id"].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, distance long, item_chars long, place long"
    out = None
    for index in _indexes(items, percent):
        one = rows.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(index), percent, rows.schema["key"].dataType, items.schema["id"].dataType), schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select(F.col("key").alias(key), F.col("item").alias(item_key), "distance", "item_chars", "place")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of docs that hold no benchmark item: each is judged by its own text, whatever its key."""
    for index in _indexes(benchmark.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")), percent):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index), percent, text), docs.schema)
    return docs


def _clean(shared, percent: int, text: str):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch[text], STEP_BYTES):
                part = batch.slice(a, b - a)
                words = split(part[text], lower=True)
                keep = np.ones(len(part), bool)
                keep[np.array([f[0] for f in matches(words, symbols(words), shared.value, percent)], np.int64)] = False
                yield part.filter(pa.array(keep))

    return clean


def _indexes(items: DataFrame, percent: int) -> Iterator[Index]:
    """The tables of all items (id, text), about ITEMS or ITEM_BYTES at a time."""
    items = items.where("text IS NOT NULL")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(-(-n // ITEMS), -(-size // ITEM_BYTES))
    for part in range(parts):
        some = items if parts == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield build([(r.id, r.text) for r in some.orderBy("id", "text").collect()], percent)


def _search(shared, percent: int, key_type, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for a, b in spread(batch["text"], STEP_BYTES):
                part = batch.slice(a, b - a)
                words = split(part["text"], lower=True)
                hashes = symbols(words)
                found = list(matches(words, hashes, index, percent))
                rows = pa.array([f[0] for f in found], pa.int64())
                yield pa.record_batch({
                    "key": part["key"].take(rows), "item": pa.array([index.ids[f[1]] for f in found], to_arrow_type(item_type)),
                    "distance": pa.array([f[2] for f in found], pa.int64()), "item_chars": pa.array([len(index.texts[f[1]]) for f in found], pa.int64()), "place": pa.array([f[3] for f in found], pa.int64()),
                })

    return search


def regions(words: Words, row: int, index: Index, item: int, places: list[int], percent: int) -> Iterator[tuple[int, str]]:
    """(place, text) of the regions that may hold the item: places near each other are one region of the text."""
    first, end = int(words.first[row]), int(words.first[row + 1])
    n, own = int(index.n_words[item]), index.pieces[item]
    most, slack = percent * len(index.texts[item]) // 100, n // 2 + 2
    at = 0
    while at < len(places):
        begin = last = places[at]
        while at < len(places) and places[at] <= last + slack:
            last, at = places[at], at + 1
        a, b = max(first, first + begin - slack), min(end, first + last + n + slack)
        region = b" ".join(words.data[words.start[a] : words.end[b - 1]].tobytes().split()).decode("utf-8", "replace") if a < b else ""
        if may_hold(own, region, most):
            yield max(begin, 0), region
