"""Quality rules on repetition, by suffix arrays.

The words of many texts at once form one suffix array in which suffixes end with
their text, built by prefix doubling that sorts again only suffixes still tied.
The longest common prefix of two neighbours is found by comparing substrings of
halving lengths by their polynomial hashes, so that a few arrays as long as the text
are held, whatever repeats in it.  The deepest interval of common prefixes that holds
a suffix is as long as the larger of its two neighbours' prefixes, which is the longest
repeated substring that starts there; the union of those of at least REPEAT words covers
exactly what maximal repeated substrings of that length cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import spread
from .words import Words, raw, split, word_hashes

#: Words of the shortest repeat that counts; percent of words that repeats may cover; words of the longest repeat allowed.
REPEAT, COVERED, LONGEST = 10, 15, 60
#: The base rules: words of a window, fewest words of a text, percent of words in repeated windows.
WINDOW, FEWEST, REPEATED = 5, 10, 20
#: Text bytes in one suffix array; a longer text has one of its own.
ARRAY_BYTES = 4 << 20

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


#: Moduli and bases of the hashes: products fit in 62 bits, sums of 2**32 residues in 63.
PRIMES, BASES = (2147483647, 2147483629), (1000003937, 1327217893)


def suffix_array(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The order of all suffixes, by text and then by words; the symbol of each word; and a length in words that no two suffixes of a text share."""
    n = len(words)
    ends = words.first[1:][words.row] if n else np.empty(0, np.int64)
    _, symbol = np.unique(hashes, return_inverse=True)
    key = words.row * (int(symbol.max(initial=0)) + 1) + symbol
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[:n]
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.empty(0, np.int64)
    rank = np.full(n + 1, -1)
    rank[order] = begin
    step = 1
    while True:
        new = np.append(new, True)
        tied = np.flatnonzero(~(new[:-1] & new[1:])) if n else np.empty(0, np.int64)
        if not len(tied):
            return order, symbol, step
        at = order[tied]
        ahead = at + step
        second = np.where(ahead < ends[at], rank[np.minimum(ahead, n)], -1)
        first = rank[at]
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        order[tied] = at
        fresh = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        new = new[:-1]
        new[tied] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        step *= 2


def prefix_hashes(symbol: np.ndarray, prime: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, powers): sums[i] is the sum of (symbol[t] + 1) * base**t for t < i, modulo prime."""
    powers = np.ones(len(symbol) + 1, np.int64)
    have = 1
    while have < len(powers):
        more = min(have, len(powers) - have)
        powers[have : have + more] = powers[:more] * pow(base, have, prime) % prime
        have += more
    return np.append(0, np.cumsum((symbol % prime + 1) * powers[:-1] % prime)) % prime, powers


def longest_repeats(words: Words, hashes: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest substring that starts there and again elsewhere in its text."""
    n = len(words)
    order, symbol, limit = suffix_array(words, hashes)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    low, high = np.minimum(order[:-1], order[1:]), np.maximum(order[:-1], order[1:])
    same = np.flatnonzero((words.row[low] == words.row[high]) & (symbol[low] == symbol[high]))
    low, high = low[same], high[same]
    end = words.first[1:][words.row[high]]
    length = np.zeros(len(low), np.int64)
    sides = [(*prefix_hashes(symbol, p, b), p) for p, b in zip(PRIMES, BASES, strict=True)]
    step = limit // 2 or 1
    while step:
        at = np.flatnonzero(high + length + step <= end)
        i, j = low[at] + length[at], high[at] + length[at]
        equal = np.ones(len(at), bool)
        for sums, powers, prime in sides:
            equal &= (sums[i + step] - sums[i]) % prime * powers[j - i] % prime == (sums[j + step] - sums[j]) % prime
        length[at[equal]] += step
        step //= 2
    np.maximum.at(out, low, length)
    np.maximum.at(out, high, length)
    return out


def covered(words: Words, lengths: np.ndarray, least: int, most: int | None = None) -> np.ndarray:
    """Words of each text inside a repeat of at least that length; each repeat counts for its first `most` words only if given."""
    gone = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    reach = lengths[at] if most is None else np.minimum(lengths[at], most)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + reach, -1)
    return per_text(words, np.cumsum(gone[:-1]) > 0)


def per_text(words: Words, flags: np.ndarray) -> np.ndarray:
    return np.bincount(words.row, flags, len(words.first) - 1).astype(np.int64)


def per_row(at: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """How many bytes of each row are flagged."""
    sums = np.append(0, np.cumsum(flags))
    return sums[at[1:]] - sums[at[:-1]]


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text: see rate_repetition."""
    words = split(texts)
    data, at = raw(texts)
    lengths = longest_repeats(words, word_hashes(words))
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, words.row, lengths)
    starts = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    return {
        "n_words": words.counts, "word_chars": per_row(at, starts & (np.cumsum(inside[:-1]) > 0)), "n_symbols": per_row(at, SYMBOLS[data]),
        "n_dup_lines": np.array([duplicate_lines(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64),
        "n_repeat_words": covered(words, lengths, WINDOW, WINDOW), "n_covered_words": covered(words, lengths, REPEAT), "longest_repeat": most,
    }


def rate_repetition(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST, percent: int = COVERED) -> DataFrame:
    """key, the measures (long), base_failed and kept for every row.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines equal
    to an earlier one), n_repeat_words (in windows of 5 words found again),
    n_covered_words (in repeats of REPEAT words or more), longest_repeat (words).
    kept: not base_failed, at most `percent` of the words covered, and no repeat
    longer than `longest`.

    Null or empty text: no words, fails the base rules.  Keys are carried along,
    so that null and repeated keys are rows like others; further columns don't matter.
    Empty table: empty result.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch["text"], ARRAY_BYTES):
                part = batch.slice(a, b - a)
                found = measures(part["text"])
                yield pa.record_batch({"key": part["key"]} | {n: pa.array(found[n], pa.int64()) for n in names})

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = rows.mapInArrow(rate, f"key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    repetitive = (100 * F.col("n_covered_words") > percent * F.col("n_words")) | (F.col("longest_repeat") > longest)
    return out.select(F.col("key").alias(key), *names, failed.alias("base_failed"), (~failed & ~repetitive).alias("kept"))
