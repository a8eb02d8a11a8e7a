"""Language-model scoring with a weighted backoff automaton.

The n-grams of the training texts become an automaton.  A state is a history: the
empty one, every word seen in training, and every longer sequence of up to ORDER - 1
words seen at least LEAST times.  From state h an arc on w exists when hw was seen,
weighing log10 p(w | h); otherwise the failure arc of h leads, without reading w, to
the history without its first word, weighing log10 of the mass that h keeps for words
not seen after it.  Probabilities are smoothed by a prior of PRIOR words:

  p(w | h) = (c(hw) + PRIOR * p(w | h')) / (c(h) + PRIOR),  mass kept: PRIOR / (c(h) + PRIOR),
  p(w) = (c(w) + 1) / (N + V + 1),

with h' the history without its first word, so that the weights from each state sum to
one over the V words and the unknown word.  After a word the automaton is in the longest
state that ends the text so far; it never gets deeper by more than one word.  Scoring
reads each text once from left to right, carrying the state, falling along failure
arcs until an arc reads the word, and adding weights; all texts of a chunk are read
side by side.

The automaton is as large as the corpus has distinct n-grams, so it is never in one
place: a chunk of documents fetches the counts that its own part needs (exchange.py),
each distinct n-gram once, order by order; longer ones only where their history is a
state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .words import U, mix, split, word_hashes

#: Words of the longest n-grams, how often a history of two words or more must be seen to be a state, and the weight of the prior.
ORDER, LEAST, PRIOR = 3, 2, 4.0
#: Texts whose `crc32(key) % FOLDS` is HELD_OUT aren't learnt from.
FOLDS, HELD_OUT = 7, 2

END = mix(np.array([1 << 40], U))[0]
PAIR = U(0x9E3779B97F4A7C15)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens (the words of each text, then its end), the text of each, and where texts begin."""
    words = split(texts, lower=True)
    counts = words.counts + 1
    first = np.append(0, np.cumsum(counts))
    out = np.full(first[-1], END, U)
    out[np.arange(len(words)) + words.row] = word_hashes(words)
    return out, np.repeat(np.arange(len(counts)), counts), first


@dataclass
class Grams:
    """The distinct n-grams of one order: keys in order, the n-gram that ends at each token (-1 where the text is shorter), and a token where each ends."""

    keys: np.ndarray
    at: np.ndarray
    where: np.ndarray


def grams(tokens: np.ndarray, first: np.ndarray, order: int, bits: int) -> list[Grams]:
    """The n-grams of orders 1 to `order`, by the first bits of their hashes."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    out, key = [], tokens
    for n in range(1, order + 1):
        if n > 1:
            history = np.empty(len(tokens), U)
            history[1:] = key[:-1]
            with np.errstate(over="ignore"):
                key = mix(mix(history) * PAIR + tokens)
        inner = np.flatnonzero(place >= n - 1)
        keys, where, inverse = np.unique(key[inner] >> U(64 - bits), return_index=True, return_inverse=True)
        at = np.full(len(tokens), -1)
        at[inner] = inverse
        out.append(Grams(keys, at, inner[where]))
    return out


def asked(levels: list[Grams], counts: list[np.ndarray], n: int, least: int) -> np.ndarray:
    """Which n-grams of order n (2 or more) have a history that is a state, given the counts of the orders below."""
    before = levels[n - 2].at[levels[n - 1].where - 1]
    return counts[n - 2][before] >= (1 if n == 2 else least)


@dataclass
class Automaton:
    """Of each order n: the log10 weight of the arc that reads the last word of an n-gram from its history's state (-inf where it has none),
    and of the failure arc of the n-gram as a state (nan where it is none)."""

    arcs: list[np.ndarray]
    failures: list[np.ndarray]


def build(levels: list[Grams], counts: list[np.ndarray], total: float, types: float, least: int, prior: float) -> Automaton:
    """The part of the automaton that these n-grams need, from their counts in training."""
    p = (counts[0] + 1.0) / (total + types + 1.0)
    probabilities, arcs, failures = [p], [np.log10(p)], []
    for n, level in enumerate(levels[1:], 2):
        history, shorter = levels[n - 2].at[level.where - 1], levels[n - 2].at[level.where]
        c, below = counts[n - 2][history], probabilities[-1][shorter]
        state = c >= (1 if n == 2 else least)
        p = np.where(state, (counts[n - 1] + prior * below) / (c + prior), below)
        probabilities.append(p)
        arcs.append(np.where(state & (counts[n - 1] > 0), np.log10(p), -np.inf))
    for n, c in enumerate(counts, 1):
        failures.append(np.where(c >= (1 if n == 1 else least), np.log10(prior / (c + prior)), np.nan))
    return Automaton(arcs, failures)


def traverse(levels: list[Grams], automaton: Automaton, row: np.ndarray, texts: int) -> np.ndarray:
    """log10 probabilities of all texts, each read once from left to right."""
    order, n = len(levels), len(row)
    # the state before each token: the longest that ends the text so far
    state, depth = np.full(n, -1), np.zeros(n, np.int64)
    for k in range(1, order):
        ends = np.full(n, -1)
        ends[1:] = np.where(row[1:] == row[:-1], levels[k - 1].at[:-1], -1)
        deeper = np.flatnonzero(ends >= 0)
        deeper = deeper[~np.isnan(automaton.failures[k - 1][ends[deeper]])]
        state[deeper], depth[deeper] = ends[deeper], k
    weight, waiting = np.zeros(n), np.arange(n)
    for k in range(order - 1, -1, -1):
        here = depth[waiting] == k
        at = waiting[here]
        arc = automaton.arcs[k][levels[k].at[at]]
        read = arc > -np.inf
        weight[at[read]] += arc[read]
        fall = at[~read]
        if k:
            weight[fall] += automaton.failures[k - 1][state[fall]]
            depth[fall] = k - 1
            if k > 1:
                state[fall] = levels[k - 2].at[fall - 1]
            waiting = np.concatenate([waiting[~here], fall])
    return np.bincount(row, weight, texts)


def total_counts(table: pa.Table) -> pa.Table:
    """Of one shard's blocks: each chunk's answers, and for the words the sum of all counts and how many were seen."""
    out = []
    for n in sorted(set(table["n"].to_pylist())):
        part = table.filter(pc.equal(table["n"], n))
        told = X.totals(part)
        facts = (0, 0)
        if n == 1:
            keys = np.concatenate([X.unpack_sorted(x) for x in part["keys"].to_pylist()])
            counts = np.concatenate([X.unpack(x) for x in part["counts"].to_pylist()]).astype(np.int64)
            facts = (counts.sum(), len(np.unique(keys[counts > 0])))
        fixed = lambda v, m=len(part): pa.array([int(v)] * m, pa.int64())
        out.append(told.append_column("n", part["n"]).append_column("tokens", fixed(facts[0])).append_column("types", fixed(facts[1])))
    return pa.concat_tables(out)


ASKED = "chunk int, shard int, keys binary, counts binary, n int"
TOLD = "chunk int, shard int, answer binary, n int, tokens long, types long"


def score_texts(docs: DataFrame, train: str = "train", key: str = "doc_id", text: str = "text", order: int = ORDER, least: int = LEAST, prior: float = PRIOR, chunk_bytes: int = X.CHUNK_BYTES) -> DataFrame:
    """Learn from the texts whose boolean column `train` is true and score every text.

    Returns key, train, n_tokens, n_known (tokens seen in training), train_tokens
    (long), base_score (add-one unigrams) and score (the automaton), both log10
    probabilities of the text with its end.  Lower-cases A-Z.

    Null or empty text: its end alone is scored.  Null train: not learnt from.
    Nothing to learn from: every token has probability 1 by the empty vocabulary's
    unknown word.  Rows with the same key, or none, are learnt from and scored each.
    Further columns don't matter.  Empty table: empty result.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    size, dealt = X.deal(docs, "text", chunk_bytes)
    shards = size.shards

    def block(chunk: int, levels: list[Grams], n: int, use: np.ndarray | None, weights: np.ndarray) -> pa.Table:
        level = levels[n - 1]
        here = level.at >= 0
        counts = np.bincount(level.at[here], weights[here], len(level.keys)).astype(np.int64)
        keys, counts = (level.keys, counts) if use is None else (level.keys[use], counts[use])
        out = X.blocks(chunk, keys, size.key_bits, shards, every=n == 1, counts=counts)
        return out.append_column("n", pa.array([n] * len(out), pa.int32()))

    def read(table: pa.Table, upto: int):
        tokens, row, first = _tokens(X.field(table, "text"))
        learnt = X.field(table, "train").to_numpy(zero_copy_only=False).astype(bool) * X.field(table, X.COPIES).to_numpy()
        return row, first, learnt.astype(np.float64)[row], grams(tokens, first, upto, size.key_bits)

    def counted(levels: list[Grams], told: pa.Table, upto: int) -> list[np.ndarray]:
        """The counts of all n-grams of orders 1 to upto; 0 for those that weren't asked for."""
        out = []
        for n in range(1, upto + 1):
            answers = X.answers(told.filter(pc.equal(told["n"], n))).astype(np.float64)
            if n > 2:
                full = np.zeros(len(levels[n - 1].keys))
                full[asked(levels, out, n, least)] = answers
                answers = full
            out.append(answers)
        return out

    def ask(table: pa.Table) -> pa.Table:
        _, _, weights, levels = read(table, min(2, order))
        return pa.concat_tables([block(table["chunk"][0].as_py(), levels, n, None, weights) for n in range(1, min(2, order) + 1)])

    def ask_longer(n: int):
        def run(name: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
            _, _, weights, levels = read(table, n)
            return block(name[0].as_py(), levels, n, asked(levels, counted(levels, told, n - 1), n, least), weights)

        return run

    told = dealt.groupBy("chunk").applyInArrow(ask, ASKED).groupBy("shard").applyInArrow(total_counts, TOLD)
    for n in range(3, order + 1):
        longer = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(ask_longer(n), ASKED)
        told = told.unionByName(longer.groupBy("shard").applyInArrow(total_counts, TOLD))

    def score(table: pa.Table, told: pa.Table) -> pa.Table:
        row, first, _, levels = read(table, order)
        n = len(first) - 1
        # every shard answers every chunk about words, so that their sums are at hand
        words = told.filter(pc.equal(told["n"], 1))
        tokens, types = (int(pc.sum(words[c]).as_py() or 0) for c in ("tokens", "types"))
        counts = counted(levels, told, order)
        automaton = build(levels, counts, tokens, types, least, prior)
        word = levels[0].at
        return pa.table({
            "id": X.field(table, "id"), "train": X.field(table, "train"), X.COPIES: X.field(table, X.COPIES),
            "n_tokens": pa.array(np.diff(first), pa.int64()),
            "n_known": pa.array(np.bincount(row, counts[0][word] > 0, n).astype(np.int64) if n else [], pa.int64()),
            "train_tokens": pa.array([tokens] * n, pa.int64()),
            "base_score": pa.array(np.bincount(row, automaton.arcs[0][word], n) if n else [], pa.float64()),
            "score": pa.array(traverse(levels, automaton, row, n) if n else [], pa.float64()),
        })

    kind = docs.schema["id"].dataType.simpleString()
    out = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, f"id {kind}, train boolean, {X.COPIES} long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return X.unfold(out, size).withColumnRenamed("id", key)
