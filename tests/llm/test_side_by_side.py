"""op9's candidates: compared many at once, walked by the number of a word, and told apart by pieces in order."""

import random

import numpy as np
import pyarrow as pa

from screenloom.llm import decontam


def edited(rng, text, times):
    out = list(text)
    for _ in range(times):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.randrange(2)] = rng.choice(["", "é", "q "])
    return "".join(out)


def test_distances_of_many_pairs_are_those_of_each():
    rng = random.Random(7)
    pairs = [("", "ab"), ("ab", ""), ("a", "a"), ("abc" * 30, "x" * 1500)]
    for _ in range(300):
        item = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 150)))
        pairs.append((item, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(60))) + edited(rng, item, rng.randrange(20)) + "b" * rng.randrange(900)))
    most = [len(p) * rng.choice((0, 20, 100)) // 100 for p, _ in pairs]
    want = [decontam.edit_distance(p, t, m)[0] if p else 0 for (p, t), m in zip(pairs, most, strict=True)]
    assert decontam.edit_distances(pairs, most) == want


def test_pieces_in_order_lose_no_edited_item_and_leave_few_others():
    rng = random.Random(8)
    words = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    kept = 0
    for _ in range(200):
        item = text(30)
        most = decontam.PERCENT * len(item) // 100
        own = decontam.in_order(item)
        assert decontam.may_hold(own, text(9) + " " + edited(rng, item, most) + " " + text(9), most)
        # the same words in another order hold its pieces, but not the item
        mixed = item.split()
        rng.shuffle(mixed)
        kept += decontam.may_hold(own, " ".join(mixed), most)
    assert kept < 100  # all of them, where only the pieces are compared


def test_walks_are_those_of_each_start():
    rng = np.random.default_rng(9)
    hashes = decontam.symbols(decontam.split(pa.array([" ".join(rng.choice(["ab", "cd", "efg", "h", "ij"], 400))]), lower=True))
    codes, window = decontam.code(hashes), 17
    for e in range(2):
        steps = decontam.samples(window, e)
        start = np.arange(len(hashes) - window + 1)
        found = decontam.walk(codes, start, window, decontam.moves(codes, e, decontam.reach(window)), steps, None)
        for (which, keys), sampled in zip(found, steps, strict=True):
            want = {}
            for s in start:
                at, key, read = int(s), np.zeros(1, np.uint64), []
                for j in range(int(sampled[-1]) + 1):
                    inside = at < s + window
                    if j in sampled:
                        key = decontam.extend(key, hashes[at : at + 1] if inside else np.array([decontam.END]))
                        read.append(at)
                    at += inside and int(decontam.bits(hashes[at : at + 1], e, j // 64)[0] >> np.uint64(j % 64)) & 1
                if len(set(read)) >= decontam.DISTINCT:
                    want[int(s)] = int(key[0])
            assert dict(zip(which.tolist(), keys.tolist(), strict=True)) == want
