"""Places in texts, and works ranked for citations, against plain loops."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from screenloom.functions import spans
from screenloom.operators import citations


def test_hits_windows_and_intervals(spark):
    dice = random.Random(2)
    texts = ["", None, "aXb", "XX", "Xa", "aX", "no", "\U0001f600X\U0001f600\U0001f600X"] + ["".join(dice.choice("abX \n😀") for _ in range(dice.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", spans.find(F.col("t"), "X+a?").alias("hits"), spans.windows(F.col("t"), "X+a?", 2, 3).alias("parts"), spans.windows(F.col("t"), "X", 1, 1, gap=2).alias("wide")).orderBy("i").collect()

    def cut(t, pattern, before, after, gap):
        out = []
        for m in re.finditer(pattern, t):
            a, b = max(0, m.start() - before), min(len(t), m.end() + after)
            if out and a <= out[-1][1] + gap:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return [t[a:b] for a, b in out]

    for r, t in zip(rows, texts, strict=True):
        if t is None:
            assert r.hits is None and r.parts is None
            continue
        assert [(h.start, h.end, h.hit) for h in r.hits] == [(m.start(), m.end(), m[0]) for m in re.finditer("X+a?", t)]
        assert r.parts == cut(t, "X+a?", 2, 3, 0) and r.wide == cut(t, "X", 1, 1, 2)


def plain(name):
    return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower()


def ranked(cites, works, offered, above):
    out = []
    for cid, names, year, topic in cites:
        every = list(dict.fromkeys(plain(n) for n in names or [] if n and n.strip()))
        wanted = every[:3]
        if not wanted or year is None:
            continue
        theirs = {w[0]: {plain(n) for n in w[1] if n} for w in works}
        same = [w for w in works if w[2] == year]
        hits, covers = [w for w in same if set(wanted) <= theirs[w[0]]], True
        if not hits and len(wanted) > 1:
            hits, covers = [w for w in same if wanted[0] in theirs[w[0]]], False
        hits.sort(key=lambda w: (-(w[4] or 0), w[0]))
        words = list(dict.fromkeys(w for w in re.findall(r"[^\W\d_]{4,}", (topic or "").lower()) if w not in citations.NO_TOPIC and plain(w) not in every))
        near = []
        if len(hits) > above:
            for n in (3, 2):
                if words and (near := [w for w in hits if {plain(x) for x in words[:n]} <= set(re.split(r"[\W_]+", plain(w[3] or "")))][:offered]):
                    break
        best = [(w[0], "topic") for w in near]
        best += [(w[0], "names" if covers else "first name") for w in hits[:offered] if w[0] not in {b[0] for b in best}]
        out += [(cid, i, ref, how, covers, len(hits)) for i, (ref, how) in enumerate(best[:offered], 1)]
    return sorted(out)


def test_ranked_works(spark):
    dice = random.Random(6)
    names = ["Zárate", "Jones", "Macken", "Ōta", "Han", "de la Cruz", "ZARATE", "jones", "Kahn", "Å"]
    words = ["memory", "status", "sound", "changing", "state", "über", "Effect", "Jones", "the", "noise_level", "café"]
    works = [(i, [dice.choice(names) for _ in range(dice.randint(0, 3))] + ([None] if i % 9 == 0 else []), dice.choice([1995, 2001]), " ".join(dice.choice(words) for _ in range(4)) if i % 11 else None, dice.choice([None, 0, 5, 9])) for i in range(300)]
    cites = [(i, dice.sample(names, dice.randint(1, 4)), dice.choice([1995, 2001, 1950, None]), " ".join(dice.choice(words) for _ in range(5))) for i in range(120)]
    cites += [(900, ["Jones"], 1995, ""), (901, ["Jones"], 1995, None), (902, [], 1995, "x"), (903, None, 1995, "x"), (904, ["", "Jones"], 2001, "Status of memory"), (905, ["Zarate", "Unknown"], 1995, "sound state")]
    got = citations.rank_works(spark.createDataFrame(cites, "cite_id int, surnames array<string>, year int, topic string"), spark.createDataFrame(works, "ref_id int, surnames array<string>, year int, title string, cited_by int"), offered=6, narrow_above=8)
    want = ranked(cites, works, 6, 8)
    assert sorted(map(tuple, got.collect())) == want
    assert {w[3] for w in want} == {"topic", "names", "first name"}
