"""The operators on documents against brute force on small texts."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest

from screenloom.llm import bpe, exchange, jaccard, ngram_lm, repetition, ring, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture
def empty(docs):
    return docs.limit(0)


def test_repetition(docs, empty):
    def repeated(w, n):
        starts = defaultdict(list)
        for p in range(len(w) - n + 1):
            starts[tuple(w[p : p + n])].append(p)
        return {q for ps in starts.values() if len(ps) > 1 for p in ps for q in range(p, p + n)}

    def longest_repeat(w):
        """By the table of common prefixes of all pairs of places."""
        best, below = 0, [0] * (len(w) + 1)
        for p in reversed(range(len(w))):
            below = [(below[q + 1] + 1 if w[p] == w[q] and p != q else 0) for q in range(len(w))] + [0]
            best = max(best, *below)
        return best

    # the key is the text's place, so that rows without an identifier are compared as well
    texts = [r.text for r in docs.collect()]
    keyed = docs.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repetition.rate_repetition(keyed).collect()}
    assert len(got) == len(texts)
    for k, r in got.items():
        w, t = words(texts[k]), texts[k] or ""
        lines = [x for x in t.split("\n") if words(x)]
        longest = longest_repeat(w) if w else 0
        five, ten = len(repeated(w, 5)), len(repeated(w, repetition.REPEAT))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered_words, r.longest_repeat) == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), five, ten, longest)
        failed = len(w) < 10 or 100 * five > 20 * len(w)
        assert r.base_failed == failed and r.kept == (not failed and 100 * ten <= repetition.COVERED * len(w) and longest <= repetition.LONGEST)
    assert repetition.rate_repetition(docs).count() == docs.count() and repetition.rate_repetition(docs).where("doc_id IS NULL").count() == 2
    assert repetition.rate_repetition(empty).count() == 0


def test_repetition_of_long_texts():
    """Texts that repeat throughout, and one without repeats: what is known of them."""
    import pyarrow as pa

    n = 300_000
    found = repetition.measures(pa.array(["z " * n, "a b c " * n, " ".join(f"w{i}" for i in range(n)), " ".join(["x y", *(f"w{i}" for i in range(n)), "x y"])]))
    assert found["longest_repeat"].tolist() == [n - 1, 3 * n - 3, 0, 2] and found["n_covered_words"].tolist() == [n, 3 * n, 0, 0]


@pytest.mark.parametrize("chunk_bytes,order", [(600, 3), (1 << 20, 3), (600, 2), (600, 4), (1 << 20, 1)])
def test_language_model(docs, empty, texts, chunk_bytes, order):
    from pyspark.sql import functions as F

    # rows without an identifier are learnt from and scored as others, each known by its text here
    marked = docs.withColumn("train", F.col("row") % 3 != 0).withColumn("doc_id", F.coalesce("doc_id", -F.octet_length("text")))
    assert ngram_lm.score_texts(docs.withColumn("train", F.lit(True)), order=order, chunk_bytes=chunk_bytes).where("doc_id IS NULL").count() == 2
    rows = {r.doc_id: (r.train, [*words((r.text or "").translate(LOWER)), ""]) for r in marked.collect()}
    counts = Counter()
    for train, w in rows.values():
        if train:
            counts.update(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    uni = {k[0]: c for k, c in counts.items() if len(k) == 1}
    total, types, prior = sum(uni.values()), len(uni), ngram_lm.PRIOR
    q = lambda w: (uni.get(w, 0) + 1) / (total + types + 1)

    def p(history, w):
        if not history:
            return q(w)
        seen, below = counts[history], p(history[1:], w)
        return below if seen < (1 if len(history) == 1 else ngram_lm.LEAST) else (counts[*history, w] + prior * below) / (seen + prior)

    for h in [k for k in counts if len(k) == order - 1 and k[-1]][:5]:  # the weights from a state sum to one, with the unknown word
        assert math.isclose(sum(p(h, w) for w in uni) + p(h, "never seen"), 1, rel_tol=1e-9)
    got = ngram_lm.score_texts(marked, order=order, chunk_bytes=chunk_bytes).collect()
    assert len(got) == len(rows)
    for r in got:
        train, w = rows[r.doc_id]
        assert (r.train, r.n_tokens, r.n_known, r.train_tokens) == (train, len(w), sum(x in uni for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10(q(x)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(tuple(w[max(0, i - order + 1) : i]), v)) for i, v in enumerate(w)), rel_tol=1e-9)
    assert ngram_lm.score_texts(marked.limit(0), order=order).count() == 0
    assert ngram_lm.score_texts(marked.withColumn("train", F.lit(None).cast("boolean")), order=order).where("n_known > 0").count() == 0


@pytest.mark.parametrize("chunk_bytes", [600, 1 << 20])
def test_jaccard(docs, texts, chunk_bytes, empty):
    sets = {}
    for i, t in enumerate(texts):
        w = words((t or "").translate(LOWER))
        sets[i * 3 + 1] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    group = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    repeated = docs.unionByName(docs.where("row < 5"))
    got = jaccard.link_documents(repeated, chunk_bytes=chunk_bytes).collect()
    assert len(got) == repeated.count()
    for r in got:
        assert (r.component_id if r.doc_id is None else (r.n_shingles, r.component_id)) == (None if r.doc_id is None else (len(sets[r.doc_id]), group[r.doc_id]))
    assert sum(i != g for i, g in group.items()) > 15
    assert jaccard.link_documents(empty).count() == 0


def test_many_equal_rows(spark):
    """Rows that would outgrow a chunk together, equal ones and ones that differ in their key, give the results of rows each by itself."""
    from pyspark.sql import functions as F

    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, passage, True)] * 300 + [(i, passage, i % 2 == 0) for i in range(200)] + [(1000 + i, f"own{i} words {passage} end", True) for i in range(5)] + [(None, "", False)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    size, dealt = exchange.deal(docs, "text", 2000)
    assert size.folded and dealt.agg(F.sum(f"row.{exchange.COPIES}")).first()[0] == len(rows) and dealt.count() < len(rows) - 250
    weights = [r.n for r in dealt.groupBy("chunk").agg(F.sum(F.octet_length("row.text")).alias("n")).collect()]
    assert max(weights) < 15_000  # of 50,000 bytes that are equal
    assert exchange.unfold(dealt.select("row.*"), size).exceptAll(docs).count() == 0 and exchange.unfold(dealt.select("row.*"), size).count() == len(rows)
    one, two = (ngram_lm.score_texts(docs, chunk_bytes=b).select("doc_id", "train", F.round("score", 9).alias("s"), "train_tokens").collect() for b in (2000, 1 << 22))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.train, r.s, r.train_tokens)
    assert sorted(map(key, one)) == sorted(map(key, two)) and len(one) == len(rows)
    groups = jaccard.link_documents(docs, chunk_bytes=2000).collect()
    assert len(groups) == len(rows) and {r.component_id for r in groups if r.doc_id is not None and r.doc_id < 200} == {0}
    left = substrings.remove_repeats(docs, chunk_bytes=2000).collect()
    assert len(left) == len(rows) and sum(r.n_removed == 0 and r.n_words == 30 for r in left) == 1 and all(r.n_removed == 30 for r in left if r.doc_id is None and r.n_words)


def test_templates_just_below_the_threshold(spark):
    """Texts with much in common that link with nobody make no pairs, so that time grows with their number."""
    base = " ".join(f"t{i}" for i in range(100))
    docs = spark.createDataFrame([(i, base + " " + " ".join(f"u{i}x{j}" for j in range(22))) for i in range(2000)], "doc_id long, text string")
    made = []
    whole = jaccard.multiply_columns

    def look(entries, percent):
        t = entries.withColumns({c: entries["token"] * 0 for c in ("strip", "strip_a", "strip_b")}).toArrow()
        made.append((len(t), len(whole(t, percent))))
        return entries.selectExpr("id AS a", "id AS b").limit(0)

    kept, jaccard.candidate_pairs = jaccard.candidate_pairs, look
    try:
        assert jaccard.link_documents(docs).where("component_id <> doc_id").count() == 0
    finally:
        jaccard.candidate_pairs = kept
    assert len(made) == 1 and 2000 * 8 <= made[0][0] < 2000 * 9 and made[0][1] == 0
    assert jaccard.link_documents(docs).where("component_id <> doc_id").count() == 0


def test_column_strips_and_bounds(spark, monkeypatch):
    """Columns cut in strips, and blocks of few entries, find the same links."""
    rng = random.Random(21)
    words_ = [f"w{i}" for i in range(60)]
    base, rows = [rng.choice(words_) for _ in range(60)], []
    for i in range(160):
        w = base[:]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(words_) + str(rng.randint(0, 3))
        rows.append((i, " ".join(w[: rng.randint(40, 60)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()}
    monkeypatch.setattr(jaccard, "STRIP", 7)
    monkeypatch.setattr(jaccard, "ENTRIES", 50)
    monkeypatch.setattr(jaccard, "AT_ONCE", 16)
    assert {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()} == plain
    sets = {i: {tuple(t.split()[p : p + 5]) for p in range(len(t.split()) - 4)} for i, t in rows}
    group = {i: i for i in sets}
    for _ in range(8):
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    assert plain == group and len(set(group.values())) > 20


def test_sketch():
    """Never an undercount; few windows that occur once are estimated repeated; sketches of parts add up."""
    import numpy as np

    rng = np.random.default_rng(4)
    first = rng.integers(0, 2**63, 40_000).astype(np.uint64)
    first[:5000] = first[5000:10_000]
    bits = substrings.width_bits(40_000 * substrings.WORD_BYTES)
    cells = substrings.sketch_cells(first, bits).reshape(substrings.DEPTH, -1)
    counts = np.bincount(cells.reshape(-1).astype(np.int64), minlength=substrings.DEPTH << bits)
    estimate = counts[cells.astype(np.int64)].min(0)
    true = np.unique(first, return_counts=True)
    exact = dict(zip(*map(np.ndarray.tolist, true)))
    assert all(e >= exact[f] for e, f in zip(estimate.tolist(), first.tolist()))
    once = np.array([exact[f] == 1 for f in first.tolist()])
    assert 0 < (estimate[once] > 1).mean() < 1.2 * substrings.ERROR


def test_chain_of_links(spark):
    """Each text is near the next only: one component, found over several rounds."""
    base = [f"a{i}" for i in range(400)]
    rows = []
    for k in range(40):
        base = base[:]
        for p in range(7):
            base[(k * 10 + p * 57) % 400] = f"b{k}x{p}"
        rows.append((100 - k, " ".join(base)))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {61}
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    found = {r.id: r.component for r in jaccard.components(links).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}


@pytest.mark.parametrize("chunk_bytes", [600, 1 << 20])
def test_substrings(docs, texts, chunk_bytes, empty):
    first = {}
    source = {i * 3 + 1: words(t) for i, t in enumerate(texts)}
    for i in sorted(source):
        for p in range(len(source[i]) - 12):
            first.setdefault(tuple(source[i][p : p + 13]), i)
    got = substrings.remove_repeats(docs, chunk_bytes=chunk_bytes)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    removed = 0
    for r in got.where("doc_id IS NOT NULL").collect():
        w = source[r.doc_id]
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < r.doc_id for q in range(p, p + 13)}
        removed += len(gone)
        assert (r.n_words, r.n_removed, words(r.text)) == (len(w), len(gone), [x for q, x in enumerate(w) if q not in gone])
        if not gone:
            assert r.text == texts[(r.doc_id - 1) // 3]
    assert removed > 100
    nulls = got.where("doc_id IS NULL").collect()
    assert len(nulls) == 2 and any(r.n_removed > 0 for r in nulls)
    assert substrings.remove_repeats(empty).count() == 0


def test_ring(spark, docs, empty):
    rows = [(i, "t" * (i % 9)) for i in range(3000)] + [(7, "same")] * 900 + [(None, None)] * 3
    got = ring.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=16).collect()
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 16
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert all(r.text_crc32 == zlib.crc32(("same" if r.doc_id == 7 and r.size == 5 else "t" * (r.size - 1)).encode()) for r in got)
    # every key is at its own point's shard or that shard is full
    from pyspark.sql import functions as F

    at = ring.ring(16, ring.POINTS)
    places, full = [p for p, _ in at], {s for s in counts if counts[s] == max(counts.values()) or len(rows) % 16 == 0 or counts[s] == min(counts.values())}
    keys = spark.createDataFrame([(i,) for i in range(3000)], "doc_id long").select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("ring")), F.lit(ring.TOP)).alias("h"))
    home = {r.doc_id: at[bisect_left(places, r.h) % len(at)][1] for r in keys.collect()}
    loads = Counter(home[r.doc_id] if r.doc_id is not None else -1 for r in got)
    away = [r for r in got if r.doc_id is not None and r.doc_id != 7 and r.shard != home[r.doc_id]]
    assert all(loads[home[r.doc_id]] > counts[home[r.doc_id]] - 5 for r in away) and len(full) == 16
    assert len(away) <= sum(max(0, n - len(rows) // 16) for n in loads.values()) + len(counts)  # no more than overflow
    assert len(at) == 16 * ring.POINTS and [p for p, s in at if s < 8] == [p for p, _ in ring.ring(8, ring.POINTS)]
    assert ring.shard_documents(empty).count() == 0
    # one more shard moves few rows beyond those it takes
    more = {r.doc_id: r.shard for r in ring.shard_documents(spark.createDataFrame(rows[:3000], "doc_id long, text string"), shards=17).collect()}
    few = {r.doc_id: r.shard for r in ring.shard_documents(spark.createDataFrame(rows[:3000], "doc_id long, text string"), shards=16).collect()}
    home17 = [p for p, _ in ring.ring(17, ring.POINTS)]
    own = ring.ring(17, ring.POINTS)
    hashes = {r.doc_id: r.h for r in keys.collect()}
    after = {k: own[bisect_left(home17, h) % len(own)][1] for k, h in hashes.items()}
    overflow = sum(few[k] != home[k] for k in few) + sum(more[k] != after[k] for k in few)
    # what moves is what the new shard takes and what overflows before or after
    assert sum(more[k] != few[k] for k in few) <= sum(after[k] == 16 for k in few) + overflow
    assert sum(more[k] != few[k] for k in few) < 0.25 * len(few)


def test_deal_loads():
    dealt = ring.deal_loads([0, 1, 2, 0, 1, 2], [10, 0, 0, 5, 1, 2], [6, 6, 6])
    assert [sum(k for s, k in parts) for parts in dealt] == [10, 0, 0, 5, 1, 2]
    assert Counter({s: sum(k for p in dealt for t, k in p if t == s) for s in range(3)}) == Counter({0: 6, 1: 6, 2: 6})
    assert dealt[0][0] == (0, 6) and dealt[3][0][0] == 1  # beyond a full shard, clockwise


def test_bpe(spark, docs, texts, empty):
    import numpy as np
    import public_tokenizers

    encode = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    long = ["word. " * 30000 + "  \n\n x" * 4000 + "don't" * 9000, "x" * 200_000 + " y", "　 a" * 40000, " " * 70_000 + "é"]
    rows = spark.createDataFrame([*docs.select("doc_id", "text").collect(), *[(9000 + i, t) for i, t in enumerate(long)]], "doc_id long, text string")
    for r in bpe.decode(bpe.encode(rows)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == encode.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")
    assert {(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in bpe.round_trip(rows).collect()} == {(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(bpe.encode(rows)).collect()}
    assert bpe.encode(empty).count() == bpe.round_trip(empty).count() == 0


def test_packing():
    import numpy as np

    for v in ([], [0], [5, 5, 5], [1, 2**40, 2**63 + 5]):
        a = np.array(v, np.uint64)
        assert exchange.unpack(exchange.pack(a)).tolist() == v and exchange.unpack_sorted(exchange.pack_sorted(a)).tolist() == v


def test_digests(spark, docs, monkeypatch, tmp_path):
    """The registered queries' digest columns."""
    from screenloom.llm import queries

    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id IS NOT NULL").collect()}
    for r in queries.op4_bpe(spark, str(tmp_path)).where("doc_id IS NOT NULL").collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    for r in queries.op10_substring_dedup(spark, str(tmp_path)).where("doc_id IS NOT NULL AND n_removed = 0").collect():
        assert r.kept_sha256 == hashlib.sha256(" ".join(words(texts[r.doc_id])).encode()).hexdigest()
    held = {r.doc_id: r.held_out for r in queries.op2_lm_scoring(spark, str(tmp_path)).where("doc_id IS NOT NULL").collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 7 == 2) for i, h in held.items())


def test_leaks_among_common_phrases():
    """A phrase every twenty words, in all items and in a long text, brings no candidates; leaks are found as ever, and so are items of one template."""
    import numpy as np
    import pyarrow as pa
    from screenloom.llm import decontam as D

    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]

    def text(n):
        return " ".join(w for i in range(n) for w in (["according", "to", "the"] if i % 20 == 7 else []) + [rng.choice(vocabulary)])

    items = [(i, text(30)) for i in range(300)] + [(1000 + i, f"what is the capital of the country that is named {vocabulary[i]} and how many people live in it now") for i in range(200)]
    index = D.build(items)
    words = D.split(pa.array([text(60_000), "a a a a " * 5000]))
    found = D.candidates(words, D.symbols(words), index)
    assert len(found) < 2000

    def edited(s, percent):
        s = list(s)
        for _ in range(len(s) * percent // 100):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice([[rng.choice("abcdefgh")], [], [s[i], rng.choice("abcdefgh")]])
        return "".join(s)

    for percent in (0, 5, 10):
        hits = 0
        for _ in range(40):
            item, plain = items[rng.randrange(len(items))]
            words = D.split(pa.array([f"{text(100)} {edited(plain, percent)} {text(100)}"]))
            hits += item in {m[1] if m[1] < 300 else m[1] + 700 for m in D.matches(words, D.symbols(words), index, D.PERCENT)}
        assert hits >= 38, percent
    # blocks of items list the same pairs as all at once
    words = D.split(pa.array([f"{text(50)} {items[i][1]} {text(50)}" for i in range(5)]))
    whole = D.near(words, index.grams)
    before, D.PAIRS = D.PAIRS, 10
    try:
        parts = D.near(words, index.grams)
    finally:
        D.PAIRS = before
    assert np.array_equal(np.unique(whole, axis=0), np.unique(parts, axis=0)) and len(whole)
