"""Token alignment, phrases and main texts, against plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from screenloom.llm import align, phrases
from screenloom.llm.queries import op11_token_alignment


def tokens_of(text):
    """(ids of A, of B, their bytes) by the libraries on the whole text, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return None
    if not hasattr(tokens_of, "a"):
        tokens_of.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        tokens_of.a.encode_special_tokens = True
        tokens_of.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        tokens_of.byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    a, b = tokens_of.a.encode(" " + text, add_special_tokens=False).ids, tokens_of.b.encode(text)
    a_bytes = [bytes(tokens_of.byte[c] for c in tokens_of.a.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if tokens_of.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, tokens_of.b.id_to_piece(i)) for i in b)]
    full = (" " + text).encode()
    return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == full and b"".join(b_bytes) == full else None


def aligned(texts):
    """The rows of op11 by loops over bytes."""
    made, counts = [], Counter()
    for text in texts:
        found = tokens_of(text)
        if found is None:
            made.append(None)
            continue
        a, b, a_bytes, b_bytes = found
        owner = [[i for i, t in enumerate(x) for _ in t] for x in (a_bytes, b_bytes)]
        links = sorted(set(zip(*owner, strict=True)))
        ends = [[sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (a_bytes, b_bytes)]
        both, groups, last = sorted(set(ends[0]) & set(ends[1])), [], 0
        for end in both:
            pick = lambda ids, own, lo=last, hi=end: ",".join(str(i) for i, e in zip(ids, own, strict=True) if lo < e <= hi)
            groups.append(f"{pick(a, ends[0])}|{pick(b, ends[1])}")
            last = end
        made.append((a, b, links, groups))
        counts.update((a[i], b[j]) for i, j in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for one in made:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = one
        own = [counts[a[i], b[j]] for i, j in links]
        best = sum(n == most[b[j]] for n, (_, j) in zip(own, links, strict=True))
        out.append((len(a), len(b), len(groups), len(links), best, sum(own), ";".join(groups)))
    return out


@pytest.fixture(scope="module")
def odd_texts(texts):
    rng = random.Random(3)
    bits = ["a", "b", "é", "  ", " ", "\n", "\t", "’s", "'s", "the", " ", " ", "　", " ", "ü", "中文", "!", "...", "12", "\x1c", "\x85", "🙂", "<s>", "<0x0A>", "<|endoftext|>", "_"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    return [*texts, *made, *made[:5], " ", "\n", "  x", "x  ", "x ", "a ▁ b", "z" * 3000, "word " * 2000]


def test_alignment_agrees_with_loops(spark, odd_texts):
    rows = [(i, t, 1, b"x") for i, t in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, keys binary")
    for docs_, chunk in ((docs.repartition(3), 1 << 12), (docs.coalesce(1), 1 << 22)):
        got = {r["doc_id"]: tuple(r)[1:] for r in align.align(docs_, chunk_bytes=chunk).collect()}
        assert [got[i] for i in range(len(odd_texts))] == aligned(odd_texts)


def test_alignment_of_null_repeated_and_text_keys(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), ("k", "a b"), ("k", None)], "doc_id string, text string")
    out = sorted((str(r["doc_id"]), r["n_a"], r["count_sum"]) for r in align.align(docs).collect())
    assert out == [("None", 2, 6), ("None", 2, 6), ("k", 0, 0), ("k", 2, 6)]
    assert align.align(docs.limit(0)).count() == 0


def test_alignment_query(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_token_alignment(spark, str(tmp_path)).collect()}
    want = [(*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[0] else "") for row in aligned(texts)]
    assert [got[i] for i in range(len(texts))] == want


def collocations(rows, least, share):
    """lang, phrase, a, l, r, n, score by loops; rows of (lang, text)."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, ".")
        for piece in low.split("."):
            words = tuple(w for w in piece.replace("\t", " ").split(" ") if w)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][words[i : i + k]] += 1
    out = []
    for lang, f in counts.items():
        kept = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        for g, a in kept.items():
            if any(100 * b >= share * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in kept.items() if len(h) > len(g)):
                continue
            score, _, left, right = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            out.append((lang, " ".join(g), a, left, right, n[lang], score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    words = ["New", "york", "City", "the", "of", "é", "x;", "in\tthe", "a.", "b\n", "of the", "UND"]
    rows = [(rng.choice(["en", "en", "fr", "und", None]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return [*rows, ("en", "of the hot line " * 400), ("en", None), ("en", ""), (None, "the city of new york " * 3), *[("de", "ein satz der sich wiederholt")] * 7, ("", "a b " * 9)]


@pytest.mark.parametrize("least,share,chunk", [(5, 80, 300), (2, 60, 1 << 22), (5, 100, 4000)])
def test_phrases_agree_with_loops(spark, least, share, chunk):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = phrases.mine(docs, least=least, share=share, chunk_bytes=chunk)
    assert sorted(map(tuple, got.collect())) == collocations(rows, least, share)


def test_phrase_ranks_and_nothing(spark):
    rows = phrase_rows()
    found = phrases.mine(spark.createDataFrame(rows, "lang string, text string"), least=3)
    want = defaultdict(list)
    for row in collocations(rows, 3, 80):
        want[row[0]].append(row)
    want = sorted((k, i, row[1]) for k, v in want.items() for i, row in enumerate(sorted(v, key=lambda r: (-r[6], -r[2], r[1].encode()))[:7], 1))
    assert sorted((r["lang"], r["rank"], r["phrase"]) for r in phrases.ranked(found, 7).collect()) == want
    assert phrases.mine(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None), ("en", " . ")], "lang string, text string")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    row = spark.createDataFrame([(big, [big + 1], [big + 3])], "a long, pre array<long>, suf array<long>").select(phrases.weakest(2).alias("c")).first()["c"]
    assert (row["score"], row["l"], row["r"]) == (2_000_000 * big // (2 * big + 4), big + 1, big + 3)
