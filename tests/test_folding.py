"""Folding of texts at scale: the same characters as before, and plain texts left alone."""

import unicodedata

from pyspark.sql import functions as F

from screenloom.functions import text as T


def test_folded_texts_are_composed_and_plainly_spaced(spark):
    import re

    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["a b", "a  b", " a\tb ", "\n a 　 b ", "", " ", "é é", "가", "– “x” é"] + ["".join(f"x{chr(c)} " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: r.f for r in T.fold_text(rows, "t", "f").select("i", "f").collect()}
    blank = re.compile("[\\s\\x0b\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+", re.ASCII)
    assert found == {i: unicodedata.normalize("NFC", blank.sub(" ", t)) for i, t in enumerate(texts)}


def test_a_character_is_compared_with_few_spans():
    parts = T.composable()[2:-2].split("]][")
    assert len(parts) < 40 and all(p.count("-") <= 17 for p in parts)
