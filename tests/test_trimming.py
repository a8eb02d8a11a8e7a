"""Trimming at scale: by characters, not by a pattern tried at each place."""

import re

from pyspark.sql import functions as F

from screenloom.functions import documents
from screenloom.functions import text as T


def test_trimmed_texts_are_those_of_the_pattern(spark):
    texts = [None, "", " ", "\t\n\x0b\f\r ", "a", " a b\n", "　a​ ", "\x1ca\x1f", "\x85\xa0é ", "᠎a﻿", *[f"{chr(c)}x{chr(c)}" for c in range(1, 0x3100)], *[chr(c) * 3 for c in range(1, 0x3100)]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.trim_all(F.col("t")).alias("trimmed"), T.is_blank(F.col("t")).alias("blank")).collect()
    pattern = re.compile("\\A[{0}]+|[{0}]+\\Z".format("\\t\\n\\x0b\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"))
    want = {i: None if t is None else pattern.sub("", t) for i, t in enumerate(texts)}
    assert {r.i: r.trimmed for r in rows} == want
    assert {r.i: r.blank for r in rows} == {i: not w for i, w in want.items()}


def test_a_text_made_of_others_is_made_once(spark):
    text = F.concat(F.lit("Discussion\n"), F.expr("repeat('nothing ', 60)"), F.lit("\nReferences\n"), F.md5("t"))
    plan = spark.createDataFrame([("a",)], "t string").select(documents.outcome_text(text, 2000).alias("o"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
