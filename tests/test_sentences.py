"""Sentences are cut where they were when each letter was tried as an abbreviation's first."""

import random

from pyspark.sql import functions as F

from screenloom.functions import text as T


def test_sentences_are_those_of_the_former_patterns(spark):
    rng = random.Random(3)
    parts = ["et al.", "e.g.", "e. g.", "I.E. ", "vs.", "Dr.", "xDr.", "éDr.", "_a.", "A.", "AB.", "9b.", "b.", ".", "!", "?", " ", "  ", "\n", "\t ", "word", "No. ", "no", "...", "\u0001", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    former = r"(?i)(?<![\p{L}\p{N}_])(et al|e\.g|i\.e|vs|Dr|Mr|Mrs|Ms|Prof|Fig|No|Vol|pp|cf|[A-Z])\."
    masked = F.regexp_replace("t", former, "$1\u0001")
    was = F.filter(F.transform(F.split(T.trim_all(masked), r"(?<=[.!?])\s+"), lambda s: F.replace(s, F.lit("\u0001"), F.lit("."))), lambda s: F.trim(s) != "")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.sentences(F.col("t")).alias("now"), was.alias("was")).collect()
    assert [(r.t, r.now) for r in rows] == [(r.t, r.was) for r in rows]


def test_points_are_looked_for_before_letters():
    # a pattern that begins with a letter's class is tried at every letter
    assert T.ABBREVIATIONS.removeprefix("(?i)").startswith(r"\.")
