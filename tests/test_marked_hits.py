"""Places of hits, marked in one pass, and names before years."""

import random
import re
import time

from pyspark.sql import functions as F

from screenloom.functions import spans
from screenloom.operators import citations


def test_hits_of_texts_with_the_mark(spark):
    dice = random.Random(9)
    texts = [spans.MARK, "X", f"{spans.MARK}X{spans.MARK}", f"X{spans.MARK}{spans.MARK}Xa"] + ["".join(dice.choice(f"aX$\\{spans.MARK}😀") for _ in range(dice.randint(0, 30))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for pattern in ("X+a?", f"X|{spans.MARK}", f"{spans.MARK}X"):
        got = {r.i: [(h.start, h.end, h.hit) for h in r.hits] for r in df.select("i", spans.find(F.col("t"), pattern).alias("hits")).collect()}
        assert got == {i: [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, t)] for i, t in enumerate(texts)}


def test_a_pattern_is_not_compiled_for_each_text(spark):
    """Splitting by a pattern compiles it anew for each text, which was most of the time of short texts."""
    pattern = "X(?:" + "|".join(f"w{i:05d}" for i in range(3000)) + ")?"
    df = spark.range(0, 4000, 1, 1).select(F.concat(F.lit("ab X "), F.col("id")).alias("t")).cache()
    df.count()

    def seconds(c):
        began = time.perf_counter()
        df.select(c).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    each = seconds(F.size(F.split("t", pattern)))
    assert seconds(F.size(spans.find(F.col("t"), pattern))) < each / 2


def test_names_are_those_of_the_plain_pattern(spark):
    """Looking at a name's first letters first leaves out none of the hits."""
    particle = r"(?:van\s+der\s+|van\s+|von\s+|de\s+la\s+|de\s+|da\s+|del\s+|den\s+|der\s+|du\s+|le\s+|la\s+|el\s+|al\s+)?"
    plain = rf"(?:{particle}[A-ZÀ-ɏ][\w{citations.LETTERS}]{{2,}})"
    dice = random.Random(4)
    bits = ["van", "der", "von", "de", "la", "da", "del", "den", "du", "le", "el", "al", "Holm", "Ärzte", "Ab", "O'Neil", "xHolm", "and", "&", "et al.", ",", "(1999)", "1999", "(2001, Study 2)", "20011", "'s", "  ", " ", "\n"]
    texts = ["".join(dice.choice(bits) + dice.choice(["", " ", " ", " "]) for _ in range(dice.randint(1, 25))) for _ in range(1500)]
    name = lambda: dice.choice(["", "", "van der ", "de la ", "von\n", "al ", "vand ", "dea "]) + dice.choice(["Holm", "Ärzte", "Ab", "xHolm", "Zwei"])
    joined = [", ", ",  ", ", and ", " and ", " & ", " et al. ", " et al ", " (1999)", "'s (2001, Study 2)", " 2004", ", 20011", " "]
    texts += ["".join(name() + dice.choice(joined) for _ in range(dice.randint(1, 12))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for form in citations.FORMS:
        before = spans.UNICODE + form.pattern.replace(citations.NAME, plain)
        assert before != form.java
        both = df.select(F.regexp_extract_all("t", F.lit(before), F.lit(0)).alias("a"), F.regexp_extract_all("t", F.lit(form.java), F.lit(0)).alias("b"))
        both = both.where("size(a) > 0 OR size(b) > 0").cache()
        assert both.where("NOT (a <=> b)").isEmpty() and not both.isEmpty()
