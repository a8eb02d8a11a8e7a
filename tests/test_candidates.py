"""Hits of a title search, groups by either key, axes folded and texts joined in order."""

import random

from pyspark.sql import functions as F

from screenloom.operators import candidates, folds


def test_groups_by_either_key(spark):
    dice = random.Random(12)
    rows = [(i, dice.randrange(3), dice.choice(["", None, *(f"d{k}" for k in range(60))]), dice.choice([None, "", *(f"i{k}" for k in range(60))])) for i in range(240)]
    rows += [(1000 + i, 9, f"d{i // 2}", f"i{(i + 1) // 2}") for i in range(64)]  # a chain
    rows += [(2000 + i, 8, "hot", None) for i in range(300)]
    got = {r.n: r.group for r in candidates.same_by_either(spark.createDataFrame(rows, "n long, w int, doi string, ident string"), ["w"], ["doi", "ident"], "n").collect()}
    label = {r[0]: r[0] for r in rows}
    while True:
        new = dict(label)
        for at in (2, 3):
            best = {}
            for r in rows:
                if r[at]:
                    best[r[1], r[at]] = min(best.get((r[1], r[at]), 1 << 60), new[r[0]])
            new = {r[0]: min(new[r[0]], best.get((r[1], r[at]), 1 << 60)) for r in rows}
        if new == label:
            break
        label = new
    assert got == label and got[1063] == 1000 and {got[2000 + i] for i in range(300)} == {2000}


def test_title_candidates(spark):
    hits = [
        (1, 0, "crossref", "https://doi.org/10.1/A", None, "A study of sleep", 2001, ["Bem, D."]), (1, 1, "openalex", "10.1/a", "W1", "A study of sleep", 2001, ["Bem"]), (1, 2, "other", None, "W1", "A study of sleep", 2001, ["Bem"]),
        (1, 1, "openalex", "", "W9", "Another thing", 1999, ["Nobody Else"]), (1, 1, "openalex", "10.1/self", "", "x", 1999, ["Bem"]), (1, 1, "openalex", "10.1/own", "", "Does sleep help memory", 1999, ["Bem"]),
        (1, 1, "openalex", "10.6084/m9.figshare.1", "", "data", 1999, ["Bem"]), (1, 1, "openalex", "10.1/front", "", "Front matter", 1999, []), (1, 1, "openalex", None, "", "no identifier", 1999, ["Bem"]),
        (1, 3, "other", "10.1037/t123-000", "W5", None, None, ["Kaufmann, A.", "bem"]), (2, 0, "crossref", "10.1/q", None, "No author cited", 2000, None), (3, 0, "crossref", "10.1/z", None, "t", 2000, None),
    ]
    works = [(1, "10.1/SELF", "Does sleep help memory?", "bem,andkauf"), (2, None, None, "")]
    out = candidates.title_candidates(spark.createDataFrame(hits, "work int, place int, source string, doi string, ident string, title string, year int, authors array<string>"), spark.createDataFrame(works, "work int, doi_r string, title_r string, surname string"))
    got = [(r.work, r.n, r.doi, r.ident, r.source, len(r.flags)) for r in out.orderBy("work", "n").collect()]
    assert got == [(1, 1, "10.1/a", "", "crossref", 0), (1, 2, "", "W9", "openalex", 1), (1, 3, "10.1037/t123-000", "W5", "other", 1), (2, 1, "10.1/q", "", "crossref", 0)]


def test_axes_and_joined_texts(spark):
    rows = [
        (1, 2, "failed", " q2 ", "abstract", "ok"), (1, 1, "cannot_be_determined", "", "x", None), (1, 3, "worked", "q1", None, ""), (1, 4, "failed", "q2", "abstract", "ok"),
        (2, 1, "", "", "", None), (2, 2, "cannot_be_determined", None, "s", None), (3, 5, "worked", "b", "s2", "r"), (3, 4, None, "a", "s1", "t"), (4, 1, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "k int, o int, axis string, quote string, source string, other string").withColumn("oq", F.lit("")).withColumn("os", F.lit(None).cast("string"))
    axes = {"axis": ("conflict", "quote", "source"), "other": ("differ", "oq", "os")}
    got = {r.k: tuple(r)[1:] for r in folds.fold_axes(df, ["k"], ["o"], axes).collect()}
    assert got == {1: ("conflict", "ok", "q2 | q1 | q2", "abstract |  | abstract", "", ""), 2: ("cannot_be_determined", "", "", "", "", ""), 3: ("worked", "differ", "a | b", "s1 | s2", "", ""), 4: ("", "", "", "", "", "")}
    once = {r.k: (r.quote, r.source) for r in folds.fold_axes(df, ["k"], ["o"], axes, once=True).collect()}
    assert once[1] == ("q2 | q1", "abstract | ")
    texts = {r.k: (r.q, r.s) for r in folds.joined_texts(df, ["k"], ["o"], {"q": F.col("quote"), "s": F.col("source")}, sep=";", once=True).collect()}
    assert texts == {1: ("q2;q1", "x;abstract"), 2: (None, "s"), 3: ("a;b", "s1;s2")}
