"""The rule language: golden routing, loading errors and patterns."""

import json
import re

import pytest

from screenloom.functions.regex import UnsupportedPattern, needed, to_java
from screenloom.plans import rules as R
from tests_data import CONTENTS, MATCHES, RESULT, SCHEMA, WORKS

def test_routing(spark):
    pool, rules = spark.createDataFrame(WORKS, SCHEMA), R.load(CONTENTS)
    rows = {r.work_id: r for r in R.route(pool, rules).collect()}
    assert {k: (r.pile, r.rule_id, r.pending_reason) for k, r in rows.items()} == RESULT
    assert rows[102].matched == ["watch-slugs"] and rows[102].live == [] and rows[105].matched == ["no-talks", "watch-slugs", "skim-sown"] and rows[105].live == ["no-talks", "skim-sown"]
    assert rows[104].evidence == "SOWN AGAIN" and rows[105].evidence == "fields"
    assert R.evaluations(R.route(pool, rules)).count() == MATCHES and R.route(pool, rules).columns[: len(pool.columns)] == pool.columns
    exempt = R.route(pool, rules, exempt=pool["work_id"] == 103).where("work_id = 103").first()
    assert exempt.pile == "screen_cheap"
    assert R.route(pool.limit(0), rules).count() == 0 and {r.pile for r in R.route(pool, []).collect()} == {"pending"}


def test_two_bundles_in_one_pass(spark):
    pool = spark.createDataFrame(WORKS, SCHEMA)
    other = [c | ({"match": {"text_regex": "beans"}} if c["id"] == "skim-topic" else {"precedence": 99} if c["id"] == "skim-sown" else {}) for c in CONTENTS[1:]]
    got = {r.work_id: (r.pile_a, r.rule_a, r.pile_b, r.rule_b) for r in R.route_two(pool, R.load(CONTENTS), R.load(other)).collect()}
    one, two = ({r.work_id: (r.pile, r.rule_id) for r in R.route(pool, R.load(c)).collect()} for c in (CONTENTS, other))
    assert got == {k: (*one[k], *two[k]) for k in one} and one != two


def test_absent_columns_and_nor(spark):
    pool = spark.createDataFrame(WORKS, SCHEMA)
    rule = R.load([{"id": "x", "pile": "screen_cheap", "precedence": 1, "match": {"none_of": [{"fields": {"type": ["poster"]}}, {"doi_regex": "4242"}]}}])
    assert {r.work_id for r in R.match_flags(pool, rule, R.Pool()).where("size(matched) > 0").collect()} == {102, 103, 104, 106, 107, 108}
    rule = R.load([{"id": "x", "pile": "screen_cheap", "precedence": 1, "match": {"fields": {"publication_year": [1991]}}}])
    assert R.match_flags(pool, rule, R.Pool()).where("size(matched) > 0").count() == 2
    assert R.match_flags(pool, rule, R.Pool(publication_year=None)).where("size(matched) > 0").count() == 0


def test_prefilters(spark):
    """Every text that a pattern matches has a literal it needs, and matches the pattern loosened before it is normalised."""
    from pyspark.sql import functions as F

    from screenloom.functions import text as T

    assert needed(r"\bop\.\s+cit\b") == ["op."] and needed("[a-z]+@[a-z]") == ["@"] and needed("a|b?") is None and needed("(?:one|two)") == ["one", "two"] and needed("abc*d") == ["ab"] and needed(r"\d{3}") is None
    arms = [r for r in R.load(CONTENTS) if r.id in ("read-twice-sown", "skim-sown", "skim-recount")]
    loose = R.fused_prefilter(arms)
    assert R.fused_prefilter(R.load(CONTENTS)) is None
    rows = spark.createDataFrame([("seeds sown\u2003again",), ("counted from the same\u00a0notes",), ("neither",), ("\u017fown again",)], "t string")
    got = rows.select(T.matches(F.col("t"), loose).alias("loose"), T.matches(F.col("t"), "sown again").alias("exact")).collect()
    assert [(r.loose, r.exact) for r in got] == [(True, False), (True, False), (False, False), (True, True)]


def test_every_error_is_reported():
    bad = [
        {"id": "a", "pile": "nowhere", "precedence": "1", "match": {}}, {"id": "a", "pile": "discard", "precedence": 1, "vocabulary": "replication", "match": {"text_regex": r"(?P<x>a)", "odd": 1}},
        {"pile": "discard", "precedence": 1, "match": {"any_of": [{"fields": {"colour": []}}]}, "domain": {"abstract_missing": "no"}, "measured": [{"set": "x"}]},
    ]
    with pytest.raises(R.RuleErrors) as e:
        R.load(bad)
    for part in ("pile 'nowhere'", "precedence", "match is empty", "used twice", "no vocabulary", "group", "unknown condition odd", "abstract_missing false", "no id", "unknown field colour", "not a boolean", "measured"):
        assert part in str(e.value)


def test_digests(tmp_path):
    for c in CONTENTS:
        (tmp_path / f"{c['id']}.json").write_text(json.dumps(dict(reversed(c.items()))))
    assert R.bundle_digest(R.load_folder(str(tmp_path))) == R.bundle_digest(R.load(CONTENTS)) != R.bundle_digest(R.load(CONTENTS[1:]))


@pytest.mark.parametrize("pattern,yes,no", [
    ("réplicat", ["RÉPLICAT"], ["replicat"]), ("k", ["K"], []), ("b$", ["ab"], ["ab\n", "ab\r"]), (r"é\b", ["caféx"], ["é"]), (r"t\b", ["été", "t"], ["tx"]), ("a.b", ["a\u0085b", "a b"], ["a\nb"]),
    (r"\s", ["\t", " "], ["\x0b", " "]), (r"\w", ["a"], ["é"]), (r"[\s,]x", [",x", "\nx"], ["\x0bx"]), (r"[]a]", ["]"], ["b"]), (r"[[]", ["["], ["a"]), (r"\$\.", ["$."], ["$x"]), (r"\S", ["\x0b"], [" "]), ("(?:a|b)+c", ["abc"], ["c"]),
])
def test_patterns_match_like_re2(spark, pattern, yes, no):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(t,) for t in [*yes, *no]], "t string").select("t", F.col("t").rlike(to_java(pattern)).alias("m")).collect()
    assert {r.t: r.m for r in rows} == {t: t in yes for t in [*yes, *no]}


@pytest.mark.parametrize("pattern", [r"\C", r"\pN", "(?P<a>b)", "(?=a)", r"(a)\1", "[[:alpha:]]", "[a", "a\\"])
def test_patterns_refused(pattern):
    with pytest.raises(UnsupportedPattern):
        to_java(pattern)


def test_generated_patterns_agree_with_re2(spark):
    """Random patterns and texts against DuckDB's RE2."""
    import random

    import duckdb
    from pyspark.sql import functions as F

    rng = random.Random(9)
    atoms = ["a", "b", ".", r"\b", r"\s", r"\w", "é", "$", "^", "[ab]", "[^a]", r"\d", "(?:a|é)", "K"]
    patterns = ["".join(rng.choice(atoms) + rng.choice(["", "", "*", "?"]) if (x := rng.choice(atoms)) is None else x + (rng.choice(["", "", "+", "?"]) if x not in ("$", "^", r"\b") else "") for _ in range(rng.randint(1, 4))) for _ in range(40)]
    texts = ["".join(rng.choice("abAK éÉ\n\t\r1\u0085K\x0b") for _ in range(rng.randint(0, 5))) for _ in range(120)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select(*[F.col("t").rlike(to_java(p)).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    con = duckdb.connect()
    for i, p in enumerate(patterns):
        want = [con.execute("SELECT regexp_matches(?, ?)", [t, "(?i)" + p]).fetchone()[0] for t in texts]
        assert [r[i] for r in got] == want, p
        literals = needed(p)
        assert literals is None or all(any(x in t.lower().replace("\u017f", "s") for x in literals) for t, m in zip(texts, want, strict=True) if m), p
    assert re  # patterns above are RE2's, not Python's
