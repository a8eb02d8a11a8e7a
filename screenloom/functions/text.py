"""Scalar functions on identifiers, titles, authors and dates, as Column expressions."""

from __future__ import annotations

import html
import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .regex import needed, to_java

#: Trimmed by trim_all: ASCII white space and the no-break and other wide spaces.
BLANK = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: Its characters, as Java's \\s is without Unicode.
BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def either(parts: list[Column]) -> Column:
    """OR of conditions that count as false where null; of none, false."""
    return reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in parts], F.lit(False))


def every(parts: list[Column]) -> Column:
    """AND likewise; of none, true."""
    return reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in parts], F.lit(True))


def matches(value: Column, pattern: str, lower: Column | None = None) -> Column:
    """Does a pattern of the rule language match?  Where it needs a literal, only values that contain it are tried; lower: the value in lower case, if it is at hand."""
    literals = needed(pattern)
    exact = value.rlike(to_java(pattern))
    if not literals:
        return exact
    lower = F.lower(value) if lower is None else lower
    return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(x)) for x in literals]) & exact


def any_contains(df: DataFrame, text: str) -> Column:
    """Has any column of df the text, without regard to case?"""
    return either([F.contains(F.lower(F.col(f"`{c}`").cast("string")), F.lit(text.lower())) for c in df.columns])


def trim_all(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """Has it no character but those?  Told by the first other one, however long it is."""
    return ~F.coalesce(c, F.lit("")).rlike(f"[^{BLANK[1:-1]}]")


def clean_doi(c: Column) -> Column:
    """Lower case, without URL or `doi:` prefix and trailing slashes; null if nothing is left."""
    bare = F.regexp_replace(F.lower(trim_all(c)), r"\A(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return F.nullif(F.regexp_replace(trim_all(bare), r"/+\z", ""), F.lit(""))


def group_doi(c: Column) -> Column:
    """clean_doi with runs of slashes as one."""
    return F.regexp_replace(clean_doi(c), "/{2,}", "/")


def doi_has_prefix(doi: Column, prefix: str) -> Column:
    return (doi == prefix) | doi.startswith(f"{prefix}/")


def work_id(c: Column) -> Column:
    """The number of a work from its URL, `W` form or digits; null for anything else."""
    return whole(F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), r"\A\s*(?:https?://[^/]+/)?[Ww]?([0-9]{1,18})\s*\z", 1), "long")


def fold_spaces(c: Column) -> Column:
    """Every run of white space, wide ones too, as one space; what is one already isn't touched."""
    return F.regexp_replace(c, f"(?:[[^ -~]&&{BLANK}]| (?={BLANK})){BLANK}*", " ")


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


@cache
def composable() -> str:
    """A Java class of the characters that a text in composed form may lack or that may compose with the one before: without any, a text is composed."""
    second = {ord(p[-1]) for c in map(chr, range(0x110000)) if (d := unicodedata.decomposition(c)) and not d.startswith("<") and len(p := [chr(int(x, 16)) for x in d.split()]) == 2}
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and (c in second or unicodedata.combining(chr(c)) or 0x1161 <= c < 0x1176 or 0x11A8 <= c < 0x11C3 or not unicodedata.is_normalized("NFC", chr(c)))]
    spans: list[list[int]] = []
    for c in points:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    # a character is looked for in the part whose ends it lies between, else nowhere
    parts = [spans[i : i + 16] for i in range(0, len(spans), 16)]
    return "[" + "".join(f"[[\\x{{{p[0][0]:X}}}-\\x{{{p[-1][1]:X}}}]&&[{''.join(f'\\x{{{a:X}}}-\\x{{{b:X}}}' for a, b in p)}]]" for p in parts) + "]"


def fold_text(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with `name`: the column with fold_spaces and in Unicode's composed form; only texts that may not be composed yet leave the JVM."""
    df = df.withColumn(name, fold_spaces(F.col(column)))
    # no character before U+0300 composes with another or is changed
    df = df.withColumn("_loose", F.when(F.col(name).rlike(r"[^\x00-\x{2FF}]"), F.when(F.col(name).rlike(composable()), F.col(name))))
    return df.withColumn(name, F.coalesce(_nfc("_loose"), name)).drop("_loose")


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    def undo(text):
        for _ in range(3):
            text = html.unescape(text) if text else text
        return text

    return s.map(undo)


def title_fingerprint(c: Column, entities: list[tuple[str, str]] | None = None) -> Column:
    """Letters and digits of a title in lower case, words apart by one space, after undoing HTML entities up to three times.

    All of HTML's, those without a semicolon too, and then only titles with an ampersand leave
    the JVM; with `entities` (reference, character) just these, as written and in this order.
    """
    if entities is None:
        undone = F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)
    else:
        undone = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), entities * 3, c)
    return F.trim(F.regexp_replace(F.lower(undone), "[^a-z0-9]+", " "))


def title_words(c: Column, least: int = 3) -> Column:
    """The distinct words of at least so many characters, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9]{%d,})" % least), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; 0 if both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def coverage(a: Column, b: Column) -> Column:
    """The share of a's words that b has; 0 if a is empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a)), F.lit(0.0))


def titles_match(a: Column, b: Column, least: float = 0.7) -> Column:
    """Similar by words, or one title of three words or more holds in the other."""
    wa, wb = title_words(a), title_words(b)
    fa, fb = title_fingerprint(a), title_fingerprint(b)
    held = F.when(F.length(fa) <= F.length(fb), (F.size(F.split(fa, " ")) >= 3) & F.contains(fb, fa)).otherwise((F.size(F.split(fb, " ")) >= 3) & F.contains(fa, fb))
    return (jaccard(wa, wb) >= least) | held


def surname(c: Column) -> Column:
    """`Last, First` or `First Last`: the last name in lower case."""
    name = trim_all(c)
    return F.lower(F.when(name.contains(","), trim_all(F.substring_index(name, ",", 1))).otherwise(F.substring_index(name, " ", -1)))


def authors_match(a: Column, b: Column) -> Column:
    """Equal surnames; or one of three letters or more begins the other; or one of four or more does but for its last letter."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    n = F.length(short)
    return (n > 0) & ((a == b) | ((n >= 3) & long.startswith(short)) | ((n >= 4) & (F.substring(long, F.lit(1), n - 1) == F.substring(short, F.lit(1), n - 1))))


def year_text(c: Column) -> Column:
    """`2018.0` as `2018`; what isn't a number passes through; null as an empty text."""
    s = trim_all(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(s.rlike(r"\A[0-9]+\.0+\z"), F.substring_index(s, ".", 1)).otherwise(s)


def whole(c: Column, kind: str = "int") -> Column:
    """A whole number from a text, null for anything else.  The pattern comes first, as a failing try_cast costs some 20 microseconds."""
    s = c.cast("string")
    return F.when(s.rlike(r"\A\s*[+-]?[0-9]{1,19}\s*\z"), F.trim(s).try_cast(kind))


def year_number(c: Column) -> Column:
    return whole(year_text(c))


def utc(c: Column) -> Column:
    """An ISO time with Z, an offset or none (UTC); null if it can't be read."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")])


def duration_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))


def identity_keys(doi: Column, work: Column, url: Column, title: Column) -> Column:
    """All keys that a row can be known by; its title only where there is no other."""
    keys = F.array_compact(F.array(F.concat(F.lit("doi:"), clean_doi(doi)), F.concat(F.lit("oa:"), work.cast("string")), F.concat(F.lit("url:"), F.nullif(F.lower(trim_all(url)), F.lit("")))))
    alone = F.array_compact(F.array(F.concat(F.lit("title:"), F.nullif(title_fingerprint(title), F.lit("")))))
    return F.when(F.size(keys) > 0, keys).otherwise(alone)


def pair_id(left: Column, right: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(left, F.lit("")), F.coalesce(right, F.lit(""))))


def json_url(json: Column, paths: list[str], fallback: Column) -> Column:
    """The first non-empty text at these paths, else the fallback."""
    return F.coalesce(*[F.nullif(F.get_json_object(json, p), F.lit("")) for p in paths], fallback)


def inverted_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, index): JSON {word: [positions]} of a text's words apart by spaces, words in order of their first place; each row by itself, none for a null text."""
    placed = F.array_sort(F.transform(F.split(F.col(text), " "), lambda w, p: F.struct(w.alias("w"), p.alias("p"))))
    rows = df.where(F.col(text).isNotNull()).select(key, placed.alias("_placed"))
    # each step reads the last one's arrays more than once, so that they stay columns and aren't made anew for each word
    first = F.filter(F.sequence(F.lit(0), F.size("_placed") - 1), lambda i: (i == 0) | (F.get("_placed", i)["w"] != F.get("_placed", i - 1)["w"]))
    rows = rows.select(key, "_placed", F.transform("_placed", lambda x: x["p"]).alias("_ps"), first.alias("_first")).withColumn("_next", F.concat(F.slice("_first", 2, F.size("_first")), F.array(F.size("_placed"))))
    words = F.zip_with("_first", "_next", lambda i, j: F.struct(F.get("_ps", i).alias("first"), F.get("_placed", i)["w"].alias("w"), F.slice("_ps", i + 1, j - i).alias("ps")))
    return rows.select(key, F.to_json(F.map_from_entries(F.transform(F.array_sort(words), lambda e: F.struct(e["w"], e["ps"])))).alias("index"))


#: A word and its places in an index, and the same as an object: a JSON name has 50,000 characters at most, a value any number.
ENTRY, ENTRY_OBJECT = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")\s*+:\s*+(\[[^\[\]"]*+\])', r'{"key":$1,"value":$2}'


def from_inverted_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """(key, text) of such indexes, each row by itself; of words at the same place the last in the JSON wins; null if it can't be read or is empty."""
    listed = F.concat(F.lit("["), F.regexp_extract(F.regexp_replace(index, ENTRY, ENTRY_OBJECT), r"(?s)\A\s*+\{(.*)\}\s*+\z", 1), F.lit("]"))
    entries = F.coalesce(F.map_entries(F.from_json(F.col(index), "map<string,array<int>>")), F.from_json(listed, "array<struct<key:string,value:array<int>>>"))
    places = F.flatten(F.transform(entries, lambda e, n: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), n.alias("n"), e["key"].alias("w")))))
    rows = df.select(key, F.array_sort(F.filter(places, lambda x: x["p"].isNotNull())).alias("_places"))
    after = F.slice(F.transform("_places", lambda x: x["p"]), 2, F.size("_places"))
    last = F.filter(F.zip_with("_places", after, lambda x, p: F.when(p.isNull() | (p != x["p"]), x["w"])), lambda w: w.isNotNull())
    return rows.select(key, F.nullif(F.array_join(last, " "), F.lit("")).alias("text"))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The ends of the Wilson interval; null for no trials."""
    n = F.when(n > 0, n.cast("double"))
    p = hits / n
    mid, wide = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (mid - wide) / (1 + z * z / n), (mid + wide) / (1 + z * z / n)


def bands(score: Column, steps: list[tuple[float, str]], least: str) -> Column:
    """The name of the first step that the score reaches."""
    out = F.lit(least)
    for at, name in sorted(steps):
        out = F.when(score >= at, name).otherwise(out)
    return F.when(score.isNull(), F.lit(least)).otherwise(out)


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The name of the first condition that holds, else null."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(reasons):
        out = F.when(F.coalesce(holds, F.lit(False)), name).otherwise(out)
    return out


#: Points of abbreviations, and of a single letter, that end no sentence.  Points are looked for first, as few characters are one.
ABBREVIATIONS = r"(?i)\.(?<=(?<![\p{L}\p{N}_])(?:et al|e\.g|i\.e|vs|Dr|Mr|Mrs|Ms|Prof|Fig|No|Vol|pp|cf|[A-Z])\.)"


def sentences(text: Column) -> Column:
    """Sentences of a text; abbreviations' points don't end one."""
    masked = F.regexp_replace(text, ABBREVIATIONS, "\u0001")
    # points within an abbreviation, as in `e.g.`, are followed by no space
    return F.filter(F.transform(F.split(trim_all(masked), r"\s(?<=[.!?]\s)\s*"), lambda s: F.replace(s, F.lit("\u0001"), F.lit("."))), lambda s: F.trim(s) != "")


def sentence_context(found: Column, at: Column, beside: int = 2) -> Column:
    """The sentence at a place (from 1) and up to so many on each side, apart by spaces."""
    first = F.greatest(at - beside, F.lit(1)).cast("int")
    return F.array_join(F.slice(found, first, (at + beside + 1 - first).cast("int")), " ")


def published_after(original: Column, replication: Column) -> Column:
    """Did the original appear in a later year?  False where a year is missing or can't be read; an equal year is allowed."""
    year = lambda c: F.nullif(F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), r"\b([12][0-9]{3})\b", 1), F.lit("")).cast("int")
    return F.coalesce(year(original) > year(replication), F.lit(False))


def years_agree(a: Column, b: Column, tolerance: int = 1) -> Column:
    """Are the years at most so far apart?  True where one is missing."""
    return F.coalesce(F.abs(year_number(a) - year_number(b)) <= tolerance, F.lit(True))


#: Beginnings, and then parts, of model names by family.
FAMILIES = [("gemini", ("gemini",), ()), ("gpt", ("gpt-", "o1", "o3", "o4"), ()), ("qwen", (), ("qwen",)), ("mistral", (), ("mistral",))]


def model_family(model: Column) -> Column:
    """The family of a model's name; `none` for no name, else `other`."""
    m = F.lower(F.trim(F.coalesce(model, F.lit(""))))
    out = F.when(m == "", "none")
    for name, begins, parts in FAMILIES:
        out = out.when(either([*[m.startswith(b) for b in begins], *[F.contains(m, F.lit(p)) for p in parts]]), name)
    return out.otherwise("other")


def value_bytes(c: Column) -> Column:
    """Bytes of a text value on disk: a header of one byte below 127, else of four."""
    n = F.octet_length(F.coalesce(c, F.lit("")))
    return F.when(n < 127, n + 1).otherwise(n + 4)


def heap_bytes(widths: Column, header: int = 24, pointer: int = 4) -> Column:
    """Bytes of a row of these widths in all: header, values up to a multiple of eight, item pointer."""
    return F.lit(header + pointer) + F.ceil(widths / 8) * 8
