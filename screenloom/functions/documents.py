"""Citation strings, sections, reference lists and the window that states an outcome, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import spans
from . import text as T

#: How list markers, initials, authors of a numbered list and what is left of a cut one look.
MARKER = r"\s*(?:[\[(]\d{1,3}[\])][.,)]?|\d{1,3}\.)\s+"
INITIALS = r"(?:[A-Z]\.[-\s]*){1,4}"
BEFORE_NEXT = r"\s*(?:[,;&]|\band\b)\s*"
AUTHOR = rf"(?:{INITIALS}(?:[A-Z][\w'’\-]+\s+)?[A-Z][\w'’\-]+|[A-Z][\w'’\-]+,?\s+{INITIALS}){BEFORE_NEXT}"
OTHERS = rf"(?i:et\.?\s*al\.?\s*(?:[,;&]|\band\b)\s*)"
CONJUNCTION = r"(?i:and|&)\s+"
CUT_OFF = r",\s*(?:[A-Z]\.){1,3}[A-Z]?\s*\z"
ONLY_INITIALS = r"\A(?:[A-Z]\.[-\s]*){1,4}[A-Z]?\.?\z"
#: A citation before a title, from most to least sure of it; the least letters of a title, and of what a cut may leave.
CITED = (r"\A.*?\((?:19|20)\d{2}[a-z]?(?:\s*[,;][^)]{0,60})?\)[\s,:.\-–]*", r"\A.*?,\s*(?:19|20)\d{2}[a-z]?\s*[,:.\-–]\s*", r"\A.{0,60}?\b(?:19|20)\d{2}[a-z]?\b[\s,:.\-–]+")
LEAST_TITLE, LEAST_LEFT = 10, 20
#: Headings of sections, and of a discussion; its least place in a text and length, the most of it, and what stands for a gap.
HEADING = r"(?imd)^\s*(?:\d+(?:\.\d+)*\.?\s+)?(abstract|introduction|background|methods?|results?|discussion|conclusions?|references|bibliography)\s*:?\s*$"
LIST_HEADING = r"(?imd)^\s*(?:\d+(?:\.\d+)*\.?\s+)?(?:references|bibliography)\s*:?\s*$"
DISCUSSION = r"(?imd)^[^\S\n]{0,8}(?:\d+[.\s]{1,3})?(?:general\s+|overall\s+)?(?:discussion|conclusions?|concluding\s+remarks|(?:summary|discussion)\s+and\s+(?:discussion|conclusions?|implications))[^\S\n]*[:.]?[^\n]{0,40}$"
PLACE, LEAST_BLOCK, MOST, GAP, HEAD = 0.4, 300, 8000, "\n…\n", 0.6
ITEM = r"\n(?=\s*(?:\[\d+\]|\d+[.)]|[-•*]|[A-ZÀ-Þ]))"
BULLET = r"\A\s*(?:\[\d+\]|\d+[.)]|[-•*])\s*"
REFERENCE = r"\A(.+?)\s*\(((?:19|20)\d\d)[a-z]?\)\.?\s*([^.]+)\.?\s*.*\z"
U = spans.UNICODE


def _text(c: Column) -> Column:
    return T.trim_all(F.coalesce(c, F.lit("")))


def without_marker(c: Column) -> Column:
    """A text without a list's number before it, if authors follow: a title may begin with a number, too."""
    text = _text(c)
    return F.regexp_replace(text, rf"{U}\A{MARKER}(?={AUTHOR})", "")


def clean_title(c: Column) -> Column:
    """The title of a raw citation: without its number, a conjunction before an author and the authors; a title stays, and so does what is nothing but authors."""
    text = F.regexp_replace(without_marker(c), rf"{U}\A{CONJUNCTION}(?={AUTHOR})", "")
    return F.regexp_replace(text, rf"{U}\A(?>{AUTHOR})(?=\s*\S)(?:(?>{AUTHOR}|{OTHERS})(?=\s*\S))*+", "")


def _is_piece(text: Column) -> Column:
    return (text == "") | text.rlike(rf"{U}\A(?:{CONJUNCTION})?{AUTHOR}") | text.rlike(U + CUT_OFF) | text.rlike(ONLY_INITIALS)


def is_fragment(c: Column) -> Column:
    """Is it a piece of a citation: empty, authors first, cut off among initials, or initials alone?"""
    return spans.let(without_marker(c), _is_piece)


def usable_title(c: Column) -> Column:
    """Can it be searched for: LEAST_TITLE letters or more, and no fragment?"""
    letters = lambda text: F.trim(F.regexp_replace(text, U + r"[\W_]+", " "))
    return spans.let(without_marker(c), lambda text: (F.length(letters(text)) >= LEAST_TITLE) & ~_is_piece(text))


def without_citation(c: Column) -> Column:
    """A text without the author-year citation before it, by the first pattern that leaves LEAST_LEFT characters or more."""
    text = _text(c)
    rest = [F.regexp_replace(text, U + p, "") for p in CITED]
    cut = lambda r: text.isNotNull() & (F.length(r) < F.length(text)) & (F.length(r) >= LEAST_LEFT)
    return F.coalesce(*[F.when(cut(r), T.trim_all(r)) for r in rest], text)


def is_bare_citation(c: Column) -> Column:
    """Is it an author-year citation that leaves no title, however much of it is cut?"""
    text = _text(c)
    lengths = [F.when(text.rlike(U + p), F.length(text) - F.length(F.regexp_replace(text, U + p, ""))) for p in CITED]
    longest = F.greatest(*lengths)
    return longest.isNotNull() & ~usable_title(F.substring(text, longest + 1, F.length(text)))


def sections(c: Column) -> Column:
    """array<struct<heading, body>> in order, bodies that aren't blank; what comes before the first heading has an empty one."""
    text = F.coalesce(c, F.lit(""))
    first = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("hit")))

    def parts(hits: Column) -> Column:
        ends = F.concat(F.transform(F.slice(hits, F.lit(2), F.size(hits)), lambda h: h["start"]), F.array(F.length(text)))
        return F.zip_with(hits, ends, lambda h, end: F.struct(F.lower(F.regexp_extract(h["hit"], U + HEADING, 1)).alias("heading"), T.trim_all(F.substring(text, h["end"] + 1, end - h["end"])).alias("body")))

    return F.filter(spans.let(F.concat(first, spans.find(text, U + HEADING)), parts), lambda p: p["body"] != "")


def references(c: Column) -> Column:
    """array<struct<authors, year, title>> of the entries of a reference list that have them."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), U + ITEM, -1), lambda s: F.trim(F.regexp_replace(F.regexp_replace(s, U + r"\s+", " "), U + BULLET, "")))
    group = lambda s, i: F.regexp_extract(s, U + REFERENCE, i)
    return F.transform(F.filter(lines, lambda s: s.rlike(U + REFERENCE)), lambda s: F.struct(F.regexp_replace(group(s, 1), r"\A[ ,]+|[ ,]+\z", "").alias("authors"), group(s, 2).cast("int").alias("year"), F.trim(group(s, 3)).alias("title")))


def outcome_text(c: Column, most: int = MOST) -> Column:
    """struct<text, origin>: the part of a paper that states its own verdict.

    origin `discussion`: from its last heading of that kind, not in the first part of the text
    and with LEAST_BLOCK characters or more, up to the references; both ends of it if it is
    longer than `most`.  `tail`: the last `most` characters before the references.  `none`.
    """
    budget = most - len(GAP)
    head = int(budget * HEAD)
    told = lambda x, origin: F.struct(x.alias("text"), F.lit(origin).alias("origin"))

    def shortened(block: Column) -> Column:
        return F.when(F.length(block) <= most, block).otherwise(F.concat(T.trim_all(F.substring(block, 1, head)), F.lit(GAP), T.trim_all(F.substring(block, head - budget, budget - head))))

    def verdict(body: Column) -> Column:
        late = F.filter(spans.find(body, U + DISCUSSION), lambda h: h["start"] >= F.length(body) * PLACE)
        blocks = F.filter(F.transform(late, lambda h: T.trim_all(F.substring(body, h["start"] + 1, F.length(body)))), lambda b: F.length(b) >= LEAST_BLOCK)
        tail = T.trim_all(F.when(F.length(body) > most, F.substring(body, -most, most)).otherwise(body))
        return spans.let(F.try_element_at(blocks, F.lit(-1)), lambda b: F.when(b.isNotNull(), told(shortened(b), "discussion")).otherwise(told(tail, "tail")))

    def window(text: Column) -> Column:
        before = F.substring(text, F.lit(1), F.coalesce(F.try_element_at(F.transform(spans.find(text, U + LIST_HEADING), lambda h: h["start"]), F.lit(-1)), F.length(text)))
        body = spans.let(before, lambda b: F.when(T.is_blank(b), text).otherwise(b))
        return F.when(T.is_blank(text), told(F.lit(""), "none")).otherwise(spans.let(body, verdict))

    # a text may be made of others: named in many places, it would be made in each
    return spans.let(F.coalesce(c, F.lit("")), window)
