"""Author and year citations in texts, and the references and works that they may mean."""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans
from ..functions import text as T
from ..sources.shared import settled
from . import folds

#: How names, years and what may follow a year in parentheses look.
LETTERS = "À-ɏḀ-ỿ"
PARTICLE = r"(?:v(?:an\s+der|an|on)\s+|d(?:e\s+la|e|a|el|en|er|u)\s+|l[ea]\s+|[ea]l\s+)?"
# what a name begins with is looked at first: at few places of a text is it there
NAME = rf"(?:(?=[A-ZÀ-ɏ]|[adelv][aelnou][lnr]?\s){PARTICLE}[A-ZÀ-ɏ][\w{LETTERS}]{{2,}})"
YEAR, TAIL = r"(?:19|20)\d{2}", r"(?:\s*[,;][^)]{0,60})?"
AND, OWNER = r"\s+(?:and|&)\s+", r"\s*'?s?\s*"
BRACKETED, PLAIN = rf"{OWNER}\(({YEAR}){TAIL}\)", rf",?\s+({YEAR})(?!\d)"
FIRST, LAST = 1900, 2099


@dataclass(frozen=True)
class Form:
    """How a citation may read: the pattern, its groups of names, and a text that it can't do without."""

    label: str
    pattern: str
    names: int
    needs: str

    @property
    def java(self) -> str:
        return spans.UNICODE + self.pattern


#: From the most to the least specific.
FORMS = [
    Form("list_bracketed", rf"({NAME}(?:,\s*{NAME}){{1,}},?{AND}{NAME}){BRACKETED}", 1, "(?:and|&)"),
    Form("list_plain", rf"({NAME}(?:,\s*{NAME}){{1,}},?{AND}{NAME}){PLAIN}", 1, "(?:and|&)"),
    Form("others_bracketed", rf"({NAME})\s+et\s+al\.?{BRACKETED}", 1, "et"),
    Form("others_plain", rf"({NAME})\s+et\s+al\.?\s*,?\s+({YEAR})(?!\d)", 1, "et"),
    Form("pair_bracketed", rf"({NAME}){AND}({NAME}){BRACKETED}", 2, "(?:and|&)"),
    Form("pair_plain", rf"({NAME}){AND}({NAME}){PLAIN}", 2, "(?:and|&)"),
    Form("one_bracketed", rf"({NAME}){BRACKETED}", 1, r"\("),
    Form("one_plain", rf"({NAME}){PLAIN}", 1, r"\s"),
]
#: Months and days of the week are never authors.
DATES = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
)
#: Words before a bare year that aren't authors, for strict extraction.
LEADS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
    "winter", "spring", "summer", "fall", "autumn",
    "study", "studies", "table", "figure", "fig", "experiment", "experiments", "session", "sessions", "wave", "waves", "sample", "samples", "model", "models",
    "appendix", "chapter", "section", "panel", "phase", "trial", "trials", "cohort", "group", "groups", "item", "items", "question", "version", "round",
    "block", "condition", "column", "row", "note", "equation", "hypothesis", "day", "week", "month", "year", "time", "age", "quarter", "volume", "vol",
    "issue", "number", "no", "page", "part", "level", "step", "set", "series", "line", "site", "class", "type", "grade",
    "covid", "sars", "mers", "hiv", "aids", "eu", "us", "usa", "uk", "un", "who", "gdp", "ai", "ml", "pcr", "dna", "rna",
    "since", "during", "between", "from", "until", "after", "before", "in", "on", "by", "at", "for", "with", "within", "over", "through", "under",
    "around", "about", "across", "throughout", "post", "pre", "early", "late", "the", "this", "that", "these", "those", "their", "our", "its", "and",
    "but", "however", "thus", "here", "there", "when", "while", "copyright", "circa", "ca", "fiscal", "academic", "christmas", "easter",
)


def _candidates(text: Column, place: int, form: Form, latest: Column | None, strict: bool) -> Column:
    """What a form finds, without hits whose names are dates or whose year is out of bounds."""
    hits = F.when(text.rlike(form.needs), spans.find(text, form.java)).otherwise(F.array().cast(spans.HITS))
    group = lambda h, i: F.regexp_extract(h["hit"], form.java, i)
    read = F.transform(hits, lambda h: F.struct(
        F.lit(place).alias("place"), h["start"].alias("start"), h["end"].alias("end"), F.lit(form.label).alias("pattern"), h["hit"].alias("raw"), group(h, 1).alias("first"),
        F.concat_ws(" ", *[group(h, i + 1) for i in range(form.names)]).alias("names"), group(h, form.names + 1).cast("int").alias("year"),
    ))

    def holds(c: Column) -> Column:
        ok = ~c["names"].rlike(f"(?i)(?<![A-Za-z-])(?:{'|'.join(DATES)})(?![A-Za-z-])") & c["year"].between(FIRST, LAST)
        if latest is not None:
            ok &= F.coalesce(c["year"] <= latest, F.lit(True))
        if strict and form.label == "one_plain":
            ok &= ~F.element_at(F.split(F.lower(F.trim(c["first"])), r"\s+"), -1).isin(*LEADS)
        return ok

    return F.filter(read, holds)


def citations_in(text: Column, latest: Column | None = None, strict: bool = False) -> Column:
    """array<struct<place, start, end, pattern, raw, first, names, year>> of a text's citations, in order of form and then of place.

    All forms are tried on the whole text; of what they find, the most specific first, those
    stay that overlap none before.  Months and days of the week are no authors, years after
    `latest` don't count.  strict: neither does a bare year after a word of LEADS.
    """
    dated = F.when(text.rlike("(?:19|20)[0-9]{2}"), text)
    every = lambda text: F.concat(*[_candidates(text, i, form, latest, strict) for i, form in enumerate(FORMS)])
    return spans.apart(F.array_sort(spans.let(dated, every)))


def find_citations(docs: DataFrame, key: str, text: str, max_year: str | None = None, strict: bool = False) -> DataFrame:
    """(key, n, pattern, start, raw, surname, year) of every citation; n: its order among those of the text, by form and place.

    surname: the names of the first group in lower case, without spaces and apostrophes.
    Texts without a year are left out before any form is tried.  Null text: none.
    """
    rows = docs.where(F.col(text).rlike("(?:19|20)[0-9]{2}"))
    found = citations_in(F.col(text), F.col(max_year).cast("int") if max_year else None, strict)
    rows = rows.select(key, F.posexplode(found).alias("n", "c"))
    return rows.select(key, "n", "c.pattern", "c.start", "c.raw", F.lower(F.regexp_replace("c.first", r"(?U)[\s']", "")).alias("surname"), "c.year")


def find_candidates(citations: DataFrame, references: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, ref_id, title, year, match_year_exact, cited) of the references that a work's citations may mean, each by the first citation that fits.

    citations: work, n, raw, surname, year, doi_self; references: work, ref_id, doi, title,
    year, surnames (array).  A reference fits with a surname and with the year or one beside
    it, tried in the order 0, 1, -1; the work itself isn't its own candidate.  The years are
    listed, so that the join is by work and year.
    """
    near = F.array(*[F.struct(F.lit(i).alias("order"), (F.col("year") + d).alias("near"), F.lit(d == 0).alias("exact")) for i, d in enumerate((0, 1, -1))])
    asked = citations.select(work, "n", "raw", "surname", "doi_self", F.explode(near).alias("y")).select(work, "n", "raw", "surname", "doi_self", "y.order", F.col("y.near").alias("year"), "y.exact")
    hits = asked.join(references.withColumnRenamed("surnames", "_names"), [work, "year"])
    hits = hits.where(F.exists("_names", lambda a: T.authors_match(F.col("surname"), F.lower(F.trim(a)))))
    hits = hits.where(~F.coalesce(T.clean_doi(F.col("doi")) == T.clean_doi(F.col("doi_self")), F.lit(False)))
    return folds.first_by(hits.select(work, "ref_id", "n", "order", "title", "year", F.col("exact").alias("match_year_exact"), F.col("raw").alias("cited")), [work, "ref_id"], ["n", "order"]).drop("n", "order")


#: Authors of a citation that are looked up, hits above which topic words narrow them, how many words are tried, works offered.
MOST_NAMES, NARROW_ABOVE, TOPIC_STEPS, OFFERED = 3, 12, (3, 2), 10
#: Words that carry no topic.
NO_TOPIC = (
    "about", "above", "after", "again", "against", "all", "also", "among", "and", "another", "any", "are", "because",
    "been", "before", "being", "between", "both", "but", "can", "conceptual", "could", "direct", "does",
    "during", "each", "effect", "effects", "evidence", "experiment", "experiments", "extension",
    "extensions", "first", "from", "further", "have", "high", "higher", "how", "into", "investigation", "its",
    "large", "low", "lower", "many", "materials", "more", "most", "new", "not", "novel", "one", "only", "other",
    "over", "paper", "papers", "pre", "preregistered", "registered", "replicate", "replicates",
    "replicating", "replication", "replications", "report", "reports", "research", "results", "revisited",
    "same", "second", "several", "study", "studies", "such", "test", "testing", "tests", "than", "that", "the",
    "their", "them", "then", "there", "these", "they", "this", "those", "three", "through", "two", "under", "using",
    "very", "was", "were", "what", "when", "where", "which", "while", "who", "why", "will", "with", "within",
    "without", "would", "your",
)


def _plain_letters() -> tuple[str, str]:
    """Letters that decompose into one ASCII letter and marks, and those letters."""
    pairs = [(chr(c), d) for c in range(128, min(sys.maxunicode, 0x2100)) for d in ["".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))] if len(d) == 1 and d.isascii() and d.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


PLAIN_LETTERS = _plain_letters()


def fold_accents(c: Column) -> Column:
    """Lower case without accents: letters with marks as the letter, marks on their own left out."""
    return F.lower(F.regexp_replace(F.translate(c, *PLAIN_LETTERS), r"\p{Mn}+", ""))


def fold_names(names: Column) -> Column:
    """Names as they are compared: without accents, white space as one space; blank ones left out, each once."""
    folded = F.transform(names, lambda n: F.trim(F.regexp_replace(fold_accents(n), r"(?U)\s+", " ")))
    return F.array_distinct(F.filter(folded, lambda n: n.isNotNull() & (n != "")))


def topic_words(text: Column, names: Column) -> Column:
    """The words of a title that carry its topic, in order: of four letters or more, not in NO_TOPIC, no author's name, each once."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)[\w&&[^\d_]]{4,}"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*NO_TOPIC) & ~F.array_contains(names, fold_accents(w))))


def rank_works(citations: DataFrame, works: DataFrame, offered: int = OFFERED, narrow_above: int = NARROW_ABOVE, names: int = MOST_NAMES, steps: tuple[int, ...] = TOPIC_STEPS) -> DataFrame:
    """(cite_id, rank, ref_id, how, covers, total): the works that a citation of authors and a year may mean, the likeliest first, `offered` at most.

    citations: cite_id, surnames (array, as cited), year, topic (the citing work's title);
    works: ref_id, surnames (array), year, title, cited_by.  Names are compared without
    accents.  In passes: works of the year that carry every name of the first `names`; where
    none does, those of the first name; where there are more than `narrow_above`, those whose
    title has all of the first three words of the topic, else of the first two, stand ahead of
    the broad list and never replace it.  Each list is by cited_by, then ref_id.  total counts
    the broad list; covers: does the work carry every name?

    A citation's names are looked up once however many cite so, by the rarest of them, and a
    first name once whatever stands behind it; titles are looked up by a word of the topic among
    works of those names, once for all citations of equal names, year and topic.  Lists are
    made of such groups, and given to their citations last.
    """
    cited = citations.select("cite_id", "year", F.slice(fold_names(F.col("surnames")), 1, names).alias("names"), fold_names(F.col("surnames")).alias("_all"), "topic").where((F.size("names") > 0) & F.col("year").isNotNull())
    cited = cited.select("cite_id", "year", "names", F.transform(topic_words(F.col("topic"), F.col("_all")), fold_accents).alias("topic"))
    known = works.select("ref_id", "year", fold_names(F.col("surnames")).alias("theirs"), F.coalesce("cited_by", F.lit(0)).alias("cited_by"), F.array_distinct(F.split(fold_accents(F.coalesce("title", F.lit(""))), r"(?U)[\W_]+")).alias("words"))
    by_name = known.select("ref_id", "year", "theirs", "cited_by", "words", F.explode("theirs").alias("name"))
    counts = by_name.groupBy("year", "name").agg(F.count(F.lit(1)).alias("n"))
    keys = cited.select("year", "names").distinct()
    each = keys.select("year", "names", F.posexplode("names").alias("at", "name")).join(counts, ["year", "name"], "left")
    rarest = each.groupBy("year", "names").agg(F.min_by("name", F.struct(F.coalesce("n", F.lit(0)), "at")).alias("name"))
    looked = ["year", "look", "ref_id", "cited_by", "words"]
    every = settled(rarest.join(by_name, ["year", "name"]).where(F.size(F.array_except("names", "theirs")) == 0).select("year", F.col("names").alias("look"), "ref_id", "cited_by", "words"))
    found = every.select("year", "look").distinct()
    # what a citation is looked up by: all its names, or its first name alone
    looks = keys.join(found.select("year", F.col("look").alias("names"), F.lit(True).alias("covers")), ["year", "names"], "left").where(F.col("covers") | (F.size("names") > 1))
    looks = looks.select("year", "names", F.when(F.col("covers"), F.col("names")).otherwise(F.slice("names", 1, 1)).alias("look"), F.coalesce("covers", F.lit(False)).alias("covers"))
    first = looks.where("NOT covers").select("year", "look").distinct().join(found, ["year", "look"], "left_anti").withColumn("name", F.element_at("look", 1))
    hits = every.unionByName(first.join(by_name, ["year", "name"]).select(*looked))
    totals = hits.groupBy("year", "look").agg(F.count(F.lit(1)).alias("total"))
    best = [F.desc("cited_by"), F.asc("ref_id")]
    top = hits.withColumn("place", F.row_number().over(Window.partitionBy("year", "look").orderBy(*best))).where(F.col("place") <= offered)
    asks = cited.join(looks.join(totals, ["year", "look"]), ["year", "names"])
    asks = asks.select("cite_id", "year", "look", "covers", "total", F.when(F.col("total") > narrow_above, F.col("topic")).otherwise(F.array().cast("array<string>")).alias("topic"))
    group = ["year", "look", "topic"]
    groups = settled(asks.select(*group).distinct())
    broad = groups.join(top, ["year", "look"]).select(*group, "ref_id", F.lit(len(steps)).alias("step"), "place")
    tried = F.array(*[F.struct(F.lit(i).alias("step"), F.slice("topic", 1, n).alias("wanted")) for i, n in enumerate(steps)])
    tried = groups.where(F.size("topic") > 0).select(*group, F.explode(tried).alias("t")).select(*group, "t.*").withColumn("word", F.element_at("wanted", 1))
    worded = hits.select(*looked, F.explode("words").alias("word")).join(tried.select("year", "look", "word").distinct(), ["year", "look", "word"], "left_semi")
    close = tried.join(worded, ["year", "look", "word"]).where(F.size(F.array_except("wanted", "words")) == 0)
    near = close.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("step", *best))).where(F.col("place") <= offered)
    near = near.withColumn("_least", F.min("step").over(Window.partitionBy(*group))).where(F.col("step") == F.col("_least")).select(*group, "ref_id", "step", "place")
    once = folds.first_by(near.unionByName(broad), [*group, "ref_id"], ["step", "place"])  # 2 * offered rows of a group at most
    lists = once.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy("step", "place"))).where(F.col("rank") <= offered)
    how = F.when(F.col("step") < len(steps), "topic").when(F.col("covers"), "names").otherwise("first name")
    return asks.join(lists, group).select("cite_id", "rank", "ref_id", how.alias("how"), "covers", "total")
