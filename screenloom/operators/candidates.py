"""Candidates for the work that a title means: hits of several sources, fit ones only, one for each work found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import settled
from . import audit

#: Titles above this are the work's own; identifiers of tests, not of articles.
OWN_TITLE, TEST_RECORD = 0.9, r"\A10\.1037/t[0-9]+-[0-9]+\z"
#: Rounds after which labels of groups must be settled: each halves the way to the smallest row, so that as many reach 2^ROUNDS rows.
ROUNDS = 40


def same_by_either(df: DataFrame, within: list[str], keys: list[str], row: str, group: str = "group") -> DataFrame:
    """df with the group of each row, its smallest `row`: rows of equal `within` are together if they share any key, or are linked by rows that do.

    row: a unique number.  Null and empty keys link nothing.  Every round takes the smallest
    label of each key's rows and then that label's own, until nothing changes; a round
    aggregates before it shuffles, so that a key of very many rows costs a row for each task.
    """
    labels = settled(df.select(row, *within, *keys, F.col(row).alias("_label")))
    for _ in range(ROUNDS):
        new = labels
        for k in keys:
            least = new.where(F.col(k).isNotNull() & (F.col(k) != "")).groupBy(*within, k).agg(F.min("_label").alias("_least"))
            new = new.join(least, [*within, k], "left").withColumn("_label", F.least("_label", F.coalesce("_least", "_label"))).drop("_least")
        own = new.select(F.col(row).alias("_label"), F.col("_label").alias("_own"))
        new = settled(new.join(own, "_label").withColumn("_label", F.least("_label", "_own")).select(*labels.columns))
        before = labels.select(row, F.col("_label").alias("_before"))
        labels, still = new, new.join(before, row).where("_label <> _before").isEmpty()
        if still:
            return df.join(labels.select(row, F.col("_label").alias(group)), row)
    raise RuntimeError(f"groups by {keys} aren't settled after {ROUNDS} rounds")


def names_of(surname: Column) -> Column:
    """The names of a citation's authors, which may run on in one word: parts of three letters or more."""
    return F.filter(F.split(F.lower(F.coalesce(surname, F.lit(""))), "[^a-z]+"), lambda n: (F.length(n) > 2) & (n != "and"))


def carries_author(authors: Column, surname: Column) -> Column:
    """Is a cited name among the authors?  Yes if none was cited."""
    text = F.lower(F.array_join(authors, " "))
    names = names_of(surname)
    return (F.size(names) == 0) | F.exists(names, lambda n: F.regexp(text, F.concat(F.lit(r"(?U)\b"), n, F.lit(r"\b"))))


def title_candidates(hits: DataFrame, works: DataFrame) -> DataFrame:
    """(work, n, doi, ident, title, year, authors, source, flags): what a title search found, the first source's hit of each work found.

    hits: work, place (of its source), source, doi, ident, title, year, authors (array); works:
    work, doi_r, title_r, surname (as cited, may be empty).  Left out are hits without any
    identifier, the work itself (by identifier, or a title alike above OWN_TITLE), what isn't an
    article, and, where an author is cited, records without authors.  An author who differs
    is a flag, and so is a test's record.  Hits are one if they share a DOI or an identifier.
    Null titles and authors count as empty; hits of a work that isn't in works are left out.
    """
    words = lambda c: T.title_words(F.coalesce(c, F.lit("")))
    rows = hits.join(works.select("work", "doi_r", "title_r", "surname"), "work")
    rows = rows.withColumn("doi", F.coalesce(T.clean_doi(F.col("doi")), F.lit(""))).withColumn("ident", F.coalesce("ident", F.lit(""))).withColumn("authors", F.filter(F.coalesce("authors", F.array()), lambda a: F.trim(a) != ""))
    fit = [(F.col("doi") != "") | (F.col("ident") != ""), (F.col("doi") == "") | (F.col("doi") != F.coalesce(T.clean_doi(F.col("doi_r")), F.lit(""))), F.coalesce(T.jaccard(words(F.col("title")), words(F.col("title_r"))) <= OWN_TITLE, F.lit(True)), audit.non_article(F.col("doi")) == "", (F.coalesce("surname", F.lit("")) == "") | (F.size("authors") > 0)]
    for test in fit:
        rows = rows.where(test)
    flags = F.array_compact(F.array(F.when(~carries_author(F.col("authors"), F.col("surname")), F.concat(F.lit("does not carry the cited author ("), "surname", F.lit(")"))), F.when(F.col("doi").rlike(TEST_RECORD), "a test's record, not an article")))
    rows = settled(rows.withColumn("flags", flags).drop("doi_r", "title_r", "surname").withColumn("_row", F.monotonically_increasing_id()))
    grouped = same_by_either(rows, ["work"], ["doi", "ident"], "_row", "_group")
    columns = ["doi", "ident", "title", "year", "authors", "source", "flags", "place", "_row"]
    first = grouped.groupBy("work", "_group").agg(F.min_by(F.struct(*columns), F.struct("place", "doi", "ident", "title", "_row")).alias("h")).select("work", "h.*")
    place = F.row_number().over(Window.partitionBy("work").orderBy("place", "doi", "ident", "title", "_row"))
    return first.select("work", place.alias("n"), *columns[:-2])
