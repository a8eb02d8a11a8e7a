"""Identifiers in cells and addresses, keys of works to skip, concepts, and authors' names as references write them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X

#: A page's identifier in an address, the registrant of pages, and parts of an address that stand before it.
PAGE, REGISTRANT = r"(?i)osf\.io/([a-z0-9]{5})(?:[/?#]|\z)", "10.17605"
BEFORE_PAGE = ("download", "project", "registrations", "nodes", "preprints", "v2", "api", "files", "wiki", "search", "dashboard", "settings", "institutions", "collections", "quickfiles", "explore")
CONCEPT_BASE = "https://openalex.org/"


def split_identifiers(c: Column) -> Column:
    """The identifiers of a cell: cut at commas only if every part is a DOI, as one may hold a comma itself; blank: none."""
    text = X.trim_all(F.coalesce(c, F.lit("")))
    parts = F.filter(F.transform(F.split(text, ","), X.trim_all), lambda p: p != "")
    several = (F.size(F.split(text, ",")) > 1) & (F.size(parts) > 0) & F.forall(parts, lambda p: p.startswith("10."))
    return F.when(text == "", F.array().cast("array<string>")).when(several, parts).otherwise(F.array(text))


def page_doi(url: Column) -> Column:
    """The DOI of a page by its address; null if the address is of none."""
    guid = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), PAGE, 1))
    return F.when(guid != "", F.concat(F.lit(f"{REGISTRANT}/osf.io/"), guid))


def registration_guid(c: Column) -> Column:
    """A page's identifier in a DOI or an address, empty if there is none: the first part behind the host that may be one, of a preprint the last, without a version."""
    text = X.trim_all(F.coalesce(c, F.lit("")))
    path = F.lower(F.regexp_extract(text, r"(?i)osf\.io/([^?#]+)", 1))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    parts = F.when(F.get(parts, F.lit(0)) == "preprints", F.slice(parts, -1, 1)).otherwise(parts)
    bare = F.filter(F.transform(parts, lambda p: F.split_part(p, F.lit("_v"), F.lit(1))), lambda p: p.rlike(r"\A[a-z0-9]{5,}\z") & ~p.isin(*BEFORE_PAGE))
    return F.coalesce(F.get(bare, F.lit(0)), F.lit(""))


def page_key(doi: Column, url: Column) -> Column:
    """What a page is asked about by: its DOI if the registrant is that of pages; without a DOI the page of its address; else null."""
    clean, guid = F.coalesce(X.clean_doi(doi), F.lit("")), registration_guid(url)
    return F.when(clean != "", F.when(F.substring_index(clean, "/", 1) == REGISTRANT, clean)).when(guid != "", F.concat(F.lit("osf.io/"), guid))


def skip_keys(sources: list[tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """(key) of all sources, each once: (rows, columns of identifiers, columns of addresses); DOIs in one form, addresses of pages as their DOI."""
    keys = []
    for rows, identifiers, urls in sources:
        cells = [F.transform(split_identifiers(F.col(c)), lambda k: F.coalesce(F.nullif(X.clean_doi(k), F.lit("")), k)) for c in identifiers]
        pages = [F.array_compact(F.array(page_doi(F.col(c)))) for c in urls]
        keys.append(rows.select(F.explode(F.concat(*cells, *pages)).alias("key")).where("key <> ''"))
    return reduce(DataFrame.unionByName, keys).distinct()


def has_concept(df: DataFrame, column: str, ids: list[str]) -> Column:
    """Has a work one of these concepts?  The column is a list of texts or of structs with id, or JSON in which an identifier ends at its quote; no such column, or null: no."""
    if column not in df.columns or not ids:
        return F.lit(False)
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(column).rlike("(?:" + "|".join(sorted(ids)) + r')"'), F.lit(False))
    if not isinstance(kind, T.ArrayType):
        return F.lit(False)
    value = lambda c: c["id"] if isinstance(kind.elementType, T.StructType) else c
    return F.coalesce(F.exists(column, lambda c: F.coalesce(F.replace(value(c), F.lit(CONCEPT_BASE), F.lit("")).isin(*ids), F.lit(False))), F.lit(False))


def _initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.when(w.endswith("."), w).otherwise(F.concat(F.substring(w, 1, 1), F.lit(".")))), " ")


def apa_author(name: Column) -> Column:
    """`John D. Bransford` as `Bransford, J. D.`; one word and blank names as they are."""
    words = F.filter(F.split(X.trim_all(name), r"(?U)\s+"), lambda w: w != "")
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.when(F.size(words) == 0, name).when(F.size(words) == 1, F.get(words, F.lit(0))).otherwise(F.concat(F.element_at(words, -1), F.lit(", "), _initials(first)))


def apa_pair(family: Column, given: Column) -> Column:
    """A family name and given ones as `Family, G. I.`; either alone as it is."""
    f, g = X.trim_all(F.coalesce(family, F.lit(""))), X.trim_all(F.coalesce(given, F.lit("")))
    words = F.filter(F.split(g, r"(?U)\s+"), lambda w: w != "")
    return F.when(f == "", g).when(g == "", f).otherwise(F.concat(f, F.lit(", "), _initials(words)))
