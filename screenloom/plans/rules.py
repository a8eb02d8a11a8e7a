"""The rule language: declarative JSON rules, checked at loading and compiled to Columns.

A rule has a match block, a pile and a precedence.  A block's conditions are ANDed;
any_of, all_of and none_of nest.  A shadow rule is evaluated and stored but never
wins.  A domain block says where a rule was meant to apply and never gates it.
Predicates are never null: a missing value doesn't match.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.regex import UnsupportedPattern, loosen, to_java

PILES = ("discard", "screen_expensive", "screen_cheap", "pending")
SCREENS = ("screen_expensive", "screen_cheap")
VOCABULARIES = ("replication", "reproduction")
REGEXES = {"doi_regex": "doi", "title_regex": "title", "abstract_regex": "abstract", "text_regex": "text", "url_regex": "url"}
FIELDS = ("type", "publication_year", "concept_ids")
GROUPS = ("any_of", "all_of", "none_of")
CONDITIONS = (*REGEXES, *GROUPS, "doi_prefix", "fields", "abstract_missing")
READS_TEXT = {"abstract_regex", "text_regex"}


class RuleErrors(ValueError):
    """All errors of a bundle."""


@dataclass(frozen=True)
class Rule:
    id: str
    pile: str
    precedence: int
    match: dict
    vocabulary: str | None = None
    shadow: bool = False
    domain: dict | None = None
    measured: tuple = ()
    content: dict = field(default_factory=dict, compare=False)

    @property
    def digest(self) -> str:
        return digest(self.content)


def digest(value) -> str:
    """sha256 of JSON with keys in order and no white space."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def _keys_used(block: dict) -> set[str]:
    return set(block) | {k for g in GROUPS for b in block.get(g, []) if isinstance(b, dict) for k in _keys_used(b)}


def _block_errors(block, where: str) -> list[str]:
    if not isinstance(block, dict):
        return [f"{where}: not an object"]
    out = [f"{where}: unknown condition {k}" for k in block if k not in CONDITIONS]
    for k in REGEXES:
        for p in _listed(block.get(k, [])):
            try:
                to_java(p)
            except (UnsupportedPattern, TypeError) as e:
                out.append(f"{where}.{k}: {e}")
    for g in GROUPS:
        if g in block and not isinstance(block[g], list):
            out.append(f"{where}.{g}: not a list")
        else:
            out += [e for i, b in enumerate(block.get(g, [])) for e in _block_errors(b, f"{where}.{g}[{i}]")]
    out += [f"{where}.fields: unknown field {k}" for k in block.get("fields", {}) if k not in FIELDS]
    if not isinstance(block.get("abstract_missing", False), bool):
        out.append(f"{where}.abstract_missing: not a boolean")
    return out


def rule_errors(content: dict) -> list[str]:
    name = content.get("id") or "?"
    out = []
    if not content.get("id"):
        out.append("a rule has no id")
    if content.get("pile") not in PILES[:-1]:
        out.append(f"{name}: pile {content.get('pile')!r}")
    if not isinstance(content.get("precedence"), int):
        out.append(f"{name}: precedence isn't an integer")
    if content.get("vocabulary") is not None and content["vocabulary"] not in VOCABULARIES:
        out.append(f"{name}: vocabulary {content['vocabulary']!r}")
    if content.get("vocabulary") is not None and content.get("pile") == "discard":
        out.append(f"{name}: a discard has no vocabulary")
    match = content.get("match")
    out += [f"{name}: {e}" for e in _block_errors(match, "match")]
    if content.get("domain") is not None:
        out += [f"{name}: {e}" for e in _block_errors(content["domain"], "domain")]
    if isinstance(match, dict):
        if not match:
            out.append(f"{name}: match is empty")
        if content.get("pile") == "discard" and _keys_used(match) & READS_TEXT and match.get("abstract_missing") is not False:
            out.append(f"{name}: a discard that reads text needs abstract_missing false")
    for m in content.get("measured", []):
        if not {"set", "value"} <= set(m):
            out.append(f"{name}: measured needs set and value")
    return out


def load(contents: Iterable[dict]) -> list[Rule]:
    """Rules by falling precedence, then id; raises RuleErrors with every error of the bundle."""
    contents = list(contents)
    errors = [e for c in contents for e in rule_errors(c)]
    ids = [c.get("id") for c in contents]
    errors += [f"{i}: id used twice" for i in sorted({i for i in ids if i and ids.count(i) > 1})]
    if errors:
        raise RuleErrors("\n".join(errors))
    rules = [Rule(c["id"], c["pile"], c["precedence"], c["match"], c.get("vocabulary"), c.get("shadow", False), c.get("domain"), tuple(map(digest, c.get("measured", []))), c) for c in contents]
    return sorted(rules, key=lambda r: (-r.precedence, r.id))


def load_folder(path: str) -> list[Rule]:
    return load(json.loads(p.read_text("utf-8")) for p in sorted(Path(path).glob("*.json")))


def bundle_digest(rules: list[Rule]) -> str:
    return hashlib.sha256("\n".join(sorted(f"{r.id}:{r.digest}" for r in rules)).encode()).hexdigest()


def _listed(value) -> list:
    return value if isinstance(value, list) else [value]


@dataclass(frozen=True)
class Pool:
    """The columns of a pool that rules read; None where it has none, which fails `fields` on them."""

    work: str = "work_id"
    doi: str | None = "doi"
    title: str = "title"
    abstract: str = "abstract"
    url: str | None = "url"
    type: str | None = "type"
    publication_year: str | None = "publication_year"
    concept_ids: str | None = "concepts"

    #: Set by prepared(): the columns that hold values once derived, and their lower-case forms.
    derived: frozenset = frozenset()

    def value(self, name: str) -> Column:
        if name in self.derived:
            return F.col(f"_value_{name}")
        if name == "text":
            return F.concat(self.value("title"), F.lit("\n"), self.value("abstract"))
        column = getattr(self, name)
        return F.lit("") if column is None else F.coalesce(F.col(column).cast("string"), F.lit(""))

    def matches(self, name: str, pattern: str) -> Column:
        """Does the pattern match this value?  Where it needs a literal, only values that contain it are tried."""
        return T.matches(self.value(name), pattern, F.col(f"_lower_{name}") if name in self.derived else None)

    def prepared(self, pool: DataFrame, blocks: list[dict]) -> tuple[DataFrame, Pool]:
        """pool with the values that these blocks' patterns read and their lower-case forms as columns, each derived once, and the Pool that reads them."""
        names = sorted({REGEXES[k] for b in blocks for k in _keys_used(b) if k in REGEXES})
        first = pool.select("*", *[self.value(n).alias(f"_value_{n}") for n in names])
        return first.select("*", *[F.lower(f"_value_{n}").alias(f"_lower_{n}") for n in names]), replace(self, derived=frozenset(names))

    def dropped(self, df: DataFrame) -> DataFrame:
        """df without the derived columns."""
        return df.drop(*[f"{k}_{n}" for n in self.derived for k in ("_value", "_lower")])


def compile_block(block: dict, pool: Pool) -> Column:
    """A boolean that is never null."""
    parts = []
    if "doi_prefix" in block:
        doi = F.coalesce(T.clean_doi(pool.value("doi")), F.lit(""))
        parts.append(T.either([T.doi_has_prefix(doi, p) for p in _listed(block["doi_prefix"])]))
    for key, column in REGEXES.items():
        if key in block:
            parts.append(T.either([pool.matches(column, p) for p in _listed(block[key])]))
    for name, values in block.get("fields", {}).items():
        if getattr(pool, name) is None:
            return F.lit(False)
        if name == "concept_ids":
            parts.append(T.either([pool.value(name).rlike(f"{v}(?:[^0-9]|\\z)") for v in _listed(values)]))
        else:
            parts.append(F.col(getattr(pool, name)).isin(_listed(values)))
    if "abstract_missing" in block:
        blank = T.is_blank(pool.value("abstract"))
        parts.append(blank if block["abstract_missing"] else ~blank)
    if "any_of" in block:
        parts.append(T.either([compile_block(b, pool) for b in block["any_of"]]))
    if "all_of" in block:
        parts.append(T.every([compile_block(b, pool) for b in block["all_of"]]))
    if "none_of" in block:
        parts.append(~T.either([compile_block(b, pool) for b in block["none_of"]]))
    return T.every(parts)


def evidence(block: dict, pool: Pool) -> Column:
    """The first text that a pattern of the block matched, else the name of its first condition."""
    found = [F.nullif(F.regexp_extract(pool.value(column), to_java(p), 0), F.lit("")) for key, column in REGEXES.items() for p in _listed(block.get(key, []))]
    found += [F.when(compile_block(b, pool), evidence(b, pool)) for g in ("all_of", "any_of") for b in block.get(g, [])]
    return F.coalesce(*found, F.lit(next(iter(block), "")))


def match_flags(pool: DataFrame, rules: list[Rule], columns: Pool, block: str = "match") -> DataFrame:
    """pool with one array column `matched` (or `domains`): the ids of the rules whose block holds, by precedence."""
    blocks = [getattr(r, block) for r in rules if getattr(r, block) is not None]
    ready, columns = (pool, columns) if columns.derived else columns.prepared(pool, blocks)
    flags = [F.when(compile_block(getattr(r, block), columns), F.lit(r.id)) for r in rules if getattr(r, block) is not None]
    name = "matched" if block == "match" else "domains"
    return ready.withColumn(name, F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")).select(*[c for c in pool.columns if c != name], name)


def route(pool: DataFrame, rules: list[Rule], columns: Pool | None = None, exempt: Column | None = None) -> DataFrame:
    """One pile per work by the matching live rule of highest precedence (ties by id).

    Adds matched (all rules, shadows too), live (those that may win), rule_id,
    precedence, pile, pending_reason and evidence.  No live rule: pending.  A screen
    pile without an abstract: pending with reason no_text, unless `exempt`.
    """
    columns = columns or Pool()
    ready, columns = columns.prepared(pool, [r.match for r in rules])
    return columns.dropped(decide(match_flags(ready, rules, columns), rules, columns, exempt))


def decide(matched: DataFrame, rules: list[Rule], columns: Pool, exempt: Column | None = None) -> DataFrame:
    """What route() adds to rows with `matched`, which may come from more rules than these."""
    rules = sorted(rules, key=lambda r: (-r.precedence, r.id))
    own = F.array(*[F.lit(r.id) for r in rules if not r.shadow]).cast("array<string>")
    out = matched.withColumn("live", F.array_intersect(own, "matched"))
    rule = F.get("live", F.lit(0))
    pick = lambda f: F.coalesce(*[F.when(rule == r.id, F.lit(f(r))) for r in rules], F.lit(None))
    won = pick(lambda r: r.pile)
    no_text = won.isin(*SCREENS) & T.is_blank(columns.value("abstract")) & ~(F.coalesce(exempt, F.lit(False)) if exempt is not None else F.lit(False))
    shown = F.coalesce(*[F.when(rule == r.id, evidence(r.match, columns)) for r in rules], F.lit(None).cast("string"))
    return (
        out.withColumn("rule_id", rule).withColumn("precedence", pick(lambda r: r.precedence)).withColumn("evidence", shown)
        .withColumn("pile", F.when(won.isNull() | no_text, "pending").otherwise(won)).withColumn("pending_reason", F.when(F.coalesce(no_text, F.lit(False)), "no_text").otherwise(""))
    )


def route_two(pool: DataFrame, a: list[Rule], b: list[Rule], columns: Pool | None = None) -> DataFrame:
    """(work, pile_a, rule_a, pile_b, rule_b) under two bundles, every text read once.

    Rules of the same digest are evaluated once; a rule that the bundles give different
    contents is evaluated for each.
    """
    columns = columns or Pool()
    other = {r.id for r in a} & {r.id for r in b if r.digest not in {x.digest for x in a}}
    marked = [r if r.id not in other else replace(r, id=f"{r.id}\0b") for r in b]
    every = [*a, *[r for r in marked if r.id not in {x.id for x in a}]]
    ready, columns = columns.prepared(pool, [r.match for r in every])
    found = match_flags(ready, every, columns)
    first = decide(found, a, columns).withColumnsRenamed({"pile": "pile_a", "rule_id": "rule_a"})
    second = decide(first, marked, columns).withColumn("rule_id", F.substring_index("rule_id", "\0", 1))
    return second.select(columns.work, "pile_a", "rule_a", F.col("pile").alias("pile_b"), F.col("rule_id").alias("rule_b"))


def text_patterns(block: dict) -> list[str] | None:
    """Text patterns of which one matches wherever the block holds, or None if there are no such."""
    direct = [p for k in ("title_regex", "abstract_regex", "text_regex") for p in [block.get(k)] if p]
    if direct:
        return _listed(direct[0])
    for child in block.get("all_of", []):
        if found := text_patterns(child):
            return found
    if block.get("any_of"):
        parts = [text_patterns(child) for child in block["any_of"]]
        return None if any(p is None for p in parts) else [p for x in parts for p in x]
    return None


def fused_prefilter(rules: list[Rule]) -> str | None:
    """One pattern that matches the raw text of every work that any of the rules could match, or None."""
    parts = [text_patterns(r.match) for r in rules]
    if not parts or any(p is None for p in parts):
        return None
    return "|".join(f"(?:{loosen(p.removeprefix('(?i)'))})" for p in dict.fromkeys(p for x in parts for p in x))


def evaluations(routed: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, rule) of every match: absence is a no."""
    return routed.select(work, F.explode("matched").alias("rule_id"))


def unbeaten_shadows(matched: DataFrame, rules: list[Rule], work: str = "work_id") -> DataFrame:
    """(rule_id, work) of each match of a shadow rule whose work no live rule of higher precedence (ties by id) matches.

    Rows of the same work are one work; without a work's identifier nothing beats a shadow.
    """
    places = F.create_map(*[F.lit(x) for i, r in enumerate(sorted(rules, key=lambda r: (-r.precedence, r.id))) for x in (r.id, i)])
    of = lambda shadow: F.array_intersect("matched", F.array(*[F.lit(r.id) for r in rules if r.shadow == shadow]).cast("array<string>"))
    own = matched.select(work, F.array_min(F.transform(of(False), lambda r: F.element_at(places, r))).alias("live"), of(True).alias("shadows"))
    # a work's rows without any shadow may beat those of another row of it
    joined = own.groupBy(work).agg(F.min("live").alias("live"), F.flatten(F.collect_list(F.when(F.size("shadows") > 0, F.col("shadows")))).alias("shadows"))
    hits = joined.where(F.size("shadows") > 0).select(work, "live", F.explode("shadows").alias("rule_id"))
    unbeaten = F.col("live").isNull() | F.col(work).isNull() | (F.element_at(places, F.col("rule_id")) < F.col("live"))
    return hits.where(unbeaten).select("rule_id", work)


def as_table(spark, rules: list[Rule]) -> DataFrame:
    """The rules as rows: a bundle's size."""
    return spark.createDataFrame([(r.id, r.pile, r.precedence, r.shadow, r.vocabulary) for r in rules], "rule_id string, pile string, precedence int, shadow boolean, vocabulary string")
