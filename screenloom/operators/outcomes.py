"""Outcomes of studies from phrases in titles and abstracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.regex import to_java

UNKNOWN = "cannot_be_determined"


@dataclass(frozen=True)
class Phrases:
    """Patterns of the rule language, in the order in which they are tried: the first whose phrase is there decides.

    A failure counts only in a sentence that reports no explicit success.
    """

    failure: str
    explicit_success: str
    mixed: str
    success: str
    weak_failure: str
    descriptive: str

    def outcomes(self) -> list[tuple[str, str, str]]:
        """(outcome, confidence, pattern) of those after failure."""
        return [
            ("mixed", "medium", self.mixed), ("successful", "high", self.success),
            ("failed", "medium", self.weak_failure), ("descriptive only", "medium", self.descriptive),
        ]


#: The phrases by which replications report their outcome.
REPLICATION = Phrases(
    failure=r"\b(?:failed to replicate|replication failed|could not replicate|did not replicate|not replicated|no support for the original"
    r"|inconsistent with (?:the )?(?:original|prior)|results did not (?:hold|replicate)|null result|failed to reproduce|did not reproduce)\b",
    explicit_success=r"\b(?:successfully replicated|replication succeeded|results (?:were )?replicated|confirmed the (?:original|findings?|results?|effect)|supported the original"
    r"|consistent with (?:the )?(?:original|prior)|replication was successful|effect was reproduced|was (?:successfully )?replicated|replicated successfully)\b",
    mixed=r"\b(?:partially replicated|mixed results?|partial replication|some but not all|some (?:but not all|support)|nuanced|qualified support)\b",
    success=r"\b(?:successfully replicated|replication succeeded|results (?:were )?replicated|confirmed the (?:original|findings?|results?|effect)|supported the original"
    r"|consistent with (?:the )?(?:original|prior)|replication was successful|effect was reproduced|was (?:successfully )?replicated|replicated successfully)\b|\breplicated\b",
    weak_failure=r"\bno (?:evidence|significant (?:effect|difference))\b",
    descriptive=r"\b(?:adapted (?:the|this) (?:method|procedure|paradigm)|in a (?:different|new) (?:context|sample|culture|population)|not intended to test|not a direct test)\b",
)


def _place(sentences: Column, holds) -> Column:
    """From 1, the first sentence for which it holds; 0 if none does."""
    return F.coalesce(F.array_position(F.transform(sentences, holds), True), F.lit(0))


def _holds(pattern: str):
    # a sentence is short: its lower-case form would cost more than the pattern
    return lambda s: s.rlike(to_java(pattern))


def scan(df: DataFrame, text: str, phrases: Phrases = REPLICATION, name: str = "hit") -> DataFrame:
    """df with `name`: a struct (outcome, confidence, phrase), null without a phrase.

    phrase is the sentence with the phrase and up to two on each side.  Sentences are
    cut only in texts that have a phrase, and patterns that need a literal are tried only
    on texts with it.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_low", F.lower(whole))
    flags = [T.matches(whole, p, F.col("_low")).alias(f"f{i}") for i, p in enumerate([phrases.failure, *[p for _, _, p in phrases.outcomes()]])]
    df = df.withColumn("_has", F.struct(*flags))
    some = T.either([F.col("_has")[f"f{i}"] for i in range(len(flags))])
    df = df.withColumn("_cut", F.when(some, T.sentences(whole)))
    failed = _place(F.col("_cut"), lambda s: _holds(phrases.failure)(s) & ~_holds(phrases.explicit_success)(s))
    df = df.withColumn("_failed", F.when(F.col("_has")["f0"], failed).otherwise(0))
    hit = F.when(F.col("_failed") > 0, _hit("failed", "high", F.col("_failed")))
    for i, (outcome, confidence, pattern) in enumerate(phrases.outcomes(), 1):
        at = _place(F.col("_cut"), _holds(pattern))
        hit = hit.when(F.col("_has")[f"f{i}"], _hit(outcome, confidence, F.greatest(at, F.lit(1))))
    return df.withColumn(name, hit).drop("_low", "_has", "_cut", "_failed")


def _hit(outcome: str, confidence: str, at: Column) -> Column:
    return F.struct(F.lit(outcome).alias("outcome"), F.lit(confidence).alias("confidence"), T.sentence_context(F.col("_cut"), at).alias("phrase"))


def predict(df: DataFrame, record_type: str = "record_type", title: str = "title", abstract: str = "abstract", phrases: Phrases = REPLICATION) -> DataFrame:
    """df with outcome, outcome_confidence, outcome_phrase and outcome_source, by phrases alone.

    A reproduction's outcome has other words and can't be told.  A title counts only with
    a phrase of high confidence, an abstract with any; full texts are never scanned, as
    they tell of other studies' outcomes too.
    """
    out = scan(scan(df, title, phrases, "_title"), abstract, phrases, "_abstract")
    of_title = F.when(F.col("_title.confidence") == "high", F.struct("_title.outcome", "_title.confidence", "_title.phrase", F.lit("title").alias("source")))
    of_abstract = F.when(F.col("_abstract").isNotNull(), F.struct("_abstract.outcome", "_abstract.confidence", "_abstract.phrase", F.lit("abstract").alias("source")))
    reproduction = F.lower(F.trim(F.coalesce(F.col(record_type), F.lit("")))) == "reproduction"
    none = F.struct(F.lit(UNKNOWN).alias("outcome"), F.lit("low").alias("confidence"), F.lit("").alias("phrase"), F.lit("").alias("source"))
    out = out.withColumn("_hit", F.when(reproduction, none).otherwise(F.coalesce(of_title, of_abstract, none)))
    return out.select("*", F.col("_hit.outcome").alias("outcome"), F.col("_hit.confidence").alias("outcome_confidence"), F.col("_hit.phrase").alias("outcome_phrase"), F.col("_hit.source").alias("outcome_source")).drop("_title", "_abstract", "_hit")
