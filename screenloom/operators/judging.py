"""Screening tiers: recorded answers folded to decisions, and what decisions would change.

Answers of models are a table; nothing is asked here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

PROCEED, DISCARD, BYPASS = "proceed", "discard", "prescreen_bypass"
#: A text shorter than this is too short to judge, and the sources of curated lists.
SHORTEST, CURATED = 200, ("flora_list",)


def bypass(title: Column, abstract: Column, source: Column, signal: str, curated: tuple[str, ...] = CURATED, shortest: int = SHORTEST) -> Column:
    """Why a small model may not end a work, null if it may: it is on a curated list, its text is short, or it states the design outright."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(abstract, F.lit("")))
    return F.when(source.isin(*curated), "curated").when(F.length(T.trim_all(F.coalesce(abstract, F.lit("")))) < shortest, "short text").when(T.matches(text, signal), "signal")


def cheap_judge(works: DataFrame, answers: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, voter, verdict) of the votes that are asked for: works has `bypass`, answers (work, voter 1 or 2, verdict).

    A work with a bypass gets one vote, to proceed, of no model.  Voter 2 is asked only
    where voter 1 said no: after anything else a second answer changes nothing.  A missing
    or empty verdict is `no_answer`.
    """
    by = answers.groupBy(work).agg(F.max(F.when(F.col("voter") == 1, F.col("verdict"))).alias("one"), F.max(F.when(F.col("voter") == 2, F.col("verdict"))).alias("two"))
    said = lambda c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("no_answer"))
    vote = lambda voter, verdict: F.struct(F.lit(voter).alias("voter"), verdict.alias("verdict"))
    out = works.join(by, work, "left")
    votes = F.when(F.col("bypass").isNotNull(), F.array(vote(BYPASS, F.lit(PROCEED)))).when(said("one") == "no", F.array(vote("1", said("one")), vote("2", said("two")))).otherwise(F.array(vote("1", said("one"))))
    return out.select(work, F.explode(votes).alias("v")).select(work, "v.voter", "v.verdict")


def cheap_decision(votes: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, outcome): discard for two voters or more who all say no, else proceed; votes has one row per voter."""
    g = votes.groupBy(work).agg(F.countDistinct(F.when(F.col("verdict") == "no", F.col("voter"))).alias("noes"), F.count_if(F.col("verdict") != "no").alias("others"))
    return g.select(work, F.when((F.col("noes") >= 2) & (F.col("others") == 0), DISCARD).otherwise(PROCEED).alias("outcome"))


def expensive_decision(votes: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, outcome): discard where all of two voters or more say none; null where one voter only answered; else proceed."""
    g = votes.groupBy(work).agg(F.countDistinct("voter").alias("n"), F.count_if(F.col("verdict") != "none").alias("others"))
    return g.select(work, F.when(F.col("n") < 2, F.lit(None)).when(F.col("others") == 0, DISCARD).otherwise(PROCEED).alias("outcome"))


def tier_outcomes(verdicts: DataFrame, claims: DataFrame, release: str, work: str = "work_id") -> DataFrame:
    """(tier, work, outcome) recomputed from the permanent verdicts of a release's claims, whatever mode they were made in.

    verdicts: claim, tier, work, voter, verdict; claims: claim, tier, release_id.
    """
    own = verdicts.join(claims.where(F.col("release_id") == release).select("claim", "tier").distinct(), ["claim", "tier"], "left_semi")
    out = None
    for tier, decide in (("screen_cheap", cheap_decision), ("screen_expensive", expensive_decision)):
        one = decide(own.where(F.col("tier") == tier), work).select(F.lit(tier).alias("tier"), work, "outcome")
        out = one if out is None else out.unionByName(one)
    return out


def progress(works: DataFrame, votes: DataFrame, work: str = "work_id") -> DataFrame:
    """(work, state) of all works: untouched without a vote, incomplete while a voter that was asked has no answer, else decided."""
    g = votes.groupBy(work).agg(F.bool_or(F.col("verdict") == "no_answer").alias("open"))
    return works.select(work).join(g, work, "left").select(work, F.when(F.col("open").isNull(), "untouched").when(F.col("open"), "incomplete").otherwise("decided").alias("state"))


def would_discard(decisions: DataFrame, routing: DataFrame, work: str = "work_id") -> DataFrame:
    """(pile, works): how many works that a tier would discard lie in each pile that the rules chose."""
    gone = decisions.where(F.col("outcome") == DISCARD).select(work)
    return routing.join(gone, work, "left_semi").groupBy("pile").agg(F.count(F.lit(1)).alias("works"))


def cohorts(answers: DataFrame, known: dict[tuple[str, str], str], template: str = "template", model: str = "model") -> DataFrame:
    """answers with `cohort`, by the digest of the prompt's template and the model; `other` for those not known."""
    tag = F.lit("other")
    for (t, m), name in known.items():
        tag = F.when((F.col("template_hash") == t) & (F.col(model) == m), name).otherwise(tag)
    return answers.withColumn("template_hash", F.sha2(F.coalesce(F.col(template), F.lit("")), 256)).withColumn("cohort", tag)


def decision_flips(decisions: DataFrame, option: str = "option", work: str = "work_id", base: str = "base") -> DataFrame:
    """(option, works, gained, lost): against the option `base`, how many works each other one accepts anew or no longer; decisions: (work, option, accepted), a row each."""
    first = decisions.where(F.col(option) == base).select(work, F.col("accepted").alias("_was"))
    both = decisions.where(F.col(option) != base).join(first, work)
    return both.groupBy(option).agg(F.count(F.lit(1)).alias("works"), F.count_if(F.col("accepted") & ~F.col("_was")).alias("gained"), F.count_if(~F.col("accepted") & F.col("_was")).alias("lost"))
