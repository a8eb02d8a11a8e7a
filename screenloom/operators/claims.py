"""Claims on works as an append-only log of events, folded to their state.

One writer appends; two writers at once aren't told apart, as files have no locks.
An event: claim, tier, kind (claim, renew, release, finish), works, at, expires_at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settled
from . import running
from .candidates import same_by_either

SCHEMA = "claim string, tier string, kind string, works array<long>, at timestamp, expires_at timestamp"
#: Where a verdict's raw response is.
PENDING, UPLOADED = "response_pending_upload", "uploaded"
STATES = {"claim": "active", "renew": "active", "release": "released", "finish": "finished"}


class Conflict(ValueError):
    """Works of a batch are claimed already; the whole batch is refused."""


def state(events: DataFrame) -> DataFrame:
    """(claim, tier, works, state, expires_at): the last event's state; a renewal never shortens the lease."""
    last = F.max_by("kind", F.struct("at", F.col("kind") != "claim"))
    named = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    return events.groupBy("claim").agg(F.min_by("tier", "at").alias("tier"), F.min_by("works", F.struct("at", F.col("kind") != "claim")).alias("works"), F.try_element_at(named, last).alias("state"), F.max("expires_at").alias("expires_at"))


def live(events: DataFrame, tier: str, at: str) -> DataFrame:
    """(work, claim) of active, unexpired claims of a tier."""
    now = F.lit(at).cast("timestamp")
    return state(events).where((F.col("tier") == tier) & (F.col("state") == "active") & (F.col("expires_at") > now)).select(F.explode("works").alias("work"), "claim")


def claim(events: DataFrame, batch: DataFrame, claim: str, tier: str, at: str, hours: int = 6) -> DataFrame:
    """The event that claims the batch's works (column `work`); raises Conflict if any is claimed.  A batch is bounded by who asks for it."""
    held = batch.join(live(events, tier, at), "work", "left_semi").limit(5).collect()
    if held:
        raise Conflict(f"claimed already: {', '.join(str(r.work) for r in held)}")
    works = F.array_sort(F.collect_set("work"))
    now = F.lit(at).cast("timestamp")
    return batch.agg(works.alias("works")).select(F.lit(claim).alias("claim"), F.lit(tier).alias("tier"), F.lit("claim").alias("kind"), "works", now.alias("at"), (now + F.make_interval(hours=F.lit(hours))).alias("expires_at"))


def conflicts(batch: DataFrame, events: DataFrame, tier: str, at: str) -> DataFrame:
    """(work, claim) of a batch's works that live claims of the tier hold."""
    return batch.select("work").distinct().join(live(events, tier, at), "work")


def expired(events: DataFrame, at: str) -> DataFrame:
    """(claim, tier, expires_at, n_works) of claims whose lease ran out while they were active."""
    out = state(events).where((F.col("state") == "active") & (F.col("expires_at") <= F.lit(at).cast("timestamp")))
    return out.select("claim", "tier", "expires_at", F.size("works").cast("long").alias("n_works"))


def stale(verdicts: DataFrame, questions: DataFrame) -> DataFrame:
    """verdicts with `reason` of those whose question isn't today's any more.

    verdicts: work_id, question_hash, at and more, a row each; questions: work_id,
    question_hash, text_at.  A verdict that recorded its question is judged by that; one that
    didn't by the text: it is stale if the text was fetched after it.  Works without a question
    today have no stale verdicts.
    """
    today = questions.select("work_id", F.col("question_hash").alias("_now"), F.col("text_at").alias("_text_at"))
    had = F.coalesce(F.col("question_hash"), F.lit("")) != ""
    reason = F.when(had & (F.col("question_hash") != F.col("_now")), "question moved").when(~had & (F.col("_text_at") > F.col("at")), "text is newer")
    return verdicts.join(today, "work_id").withColumn("reason", reason).where("reason IS NOT NULL").drop("_now", "_text_at")


#: Columns of a verdict that may change once it is written.
MUTABLE = ("superseded_by", "response_state", "response_hash")


def tampered(before: DataFrame, after: DataFrame, key: str = "id", mutable: tuple[str, ...] = MUTABLE) -> DataFrame:
    """(key, what) of verdicts that were deleted, or changed in a column that is permanent: `deleted`, or the columns in order, by comma."""
    fixed = [c for c in before.columns if c != key and c not in mutable and c in after.columns]
    now = after.select(key, F.struct(F.lit(True).alias("there"), *fixed).alias("_now"))
    both = before.join(now, key, "left")
    moved = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col("_now")[c]), c) for c in fixed]).cast("array<string>"))
    return both.select(key, F.when(F.col("_now").isNull(), "deleted").when(F.size(moved) > 0, F.array_join(moved, ",")).alias("what")).where("what IS NOT NULL")


def reconcile(verdicts: DataFrame, blobs: DataFrame, key: str = "id") -> DataFrame:
    """(response_hash, verdicts, first, present) of responses still pending: how many verdicts name each, and is it among the blobs (response_hash)?"""
    pending = verdicts.where((F.col("response_state") == PENDING) & (F.coalesce(F.col("response_hash"), F.lit("")) != ""))
    named = pending.groupBy("response_hash").agg(F.count(F.lit(1)).alias("verdicts"), F.min(key).alias("first"))
    there = blobs.select("response_hash").distinct().withColumn("_there", F.lit(True))
    return named.join(there, "response_hash", "left").select("response_hash", "verdicts", "first", F.col("_there").isNotNull().alias("present"))


def follow(events: DataFrame, claim: str, kind: str, at: str, hours: int = 6) -> DataFrame:
    """The event that renews, releases or finishes an active claim; raises if it is over or, for a renewal, expired."""
    row = state(events.where(F.col("claim") == claim)).first()
    now = F.lit(at).cast("timestamp")
    if row is None or row.state != "active":
        raise ValueError(f"claim {claim} isn't active")
    if kind == "renew" and state(events.where(F.col("claim") == claim)).where(F.col("expires_at") <= now).count():
        raise ValueError(f"claim {claim} has expired")
    one = events.where((F.col("claim") == claim) & (F.col("kind") == "claim")).limit(1)
    end = F.when(F.lit(kind == "renew"), now + F.make_interval(hours=F.lit(hours))).otherwise(F.col("expires_at"))
    return one.select("claim", "tier", F.lit(kind).alias("kind"), "works", now.alias("at"), F.greatest("expires_at", end).alias("expires_at"))


def generation_classes(pairs: DataFrame) -> DataFrame:
    """(generation, class): generations that declared pairs (a, b) make equivalent, in however many steps; the class is the smallest of them.

    A generation that no pair names is a class by itself and isn't listed.
    """
    links = settled(pairs.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b", (2 * F.monotonically_increasing_id()).alias("pair")))
    ends = links.select(F.col("a").alias("generation"), F.col("pair").cast("string").alias("pair"), F.col("pair").alias("row")).unionByName(links.select(F.col("b").alias("generation"), F.col("pair").cast("string").alias("pair"), (F.col("pair") + 1).alias("row")))
    rows = same_by_either(ends, [], ["pair", "generation"], "row")
    least = rows.groupBy("group").agg(F.min("generation").alias("class"))
    return rows.join(least, "group").select("generation", "class").distinct()


def answering(verdicts: DataFrame, classes: DataFrame, generation: str) -> DataFrame:
    """Verdicts of a generation, or of one declared equivalent to it, that still answer what it asks."""
    own = classes.where(F.col("generation") == generation).select("class")
    accepted = classes.join(own, "class", "left_semi").select("generation").union(verdicts.sparkSession.createDataFrame([(generation,)], "generation string")).distinct()
    return verdicts.join(accepted, "generation", "left_semi")


def affordable(works: DataFrame, cost: str, order: list[str], bound: int, spent: int = 0) -> DataFrame:
    """works with spent_before and `decided`: in this order each is decided as long as what was spent before it is below the bound.

    The last one may cross the bound, as its cost is known afterwards only; null costs are
    free, a negative cost is none.  The order should be total, or ties are in any order.
    """
    charged = works.withColumn("_cost", F.greatest(F.coalesce(F.col(cost), F.lit(0)), F.lit(0)))
    total = running.in_order(charged, order).running(_through=F.col("_cost")).done()
    before = F.col("_through") - F.col("_cost") + spent
    return total.withColumn("spent_before", before).withColumn("decided", F.col("spent_before") < bound).drop("_cost", "_through")


def mark_uploaded(verdicts: DataFrame, stored: DataFrame) -> DataFrame:
    """Verdicts whose response is pending and whose hash is among those stored (response_hash) as uploaded; all others as they are."""
    hashes = stored.select("response_hash").where(F.col("response_hash").isNotNull() & (F.col("response_hash") != "")).distinct().withColumn("_stored", F.lit(True))
    moved = F.col("_stored").isNotNull() & (F.col("response_state") == PENDING)
    return verdicts.join(hashes, "response_hash", "left").withColumn("response_state", F.when(moved, UPLOADED).otherwise(F.col("response_state"))).select(*verdicts.columns)


def select_verdicts(verdicts: DataFrame, claims: DataFrame, mode: str | None = None, generation: str | None = None, kinds: list[str] | None = None, superseded: bool = False) -> DataFrame:
    """Verdicts with their claim's mode and generation, of the given mode, generation and kinds of verdict; superseded ones only if asked for.

    verdicts: claim, verdict, superseded_by; claims: claim, mode, generation.  A verdict
    whose claim is unknown has neither and is left out where either is asked for.
    """
    out = verdicts.join(claims.select("claim", "mode", "generation"), "claim", "left")
    if mode is not None:
        out = out.where(F.col("mode") == mode)
    if generation is not None:
        out = out.where(F.col("generation") == generation)
    if kinds is not None:
        out = out.where(F.col("verdict").isin(kinds))
    return out if superseded else out.where("superseded_by IS NULL")


def verdict_rows(verdicts: DataFrame) -> DataFrame:
    """Verdicts with the content hash of their response."""
    return verdicts.withColumn("response_hash", F.sha2("response", 256)).drop("response")


def supersede(verdicts: DataFrame, replaced: DataFrame) -> DataFrame:
    """Verdicts with superseded_by from (id, by); set once, it stays."""
    return verdicts.join(replaced.select("id", "by"), "id", "left").withColumn("superseded_by", F.coalesce("superseded_by", "by")).drop("by")


@dataclass(frozen=True)
class Tier:
    """A screening tier: its name, the piles it reads, how it judges works and decides on votes."""

    name: str
    piles: tuple[str, ...]
    judge: Callable[[DataFrame], DataFrame]
    decide: Callable[[DataFrame], DataFrame]
    generation: str = ""


_TIERS: dict[str, Tier] = {}


def register_tier(tier: Tier) -> Tier:
    if tier.name in _TIERS:
        raise ValueError(f"tier {tier.name} is registered")
    _TIERS[tier.name] = tier
    return tier


def tier(name: str) -> Tier:
    if name not in _TIERS:
        raise LookupError(f"no tier {name}; there are {', '.join(sorted(_TIERS)) or 'none'}")
    return _TIERS[name]


def run_tier(name: str, routed: DataFrame, decided: DataFrame, budget: int | None = None, cost: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Votes and decisions of a tier on its piles' works that aren't decided.

    budget: what their `cost` may come to; in `order` (work_id) works are judged until it is
    spent, and the rest stay undecided for the next run.
    """
    t = tier(name)
    todo = routed.where(F.col("pile").isin(*t.piles)).join(decided.select("work_id"), "work_id", "left_anti")
    if budget is not None:
        todo = affordable(todo, cost or "cost", order or ["work_id"], budget).where("decided").drop("decided", "spent_before")
    return t.decide(t.judge(todo))
