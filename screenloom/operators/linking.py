"""Links between works as rows: verification of identifiers, guards, types, endings, votes and what is handed on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import documents as D
from ..functions import text as X
from . import audit

#: Titles alike from here describe one work, years may differ by so much; methods that need no original, or resolved one.
SAME_TITLE, YEARS_APART = 0.5, 1
WITHOUT_ORIGINAL = ("target_pending", "api_error", "no_original_found", "not_a_replication", "screen_disagreement", "prescreen_discard")
#: Columns that describe an original, blanked when it is rejected.
ORIGINAL = ("doi_o", "study_o", "study_r", "title_o", "year_o", "authors_o", "ref_o", "bibtex_ref_o", "oa_work_id_o")
#: Verdicts with substance, what else there is in order of what it tells, and the axes of a reproduction.
SUBSTANTIVE, FALLBACKS, UNSETTLED = ("successful", "failed", "mixed", "statistically successful but flawed"), ("uninformative", "descriptive only", "not_a_replication"), "cannot_be_determined"
COMPUTATION, ROBUSTNESS = ("computationally reproducible", "computational issues", "technical failure", "not checked"), ("robust", "robustness challenges", "not checked")
NO_DOCUMENT, EVIDENCE_SEP = "multi_target_no_document: reference-list link without full text", " || "
#: Piles handed on, in this order.
PILES = ("screen_expensive", "screen_cheap")


def said(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def noted(evidence: Column, note: Column) -> Column:
    """Evidence with a note behind it."""
    return F.when(evidence != "", F.concat(evidence, F.lit(" | "), note)).otherwise(note)


def with_columns(df: DataFrame, when: Column, **values: Column | str) -> DataFrame:
    """df with these columns replaced where `when` holds; a column that isn't there is made, empty elsewhere."""
    new = {c: F.when(when, F.lit(v) if isinstance(v, str) else v).otherwise(F.col(c) if c in df.columns else F.lit("")) for c, v in values.items()}
    return df.withColumns(new)


# verification ---------------------------------------------------------------------------------


def describes(title: Column, year: Column, meta_title: Column, meta_year: Column) -> Column:
    """Do a registry's title and year describe the work meant?  Titles alike, years close or unknown."""
    words = lambda c: X.title_words(F.coalesce(c, F.lit("")))
    a, b = X.year_number(year), X.year_number(meta_year)
    return (X.trim_all(F.coalesce(title, F.lit(""))) != "") & (X.jaccard(words(title), words(meta_title)) >= SAME_TITLE) & F.coalesce(F.abs(a - b) <= YEARS_APART, F.lit(True))


def verify(rows: DataFrame, registry: DataFrame, searches: DataFrame, key: str = "row_key") -> DataFrame:
    """rows with doi_o, doi_o_verification and `note` as the registry and searches by metadata say.

    rows: key, doi_o, title_o, year_o.  registry: doi, registered, title, year, surname, a row
    for each identifier that was looked up and answered.  searches: key, tier (0 the strictest),
    answered, doi, ident, title: a row for each search that was made; no doi and no ident: it
    found nothing.  The first tier that found something counts; a search without answer says
    nothing, so that a work isn't called missing because of it.
    """
    meta = registry.select(X.clean_doi(F.col("doi")).alias("_doi"), F.struct("registered", "title", "year", "surname").alias("_meta")).dropDuplicates(["_doi"])
    hit = (F.coalesce("doi", F.lit("")) != "") | (F.coalesce("ident", F.lit("")) != "")
    found = searches.groupBy(key).agg(F.min_by(F.struct(F.coalesce(X.clean_doi(F.col("doi")), F.lit("")).alias("doi"), F.coalesce("ident", F.lit("")).alias("ident"), F.coalesce("title", F.lit("")).alias("title")), F.when(hit & F.col("answered"), F.col("tier"))).alias("_found"), F.bool_or(~F.col("answered")).alias("_silent"))
    out = rows.withColumn("_doi", F.coalesce(X.clean_doi(said("doi_o")), F.lit(""))).join(meta, "_doi", "left").join(found, key, "left")
    doi, title, m, f = F.col("_doi"), X.trim_all(said("title_o")), F.col("_meta"), F.col("_found")
    silent, registered = F.coalesce("_silent", F.lit(False)), F.coalesce(m["registered"], F.lit(False))
    matched = registered & describes(F.col("title_o"), F.col("year_o"), m["title"], m["year"])
    told = lambda status, new, *note: F.struct(F.lit(status).alias("status"), new.alias("doi"), F.concat(*[F.coalesce(n, F.lit("")) if isinstance(n, Column) else F.lit(n) for n in (note or ("",))]).alias("note"))
    nothing = F.lit("")
    with_doi = (
        F.when(m.isNull(), told("api_error", doi, "DOI verification failed: no registry answered")).when(matched, told("verified", doi))
        .when(f.isNull() & silent, told("api_error", doi, "DOI verification incomplete: a search wasn't answered"))
        .when(f["doi"] == doi, told("verified", doi, "DOI confirmed by search; year or author of the row differ (", m["year"].cast("string"), ", ", m["surname"], ")"))
        .when(f["doi"] != "", told("corrected", f["doi"], "DOI corrected: ", doi, F.when(registered, " pointed to a different work").otherwise(" is not registered"), "; replaced with ", f["doi"], " (", f["title"], ")"))
        .when(f.isNotNull(), told("no_doi", nothing, "DOI removed: ", doi, " did not match; original exists without a DOI (", f["ident"], ")"))
        .when(registered, told("mismatch", doi, "DOI mismatch: ", doi, " points to ", m["title"], " (", m["year"].cast("string"), "), not ", title))
        .otherwise(told("no_metadata", doi, "DOI ", doi, " is not registered and no replacement was found"))
    )
    without = (
        F.when(title == "", told("skipped", nothing)).when(f.isNull() & silent, told("api_error", nothing, "DOI search incomplete: a search wasn't answered"))
        .when(f["doi"] != "", told("corrected", f["doi"], "DOI filled from search: ", f["doi"])).when(f.isNotNull(), told("no_doi", nothing, "Original has no registered DOI (", f["ident"], ")"))
        .otherwise(told("not_found", nothing, "No DOI found for title and author"))
    )
    out = out.withColumn("_v", F.when(doi != "", with_doi).otherwise(without))
    return out.withColumns({"doi_o_verification": F.col("_v.status"), "doi_o": F.col("_v.doi"), "note": F.col("_v.note")}).drop("_v", "_doi", "_meta", "_found", "_silent")


def keeps_no_doi(new: Column, prior: Column, work_id: Column) -> Column:
    """Does a recorded no_doi stay, as a search for DOIs can't find a work that has none?"""
    return new.isin("not_found", "api_error") & (prior == "no_doi") & X.work_id(work_id).isNotNull()


# guards ---------------------------------------------------------------------------------------


def guard_links(rows: DataFrame, found: DataFrame | None = None, resolved: list[str] | None = None, key: str = "row_key") -> DataFrame:
    """rows whose original is the work itself, or nothing that can be told, set back; DOIs that a title search found, filled in.

    rows: key, doi_r, doi_o, title_r, title_o, oa_work_id_r, oa_work_id_o, link_method,
    link_evidence, link_confidence, doi_o_verification and further columns of ORIGINAL.
    found: key, doi, ident, what a search for the title of a row without a DOI returned.
    A rejected row is target_pending, its original blank.  One that has no DOI but a usable
    title stays, as no_doi; with neither DOI nor work it is unidentified_original if its
    method (in `resolved`; default: any) claims to have resolved one.
    """
    found = found if found is not None else rows.sparkSession.createDataFrame([], T.StructType([rows.schema[key], T.StructField("doi", T.StringType()), T.StructField("ident", T.StringType())]))
    hits = found.groupBy(key).agg(F.min_by(F.struct("doi", "ident"), F.struct("doi", "ident")).alias("_hit"))
    out = rows.join(hits, key, "left")
    clean = lambda c: F.coalesce(X.clean_doi(c), F.lit(""))
    work = lambda c: F.coalesce(X.work_id(c).cast("string"), F.lit(""))
    out = out.withColumns({"_r": clean(said("doi_r")), "_o": clean(said("doi_o")), "_wr": work(said("oa_work_id_r")), "_wo": work(said("oa_work_id_o")), "_fd": clean(F.col("_hit.doi")), "_fw": work(F.coalesce("_hit.ident", F.lit(""))), "_use": D.usable_title(said("title_o")), "_same": (X.title_fingerprint(said("title_o")) != "") & (X.title_fingerprint(said("title_o")) == X.title_fingerprint(said("title_r")))})
    out = out.withColumn("_fd", F.when(audit.non_article(F.col("_fd")) == "", F.col("_fd")).otherwise(""))
    r, o, blank = F.col("_r"), F.col("_o"), F.col("_o") == ""
    own = lambda doi, ident: F.when((doi != "") & (doi == r), "resolved original is the replication itself (same DOI)").when((ident != "") & (ident == F.col("_wr")), "resolved original is the replication itself (same work)").when(F.col("_same"), "resolved original has the same title as the replication")
    filled = blank & F.col("_use") & (F.col("_fd") != "")
    ident = F.when(F.col("_use") & (F.col("_fw") != ""), F.col("_fw")).otherwise(F.col("_wo"))
    reason = (
        F.when(own(o, F.lit("")).isNotNull(), own(o, F.lit("")))
        .when(filled & own(F.col("_fd"), F.col("_fw")).isNotNull(), F.concat(F.lit("recovered DOI is a self-link: "), own(F.col("_fd"), F.col("_fw"))))
        .when(blank & ~filled & ~F.col("_use"), "no doi_o and no usable title_o")
        .when(blank & ~filled & (ident != "") & (ident == F.col("_wr")), "title-search hit is a self-link: same work")
    )
    out = out.withColumn("_reason", F.when(~said("link_method").isin(*WITHOUT_ORIGINAL), reason)).withColumn("_ident", ident).withColumn("_filled", filled)
    open_ = ~said("link_method").isin(*WITHOUT_ORIGINAL)
    bad = F.col("_reason").isNotNull()
    claims = F.lit(True) if resolved is None else said("link_method").isin(*resolved)
    bare = open_ & ~bad & (F.col("_o") == "") & ~F.col("_filled")
    lost = bare & (F.col("_ident") == "") & claims
    out = out.withColumns({"_bad": bad, "_take": open_ & ~bad & F.col("_filled"), "_bare": bare, "_lost": lost})
    out = with_columns(out, F.col("_take"), doi_o=F.col("_fd"), oa_work_id_o="", pair_id=X.pair_id(r, F.col("_fd")))
    out = with_columns(out, F.col("_bare"), doi_o_verification="no_doi", oa_work_id_o=F.when(F.col("_ident") != "", F.concat(F.lit("W"), "_ident")).otherwise(said("oa_work_id_o")))
    out = with_columns(out, F.col("_lost"), link_method="unidentified_original", link_confidence="low", link_evidence=noted(said("link_evidence"), F.lit("the named original has neither a DOI nor a work: kept for review")))
    out = with_columns(out, F.col("_bad"), link_method="target_pending", doi_o_verification="skipped", link_confidence="low", link_evidence=noted(said("link_evidence"), F.concat(F.lit("rejected: "), "_reason")), **{c: "" for c in ORIGINAL if c in rows.columns})
    return out.drop("_hit", "_r", "_o", "_wr", "_wo", "_fd", "_fw", "_use", "_same", "_reason", "_ident", "_filled", "_bad", "_take", "_bare", "_lost")


def demote_reference_only(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows of groups of several, linked from a list of references alone and without a document: low confidence, and a note that says so."""
    many = rows.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("_many"))
    low = F.col("_many") & (said("link_method") == "llm_references") & (F.trim(said("pdf_source")) == "")
    out = rows.join(many, keys).withColumn("_low", low)
    return with_columns(out, F.col("_low"), link_confidence="low", link_evidence=noted(said("link_evidence"), F.lit(NO_DOCUMENT))).drop("_many", "_low")


# types, endings, outcomes ----------------------------------------------------------------------


def record_type(screen_type: Column, screened: Column, paper_type: Column) -> Column:
    """The screen's type; else the paper's, if it is one; else empty where a screen left it open, and replication where none ran."""
    kind = F.lower(F.trim(F.coalesce(paper_type, F.lit(""))))
    return F.when(screened & (F.coalesce(screen_type, F.lit("")) != ""), screen_type).when(kind.isin("replication", "reproduction"), kind).when(screened, "").otherwise("replication")


def front_door(method: Column, verdict: Column) -> Column:
    """How a screen ends a paper: target_pending for one vote, api_error for none, not_a_replication for a discard; null: it goes on."""
    return F.when(method == "llm_refscreen_partial", "target_pending").when(method == "llm_refscreen_failed", "api_error").when(verdict == "discard", "not_a_replication")


def fold_outcomes(df: DataFrame, keys: list[str], outcome: str = "outcome") -> DataFrame:
    """One outcome of several studies: two substantive ones that differ are mixed, one counts whatever else there is, else the most telling of the rest."""
    c = F.col(outcome)
    real = F.when(c.isin(*SUBSTANTIVE), c)
    sums = df.groupBy(*keys).agg(F.min(real).alias("_lo"), F.max(real).alias("_hi"), *[F.coalesce(F.bool_or(c == f), F.lit(False)).alias(f"_f{i}") for i, f in enumerate(FALLBACKS)])
    rest = F.coalesce(*[F.when(F.col(f"_f{i}"), f) for i, f in enumerate(FALLBACKS)], F.lit(UNSETTLED))
    return sums.select(*keys, F.when(F.col("_lo") != F.col("_hi"), "mixed").otherwise(F.coalesce("_lo", rest)).alias(outcome))


def reproduction_outcome(computation: Column, robustness: Column) -> Column:
    """Both axes, or unsettled if either is, or is no value of its axis."""
    a, b = (F.trim(F.coalesce(c, F.lit(""))) for c in (computation, robustness))
    return F.when(a.isin(*COMPUTATION) & b.isin(*ROBUSTNESS), F.concat_ws(", ", a, b)).otherwise(UNSETTLED)


# votes ------------------------------------------------------------------------------------------


def parse_votes(c: Column) -> Column:
    """array<struct<model, classification, confident>> of `model=class/confident|...`, in order; parts without = are left out."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda p: p.contains("="))
    answer = lambda p: F.regexp_extract(p, r"(?s)=(.*)\z", 1)
    cut = lambda a: F.regexp_extract(a, r"(?s)\A(.*)/[^/]*\z", 1)
    return F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("model"), F.lower(F.trim(cut(answer(p)))).alias("classification"), (F.trim(F.substring_index(answer(p), "/", -1)) == "confident").alias("confident")))


def format_votes(votes: Column) -> Column:
    """The text that parse_votes reads."""
    return F.array_join(F.transform(votes, lambda v: F.concat(F.coalesce(v["model"], F.lit("")), F.lit("="), F.coalesce(v["classification"], F.lit("")), F.when(v["confident"], "/confident").otherwise("/unconfident"))), "|")


def format_evidence(votes: Column, sep: str = EVIDENCE_SEP) -> Column:
    """`model: quote` of every vote with a quote, in order."""
    parts = F.transform(votes, lambda v: F.struct(F.trim(F.coalesce(v["model"], F.lit(""))).alias("m"), F.trim(F.coalesce(v["quote"], F.lit(""))).alias("q")))
    return F.array_join(F.transform(F.filter(parts, lambda p: p["q"] != ""), lambda p: F.when(p["m"] != "", F.concat(p["m"], F.lit(": "), p["q"])).otherwise(p["q"])), sep)


# what is handed on -----------------------------------------------------------------------------


def hand_on(rows: DataFrame, decisions: DataFrame, screened_only: bool = False) -> DataFrame:
    """Rows of PILES with what the screens decided, in order: pile_order and the columns of the screen.

    rows: work_id, pile, paper_type, filter_method; decisions: work_id, tier (expensive or
    cheap), outcome (proceed, discard or another, which settles nothing), record_type, votes
    (of parse_votes, with quote).  An expensive discard drops a work, a cheap one only where no
    expensive verdict is; a record type replaces the paper's.  screened_only: works without an
    expensive verdict stay behind.
    """
    settled = decisions.where(F.col("outcome").isin("discard", "proceed"))
    best = settled.groupBy("work_id").agg(F.min_by(F.struct("tier", "outcome", "record_type", "votes"), F.when(F.col("tier") == "expensive", 0).otherwise(1)).alias("_d"))
    out = rows.where(F.col("pile").isin(*PILES)).join(best, "work_id", "left").where(F.coalesce(F.col("_d.outcome") != "discard", F.lit(True)))
    own = F.coalesce(F.col("_d.tier") == "expensive", F.lit(False))
    out = out.where(own) if screened_only else out
    kind = F.when(own, F.coalesce("_d.record_type", F.lit(""))).otherwise("")
    given = lambda c: F.when(own, c).otherwise("")
    order = F.array_position(F.array(*map(F.lit, PILES)), F.col("pile")).cast("int")
    return out.withColumns({
        "pile_order": order, "screen_verdict": given(F.col("_d.outcome")), "screen_record_type": kind, "screen_votes": given(F.coalesce(format_votes(F.col("_d.votes")), F.lit(""))), "screen_evidence": given(F.coalesce(format_evidence(F.col("_d.votes")), F.lit(""))),
        "paper_type": F.when(kind != "", kind).otherwise(F.col("paper_type")), "filter_method": F.when(kind != "", "screen").otherwise(F.col("filter_method")),
    }).drop("_d")


def plan_supersession(diffs: DataFrame, sent: DataFrame) -> DataFrame:
    """(work_id, kind, old_pile, new_pile, record_ids, n_validated, n_unvalidated) of works whose pile changed after records of them were sent.

    diffs: work_id, old_pile, new_pile; sent: work_id, record_id, validated.  withdrawal: the
    work is discarded now; else reroute.  Works without records need none.
    """
    records = sent.where("record_id IS NOT NULL").groupBy("work_id").agg(F.array_sort(F.collect_set("record_id")).alias("record_ids"), F.count_if(F.coalesce("validated", F.lit(False))).alias("n_validated"), F.count_if(~F.coalesce("validated", F.lit(False))).alias("n_unvalidated"))
    kind = F.when(F.col("new_pile") == "discard", "withdrawal").otherwise("reroute")
    return diffs.join(records, "work_id").select("work_id", kind.alias("kind"), "old_pile", "new_pile", "record_ids", "n_validated", "n_unvalidated")


def pair_side(doi: Column, work: Column, title: Column) -> Column:
    """What stands for a work in a pair: its DOI, else its work, else its title, else nothing."""
    ident, name = X.work_id(F.coalesce(work, F.lit(""))).cast("string"), F.lower(F.regexp_replace(X.trim_all(F.coalesce(title, F.lit(""))), r"(?U)\s+", " "))
    return F.when(F.coalesce(doi, F.lit("")) != "", doi).when(ident.isNotNull(), F.concat(F.lit("oa:W"), ident)).when(name != "", F.concat(F.lit("t:"), name)).otherwise("")


def render_payload(stored: DataFrame, payload: str, inputs: list[str], columns: list[str], renamed: dict[str, str] | None = None) -> DataFrame:
    """A row for each target of a stored payload {input: {...}, targets: [{...}]}: the other columns of `stored`, `at` (from 0) and `columns` as texts.

    A target's value stands before the input's, of which only `inputs` are taken; columns under
    an old name are read under today's, unless that has a value.  A pair_id made without
    anything for a replication without a DOI is made anew, where its original is beyond doubt.
    Payloads that can't be read, or have no targets, give no rows.
    """
    parsed = F.from_json(payload, "input map<string,string>, targets array<map<string,string>>")
    rest = [c for c in stored.columns if c != payload and c not in columns]
    rows = stored.withColumn("_p", parsed).select(*rest, F.col("_p.input").alias("_in"), F.posexplode("_p.targets").alias("at", "_t"))
    old = {new: [o for o, n in (renamed or {}).items() if n == new] for new in set((renamed or {}).values())}
    held = lambda side, c: F.coalesce(*[F.nullif(F.try_element_at(F.col(side), F.lit(n)), F.lit("")) for n in [c, *old.get(c, [])]])
    made = {c: F.coalesce(held("_t", c), held("_in", c) if c in inputs else F.lit(None), F.lit("")) for c in columns}
    rows = rows.select(*rest, "at", *[v.alias(c) for c, v in made.items()])
    need = {"pair_id", "doi_r", "doi_o", "oa_work_id_o", "title_o", "oa_work_id_r", "title_r"}
    if need <= set(columns):
        sure = (F.col("doi_o") != "") | ((F.col("oa_work_id_o") == "") & (F.col("title_o") == ""))
        again = X.pair_id(pair_side(F.col("doi_r"), F.col("oa_work_id_r"), F.col("title_r")), F.col("doi_o"))
        rows = rows.withColumn("pair_id", F.when((F.col("doi_r") == "") & sure, again).otherwise(F.col("pair_id")))
    return rows
