"""Citations of a text: what all forms need is looked at once."""

from pyspark.sql import functions as F

from screenloom.operators import citations


def test_a_year_is_looked_for_once_for_all_forms(spark):
    """Each of the forms looked for it four times before its own pattern was tried."""
    docs = spark.createDataFrame([(1, "See Holm et al. 1999, Ritter & Zwei (2001) and de la Cruz's (2003, Study 2) view."), (2, None), (3, "No year, Holm et al.")], "id int, text string")
    found = citations.find_citations(docs, "id", "text")
    assert [(r.id, r.pattern, r.start, r.surname, r.year) for r in found.orderBy("n").collect()] == [(1, "others_plain", 4, "holm", 1999), (1, "pair_bracketed", 22, "ritter", 2001), (1, "one_bracketed", 47, "delacruz", 2003)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("(?:19|20)[0-9]{2}") <= 2
    refs = spark.createDataFrame([(1, 7, None, "", 2000, ["Holms"]), (1, 8, None, "", 2003, ["Else"])], "id int, ref_id int, doi string, title string, year int, surnames array<string>")
    got = citations.find_candidates(found.withColumn("doi_self", F.lit(None).cast("string")), refs, "id").collect()
    assert [(r.ref_id, r.match_year_exact) for r in got] == [(7, False)]
