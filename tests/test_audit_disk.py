"""An audit keeps and shuffles few and narrow rows, and finds the same."""

import random

import pytest
from screenloom.operators import audit
from screenloom.plans import standins

ROWS = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def kept(monkeypatch):
    """(columns, rows) of what is kept in the shared folder."""
    keep, sizes = audit.settled, []

    def count(df):
        out = keep(df)
        sizes.append((sorted(out.columns), out.count()))
        return out

    monkeypatch.setattr(audit, "settled", count)
    return sizes


@pytest.mark.parametrize("many", [1 << 20, 3])
def test_findings_among_few_rows_are_those_of_all(spark, many, monkeypatch):
    monkeypatch.setattr(audit.unfit_rows, "__defaults__", (many,))
    rng = random.Random(4)
    digests = [f"{i:032x}" for i in range(60)]
    pairs = [*digests, digests[3].upper(), " p", "p ", "p", "", " ", None, digests[7] + "0", " " + digests[9]]
    rows = [(rng.choice(pairs), f"10.1/{rng.choice('rR')}{rng.randint(0, 40)}", str(rng.randint(1, 3)), str(rng.randint(1, 3))) for _ in range(150)]
    for at, (k, ranks) in enumerate(((70, range(1, 71)), (71, [*range(1, 71), 70]), (64, range(1, 65)), (3, [1, 2, None]), (2, ["2.0", "1"]), (2, [0, 1]), (2, ["x", 1]), (1, [-1]))):
        rows += [(f"q{k}.{i}", f"10.2/p{at}", None if r is None else str(r), str(k)) for i, r in enumerate(ranks)]
    rows += [("n1", "10.3/n", "1", None), ("n2", "10.3/n", "2", "2"), ("n3", None, "1", "9"), ("n4", "", "1", "9")]
    rows = spark.createDataFrame(rows, "pair_id string, doi_r string, original_rank string, n_originals string")
    want = audit.group_findings(rows).selectExpr("pair_id", "doi_r", "inline(findings)")
    told = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert told(audit.findings_among(rows)) == told(audit.findings_among(rows, keep=False)) == told(want) != []


def test_audit_keeps_rows_that_may_be_repeated_only(spark, kept):
    rows = standins.extracted(spark, ROWS)
    found = audit.audit(rows, ratios=False)
    repeated = sum(r["check"] == "duplicate_pair_id" for r in found.collect())
    assert [c for c, _ in kept] == [["_pair", "doi_r", "pair_id"]] and repeated <= kept[0][1] < repeated + 20


def test_lines_are_counted_as_lines_and_only_where_asked(spark):
    rows = standins.extracted(spark, ROWS)
    assert "Window" not in plan(rows.select("pair_id", "title_r")) and "Join" not in plan(rows.select("pair_id"))
    counted = plan(rows.select("n_originals", "abstract_r"))
    assert "Join" not in counted and "We find" not in counted[counted.index("Window") :]


def test_concerns_keep_no_whole_rows(spark, kept):
    rows = standins.extracted(spark, ROWS)
    found = {r.concern: r.rows for r in audit.concerns(rows).collect()}
    assert [c for c, _ in kept] == [["_pair", "doi_r", "pair_id"]] and kept[0][1] < rows.count() / 4
    by = {r["check"]: r["count"] for r in audit.audit(rows, ratios=False).groupBy("check").count().collect()}
    by |= {f"set aside: {r.bucket}": r["count"] for r in audit.partition(rows).where("bucket IS NOT NULL").groupBy("bucket").count().collect()}
    gaps = {"empty title_r": "trim(title_r) = ''", "empty title_o": "title_o = ''", "unreadable year_r": "year_r = 'n.d.'"}
    assert found == by | {g: n for g, w in gaps.items() if (n := rows.where(w).count())}
