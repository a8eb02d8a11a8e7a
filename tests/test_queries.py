"""Every registered query with SQL gives the rows that DuckDB gives."""

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _names():
    from screenloom.plans import catalogue

    return sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.mark.parametrize("name", _names())
def test_query(spark, duck, name):
    from screenloom.plans import catalogue

    frame = catalogue.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in frame.collect())
    if name not in catalogue.ORACLE_SQL:
        return
    result = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in result.fetchall())


def test_queries_without_sql(spark):
    """Those that SQL can't express, against their function on every row."""
    from screenloom.functions import parse
    from screenloom.plans import catalogue, standins

    works = {r.work_id: r for r in standins.pool(spark, SF).collect()}
    got = {r.work_id: r.found for r in catalogue.QUERIES["quote_ratio"](spark, SF).collect()}
    fold = lambda t: " ".join(t.lower().split())
    assert got.keys() == works.keys() and all(v or not w.title.strip() or fold(w.title) not in fold(w.abstract) for k, v in got.items() for w in [works[k]])
    titles = sorted({(1950 + r.p_size, f"{r.p_name} {r.p_type}") for r in standins.table(spark, SF, "part").collect()})
    first = {}
    for i, (year, x) in enumerate(titles):
        near = [y for z, y in titles[i + 1 :] if z == year and set(x.lower().split()) & set(y.lower().split()) and parse.token_set_ratio(x, y) >= 75]
        if near:
            first[year, x] = near[0]
    assert {(r.year, r.title): r.other for r in catalogue.QUERIES["token_set_match"](spark, SF).collect()} == first


def test_quote_ratio_reads_the_whole_abstract(spark, tmp_path):
    from screenloom.plans import catalogue

    later = "First  one here. And then\nA Quoted title follows. " + "More words follow. " * 200
    rows = [(1, "A quoted  Title\n" + later), (2, "a quotid title\n" + later), (3, "no abstract"), (4, None), (5, "\n" + later)]
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.work_id: r.found for r in catalogue.QUERIES["quote_ratio"](spark, str(tmp_path)).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100


def test_imports_without_training_data_operators(tmp_path):
    """The rest works when the llm folders and the pipeline are deleted."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for part in ("screenloom", "__spark_entry__.py"):
        source = os.path.join(root, part)
        shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(source) else shutil.copy(source, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'route_winner' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
