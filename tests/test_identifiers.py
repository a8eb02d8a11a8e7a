"""Identifiers, keys to skip, concepts and authors' names."""

from pyspark.sql import functions as F

from screenloom.functions import identifiers as I


def one(spark, f, values):
    return [r[0] for r in spark.createDataFrame(list(enumerate(values)), "i int, t string").orderBy("i").select(f(F.col("t"))).collect()]


def test_cells_and_pages(spark):
    cells = {"10.1/a, 10.2/b": ["10.1/a", "10.2/b"], "10.1/a,b": ["10.1/a,b"], "10.1/(a;b)": ["10.1/(a;b)"], " 10.1/a, ,10.2/b, ": ["10.1/a", "10.2/b"], "": [], None: [], " x ": ["x"], ",": [","]}
    assert one(spark, I.split_identifiers, cells) == list(cells.values())
    pages = {"https://osf.io/AB12d": "10.17605/osf.io/ab12d", "http://osf.io/ab12d/?x": "10.17605/osf.io/ab12d", "https://osf.io/toolong": None, "https://x.org/a": None, None: None}
    assert one(spark, I.page_doi, pages) == list(pages.values())
    guids = {"10.17605/OSF.IO/Ab12D": "ab12d", "https://api.osf.io/v2/nodes/ab12d/": "ab12d", "osf.io/preprints/psyarxiv/d3x9p_v4": "d3x9p", "https://osf.io/ab12d#top": "ab12d", "osf.io/files": "", "x": "", None: ""}
    assert one(spark, I.registration_guid, guids) == list(guids.values())
    rows = spark.createDataFrame([("10.17605/OSF.io/ab12d", "u", "10.17605/osf.io/ab12d"), ("10.1/x", "https://osf.io/ab12d", None), ("", "https://osf.io/ab12d/", "osf.io/ab12d"), (None, "https://x.org", None)], "d string, u string, want string")
    assert all(r[0] == r[1] for r in rows.select("want", I.page_key(F.col("d"), F.col("u"))).collect())


def test_skip_keys(spark):
    # a cell of which a part is no DOI is one identifier
    a = spark.createDataFrame([("https://doi.org/10.1/A, 10.2/B", "https://osf.io/ab12d"), ("10.1/a", None), (None, "https://x.org")], "ids string, url string")
    b = spark.createDataFrame([("10.17605/OSF.IO/AB12D",), ("",)], "doi string")
    keys = sorted(r.key for r in I.skip_keys([(a, ["ids"], ["url"]), (b, ["doi"], [])]).collect())
    assert keys == ["10.1/a", "10.1/a, 10.2/b", "10.17605/osf.io/ab12d"]


def test_concepts(spark):
    base = I.CONCEPT_BASE
    for rows, kind, want in (
        ([([base + "C1"],), (["C12"],), ([],), (None,), ([None, "C2"],)], "array<string>", [True, False, False, False, True]),
        ([([(base + "C1", 1)],), ([("C11", 1), ("C2", 2)],), ([(None, 1)],), (None,)], "array<struct<id:string,n:int>>", [True, True, False, False]),
        ([('[{"id": "https://openalex.org/C1"}]',), ('[{"id": "C11"}]',), ('["C2"]',), (None,), ("",)], "string", [True, False, True, False, False]),
        ([(1,), (None,)], "int", [False, False]),
    ):
        df = spark.createDataFrame(rows, f"c {kind}").coalesce(1)
        assert [r[0] for r in df.select(I.has_concept(df, "c", ["C1", "C2"])).collect()] == want, kind
        assert df.select(I.has_concept(df, "none", ["C1"])).first()[0] is False


def test_authors(spark):
    names = {"John D. Bransford": "Bransford, J. D.", "J. Richard Barclay": "Barclay, J. R.", "Plato": "Plato", "": "", None: None, " Åsa  Öberg ": "Öberg, Å."}
    assert one(spark, I.apa_author, names) == list(names.values())
    pairs = spark.createDataFrame([("Smith", "John D.", "Smith, J. D."), ("Smith", "", "Smith"), (None, "Ann", "Ann"), ("van der Berg", "A. b", "van der Berg, A. b."), (None, None, "")], "f string, g string, want string")
    assert all(r[0] == r[1] for r in pairs.select("want", I.apa_pair(F.col("f"), F.col("g"))).collect())
