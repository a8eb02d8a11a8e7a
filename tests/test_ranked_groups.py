"""Citations of equal names, year and topic are looked up and ranked once."""


def test_equal_citations_are_one_group(spark, monkeypatch):
    from screenloom.operators import citations

    keep, sizes = citations.settled, []

    def count(df):
        out = keep(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(citations, "settled", count)
    works = [(i, ["Ash", "Elm"] if i % 2 else ["Ash"], 1990, "green leaves" if i % 3 else "brown roots", i % 5) for i in range(40)]
    cites = [(i, ["Ash"], 1990, "Brown roots") for i in range(30)] + [(100 + i, ["Ash", "Nobody"], 1990, "Green leaves") for i in range(30)] + [(200 + i, ["Ash", f"None{i}"], 1990, None) for i in range(5)]
    got = citations.rank_works(spark.createDataFrame(cites, "cite_id int, surnames array<string>, year int, topic string"), spark.createDataFrame(works, "ref_id int, surnames array<string>, year int, title string, cited_by int")).collect()
    assert sizes == [40, 3]  # works of Ash, though six pairs of names begin so; brown roots, green leaves, no topic
    by = {}
    for r in sorted(got, key=lambda r: (r.cite_id, r.rank)):
        by.setdefault(r.cite_id, []).append((r.ref_id, r.how, r.covers, r.total))
    best = lambda title: sorted((w for w in works if title is None or w[3] == title), key=lambda w: (-w[4], w[0]))
    roots, leaves, broad = [w[0] for w in best("brown roots")][:10], [w[0] for w in best("green leaves")][:10], [w[0] for w in best(None)][:10]
    assert len(by) == 65
    for i in range(30):
        assert by[i] == [(x, "topic", True, 40) for x in roots] and by[100 + i] == [(x, "topic", False, 40) for x in leaves]
    assert all(by[200 + i] == [(x, "first name", False, 40) for x in broad] for i in range(5))
