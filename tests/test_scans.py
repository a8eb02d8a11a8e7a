"""Scans: sources by their whole path, the ledger by runs, rescans, files cut short, parquet, gates."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenloom.sources import exports, scans

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        store = f"{tmp_path}/store"

        def put(self, name, *lines):
            os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
            with open(f"{tmp_path}/{name}", "w") as f:
                f.write("".join(f"{x}\n" for x in lines))
            # the checksum that a Hadoop writer may have left
            return f"{tmp_path}/{name}"

        def scan(self, *files, gate=None, **more):
            manifest = spark.createDataFrame(list(files), "url string, content_length long, record_count long")
            gate = F.col("t") == "keep" if gate is None else gate
            rows = scans.scan(spark, manifest, self.store, SCHEMA, gate, [F.col("id"), F.upper("t").alias("t")], **more).collect()
            return {r.url.removeprefix(f"{tmp_path}/"): (r.run, r.status, r.records, r.kept, r.malformed) for r in rows}

        def pool(self):
            return sorted(r.id for r in scans.read(spark, self.store, T.StructType([T.StructField("id", T.LongType())])).collect())

    return Place()


def test_equal_names_in_other_folders(place):
    a = place.put("date=1/part_000.json", '{"id": 1, "t": "keep"}', '{"id": 2, "t": "keep"}')
    b = place.put("date=2/part_000.json", '{"id": 3, "t": "keep"}')
    assert place.scan((a, 50, None), (b, 25, None)) == {"date=1/part_000.json": (1, "done", 2, 2, 0), "date=2/part_000.json": (1, "done", 1, 1, 0)}
    place.put("date=2/part_000.json", '{"id": 4, "t": "keep"}')
    assert place.scan((a, 50, None), (b, 26, None)) == {"date=2/part_000.json": (2, "done", 1, 1, 0)}
    assert place.pool() == [1, 2, 4]
    assert place.scan((a, 50, None), (b, 26, None)) == {}


def test_a_file_that_shrinks_or_keeps_nothing(spark, place):
    a = place.put("x/a.json", '{"id": 1, "t": "keep"}', "{bad", "", '{"id": 2, "t": "drop"}', '{"id": null, "t": "keep"}')
    assert place.scan((a, 90, None)) == {"x/a.json": (1, "done", 4, 2, 1)}
    place.put("x/a.json", '{"id": 7, "t": "keep"}')
    assert place.scan((a, 9, None)) == {"x/a.json": (2, "done", 1, 1, 0)} and place.pool() == [7]
    assert place.scan((a, 9, None)) == {}
    place.put("x/a.json", '{"id": 8, "t": "drop"}')
    assert place.scan((a, 8, None)) == {"x/a.json": (3, "done", 1, 0, 0)} and place.pool() == []
    assert scans.clean(spark, place.store) == 2 and place.pool() == []
    place.put("x/a.json")
    assert place.scan((a, 0, None)) == {"x/a.json": (4, "done", 0, 0, 0)}


def test_short_and_missing_files_leave_what_was_there(place, tmp_path):
    a = place.put("a.json", '{"id": 1, "t": "keep"}')
    gone = f"{tmp_path}/none.json"
    assert place.scan((a, 5, 1), (gone, 5, 1)) == {"a.json": (1, "done", 1, 1, 0), "none.json": (1, "missing", 0, 0, 0)}
    place.put("a.json", '{"id": 2, "t": "keep"}')
    assert place.scan((a, 6, 3), (gone, 5, 1)) == {"a.json": (2, "short", 1, 1, 0), "none.json": (2, "missing", 0, 0, 0)}
    assert place.pool() == [1]
    place.put("a.json", *['{"id": 3, "t": "keep"}'] * 3)
    assert place.scan((a, 6, 3)) == {"a.json": (3, "done", 3, 3, 0)} and place.pool() == [3, 3, 3]


def test_a_run_that_ends_early_changes_nothing(spark, place):
    a = place.put("a.json", '{"id": 1, "t": "keep"}')
    place.scan((a, 5, None))
    place.put("a.json", '{"id": 2, "t": "keep"}')
    with pytest.raises(Exception, match="stop here"):
        place.scan((a, 6, None), gate=F.raise_error(F.lit("stop here")).cast("boolean"))
    assert place.pool() == [1]
    assert place.scan((a, 6, None)) == {"a.json": (2, "done", 1, 1, 0)} and place.pool() == [2]


def test_parquet_with_other_columns_and_gates_without_columns(spark, place, tmp_path):
    paths = []
    for name, frame in (("d=1/p", spark.createDataFrame([(1, "keep"), (2, "x")], "id long, t string")), ("d=2/p", spark.createDataFrame([(3, 1.5)], "id long, other double"))):
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        paths += [f"{tmp_path}/{name}/{x}" for x in os.listdir(f"{tmp_path}/{name}") if x.endswith(".parquet")]
    assert sorted(v for v in place.scan(*[(p, 1, None) for p in paths], kind="parquet").values()) == [(1, "done", 1, 0, 0), (1, "done", 2, 1, 0)]
    assert place.pool() == [1]
    place.store += "-all"
    place.scan(*[(p, 1, None) for p in paths], kind="parquet", gate=F.lit(True))
    assert place.pool() == [1, 2, 3]
    place.store += "-json"
    a = place.put("a.json", '{"id": 1}', "{bad")
    assert place.scan((a, 5, None), gate=F.lit(True)) == {"a.json": (1, "done", 2, 1, 1)}


def test_another_gate_is_refused(place):
    a, b = place.put("a.json", '{"id": 1, "t": "keep"}'), place.put("b.json", '{"id": 2, "t": "keep"}')
    place.scan((a, 5, None), gate_id="one")
    with pytest.raises(exports.Refused, match="'one'"):
        place.scan((b, 5, None), gate_id="two")
    assert place.pool() == [1]
    place.scan((b, 5, None), gate_id="two", force=True)
    assert place.pool() == [1, 2]


def test_steps_that_fail_leave_the_old_state(spark, tmp_path, monkeypatch):
    from screenloom.plans import release

    path = f"{tmp_path}/pointer.json"
    exports.write_text(spark, path, "one")
    exports.write_text(spark, path, "two", overwrite=True)
    assert exports.read_text(spark, path) == "two"
    with pytest.raises(exports.Refused):
        exports.write_text(spark, path, "three")
    monkeypatch.setattr(exports, "move", lambda *a, **k: (_ for _ in ()).throw(OSError("no move")))
    with pytest.raises(OSError):
        exports.write_text(spark, path, "four", overwrite=True)
    assert exports.read_text(spark, path) == "two"
    monkeypatch.undo()
    store = f"{tmp_path}/store"
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "release_id string, created_at string")
    rows.write.parquet(f"{store}/releases")
    real, calls = exports.move, []

    def breaks(*a, **k):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("no second move")
        return real(*a, **k)

    ids = lambda: sorted(r.release_id for r in spark.read.parquet(f"{store}/releases").collect())
    monkeypatch.setattr(exports, "move", breaks)
    with pytest.raises(OSError):
        release.drop_release(spark, store, "a")
    monkeypatch.undo()
    release.recover(spark, store)
    assert ids() == ["b", "c"]
    release.drop_release(spark, store, "b")
    assert ids() == ["c"] and sorted(os.listdir(store)) == ["releases"]
