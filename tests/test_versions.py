"""Loads that break off at every step: old rows or new rows, never a mix, never a loss."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pitwall.sources import files, merge, versions
from pitwall.sources.versions import ConflictError, VersionedTable

SCHEMA = "k int, v string, p string"


class Broken(Exception):
    pass


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def steps(monkeypatch, module, at):
    """Lets the n-th small file operation of a module, counted from 0, break off before it is done."""
    count = [0]
    for name in ("move", "write_text", "remove_path"):
        def step(*args, real=getattr(module, name)):
            count[0] += 1
            if count[0] == at + 1:
                raise Broken
            return real(*args)

        monkeypatch.setattr(module, name, step)
    return count


OLD = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "z")]
NEW = [(1, "a2", "y"), (2, "b", "y"), (3, "c2", None), (4, "d", "z"), (5, "e", "w")]
BATCH = [(1, "a2", "y"), (3, "c2", None), (5, "e", "w")]


def test_upsert_breaks_off_at_each_step(spark, tmp_path, monkeypatch):
    done = False
    for at in range(40):
        path = str(tmp_path / f"t{at}")
        merge.upsert(spark, path, frame(spark, OLD), ["k"], "p")
        with monkeypatch.context() as m:
            steps(m, merge, at)
            try:
                merge.upsert(spark, path, frame(spark, BATCH), ["k"], "p")
                done = True
            except Broken:
                pass
        merge.finish_swap(spark, path)
        assert held(spark.read.parquet(path).select("k", "v", "p")) in (sorted(OLD, key=repr), sorted(NEW, key=repr))
        assert files.children(spark, f"{path}/{merge.PENDING}") == []
        # the load is repeated, whatever became of it
        merge.upsert(spark, path, frame(spark, BATCH), ["k"], "p")
        assert held(spark.read.parquet(path).select("k", "v", "p")) == sorted(NEW, key=repr)
        if done:
            break
    assert done and at > 8


def test_upsert_breaks_off_while_it_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    bad = frame(spark, BATCH).withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        merge.upsert(spark, path, bad, ["k"], "p")
    assert not merge.has_rows(spark, path)
    merge.upsert(spark, path, frame(spark, OLD), ["k"], "p")
    with pytest.raises(PySparkException):
        merge.upsert(spark, path, bad, ["k"], "p")
    assert held(spark.read.parquet(path).select("k", "v", "p")) == sorted(OLD, key=repr)
    merge.upsert(spark, path, frame(spark, BATCH), ["k"], "p")
    assert held(spark.read.parquet(path).select("k", "v", "p")) == sorted(NEW, key=repr)


def test_versions_break_off_at_each_step(spark, tmp_path, monkeypatch):
    loads = {
        "upsert": (lambda t: t.upsert(frame(spark, BATCH), ["k"]), NEW),
        "replace": (lambda t: t.replace(frame(spark, [(9, "n", "y"), (8, "m", None)])), [(1, "a", "x"), (9, "n", "y"), (8, "m", None), (4, "d", "z")]),
        "delete": (lambda t: t.delete(["x", None, "nowhere"]), [(2, "b", "y"), (4, "d", "z")]),
        "everything": (lambda t: t.replace(frame(spark, [(7, "q", "q")]), everything=True), [(7, "q", "q")]),
    }
    for name, (load, want) in loads.items():
        for at in range(9):
            table = VersionedTable(spark, str(tmp_path / f"{name}{at}"), "p")
            table.replace(frame(spark, OLD))
            open_before = table.read()
            with monkeypatch.context() as m:
                steps(m, versions, at)
                try:
                    load(table)
                    done = True
                except Broken:
                    done = False
            assert held(table.read()) == sorted(want if done else OLD, key=repr)
            # a reader that opened the table before still has its rows
            assert held(open_before) == sorted(OLD, key=repr)
            load(table)
            assert held(table.read()) == sorted(want, key=repr)
            if done:
                break
        assert done and at >= 2


def test_a_failing_write_leaves_the_version_before(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), "p")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(frame(spark, OLD))
    bad = frame(spark, BATCH).withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    for load in (lambda: table.replace(bad), lambda: table.upsert(bad, ["k"])):
        with pytest.raises(PySparkException):
            load()
    assert table.versions() == [1] and held(table.read()) == sorted(OLD, key=repr)
    # what a load wrote that was lost before its manifest goes when it is old enough
    with monkeypatch.context() as m:
        steps(m, versions, 0)
        with pytest.raises(Broken):
            table.upsert(frame(spark, BATCH), ["k"])
    assert table.vacuum() == [] and len(table.vacuum(idle_hours=0)) == 1
    assert held(table.read()) == sorted(OLD, key=repr)


def test_two_writers(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), "p")
    table.replace(frame(spark, OLD))

    def meanwhile(other):
        """Runs `other` between a load's reading of the current version and its commit."""
        real, ran = versions.write_text, []

        def late(*args):
            if not ran:
                ran.append(1)
                other()
            return real(*args)

        return late

    with monkeypatch.context() as m:
        m.setattr(versions, "write_text", meanwhile(lambda: table.replace(frame(spark, [(40, "z", "z")]))))
        assert table.replace(frame(spark, [(10, "x", "x")])) == 3
    assert held(table.read()) == sorted([(10, "x", "x"), (2, "b", "y"), (3, "c", None), (40, "z", "z")], key=repr)
    with monkeypatch.context() as m:
        m.setattr(versions, "write_text", meanwhile(lambda: table.replace(frame(spark, [(41, "z", "z")]))))
        with pytest.raises(ConflictError):
            table.replace(frame(spark, [(42, "z", "z")]))
    with monkeypatch.context() as m:
        # the key might have come into any partition meanwhile
        m.setattr(versions, "write_text", meanwhile(lambda: table.replace(frame(spark, [(2, "new", "q")]))))
        with pytest.raises(ConflictError):
            table.upsert(frame(spark, [(2, "b2", "x")]), ["k"])
    assert held(table.read()) == sorted([(10, "x", "x"), (2, "b", "y"), (3, "c", None), (41, "z", "z"), (2, "new", "q")], key=repr)


def test_history_columns_and_tables_without_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "p")
    table.replace(frame(spark, OLD))
    table.upsert(frame(spark, [(1, "a2", "x", 5)], SCHEMA + ", n int"), ["k"], sync_columns=True)
    assert held(table.read()) == sorted([(1, "a2", "x", 5), (2, "b", "y", None), (3, "c", None, None), (4, "d", "z", None)], key=repr)
    assert held(table.read(1)) == sorted(OLD, key=repr) and table.versions() == [1, 2]
    # partitions that a load doesn't touch are the same files
    assert table.manifest(2).partitions["p=y"] == table.manifest(1).partitions["p=y"]
    assert len(table.vacuum(idle_hours=0)) == 0 and table.versions() == [2]
    table.replace(frame(spark, []), everything=True)
    assert held(table.read()) == []
    plain = VersionedTable(spark, str(tmp_path / "u"), None)
    plain.upsert(frame(spark, OLD), ["k"])
    plain.upsert(frame(spark, BATCH), ["k"])
    assert held(plain.read()) == sorted(NEW, key=repr)
    with pytest.raises(ValueError):
        plain.upsert(frame(spark, [(1, "a", "x"), (1, "b", "x")]), ["k"])
