"""The store: odd names, broken runs, restarts."""

import pytest
from pyspark.sql import functions as F

from quadrille import store as S
from quadrille import terms
from quadrille.store import QuadStore

N = "http://t/"
SOURCES = ["src", "http://x.org/a?b=c&d#e", "with space / slash", "100%", "a=b", "né", "_hidden", ".dot", "", "A_3a", "%3A"]
VERSION = "2024-05-01T12:30:00+02:00"


def quads(spark, *subjects):
    return terms.quads(spark.createDataFrame([(N + s, N + "p", s) for s in subjects], "s string, p string, o string"))


def subjects(df):
    return sorted(r["s"].removeprefix(N) for r in df.select("s").collect())


@pytest.mark.parametrize("name", [*SOURCES, VERSION, "日本", "a" * 60])
def test_folder_names(name):
    folder = S.folder_name(name)
    assert S.name_of(folder) == name and folder[0] == "n" and all(c.isascii() and (c.isalnum() or c in "-_") for c in folder)


def test_every_operation_under_odd_names(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "store"))
    for source in SOURCES[:6]:
        store.append(quads(spark, "a", "b", "c"), source, VERSION)
        store.append(quads(spark, "d"), source, VERSION)
        store.remove(quads(spark, "b"), source, VERSION)
        assert subjects(store.latest(source)) == ["a", "c", "d"]
        assert store.swap(quads(spark, "z"), source, "2025-01-01T00:00:00") == 1
        assert store.versions(source) == ["2025-01-01T00:00:00"] and subjects(store.read(source)) == ["z"]
    assert store.sources() == sorted(SOURCES[:6])
    assert {r["source"] for r in store.read().select("source").distinct().collect()} == set(SOURCES[:6])
    store.clear(SOURCES[1], "2025-01-01T00:00:00")
    assert store.versions(SOURCES[1]) == [] and store.read(SOURCES[1]).count() == 0
    assert store.clean_up([SOURCES[0]], (SOURCES[2],)) == sorted({*SOURCES[:6]} - {SOURCES[0], SOURCES[1], SOURCES[2]})
    assert store.sources() == sorted([SOURCES[0], SOURCES[2]])
    with pytest.raises(LookupError):
        store.latest(SOURCES[1])


def test_swap_guards(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "store"))
    store.swap(quads(spark, "a"), "s", "v1")
    assert store.swap(quads(spark, "a").limit(0), "s", "v2") == 0 and store.versions("s") == ["v1"]
    assert store.swap(quads(spark, "a").limit(0), "s", "v2", expected=10, errors=3) == 0 and store.versions("s") == ["v1"]
    assert store.swap(quads(spark, "b"), "s", "v1") == 1 and subjects(store.read("s")) == ["b"]
    assert store.swap(quads(spark, "a").limit(0), "s", "v2", expected=10, errors=2) == 0 and store.versions("s") == []


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_rename", "_delete"])
@pytest.mark.parametrize("after", [0, 1])
def test_a_crash_leaves_the_old_or_the_new(spark, tmp_path, monkeypatch, step, after):
    store = QuadStore(spark, str(tmp_path / "store"))
    store.append(quads(spark, "a", "b"), "s", VERSION)
    calls, real = [], getattr(S, step)

    def broken(*args):
        calls.append(args)
        if len(calls) > after:
            raise Crash
        return real(*args)

    monkeypatch.setattr(S, step, broken)
    crashed = False
    try:
        store.remove(quads(spark, "a"), "s", VERSION)
    except Crash:
        crashed = True
    monkeypatch.undo()
    found = subjects(store.read("s", VERSION))
    assert found == (["a", "b"] if step == "_rename" else ["b"]) and crashed == (step == "_rename" or after == 0)
    store.remove(quads(spark, "a"), "s", VERSION)
    store.sweep()
    assert subjects(store.read("s")) == ["b"] and [x.name for x in (tmp_path / "store").iterdir() if x.name[0] == "_"] == []


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    from quadrille.operators.lift import Field, lift
    from quadrille.streaming.ingest import ingest

    spark.range(10).select(F.col("id").cast("string").alias("k")).write.parquet(str(tmp_path / "in"))
    to_quads = lambda d: lift(d, F.concat(F.lit(N), "k"), {"k": Field(N + "k")}, one_pass=True)
    store = QuadStore(spark, str(tmp_path / "store"))
    for checkpoint in ("one", "two"):  # a lost checkpoint: the same batch comes again under the same number
        ingest(spark.readStream.schema("k string").parquet(str(tmp_path / "in")), to_quads, store, "http://s/1", str(tmp_path / checkpoint)).awaitTermination()
        assert store.read("http://s/1").count() == 10


def test_deletes_are_checked(spark, tmp_path):
    S._delete(spark, str(tmp_path / "absent"))
    with pytest.raises(OSError):
        S._rename(spark, str(tmp_path / "absent"), str(tmp_path / "x"))


def test_scratch_tables_go(spark):
    import os

    here = lambda t: os.path.exists(S._tables[t].removeprefix("file://"))
    with S.scratch(spark) as keep:
        a = S.written(spark.range(3), "a")
        with S.scratch(spark) as inner:
            b, c = inner(S.written(spark.range(4), "b")), S.written(spark.range(5), "c")
        d = keep(S.written(b, "d"))
        assert here(b) and not here(c) and d.count() == 4
    assert not here(a) and not here(b) and here(d)
    path = S._tables[d].removeprefix("file://")
    S.drop(d)
    S.drop(spark.range(1))
    assert not os.path.exists(path)


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    @staticmethod
                    def getCheckpointDir():
                        class Option:
                            isDefined = staticmethod(lambda: False)

                        return Option

                return Sc

    class Session:
        conf, sparkContext = Conf(), Context

    with pytest.raises(RuntimeError):
        S.shared_dir(Session)
