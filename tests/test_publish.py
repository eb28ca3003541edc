import glob
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tessera.publish import NothingPublished, Store


def _rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "fonte string, v int")


def _of(store, version=None):
    return sorted((r.fonte, r.v) for r in store.read(version).collect())


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/t")
    with pytest.raises(NothingPublished):
        store.read()
    store.publish(_rows(spark, ("a", 1), ("b", 2)), "first")
    old = store.read()
    # killed while the files are written: some are there, no manifest names them
    with pytest.raises(Exception):
        store.publish(_rows(spark, ("c", 3)).withColumn("v", F.raise_error(F.lit("killed")).cast("int")), "second")
    assert _of(store) == [("a", 1), ("b", 2)]
    # killed between files and manifest
    monkeypatch.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.publish(_rows(spark, ("c", 3)), "second")
    monkeypatch.undo()
    assert _of(store) == [("a", 1), ("b", 2)] and store.versions() == [1]
    # the retry writes over what the dead one left; a further one changes nothing
    assert store.publish(_rows(spark, ("c", 3)), "second").version == 2
    before = set(glob.glob(f"{tmp_path}/t/data/*/*"))
    assert store.publish(_rows(spark, ("x", 9)), "second").version == 2 and set(glob.glob(f"{tmp_path}/t/data/*/*")) == before
    assert _of(store) == [("c", 3)] and _of(store, 1) == [("a", 1), ("b", 2)]
    assert sorted((r.fonte, r.v) for r in old.collect()) == [("a", 1), ("b", 2)]  # a reader keeps its version
    assert store.collect_garbage(keep=1) == ["data/first"] and _of(store) == [("c", 3)] and store.versions() == [2]


def test_a_dead_claim_does_not_block_the_next_writer(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t")
    store.publish(_rows(spark, ("a", 1)), "one")
    claim = tmp_path / "t/manifest/_claim-000000000002"
    claim.write_text("")
    os.utime(claim, (time.time() - 3600,) * 2)
    assert store.publish(_rows(spark, ("b", 2)), "two").version == 2 and _of(store) == [("b", 2)]


def test_partial_refresh_leaves_other_folders_alone(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t")
    store.publish(_rows(spark, ("a", 1), ("b", 2), ("b", 3), ("c d/é", 4), (None, 5)), "all", by="fonte")
    files = lambda: {p: (os.stat(p).st_mtime_ns, os.stat(p).st_ino) for p in glob.glob(f"{tmp_path}/t/data/all/**/*.parquet", recursive=True)}
    before = files()
    store.replace(_rows(spark, ("b", 7), ("new", 8)), "some")
    assert files() == before  # names, times, inodes
    of_a = lambda rows: {f for f in rows.inputFiles() if "fonte=a/" in f}
    assert of_a(store.read()) == of_a(store.read(1)) != set()
    got = {r.fonte: r.v for r in store.read().collect()}
    assert got == {"a": 1, "b": 7, "new": 8, "c d/é": 4, None: 5} and store.read().count() == 5
    store.replace(_rows(spark, ("a", 10)), "drop", drop=("new",))
    assert {r.fonte: r.v for r in store.read().collect()} == {"a": 10, "b": 7, "c d/é": 4, None: 5}
    gone = store.collect_garbage(keep=1)
    assert "data/all/fonte=a" in gone and "data/all/fonte=b" in gone and "data/some/fonte=new" in gone
    assert {r.fonte: r.v for r in store.read().collect()} == {"a": 10, "b": 7, "c d/é": 4, None: 5}
    with pytest.raises(Exception):
        store.replace(spark.createDataFrame([("a",)], "fonte string"), "lacks a column")


def test_writers_at_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t")
    store.publish(_rows(spark, *[(f"s{i}", 0) for i in range(6)]), "all", by="fonte")
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda i: Store(spark, store.root).replace(_rows(spark, (f"s{i}", i + 1)), f"w{i}").version, range(6)))
    assert sorted(done) == [2, 3, 4, 5, 6, 7]  # each on top of another
    assert _of(store) == [(f"s{i}", i + 1) for i in range(6)]
