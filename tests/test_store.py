"""Stored models, the count store, and lookups that are never broadcast."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from test_plans import plan_text

from tallybayes import CountStore, ModelNotWhole, hash_split, load_model, predict, prepare, save_model, train
from tallybayes.operators.train import count_features
from tallybayes.sources import events_set, orders_set
from tallybayes.sources.files import Folder
from tallybayes.streaming import score_stream

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def events(spark):
    df, spec = events_set(spark, SF)
    tr, te = hash_split(df, spec.ids)
    return train(prepare(tr, spec)), te, spec


def test_a_loaded_model_scores_as_it_did_without_statistics_jobs(spark, scratch, events):
    model, te, spec = events
    test = prepare(te, spec)
    want = rows_of(predict(test, model, spec.ids))
    save_model(model, f"{scratch}/m")
    sc = spark.sparkContext
    sc.setJobGroup("from-load", "from load to result")
    loaded = load_model(spark, f"{scratch}/m")
    got = rows_of(predict(test, loaded, spec.ids))
    jobs = sc.statusTracker().getJobIdsForGroup("from-load")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == want and len(jobs) <= 3
    assert loaded.stats() == model.stats() and rows_of(loaded.table) == rows_of(model.table)
    for kind in ("long", "map_arrays", "sparse"):
        assert rows_of(predict(test, loaded, spec.ids, scorer=kind)) == want
    with pytest.raises(FileExistsError):
        save_model(model, f"{scratch}/m")
    loaded.release()


def test_half_written_models_are_refused(spark, scratch, events):
    model, _, _ = events
    path = f"{scratch}/m"
    with pytest.raises(ModelNotWhole, match="no manifest"):
        load_model(spark, path)
    save_model(model, path, buckets=3)
    (data,) = [n for n in os.listdir(path) if n.startswith("data-")]
    os.rename(f"{path}/MANIFEST.json", f"{path}/kept")  # stopped before the end
    with pytest.raises(ModelNotWhole, match="no manifest"):
        load_model(spark, path)
    save_model(model, path, buckets=3)  # a second try stands beside what the first left
    os.rename(f"{path}/kept", f"{path}/old")
    manifest = json.load(open(f"{path}/MANIFEST.json"))
    assert manifest["data"] != data
    part = next(f for f in manifest["files"] if f.startswith("counts/"))
    os.remove(f"{path}/{manifest['data']}/{part}")
    with pytest.raises(ModelNotWhole, match="differs"):
        load_model(spark, path)


def test_no_part_of_a_model_above_the_bounds_is_broadcast(spark, scratch, events):
    model, te, spec = events
    want = rows_of(predict(prepare(te, spec), model, spec.ids))
    save_model(model, f"{scratch}/m")
    loaded = load_model(spark, f"{scratch}/m")
    for m in (model, loaded):
        df = predict(prepare(te, spec), m, spec.ids, scorer="map", max_map_bytes=0, max_dense_bytes=0)
        assert rows_of(df) == want
        assert "Broadcast" not in joins_above_scan(plan_text(df))
    text = plan_text(predict(prepare(te, spec), loaded, spec.ids, scorer="map", max_map_bytes=0, max_dense_bytes=0))
    assert text.count("Bucketed: true") == 3
    # an exchange for each lookup's test side, one for either side of the header: none for the model table
    assert text.count("Exchange hashpartitioning") == 5
    te.coalesce(1).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(te.schema).parquet(f"{scratch}/in")
    scored = score_stream(stream, spec, loaded, max_map_bytes=0, max_dense_bytes=0)
    q = scored.writeStream.format("memory").queryName("size_safe").option("checkpointLocation", f"{scratch}/chk").start()
    q.processAllAvailable()
    plan = q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else ""
    q.stop()
    assert rows_of(spark.table("size_safe")) == want
    assert "Broadcast" not in plan
    loaded.release()


def joins_above_scan(text):
    """The plan's lines that join (the model's own derivation may broadcast its small dimensions)."""
    head = text.split("SortMergeJoin", 1)
    return head[0] + "".join(ln for ln in text.splitlines() if "NestedLoop" in ln)


# -- counts kept up to date ---------------------------------------------------------
@pytest.fixture()
def parts(spark):
    df, spec = orders_set(spark, SF)
    return lambda *which: prepare(df.filter(F.pmod("o_orderkey", F.lit(4)).isin(*which)), spec)


def test_batches_are_added_and_withdrawn_once(spark, scratch, parts):
    store = CountStore(spark, f"{scratch}/c")
    assert store.counts().count() == 0 and store.version == 0
    assert store.add("a", parts(0)) and store.add("b", parts(1))
    assert not store.add("a", parts(2))  # delivered again, even with other rows
    assert rows_of(store.counts()) == rows_of(count_features(parts(0, 1)))
    assert store.withdraw("b") and not store.withdraw("b") and not store.withdraw("never")
    assert not store.add("b", parts(1))  # a withdrawn id stays withdrawn
    assert rows_of(store.counts()) == rows_of(count_features(parts(0)))
    assert rows_of(store.counts(version=2)) == rows_of(count_features(parts(0, 1)))
    again = CountStore(spark, f"{scratch}/c")
    assert again.version == 3 and set(again.batches()) == {"a"}
    want = train(parts(0))
    assert rows_of(again.model().table) == rows_of(want.table)


def test_snapshots_and_what_comes_after(spark, scratch, parts):
    store = CountStore(spark, f"{scratch}/c")
    for i in range(3):
        store.add(str(i), parts(i))
    store.snapshot()
    assert store.withdraw("1") and store.add("3", parts(3))
    assert rows_of(store.counts()) == rows_of(count_features(parts(0, 2, 3)))
    read = store.counts().inputFiles()
    assert not any(store.batches(3)["0"] in f for f in read)  # from the snapshot, not from the batch
    store.snapshot()
    assert rows_of(store.counts()) == rows_of(count_features(parts(0, 2, 3)))
    for v, which in ((1, (0,)), (2, (0, 1)), (4, (0, 1, 2)), (5, (0, 2))):
        assert rows_of(store.counts(v)) == rows_of(count_features(parts(*which))), v


def test_interrupted_and_concurrent_writers(spark, scratch, parts):
    store, other = CountStore(spark, f"{scratch}/c"), CountStore(spark, f"{scratch}/c")
    own = store._append

    def late(entry, fits):  # the other writer is faster, between the data and the entry
        store._append = own
        assert other.add("a", parts(0)) and other.add("x", parts(1))
        return own(entry, fits)

    store._append = late
    assert not store.add("a", parts(0))
    assert store.add("y", parts(2)) and store.version == 3
    assert rows_of(store.counts()) == rows_of(count_features(parts(0, 1, 2)))
    # a writer that died after the data
    count_features(parts(3)).write.parquet(f"{scratch}/c/data/orphan")
    assert rows_of(store.counts()) == rows_of(count_features(parts(0, 1, 2)))
    assert store.vacuum() == 1 and store.vacuum() == 0


def test_a_file_is_written_once(spark, scratch):
    folder = Folder(spark, f"{scratch}/f")
    assert folder.read("a/1.json") is None and folder.names("a") == []
    assert folder.write_new("a/1.json", {"x": "é"}) and not folder.write_new("a/1.json", {"x": 2})
    assert folder.read("a/1.json") == {"x": "é"} and folder.names("a") == ["1.json"]
