"""Lineage cutting: checkpointed counts and staged tables live in the shared folder."""

from __future__ import annotations

from tallybayes import prepare, train
from tallybayes.operators.train import checkpoint_dir, make_durable, stage_table
from tallybayes.sources import CAR_SPEC, car_table


def test_checkpoint_folder_comes_from_the_session(spark):
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_stage_table_round_trips_under_the_checkpoint_folder(spark):
    df = prepare(car_table(spark), CAR_SPEC)
    staged = stage_table(df, "unit")
    files = staged.inputFiles()
    base = checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, df.collect()))


def test_trained_counts_are_checkpointed(spark):
    m = train(prepare(car_table(spark), CAR_SPEC))
    plan = m.counts._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan  # read back from the checkpoint, lineage cut
    assert make_durable(m.counts).count() == m.counts.count()


def test_without_a_checkpoint_folder_counts_are_persisted(spark, monkeypatch):
    import importlib

    T = importlib.import_module("tallybayes.operators.train")
    monkeypatch.setattr(T, "checkpoint_dir", lambda _spark: None)
    m = T.train(prepare(car_table(spark), CAR_SPEC))
    assert m.counts.is_cached
    assert m.counts.count() == 21
    m.counts.unpersist()


def test_no_shared_folder_is_refused_off_local_mode(spark, monkeypatch):
    import importlib

    import pytest

    T = importlib.import_module("tallybayes.operators.train")
    monkeypatch.setattr(T, "checkpoint_dir", lambda _spark: None)
    assert "/checkpoints/" in T.shared_folder(spark, "x")

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        T.shared_folder(Cluster, "x")


def test_release_removes_staged_folders_and_cached_counts(spark, monkeypatch):
    import importlib
    import os

    T = importlib.import_module("tallybayes.operators.train")
    staged = stage_table(prepare(car_table(spark), CAR_SPEC), "unit")
    folder = staged._tallybayes_folder.replace("file:", "")
    assert os.path.isdir(folder)
    T.release(staged)
    assert not os.path.exists(folder)
    monkeypatch.setattr(T, "checkpoint_dir", lambda _spark: None)
    m = T.train(prepare(car_table(spark), CAR_SPEC))
    assert m.counts.is_cached
    m.release()
    assert not m.counts.is_cached
