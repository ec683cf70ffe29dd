"""What operators leave on shared storage goes when its owner says so."""

from __future__ import annotations

import os

import pytest

from tallybayes import Scope, owning, predict, prepare, release, train, write_observed
from tallybayes.operators.train import checkpoint_dir, make_durable, stage_table
from tallybayes.plans.catalog import split_prepared
from tallybayes.sources import CAR_SPEC, car_table, events_set

SF = "/root/testdata/sf0.001"


def left(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, files in os.walk(base) for f in files}


def test_a_scope_deletes_checkpoints_and_folders(spark):
    before = left(spark)
    with Scope(spark):
        model = train(prepare(car_table(spark), CAR_SPEC))
        stage_table(model.prior)
        with Scope(spark):  # its own only
            make_durable(car_table(spark))
        assert model.counts.count() == 21
        assert left(spark) - before
    assert not left(spark) - before


def test_a_result_owns_what_it_reads(spark):
    before = left(spark)

    @owning
    def query(spark, fail=False):
        df, spec = events_set(spark, SF)
        tr, te = split_prepared(df, spec)
        model = train(tr)
        if fail:
            raise RuntimeError
        return predict(te, model, spec.ids, scorer="long")

    out = query(spark)
    n = out.count()
    derived = out.filter("score is not null")
    del_me = out
    del out
    assert derived.count() == n  # nothing goes by itself
    release(del_me)
    assert not left(spark) - before
    with pytest.raises(RuntimeError):
        query(spark, fail=True)
    assert not left(spark) - before
    stage = stage_table(car_table(spark))  # outside of any scope, released by hand
    release(stage)
    assert not left(spark) - before


def test_observed_counts_come_from_the_writing_job(spark, scratch):
    df, spec = events_set(spark, SF)
    tr, te = split_prepared(df, spec)
    pred = predict(te, train(tr), spec.ids)
    want = pred.selectExpr("count(*)", "count_if(prediction <=> label)").first()
    sc = spark.sparkContext
    got = write_observed(pred, f"{scratch}/p").first()
    assert (got["n_test"], got["n_correct"]) == tuple(want) == (spark.read.parquet(f"{scratch}/p").count(), want[1])
    assert got["accuracy"] == want[1] / want[0]
    assert tuple(write_observed(pred.limit(0), f"{scratch}/q").first()) == (0, 0, 0.0)
    assert sc.statusTracker() is not None
