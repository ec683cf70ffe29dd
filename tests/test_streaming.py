"""Scoring a file stream gives the same predictions as the batch scorer."""

from __future__ import annotations

import os

from tallybayes import predict, prepare, train
from tallybayes.plans.catalog import split_prepared
from tallybayes.sources import events_set
from tallybayes.streaming import score_stream, write_predictions

SF = "/root/testdata/sf0.001"


def test_stream_scoring_matches_batch(spark, scratch):
    df, spec = events_set(spark, SF)
    tr, te = split_prepared(df, spec)
    model = train(tr)
    batch = {r.event_id: (r.prediction, r.score) for r in predict(te, model, spec.ids).collect()}

    # the test rows arrive as parquet files in a folder the stream watches
    src = os.path.join(scratch, "in")
    from tallybayes.operators.prepare import hash_split

    _, raw_test = hash_split(df, spec.ids)
    raw_test.write.parquet(src)
    stream = spark.readStream.schema(raw_test.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = write_predictions(
        score_stream(stream, spec, model), os.path.join(scratch, "out"), os.path.join(scratch, "chk")
    )
    q.processAllAvailable()
    q.stop()
    got = {r.event_id: (r.prediction, r.score) for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
    assert got == batch and len(got) > 0


def test_stream_scoring_with_a_model_too_large_to_broadcast(spark, scratch, monkeypatch):
    import importlib

    P = importlib.import_module("tallybayes.operators.predict")
    df, spec = events_set(spark, SF)
    tr, te = split_prepared(df, spec)
    model = train(tr)
    want = {r.event_id: (r.prediction, r.score) for r in predict(te, model, spec.ids).collect()}
    from tallybayes.operators.prepare import hash_split

    _, raw_test = hash_split(df, spec.ids)
    src = os.path.join(scratch, "in")
    raw_test.coalesce(1).write.parquet(src)
    monkeypatch.setattr(P, "MAX_DENSE_BROADCAST_BYTES", 0)
    defaults = P.predict.__defaults__
    monkeypatch.setattr(P.predict, "__defaults__", tuple(1 if d == P.MAX_MAP_BYTES else d for d in defaults))
    stream = spark.readStream.schema(raw_test.schema).parquet(src)
    q = write_predictions(score_stream(stream, spec, model), os.path.join(scratch, "out"), os.path.join(scratch, "chk"))
    q.processAllAvailable()
    q.stop()
    got = {r.event_id: (r.prediction, r.score) for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
    assert got == want
