"""A stream that stops at any point and starts again writes each row once."""

from __future__ import annotations

import pytest

from tallybayes import CountStore, hash_split, predict, prepare, train
from tallybayes.operators.train import count_features
from tallybayes.sources import events_set
from tallybayes.streaming import OnceSink, count_stream, write_predictions_once

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def stream(spark, scratch):
    df, spec = events_set(spark, SF)
    tr, te = hash_split(df, spec.ids)
    te.repartition(3).write.parquet(f"{scratch}/in")
    reader = spark.readStream.schema(te.schema).option("maxFilesPerTrigger", 1)
    return tr, te, spec, lambda: reader.parquet(f"{scratch}/in")


def test_stopped_before_a_commit_and_after_one(spark, scratch, stream, monkeypatch):
    tr, te, spec, source = stream
    model = train(prepare(tr, spec))
    want = rows_of(predict(prepare(te, spec), model, spec.ids))
    sink = OnceSink(spark, f"{scratch}/out")
    with pytest.raises(FileNotFoundError):
        sink.read()
    own = OnceSink.write
    deaths = []

    def dies(self, batch, batch_id):
        if batch_id == 1 and "before" not in deaths:
            deaths.append("before")  # rows written, no commit
            batch.write.parquet(f"{self.path}/batch-1-lost")
            raise RuntimeError("stopped")
        done = own(self, batch, batch_id)
        if batch_id == 1 and "after" not in deaths:
            deaths.append("after")  # committed, but the stream does not know
            raise RuntimeError("stopped")
        return done

    monkeypatch.setattr(OnceSink, "write", dies)
    for _ in range(3):
        q = write_predictions_once(source(), spec, model, sink.path, f"{scratch}/chk", scorer="sparse")
        try:
            q.processAllAvailable()
        except Exception:  # noqa: BLE001 - the stream's own error
            pass
        finally:
            q.stop()
    assert deaths == ["before", "after"]
    assert sorted(sink.committed()) == [0, 1, 2]
    assert rows_of(sink.read()) == want


def test_a_batch_id_is_written_once(spark, scratch):
    sink = OnceSink(spark, f"{scratch}/out")
    assert sink.write(spark.range(3), 7) and not sink.write(spark.range(100), 7)
    assert sink.read().count() == 3


def test_counts_from_a_stream(spark, scratch, stream):
    _, te, spec, source = stream
    store = CountStore(spark, f"{scratch}/counts")
    for _ in range(2):  # the second run finds nothing new
        q = count_stream(source(), spec, store, "events", f"{scratch}/chk")
        q.processAllAvailable()
        q.stop()
    assert rows_of(store.counts()) == rows_of(count_features(prepare(te, spec)))
    assert len(store.batches()) == 3
