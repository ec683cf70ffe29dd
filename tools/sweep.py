"""Timed sweep: datasets x replication scales x scorers, then the reports.

Usage: python tools/sweep.py [sf_dir] [scale ...]      (default scales 1 10 50)

For each dataset and scale the training rows are replicated ``scale`` times
(materialised copies, as a scaling study wants), each implementation trains
and predicts with its own clock around an action, and one run record is
kept. The records become a DataFrame and the report operators print the
implementation x size table, speedups and winner per size, means per
implementation and the accuracy listing. Timing is wall-clock on the driver
around Spark actions; the work itself runs on Spark.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tallybayes import accuracy, hash_split, predict, prepare, replicate, train  # noqa: E402
from tallybayes.operators.report import (  # noqa: E402
    RECORD_DDL,
    SIZE_LABELS,
    accuracy_listing,
    mean_by,
    pivot_table,
    speedups,
)
from tallybayes.sources import load_dataset  # noqa: E402

DATASETS = ("orders", "events", "documents_lang")
# implementation name -> predict keyword arguments
IMPLS = {
    "Map Arrays": {"scorer": "map_arrays"},
    "Map": {"scorer": "map"},
    "Long Shuffle": {"scorer": "long", "max_dense_bytes": 0},
    "Long": {"scorer": "long"},
}
APIS = (("Map", "Map Arrays", "Map"), ("Long", "Long Shuffle", "Long"))


def run(spark: SparkSession, sf_dir: str, scales=(1, 10, 50)):
    rows = []
    for name in DATASETS:
        df, spec = load_dataset(spark, sf_dir, name)
        tr, te = hash_split(df, spec.ids)
        test = prepare(te, spec)
        for scale in scales:
            train_rows = replicate(prepare(tr, spec), scale).drop("copy")
            for impl, kw in IMPLS.items():
                t0 = time.perf_counter()
                model = train(train_rows)  # eager checkpoint: the counting job runs here
                n_train = model.totals.first()["n_total"]
                t1 = time.perf_counter()
                acc = accuracy(predict(test, model, spec.ids, **kw)).first()["accuracy"]
                t2 = time.perf_counter()
                label = SIZE_LABELS.get(scale, str(scale))
                rows.append((name, impl, scale, label, n_train, t1 - t0, t2 - t1, t2 - t0, acc))
                print(f"{name:15s} x{scale:<3d} {impl:13s} train={t1 - t0:6.2f}s pred={t2 - t1:6.2f}s acc={acc:.4f}", flush=True)
    return spark.createDataFrame(rows, RECORD_DDL)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scales = tuple(int(x) for x in sys.argv[2:]) or (1, 10, 50)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    records = run(spark, sf, scales).cache()
    sizes = [SIZE_LABELS.get(s, str(s)) for s in scales]
    pivot_table(records, sizes=sizes).show(truncate=False)
    speedups(records, apis=APIS).show(truncate=False)
    mean_by(records).show(truncate=False)
    accuracy_listing(records).show(100, truncate=False)
