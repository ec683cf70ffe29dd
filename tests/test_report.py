"""Report operators over inline run records."""

from __future__ import annotations

import pytest

from tallybayes.operators.report import (
    DF_BASELINE,
    DF_OPTIMISED,
    RDD_BASELINE,
    RDD_OPTIMISED,
    accuracy_listing,
    complete_records,
    mean_by,
    mean_winner,
    pivot_table,
    speedups,
)

DDL = "dataset string, impl string, scale int, n_train bigint, train_time double, pred_time double, accuracy double"


@pytest.fixture()
def records(spark):
    rows = []
    times = {RDD_BASELINE: 4.0, RDD_OPTIMISED: 2.0, DF_BASELINE: 3.0, DF_OPTIMISED: 1.0}
    for scale in (1, 10, 50):
        for impl, t in times.items():
            if scale == 50 and impl == DF_OPTIMISED:
                continue  # a missing cell
            rows.append(("car", impl, scale, 100 * scale, t * scale, 0.5, 0.9))
    rows.append(("car", RDD_BASELINE, 7, 700, 1.0, 1.0, 0.8))
    return spark.createDataFrame(rows, DDL)


def test_total_time_and_size_labels(records):
    rec = {(r.impl, r.scale): r for r in complete_records(records).collect()}
    assert rec[(RDD_BASELINE, 1)].total_time == 4.5
    assert rec[(RDD_BASELINE, 1)].size_label == "Small"
    assert rec[(RDD_BASELINE, 10)].size_label == "Medium"
    assert rec[(RDD_BASELINE, 50)].size_label == "Large"
    assert rec[(RDD_BASELINE, 7)].size_label == "7"


def test_pivot_has_null_for_missing_cell(records):
    rows = {r.impl: r for r in pivot_table(records).collect()}
    assert rows[DF_OPTIMISED].Small == 1.5 and rows[DF_OPTIMISED].Large is None
    assert rows[RDD_BASELINE].Medium == 40.5


def test_speedup_and_winner_only_for_complete_sizes(records):
    rows = {r.size_label: r for r in speedups(records).collect()}
    assert set(rows) == {"Small", "Medium"}
    s = rows["Small"]
    assert s.rdd_speedup == pytest.approx(4.5 / 2.5)
    assert s.df_speedup == pytest.approx(3.5 / 1.5)
    assert s.winner == "DF"


def test_winner_is_rdd_only_when_strictly_faster(spark):
    rows = [("d", i, 1, 1, t, 0.0, 1.0) for i, t in
            [(RDD_BASELINE, 2.0), (RDD_OPTIMISED, 1.0), (DF_BASELINE, 1.0), (DF_OPTIMISED, 3.0)]]
    assert speedups(spark.createDataFrame(rows, DDL)).first().winner == "DF"  # tie -> DF
    rows[1] = ("d", RDD_OPTIMISED, 1, 1, 0.5, 0.0, 1.0)
    assert speedups(spark.createDataFrame(rows, DDL)).first().winner == "RDD"


def test_mean_winner(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 3.0)], "scale int, rdd_total double, df_total double")
    r = mean_winner(df).first()
    assert (r.avg_rdd, r.avg_df, r.winner) == (3.0, 3.0, "DataFrame")
    df2 = spark.createDataFrame([(1, 1.0, 3.0)], "scale int, rdd_total double, df_total double")
    assert mean_winner(df2).first().winner == "RDD"


def test_mean_by_and_accuracy_listing(records):
    means = {r.impl: r.mean_total_time for r in mean_by(complete_records(records)).collect()}
    assert means[DF_OPTIMISED] == pytest.approx((1.5 + 10.5) / 2)
    lst = accuracy_listing(records).collect()
    assert len(lst) == records.count() and lst[0].dataset == "car"


def test_speedups_with_custom_implementation_pairs(spark):
    rows = [("d", i, 1, 1, t, 0.0, 1.0) for i, t in [("A0", 4.0), ("A1", 2.0), ("B0", 3.0), ("B1", 1.0)]]
    out = speedups(spark.createDataFrame(rows, DDL), apis=(("A", "A0", "A1"), ("B", "B0", "B1"))).first()
    assert (out.a_speedup, out.b_speedup, out.winner) == (2.0, 3.0, "B")


def test_pivot_shows_sizes_without_a_name(spark):
    rows = [("d", "i", 1, 1.0), ("d", "i", 100, 2.0), ("d", "i", 7, 3.0)]
    out = pivot_table(spark.createDataFrame(rows, "dataset string, impl string, scale int, total_time double"))
    assert out.columns == ["dataset", "impl", "Small", "Medium", "Large", "7", "100"]
    assert tuple(out.first()) == ("d", "i", 1.0, None, None, 3.0, 2.0)
