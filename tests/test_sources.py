"""Delimited scans: the CSV and raw-text row policies."""

from __future__ import annotations

import os

import pytest

from tallybayes import prepare, predict, train
from tallybayes.sources import (
    CAR_COLUMNS,
    CAR_ROWS,
    CAR_SPEC,
    MUSHROOM_COLUMNS,
    MUSHROOM_ROWS,
    read_csv_table,
    read_text_table,
)

COLS = ("a", "b", "label")
LINES = [
    "x,y,c1",  # plain
    "",  # blank line
    "x,,c2",  # empty field
    '"p,q",y,c3',  # quoted comma
    "  x,y,c4  ",  # outer whitespace
    "x,c5",  # short row
    "x,y,z,c6",  # long row
]


def write_lines(folder: str, lines) -> str:
    path = os.path.join(folder, "data.txt")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_csv_policy(spark, scratch):
    path = write_lines(scratch, LINES)
    rows = [tuple(r) for r in read_csv_table(spark, path, COLS).collect()]
    assert ("x", "y", "c1") in rows
    assert ("x", None, "c2") in rows  # empty field -> null
    assert ("p,q", "y", "c3") in rows  # quotes parsed
    assert ("  x", "y", "c4  ") in rows  # whitespace kept
    assert ("x", "c5", None) in rows  # short row padded
    assert ("x", "y", "z") in rows  # long row truncated
    assert len(rows) == 6  # blank line skipped


def test_text_policy(spark, scratch):
    path = write_lines(scratch, LINES)
    rows = [tuple(r)[:3] for r in read_text_table(spark, path, COLS).collect()]
    assert ("x", "y", "c1") in rows
    assert ("", None, None) in rows  # blank line is a row
    assert ("x", "", "c2") in rows  # empty field is a category
    assert ('"p', 'q"', "y") in rows  # quotes literal
    assert ("x", "y", "c4") in rows  # outer whitespace stripped
    assert ("x", "c5", None) in rows
    assert ("x", "y", "z") in rows
    assert len(rows) == 7


def test_text_keeps_the_rest_of_a_long_row(spark, scratch):
    path = write_lines(scratch, LINES)
    rows = {tuple(r[:3]): r["rest"] for r in read_text_table(spark, path, COLS).collect()}
    assert rows["x", "y", "z"] == ["c6"] and rows["x", "y", "c1"] == [] and rows["x", "c5", None] == []


def test_csv_strict_fails_on_ragged_rows(spark, scratch):
    path = write_lines(scratch, ["x,y,c1", "x,c5"])
    with pytest.raises(Exception):
        read_csv_table(spark, path, COLS, strict=True).collect()


def test_file_row_ids_do_not_follow_the_layout(spark, scratch):
    from tallybayes.sources import load_car

    path = write_lines(scratch, [",".join(r) for r in CAR_ROWS] * 400)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        seen = []
        for size in ("1k", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            tr, te, _ = load_car(spark, path)
            seen.append([sorted(map(tuple, side.collect())) for side in (tr, te)])
        assert seen[0] == seen[1] and len(seen[0][0]) + len(seen[0][1]) == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_text_strict_fails_on_ragged_rows(spark, scratch):
    path = write_lines(scratch, ["x,y,c1", "x,c5"])
    with pytest.raises(Exception):
        read_text_table(spark, path, COLS, strict=True).collect()
    ok = write_lines(scratch, ["x,y,c1", "p,q,c2"])
    assert read_text_table(spark, ok, COLS, strict=True).count() == 2


@pytest.mark.parametrize("reader", [read_csv_table, read_text_table])
def test_car_file_round_trip_trains_the_same_model(spark, scratch, reader):
    path = write_lines(scratch, [",".join(r) for r in CAR_ROWS])
    df = reader(spark, path, CAR_COLUMNS)
    spec = CAR_SPEC.__class__("car", CAR_SPEC.features, "label", ())
    m = train(prepare(df, spec))
    assert sorted((r.label, r.n_c) for r in m.classes.collect()) == [("acc", 2), ("good", 1), ("unacc", 2)]
    assert m.counts.count() == 21


def test_mushroom_label_first_layout(spark, scratch):
    path = write_lines(scratch, [",".join(r) for r in MUSHROOM_ROWS])
    df = read_text_table(spark, path, MUSHROOM_COLUMNS, strict=True).withColumn(
        "row_id", __import__("pyspark.sql.functions", fromlist=["x"]).monotonically_increasing_id()
    )
    from tallybayes.sources import MUSHROOM_SPEC

    p = prepare(df, MUSHROOM_SPEC)
    m = train(p)
    assert m.counts.count() == 60
    out = predict(p, m, ["row_id"]).collect()
    assert all(r.prediction == r.label for r in out)


def test_text_strip_is_unicode_aware(spark, scratch):
    path = write_lines(scratch, [" x,y,c1　", "\tx,y,c2 "])
    rows = sorted(tuple(r) for r in read_text_table(spark, path, COLS, rest=None).collect())
    assert rows == [("x", "y", "c1"), ("x", "y", "c2")]


@pytest.mark.parametrize("fmt", ["csv", "text"])
def test_loaders_read_split_train_and_predict(spark, scratch, fmt):
    from tallybayes import accuracy
    from tallybayes.sources import load_car, load_mushroom

    rows = [",".join(r) for r in CAR_ROWS] * 40
    path = write_lines(scratch, rows)
    tr, te, spec = load_car(spark, path, fmt=fmt)
    assert tr.count() + te.count() == 200
    model = train(prepare(tr, spec))
    acc = accuracy(predict(prepare(te, spec), model, ["row_id"])).first()
    assert acc.n_test == te.count() and 0.0 <= acc.accuracy <= 1.0
    htr, hte, _ = load_car(spark, path, fmt=fmt, split="hash")
    assert htr.count() + hte.count() == 200
    # no path: the inline rows
    itr, ite, mspec = load_mushroom(spark)
    assert itr.count() + ite.count() == 5 and mspec.label == "label"


@pytest.mark.parametrize("reader", [read_csv_table, read_text_table])
def test_question_mark_is_an_ordinary_category(spark, scratch, reader):
    path = write_lines(scratch, ["x,?,c1", "?,y,c2"])
    rows = sorted(tuple(r)[:3] for r in reader(spark, path, COLS).collect())
    assert rows == [("?", "y", "c2"), ("x", "?", "c1")]
