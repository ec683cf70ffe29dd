"""Each line of a file is a typed row or a reject with a reason."""

from __future__ import annotations

import pytest

from tallybayes.sources import read_with_rejects

COLUMNS = {"id": "int", "name": "string", "size": "double"}


def scan(spark, scratch, lines, **kw):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/f")
    out = read_with_rejects(spark, f"{scratch}/f", COLUMNS, **kw)
    accepted, rejects = [tuple(r) for r in out.accepted.collect()], [(r["line"], r["reason"]) for r in out.rejects.collect()]
    assert len(accepted) + len(rejects) == len(lines)
    assert all(r["file"].endswith(".txt") for r in out.rejects.collect())
    return accepted, rejects


def test_csv_policy(spark, scratch):
    good = ['1,a,2.5', '2,"x, y",3', '3,,', '4,"say ""hi""",1e3', ' 5, b ,7', "6,it's,0", '7,a"b,1']
    bad = {
        "": "blank line", " \t": "blank line", "8,a": "fields: expected 3, got 2", "8,a,1,2": "fields: expected 3, got 4",
        "8": "fields: expected 3, got 1", "x,a,1": "type: column id is not int", "8,a,wide": "type: column size is not double",
        "99999999999,a,1": "type: column id is not int", '8,"open,1': "malformed", '8,"a"b,1': "malformed",
    }
    accepted, rejects = scan(spark, scratch, [*good, *bad])
    assert accepted == [
        (1, "a", 2.5), (2, "x, y", 3.0), (3, None, None), (4, 'say "hi"', 1000.0), (5, " b ", 7.0), (6, "it's", 0.0), (7, 'a"b', 1.0),
    ]
    assert rejects == list(bad.items())


def test_text_policy_and_another_separator(spark, scratch):
    accepted, rejects = scan(spark, scratch, [' 1;"a;2 ', "2;;3", "3;b;", "4;b"], sep=";", policy="text")
    assert accepted == [(1, '"a', 2.0), (2, "", 3.0)]
    assert rejects == [("3;b;", "type: column size is not double"), ("4;b", "fields: expected 3, got 2")]


def test_empty_file_and_unknown_policy(spark, scratch):
    assert scan(spark, scratch, []) == ([], [])
    with pytest.raises(ValueError, match="policy"):
        read_with_rejects(spark, scratch, COLUMNS, policy="x")
