"""Delimited-file scans with an explicit schema and an explicit row policy.

Two policies exist because a CSV parser and a raw line split disagree on
several inputs:

==================  ======================  ============================
input               ``read_csv_table``      ``read_text_table``
==================  ======================  ============================
blank line          skipped                 one row, first field ``''``
empty field         null                    ``''`` (a category)
quoted ``"a,b"``    one field ``a,b``       two fields, quotes kept
outer whitespace    kept                    stripped from the line
short row           padded with null        padded with null
long row            extra fields dropped    extra fields in ``rest``
==================  ======================  ============================

``strict=True`` on either scan fails the job on a row whose field count
differs from the schema instead of padding or dropping. ``rest`` on the text
scan names the array column that takes the fields beyond the schema (None drops
them). ``read_with_rejects`` is the third way: rows that don't fit become a table
of their own, with the line and what is wrong with it.
All are plain DataFrame scans: splittable, parallel, no driver work.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.sources.fixed import string_schema

FIELDS = "_fields"


def read_csv_table(spark: SparkSession, path: str, columns, sep: str = ",", strict: bool = False) -> DataFrame:
    """Headerless delimited file parsed as CSV into all-string columns."""
    return (
        spark.read.schema(string_schema(tuple(columns)))
        .option("header", "false")
        .option("sep", sep)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )


def read_text_fields(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """One row per line: the line stripped of outer whitespace, split on ``sep``.

    Whitespace is Unicode-aware (``(?U)``), so e.g. a no-break space at a line
    end is stripped too.
    """
    line = F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", "")
    return spark.read.text(path).select(F.split(line, re.escape(sep), -1).alias(FIELDS))


def read_text_table(
    spark: SparkSession, path: str, columns, sep: str = ",", strict: bool = False, rest: str | None = "rest"
) -> DataFrame:
    """Headerless delimited file split line by line into all-string columns, and the array ``rest`` unless strict."""
    columns = tuple(columns)
    fields = F.col(FIELDS)
    if strict:
        fields = F.when(F.size(fields) == len(columns), fields).otherwise(
            F.raise_error(
                F.concat(
                    F.lit(f"expected {len(columns)} fields, got "),
                    F.size(fields).cast("string"),
                )
            )
        )
    out = [F.get(fields, i).alias(c) for i, c in enumerate(columns)]
    if rest is not None and not strict:
        n = len(columns)
        out.append(F.slice(fields, F.lit(n + 1), F.greatest(F.size(fields) - n, F.lit(0))).alias(rest))
    return read_text_fields(spark, path, sep).select(*out)


@dataclass(frozen=True)
class Scan:
    """What a file holds: rows that fit the schema, and lines that don't (file, line, reason)."""

    accepted: DataFrame
    rejects: DataFrame


def read_with_rejects(spark: SparkSession, path: str, columns: dict[str, str], sep: str = ",", policy: str = "csv") -> Scan:
    """Typed rows of a headerless delimited file, and its other lines with the reason; each line is in one of the two.

    ``columns`` gives a Spark type for each column. Reasons, the first that holds:
    ``blank line``, ``malformed`` (an open quote), ``fields: expected 4, got 3``,
    ``type: column x is not bigint``. The policies split as the two scans do:
    ``csv`` has quotes, and empty fields are null; ``text`` strips the line and
    splits it at each separator, and empty fields are empty strings. Fields don't span lines.
    """
    if policy not in ("csv", "text"):
        raise ValueError(f"unknown policy {policy!r}")
    names, n = list(columns), len(columns)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    blank = F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", "") == ""
    if policy == "text":
        line = F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", "")
        lines = lines.withColumn("parts", F.split(line, re.escape(sep), -1)).withColumn("broken", F.lit(False))
    else:
        quoted = f'"(?:[^"]|"")*"'
        one = f"(?:{quoted}|[^{re.escape(sep)}\"][^{re.escape(sep)}]*|)"
        whole = F.col("value").rlike(f"^{one}(?:{re.escape(sep)}{one})*$")
        # each field follows a separator, put before the first one too
        found = F.regexp_extract_all(F.concat(F.lit(sep), F.col("value")), F.lit(f"{re.escape(sep)}({one})"), F.lit(1))
        plain = F.transform(
            found,
            lambda f: F.when(f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')))
            .when(f == "", F.lit(None))
            .otherwise(f),
        )
        lines = lines.withColumn("parts", plain).withColumn("broken", ~whole)
    field = {c: F.get(F.col("parts"), F.lit(i)) for i, c in enumerate(names)}
    typed = {c: field[c] if t == "string" else field[c].try_cast(t) for c, t in columns.items()}
    reason = (
        F.when(blank, F.lit("blank line"))
        .when(F.col("broken"), F.lit("malformed"))
        .when(F.size("parts") != n, F.concat(F.lit(f"fields: expected {n}, got "), F.size("parts").cast("string")))
    )
    for c, t in columns.items():
        if t != "string":
            reason = reason.when(field[c].isNotNull() & typed[c].isNull(), F.lit(f"type: column {c} is not {t}"))
    rows = lines.select("file", "value", reason.alias("_reason"), *[typed[c].alias(f"_c{i}") for i, c in enumerate(names)])
    accepted = rows.filter(F.col("_reason").isNull()).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
    rejects = rows.filter(F.col("_reason").isNotNull()).select("file", F.col("value").alias("line"), F.col("_reason").alias("reason"))
    return Scan(accepted, rejects)
