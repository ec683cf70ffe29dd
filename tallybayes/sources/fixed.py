"""The two small labelled datasets and their schemas.

These are inline tables: handy for tests and examples. Registered queries
never run on them alone; they read the driver tables instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallybayes.sources.spec import DatasetSpec

# --- fixed values (schemas and rows of the two inline datasets) ------------
# Car evaluation: no header, comma separated, label last.
CAR_COLUMNS = ("buying", "maint", "doors", "persons", "lug_boot", "safety", "label")
CAR_ROWS = (
    ("low", "med", "2", "2", "small", "low", "unacc"),
    ("low", "med", "2", "2", "small", "med", "unacc"),
    ("low", "med", "2", "2", "small", "high", "acc"),
    ("low", "med", "2", "2", "med", "low", "acc"),
    ("low", "med", "2", "2", "med", "med", "good"),
)
# Mushroom: no header, comma separated, label first (p = poisonous, e = edible).
MUSHROOM_COLUMNS = (
    "label",
    "cap_shape",
    "cap_surface",
    "cap_color",
    "bruises",
    "odor",
    "gill_attachment",
    "gill_spacing",
    "gill_size",
    "gill_color",
    "stalk_shape",
    "stalk_root",
    "stalk_surface_above_ring",
    "stalk_surface_below_ring",
    "stalk_color_above_ring",
    "stalk_color_below_ring",
    "veil_type",
    "veil_color",
    "ring_number",
    "ring_type",
    "spore_print_color",
    "population",
    "habitat",
)
MUSHROOM_ROWS = (
    ("p", "x", "s", "n", "t", "p", "f", "c", "n", "k", "e", "e", "s", "s", "w", "w", "p", "w", "o", "p", "k", "s", "u"),
    ("e", "x", "s", "y", "t", "a", "f", "c", "b", "k", "e", "c", "s", "s", "w", "w", "p", "w", "o", "p", "n", "n", "g"),
    ("e", "b", "s", "w", "t", "l", "f", "c", "b", "n", "e", "c", "s", "s", "w", "w", "p", "w", "o", "p", "n", "n", "m"),
    ("p", "x", "y", "w", "t", "p", "f", "c", "n", "n", "e", "e", "s", "s", "w", "w", "p", "w", "o", "p", "k", "s", "u"),
    ("e", "x", "s", "g", "f", "n", "f", "w", "b", "k", "t", "e", "s", "s", "w", "w", "p", "w", "o", "e", "n", "a", "g"),
)
# ---------------------------------------------------------------------------

ROW_ID = "row_id"

CAR_SPEC = DatasetSpec("car", CAR_COLUMNS[:-1], "label", (ROW_ID,))
MUSHROOM_SPEC = DatasetSpec("mushroom", MUSHROOM_COLUMNS[1:], "label", (ROW_ID,))


def string_schema(columns: tuple[str, ...] | list[str]) -> StructType:
    """All-string, nullable schema (the data model of both datasets)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def inline_table(spark: SparkSession, columns, rows, with_id: bool = True) -> DataFrame:
    """Small constant table; ``row_id`` (1-based row number) added when asked."""
    df = spark.createDataFrame([tuple(r) for r in rows], schema=string_schema(columns))
    if not with_id:
        return df
    ided = [(i + 1, *r) for i, r in enumerate(rows)]
    schema = StructType([StructField(ROW_ID, LongType(), False), *string_schema(columns).fields])
    return spark.createDataFrame(ided, schema=schema)


def car_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, CAR_COLUMNS, CAR_ROWS)


def mushroom_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, MUSHROOM_COLUMNS, MUSHROOM_ROWS)
