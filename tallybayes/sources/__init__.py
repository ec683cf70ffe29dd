"""Sources: dataset descriptors, inline tables, delimited scans, driver tables."""

from tallybayes.sources.delimited import Scan, read_csv_table, read_text_fields, read_text_table, read_with_rejects
from tallybayes.sources.fixed import (
    CAR_COLUMNS,
    CAR_ROWS,
    CAR_SPEC,
    MUSHROOM_COLUMNS,
    MUSHROOM_ROWS,
    MUSHROOM_SPEC,
    car_table,
    inline_table,
    mushroom_table,
    string_schema,
)
from tallybayes.sources.loaders import load_car, load_labelled, load_mushroom
from tallybayes.sources.spec import DatasetSpec
from tallybayes.sources.tables import (
    DATASETS,
    documents_lang,
    events_set,
    lineitem_part,
    load_dataset,
    orders_set,
    read_table,
)

__all__ = [
    "CAR_COLUMNS",
    "CAR_ROWS",
    "CAR_SPEC",
    "DATASETS",
    "DatasetSpec",
    "MUSHROOM_COLUMNS",
    "MUSHROOM_ROWS",
    "MUSHROOM_SPEC",
    "Scan",
    "car_table",
    "documents_lang",
    "events_set",
    "inline_table",
    "lineitem_part",
    "load_car",
    "load_dataset",
    "load_labelled",
    "load_mushroom",
    "mushroom_table",
    "orders_set",
    "read_csv_table",
    "read_table",
    "read_text_fields",
    "read_text_table",
    "read_with_rejects",
    "string_schema",
]
