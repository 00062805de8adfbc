"""Open metadata of a record as ``map<string, variant>``."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import strip

# Texts that mean "no metadata", and keys the record itself owns.
MISSING = ["", "none", "null", "nan"]
RESERVED = ["bucket", "object_path", "line_no"]

METADATA = "map<string,variant>"


@F.pandas_udf(StringType())
def _python_dict_batch(texts: pd.Series) -> pd.Series:
    """JSON form of texts that are Python dict literals, null for anything else."""

    def convert(text):
        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
            return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return texts.map(convert)


def sentinel_to_null(text: Column) -> Column:
    return F.when(F.lower(strip(text)).isin(MISSING), F.lit(None)).otherwise(text)


def _as_map(value: Column) -> Column:
    """The variant as a map, null unless it is an object."""
    return F.try_variant_get(value, "$", METADATA)


def parse_metadata(meta: Column) -> Column:
    """Metadata text to a map: JSON object, else Python dict literal, else kept whole under ``raw_meta``.

    Only texts that are not JSON objects are handed to Python.
    """
    meta = sentinel_to_null(meta)
    from_json = _as_map(F.try_parse_json(meta))
    not_json = meta.isNotNull() & from_json.isNull()
    from_python = _as_map(F.try_parse_json(_python_dict_batch(F.when(not_json, meta))))
    raw = F.create_map(F.lit("raw_meta"), F.parse_json(F.to_json(F.array(meta))))
    raw = F.transform_values(raw, lambda _, v: F.variant_get(v, "$[0]", "variant"))
    empty = F.create_map().cast(METADATA)
    return F.coalesce(from_json, from_python, F.when(meta.isNotNull(), raw), empty)


def put(meta: Column, key: str, value: Column) -> Column:
    """Set ``key`` to a text value where that value is present; other keys are kept."""
    quoted = F.variant_get(F.parse_json(F.to_json(F.array(value))), "$[0]", "variant")
    others = F.map_filter(meta, lambda k, _: k != key)
    return F.when(value.isNotNull() & (value != ""), F.map_concat(others, F.create_map(F.lit(key), quoted))).otherwise(meta)


def put_array(meta: Column, key: str, values: Column) -> Column:
    others = F.map_filter(meta, lambda k, _: k != key)
    entry = F.create_map(F.lit(key), F.parse_json(F.to_json(values)))
    return F.when(F.size(values) > 0, F.map_concat(others, entry)).otherwise(meta)


def drop_reserved(meta: Column) -> Column:
    return F.map_filter(meta, lambda k, _: ~k.isin(RESERVED))


def text_of(meta: Column, key: str) -> Column:
    return F.try_variant_get(F.element_at(meta, F.lit(key)), "$", "string")


def strings_of(meta: Column, key: str) -> Column:
    """A list of texts under ``key``, null when it is absent or no list."""
    return F.try_variant_get(F.element_at(meta, F.lit(key)), "$", "array<string>")
