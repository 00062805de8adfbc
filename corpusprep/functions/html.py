"""HTML to text as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from html import unescape as decode_any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .text import NBSP, ZERO_WIDTH, maybe_not_nfc, visible

# Blocks dropped with their content.
SCRIPT_OR_STYLE = "(?is)<(script|style)\\b[^>]*>.*?</\\1\\s*>"
COMMENT = "(?s)<!--.*?-->"
TAG = "</?[A-Za-z][^>]*>|<[!?][^>]*>"
_MARKUP = [re.compile(pattern) for pattern in (SCRIPT_OR_STYLE, COMMENT, TAG)]

# Entities decoded inside the JVM. ``amp`` comes last, or its result could start a new entity.
ENTITIES = [
    ("lt", "<"),
    ("gt", ">"),
    ("quot", '"'),
    ("apos", "'"),
    ("nbsp", chr(0xA0)),
    ("copy", "©"),
    ("reg", "®"),
    ("middot", "·"),
    ("bull", "•"),
    ("hellip", "…"),
    ("ndash", "–"),
    ("mdash", "—"),
    ("lsquo", "‘"),
    ("rsquo", "’"),
    ("ldquo", "“"),
    ("rdquo", "”"),
    ("laquo", "«"),
    ("raquo", "»"),
    ("amp", "&"),
]
_OTHER_ENTITY = "&(?!(?:" + "|".join(name for name, _ in ENTITIES) + ");)[#A-Za-z]"


@F.pandas_udf(StringType())
def _decode_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else decode_any(t))


def drop_markup(html: Column) -> Column:
    """Script and style blocks, comments and tags removed; texts without a tag opener skip the expressions."""
    stripped = F.regexp_replace(html, SCRIPT_OR_STYLE, "")
    stripped = F.regexp_replace(stripped, COMMENT, "")
    return F.when(html.contains("<"), F.regexp_replace(stripped, TAG, "")).otherwise(html)


def _decode_common(text: Column) -> Column:
    decoded = text
    for name, char in ENTITIES:
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(char))
    return F.when(text.contains("&"), decoded).otherwise(text)


def with_text(df: DataFrame, html: str, out: str) -> DataFrame:
    """Add the text of an HTML column.

    Common entities are replaced inside the JVM; only rows holding any other entity go to Python. The stripped form is
    its own projection and so is computed once.
    """
    stripped = df.withColumn("_stripped", drop_markup(F.col(html)))
    other = _decode_batch(F.when(F.col("_stripped").rlike(_OTHER_ENTITY), F.col("_stripped")))
    return stripped.withColumn(out, F.coalesce(other, _decode_common(F.col("_stripped")))).drop("_stripped")


@F.pandas_udf(StructType([StructField("visible", StringType()), StructField("text", StringType())]))
def _rare_batch(texts: pd.Series) -> pd.DataFrame:
    """Both steps for the rows that need Python: composed visible text, and the same without markup."""
    zero_width = str.maketrans(NBSP, " ", ZERO_WIDTH)
    visible, plain = [], []
    for text in texts:
        if text is not None:
            text = unicodedata.normalize("NFC", text).translate(zero_width)
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        visible.append(text)
        if text is not None:
            for pattern in _MARKUP:
                text = pattern.sub("", text)
            text = decode_any(text)
        plain.append(text)
    return pd.DataFrame({"visible": visible, "text": plain}, dtype=object)


def with_visible_text(df: DataFrame, raw: str, visible_out: str, text_out: str) -> DataFrame:
    """Unicode and HTML steps together: normal form and its text.

    One Python call serves both steps, for rows that may not be composed or hold an uncommon entity; every other row
    is done by built-in expressions and passes a null.
    """
    source = F.col(raw)
    rare = maybe_not_nfc(source) | (source.contains("&") & source.rlike(_OTHER_ENTITY))
    df = df.withColumn("_rare", _rare_batch(F.when(rare, source)))
    df = df.withColumn("_native", F.when(F.col("_rare.visible").isNull(), visible(source)))
    df = df.withColumn("_stripped", drop_markup(F.col("_native")))
    return (
        df.withColumn(visible_out, F.coalesce("_rare.visible", "_native"))
        .withColumn(text_out, F.coalesce(F.col("_rare.text"), _decode_common(F.col("_stripped"))))
        .drop("_rare", "_native", "_stripped")
    )
