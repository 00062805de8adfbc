"""Text normalisation, measures and checksums as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Literal escape texts and the characters they stand for, in the order they are replaced.
ESCAPES = [
    ("\\r\\n", "\n"),
    ("\\n", "\n"),
    ("\\t", "\t"),
    ("\\u00A0", chr(0x00A0)),
    ("\\u200B", chr(0x200B)),
    ("\\u200C", chr(0x200C)),
    ("\\u200D", chr(0x200D)),
]

NBSP = chr(0xA0)
ZERO_WIDTH = chr(0x200B) + chr(0x200C) + chr(0x200D)

# Default script (Thai block), its gate for the language code, and the default limits.
THAI = "\\u0E00-\\u0E7F"
THAI_GATE = 0.90
MIN_CHARS = 10
MIN_RATIO = 0.1

# Every character Python's str.strip() removes.
BLANKS = "".join(
    [chr(c) for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680)]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)
# The same set inside a regular-expression character class.
BLANK_CLASS = (
    "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
)

# Texts without any of these are already NFC: Latin up to U+02FF, Thai, general punctuation and the blanks and brackets
# U+3000 to U+3029 compose no further.
# Thai vowel signs and tone marks still need canonical ordering when they come in the wrong order.
_MAYBE_NOT_NFC = "[\\u0300-\\u0DFF\\u0E80-\\u2001\\u205F-\\u2FFF\\u302A-\\x{10FFFF}]"
_THAI_BELOW = "[\\u0E38-\\u0E3A]"
_TO_CHECK = f"[{_MAYBE_NOT_NFC[1:-1]}{_THAI_BELOW[1:-1]}]"
_WORD = "\\p{L}\\p{M}\\p{N}"
_THAI_DISORDER = "[\\u0E48-\\u0E4B][\\u0E38-\\u0E3A]|[\\u0E38\\u0E39]\\u0E3A"


@F.pandas_udf(StringType())
def _nfc_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


def strip(text: Column) -> Column:
    """Trim all Unicode blanks (Spark's ``trim`` alone removes U+0020 only)."""
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def unescape(text: Column) -> Column:
    """Literal escapes to characters; texts without a back-slash skip the scans."""
    replaced = text
    for escape, char in ESCAPES:
        replaced = F.replace(replaced, F.lit(escape), F.lit(char))
    return F.when(text.contains("\\"), replaced).otherwise(text)


def maybe_not_nfc(text: Column) -> Column:
    """One scan for most texts; only those it stops at are looked at again."""
    return text.rlike(_TO_CHECK) & (text.rlike(_MAYBE_NOT_NFC) | text.rlike(_THAI_DISORDER))


def nfc(text: Column) -> Column:
    """Canonical composition.

    Spark has no built-in for it. Only rows that may need it carry their text to Python; all others pass a null, so
    the Arrow transfer stays small on already composed corpora.
    """
    return F.coalesce(_nfc_batch(F.when(maybe_not_nfc(text), text)), text)


def visible(text: Column) -> Column:
    """No-break spaces to spaces, zero-width characters dropped, every line end a line feed."""
    replaced = F.replace(text, F.lit(NBSP), F.lit(" "))
    for char in ZERO_WIDTH:
        replaced = F.replace(replaced, F.lit(char), F.lit(""))
    replaced = F.replace(replaced, F.lit("\r\n"), F.lit("\n"))
    return F.replace(replaced, F.lit("\r"), F.lit("\n"))


def normalize_unicode(text: Column) -> Column:
    return visible(F.coalesce(nfc(text), F.lit("")))


def normalize_whitespace(text: Column) -> Column:
    """Collapse blanks and tabs, at most one empty line in a row, trim.

    A blank run before a line feed needs no rule of its own: the first step already leaves one space there.
    """
    plain = F.replace(text, F.lit("\t"), F.lit(" "))
    text = F.when(plain.contains("  "), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain)
    return strip(F.when(text.contains("\n\n\n"), F.regexp_replace(text, "\\n{3,}", "\n\n")).otherwise(text))


def checksum(text: Column) -> Column:
    return F.sha2(text, 256)


def script_chars(text: Column, script: str = THAI) -> Column:
    """Characters of ``text`` inside the class; removing runs is cheaper than listing single matches."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{script}]+", ""))


def script_ratio(text: Column, script: str = THAI) -> Column:
    size = F.length(text)
    return F.when(size > 0, script_chars(text, script) / size).otherwise(F.lit(0.0))


def language_gate(ratio: Column, code: str = "th", gate: float = THAI_GATE) -> Column:
    """The language code when the script ratio settles it, else null (left to the detector)."""
    return F.when(ratio >= gate, F.lit(code))


def word_count(text: Column) -> Column:
    """Runs of letters, marks and digits. Each run with what surrounds it becomes one ``w``; a text without any stays."""
    runs = F.regexp_replace(text, f"[^{_WORD}]*+[{_WORD}]++[^{_WORD}]*+", "w")
    return F.when(runs.startswith("w"), F.length(runs)).otherwise(F.when(text.isNotNull(), 0)).cast("long")


def char_count(text: Column) -> Column:
    return F.length(text).cast("long")


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def token_budget(max_positions: int = 512) -> int:
    """Tokens that fit the model, leaving two slots for its markers."""
    return max(2, min(512, max_positions) - 2)


def cut_to_budget(text: Column, budget: int) -> Column:
    """Keep the first ``budget`` blank-separated tokens when the text holds more; shorter texts stay as they are."""
    tokens = F.split(strip(text), f"[{BLANK_CLASS}]+", budget + 1)
    return F.when(F.size(tokens) > budget, F.array_join(F.slice(tokens, 1, budget), " ")).otherwise(text)
