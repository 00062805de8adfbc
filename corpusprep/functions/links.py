"""Link extraction and URL normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK_CLASS, strip

# What ends a link inside text, and punctuation cut from its end.
URL = f'(?i)(https?://[^{BLANK_CLASS})>\\]"}}]+)'
TRAILING_PUNCT = ".,);]}>\"'!?、。’”"

_SPLIT = "^([A-Za-z][A-Za-z0-9+.\\-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?"


def strip_trailing_punct(url: Column) -> Column:
    return F.rtrim(url, F.lit(TRAILING_PUNCT))


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, keep path and query, drop the fragment.

    A host with an unpaired bracket is malformed and is returned as it came.
    """
    url = strip_trailing_punct(strip(F.coalesce(url, F.lit(""))))

    def part(group: int) -> Column:
        return F.regexp_extract(url, _SPLIT, group)

    malformed = part(2).contains("[") != part(2).contains("]")
    query = F.when(part(4) == "?", F.lit("")).otherwise(part(4))
    rebuilt = F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), part(3), query)
    return (
        F.when(malformed, url)
        .when(url.rlike(_SPLIT), rebuilt)
        .otherwise(F.regexp_replace(url, "(?s)#.*$", ""))
    )


def extract_urls(text: Column) -> Column:
    """Links of a text, normalised, each once, in order of first appearance."""
    found = F.regexp_extract_all(text, F.lit(URL), F.lit(1))
    urls = F.array_distinct(F.filter(F.transform(found, normalize_url), lambda u: u != ""))
    return F.when(text.contains("://"), urls).otherwise(F.array().cast("array<string>"))


def merge_links(previous: Column, links: Column) -> Column:
    """Ordered union of two link lists; blanks and nulls are dropped."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(previous, empty), F.coalesce(links, empty))
    return F.array_distinct(F.filter(both, lambda u: u.isNotNull() & (u != "")))
