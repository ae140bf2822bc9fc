"""URL, text and number expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline import constants as C


def url_host(url: Column) -> Column:
    """Lower-case host of a URL; one blank for NULL, empty text when nothing matches."""
    one_line = F.coalesce(F.regexp_replace(url, r"[\n\r]+", ""), F.lit(" "))
    return F.coalesce(F.regexp_extract(F.lower(one_line), C.URL_HOST_PATTERN, 1), F.lit(""))


def valid_url(url: Column) -> Column:
    """The URL itself when it is a plain http(s) URL, else NULL."""
    return F.when(url.rlike(C.URL_VALID_PATTERN), url)


def domain_chain(url: Column) -> Column:
    """Bare domain of a property URL: between the scheme and the first slash or query."""
    head = F.substring_index(url, "/", 3)
    after_scheme = F.substring_index(head, "://", -1)
    return F.substring_index(F.substring_index(after_scheme, "/", 1), "?", 1)


def contains(text: Column, part: Column) -> Column:
    """True when ``part`` occurs in ``text`` (the empty part always does)."""
    return F.position(part, text) > 0


def path_score(text: Column) -> Column:
    """Score of a link text by the path segments it holds."""
    is_ad = reduce(lambda a, b: a | b, [text.contains(p) for p in C.AD_PATHS])
    return (
        F.when(is_ad, C.SCORE_AD_PATH)
        .when(text.contains(C.CONTENT_PATH), C.SCORE_CONTENT_PATH)
        .otherwise(0)
    )


def strip_nul(text: Column) -> Column:
    """Text without NUL characters, which relational stores reject."""
    return F.translate(text, "\u0000", "")


def whole_seconds(millis: Column) -> Column:
    """Milliseconds to whole seconds, half up; 0 and NULL are kept."""
    return (
        F.when(millis.isNull() | (millis == 0), millis)
        .otherwise(F.round(millis / F.lit(1000.0)))
        .cast("int")
    )


def segments(text: Column, delim: str, count: int) -> Column:
    """First (``count`` > 0) or last (``count`` < 0) segments of a delimited text."""
    return F.substring_index(text, delim, count)


def part_of(text: Column, delim: str, index: int) -> Column:
    """Segment by 1-based index, negative from the end, empty text when out of range."""
    return F.split_part(text, F.lit(delim), F.lit(index))
