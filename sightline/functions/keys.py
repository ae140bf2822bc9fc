"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.text import part_of


def url_fingerprint(url: Column) -> Column:
    """Signed 64-bit hash of the first, second and last dot-separated part of a URL."""
    dot = F.lit(".")
    key = F.concat(part_of(url, ".", 1), dot, part_of(url, ".", 2), dot, part_of(url, ".", -1))
    # xxhash64 of NULL is the seed, so NULL needs its own branch
    return F.when(url.isNotNull(), F.xxhash64(key))


def md5_key(*parts: Column) -> Column:
    """Upper-case hex MD5 of the concatenated parts; NULL when any part is NULL."""
    return F.upper(F.md5(F.concat(*[p.cast("string") for p in parts])))


def stable_id(text: Column) -> Column:
    """Stable 64-bit surrogate id of a text."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def product_key(product_id: Column, system: str, secondary_ids: Column | None = None) -> Column:
    """Lookup key of the product map: id, target system, then the joined secondary ids."""
    tail = F.lit("") if secondary_ids is None else F.coalesce(secondary_ids, F.lit(""))
    return md5_key(product_id, F.lit(system), tail)
