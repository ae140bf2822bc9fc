"""Expressions over arrays inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions import jsons
from sightline.functions.keys import md5_key


def sorted_chain(chain_json: Column) -> Column:
    """Chain elements ordered by (index, id, role)."""
    elements = jsons.parsed(chain_json, jsons.CHAIN)
    return F.array_sort(
        F.transform(
            elements,
            lambda e: F.struct(
                e["index"].alias("idx"), e["id"].alias("id"), e["roleId"].alias("role_id")
            ),
        )
    )


def _joined(elements: Column, form, delim: str) -> Column:
    # an element with a NULL part becomes NULL, which array_join leaves out
    return F.array_join(F.transform(elements, form), delim)


def chain_with_roles(chain_json: Column) -> Column:
    """``id(role)`` joined by commas."""
    return _joined(
        sorted_chain(chain_json),
        lambda e: F.concat(e["id"].cast("string"), F.lit("("), e["role_id"].cast("string"), F.lit(")")),
        ",",
    )


def chain_path(chain_json: Column) -> Column:
    """``id.role`` joined by bars."""
    return _joined(
        sorted_chain(chain_json),
        lambda e: F.concat(e["id"].cast("string"), F.lit("."), e["role_id"].cast("string")),
        "|",
    )


def chain_key(purchase_method: Column, path: Column) -> Column:
    """Key of a deployment chain; empty text when there is no chain."""
    return F.when(F.coalesce(path, F.lit("")) != "", md5_key(purchase_method, path)).otherwise("")


def sorted_ids(ids: Column) -> Column:
    """Array of numbers, ascending, joined by bars."""
    return F.array_join(F.transform(F.array_sort(ids), lambda x: x.cast("string")), "|")
