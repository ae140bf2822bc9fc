"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDARY_PRODUCT = (
    "array<struct<sort_order:int,type:string,subtype:string,product_id:bigint,is_dominant:boolean>>"
)
CHAIN = "array<struct<id:bigint,role:string,index:bigint,roleId:bigint,mediator:string>>"
REFERENCE_IDS = "array<struct<id:bigint>>"
ATTRIBUTES = "array<struct<fkey:string,value:string,id:string,referenceType:string,unit:string>>"


def text_at(json: Column, path: str) -> Column:
    """Scalar or JSON text at a path; NULL when the text is not JSON."""
    return F.get_json_object(json, path)


def parsed(json: Column, ddl: str) -> Column:
    """JSON text to a typed value; NULL when malformed."""
    return F.from_json(json, ddl)


def object_keep_null(pairs: dict[str, Column]) -> Column:
    """JSON object whose values are all text; NULL values stay as JSON null."""
    flat: list[Column] = []
    for name, value in pairs.items():
        flat += [F.lit(name), value.cast("string")]
    return F.to_json(F.create_map(*flat))


def object_drop_null(pairs: dict[str, Column]) -> Column:
    """JSON object with typed values; NULL values are left out."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in pairs.items()]))


def object_typed(pairs: dict[str, Column]) -> Column:
    """JSON object with typed values; NULL values stay as JSON null."""
    return F.to_json(
        F.struct(*[v.alias(k) for k, v in pairs.items()]), {"ignoreNullFields": "false"}
    )


def merge_objects(*objects: Column) -> Column:
    """Concatenate JSON objects; on a common key the object further right wins.

    Values keep their type because they are carried as variants.
    """
    merged = None
    for json in objects:
        right = F.coalesce(
            F.try_parse_json(json).cast("map<string,variant>"),
            F.expr("cast(map() as map<string,variant>)"),
        )
        if merged is None:
            merged = right
        else:
            merged = _overlay(merged, right)
    return F.to_json(merged)


def _overlay(left: Column, right: Column) -> Column:
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def array_size(json: Column) -> Column:
    """Length of a JSON array, NULL and non-arrays read as 0."""
    return F.coalesce(F.json_array_length(json), F.lit(0))


def default_array(json: Column) -> Column:
    """NULL JSON array read as the empty array."""
    return F.coalesce(json, F.lit("[]"))


def null_if_first_missing(json: Column) -> Column:
    """NULL when the first element of the array has no id."""
    return F.when(F.get_json_object(json, "$[0].id").isNotNull(), json)
