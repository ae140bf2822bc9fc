"""Component coding: attributes translated one by one and rebuilt in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import jsons, keys
from sightline.operators.increments import reread_held
from sightline.operators.merge import merge, park_release

ENTITY = ["component_coding_id", "creative_id"]
# --- fixed values: attribute kinds that are translated ---
PRODUCT, MANUFACTURER, MATTRESS = "Product", "Manufacturer", "Mattress Product"
MAPPED_KINDS = ["Promotional Gift", "Return Policy Duration"]


def changed_components(
    components: DataFrame,
    creatives: DataFrame,
    templates: DataFrame,
    hold: DataFrame,
    since: Column,
) -> DataFrame:
    """Changed and parked components with the creative's legacy id and the template's name."""
    rows = reread_held(components, F.col("modified") > since, hold, "component_coding_id")
    legacy = creatives.select("creative_id", "legacy_creative_id")
    names = templates.select(
        F.col("componenttemplateid").alias("component_template_id"),
        F.col("componenttemplatename").alias("component_template_name"),
    )
    return (
        rows.join(legacy, "creative_id", "left")
        .join(names, "component_template_id", "left")
        .withColumnsRenamed({"created": "created_timestamp", "modified": "modified_timestamp"})
    )


def explode_components(
    components: DataFrame,
    *,
    product_map: DataFrame,
    products: DataFrame,
    advertiser_map: DataFrame,
    advertisers: DataFrame,
    value_map: DataFrame,
) -> DataFrame:
    """One row per attribute with its translation; only completed components are translated."""
    attributes = jsons.parsed(F.col("attribute_response"), jsons.ATTRIBUTES)
    firsts = F.array_min(
        F.transform(
            F.filter(attributes, lambda a: a["fkey"] == MATTRESS), lambda a: a["value"]
        )
    )
    rows = components.select(
        *ENTITY,
        "status",
        firsts.alias("advert_product"),
        F.posexplode(attributes).alias("_pos", "_a"),
    ).select(
        *ENTITY,
        "status",
        "advert_product",
        (F.col("_pos") + 1).alias("seq"),
        F.col("_a.fkey").alias("fkey"),
        F.col("_a.value").alias("fkey_value"),
        F.col("_a.id").alias("id"),
        F.col("_a.referenceType").alias("reference_type"),
        F.col("_a.unit").alias("unit"),
    )
    complete = F.col("status") == C.CODING_COMPLETED
    coded = rows.withColumns(
        {
            "mapping_hash": F.when(
                (F.col("fkey") == PRODUCT) & complete, keys.product_key(F.col("id"), C.SYSTEM_VX2)
            ),
            "vx0_company_id": F.when((F.col("fkey") == MANUFACTURER) & complete, F.col("id"))
            .try_cast("bigint"),
        }
    )
    codes = product_map.filter(F.col("system_id") == int(C.SYSTEM_VX2)).select(
        "mapping_hash", F.col("target_product_id").alias("vx2_id")
    )
    names = products.select(F.col("prseq").alias("vx2_id"), "prname")
    makers = advertiser_map.select(
        "vx0_company_id", F.col("vx2_code").alias("vx2_manufacture")
    )
    maker_names = advertisers.select(
        F.col("code").alias("vx2_manufacture"), F.col("name").alias("vx2_manufacture_name")
    )
    values = value_map.select(
        F.col("vx0_component_value").alias("fkey_value"), "vx2_component_value"
    )
    return (
        coded.join(codes, "mapping_hash", "left")
        .join(names, "vx2_id", "left")
        .join(makers, "vx0_company_id", "left")
        .join(maker_names, "vx2_manufacture", "left")
        .join(values, "fkey_value", "left")
        .select(
            *ENTITY, "status", "seq", "fkey", "fkey_value", "id", "reference_type", "unit",
            "advert_product", "vx2_id", "prname", "vx2_manufacture", "vx2_manufacture_name",
            "vx2_component_value",
        )
    )


def rebuild_components(
    components: DataFrame, exploded: DataFrame, mattress_map: DataFrame
) -> DataFrame:
    """Both attribute arrays per component, in order, and the holding flag.

    The attributes are gathered once per component, together with the maker and the mattress
    value that decide the mattress code; both arrays are then built inside the row.
    """
    kind = F.col("fkey")
    is_product = kind == PRODUCT
    gathered = exploded.groupBy(*ENTITY).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "seq", "fkey", "fkey_value", "id", "reference_type", "unit", "prname",
                    "vx2_id", "vx2_manufacture", "vx2_manufacture_name", "vx2_component_value",
                )
            )
        ).alias("_parts"),
        F.max("status").alias("_status"),
        F.max("vx2_manufacture").alias("_maker"),
        F.max("advert_product").alias("_advert"),
        F.count_if(is_product & F.col("id").isNotNull()).alias("_n_vx0"),
        F.count_if(is_product & F.col("vx2_id").isNotNull()).alias("_n_vx2"),
    )
    mattress = mattress_map.groupBy(
        F.col("vx2_mattress_product").alias("_advert"), F.col("vx2_advertiser_code").alias("_code")
    ).agg(F.min("cmp_seq").cast("string").alias("_seq"))
    placed = gathered.withColumn("_code", F.coalesce("_maker", F.lit(""))).join(
        mattress, ["_advert", "_code"], "left"
    )

    def element(p: Column, value: Column, id: Column) -> Column:
        return F.create_map(
            F.lit("fkey"), p["fkey"],
            F.lit("fkey_value"), value,
            F.lit("id"), id,
            F.lit("referenceType"), p["reference_type"],
            F.lit("unit"), p["unit"],
        )

    def as_stored(p: Column) -> Column:
        return element(p, p["fkey_value"], p["id"])

    def as_translated(p: Column) -> Column:
        value = (
            F.when(p["fkey"] == PRODUCT, p["prname"])
            .when(p["fkey"] == MANUFACTURER, p["vx2_manufacture_name"])
            .when(p["fkey"].isin(MAPPED_KINDS), p["vx2_component_value"])
            .otherwise(p["fkey_value"])
        )
        id = (
            F.when(p["fkey"] == PRODUCT, p["vx2_id"].cast("string"))
            .when(p["fkey"] == MANUFACTURER, p["vx2_manufacture"])
            .when(p["fkey"] == MATTRESS, F.col("_seq"))
            .otherwise(p["id"])
        )
        return element(p, value, id)

    rebuilt = placed.select(
        *ENTITY,
        F.to_json(F.transform("_parts", as_stored)).alias("attribute_response"),
        F.when(
            F.col("_status") == C.CODING_COMPLETED, F.to_json(F.transform("_parts", as_translated))
        ).alias("attribute_response_vx2"),
        "_n_vx0",
        "_n_vx2",
    )
    zero = F.lit(0)
    return (
        components.drop("attribute_response")
        .join(rebuilt, ENTITY, "left")
        .withColumn(
            "holding_flag",
            F.coalesce(
                (F.col("status") == C.CODING_COMPLETED)
                & (F.coalesce("_n_vx0", zero) != F.coalesce("_n_vx2", zero)),
                F.lit(False),
            ),
        )
        .drop("_n_vx0", "_n_vx2")
    )


#: columns of a stored component that an update replaces
MUTABLE = [
    "attribute_response", "attribute_response_vx2", "is_logically_deleted", "modified_timestamp",
    "creative_path", "status", "modified_by", "order_number",
]


def gold_components(gold: DataFrame, rebuilt: DataFrame) -> DataFrame:
    ready = rebuilt.filter(~F.col("holding_flag"))
    return merge(gold, ready, ["creative_id", "component_coding_id"],
                 update=[c for c in MUTABLE if c in gold.columns])


def component_hold(hold: DataFrame, rebuilt: DataFrame) -> DataFrame:
    held = F.col("holding_flag")
    return park_release(hold, rebuilt, ["component_coding_id"], ~held, held)
