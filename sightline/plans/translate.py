"""Translation of product codes into two target systems."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import jsons, keys, nested
from sightline.operators.joins import in_any
from sightline.operators.merge import merge
from sightline.operators.increments import changes_inclusive
from sightline.session import materialize

SYSTEMS = {"vx1": C.SYSTEM_VX1, "vx2": C.SYSTEM_VX2}


#: the system number under which competitors are looked up
COMPETITOR = 0


def _lists(base: DataFrame, entity: Sequence[str], competitors: bool) -> DataFrame:
    """The codes to translate per row."""
    rivals = [jsons.parsed(F.col("attribution_competitor"), jsons.REFERENCE_IDS).alias("_rivals")] if competitors else []
    return base.select(
        *entity,
        "primary_product_id",
        F.coalesce(
            jsons.parsed(F.col("secondary_products"), jsons.SECONDARY_PRODUCT),
            F.array().cast(jsons.SECONDARY_PRODUCT),
        ).alias("_sec"),
        *rivals,
    )


def _lookups(lists: DataFrame, entity: Sequence[str], competitors: bool) -> DataFrame:
    """One row per code to translate that a creative has alone: the primary product per system, and each
    competitor."""

    def row(key: Column, system: str | int) -> Column:
        return F.struct(F.lit(system).cast("int").alias("system_id"), key.alias("mapping_hash"))

    ids = nested.sorted_ids(F.transform("_sec", lambda e: e["product_id"]))
    keyed = lists.withColumn("_ids", ids)
    primary = [row(keys.product_key(F.col("primary_product_id"), s, F.col("_ids")), s) for s in SYSTEMS.values()]
    rows = [F.array(*primary)]
    if competitors:
        named = F.transform("_rivals", lambda r: row(r["id"].cast("string"), COMPETITOR))
        rows.append(F.coalesce(named, F.slice(F.array(primary[0]), 1, 0)))
    return keyed.select(*entity, F.explode(F.concat(*rows)).alias("_r")).select(*entity, "_r.*")


def _secondary_codes(elements: DataFrame, codes: DataFrame) -> DataFrame:
    """Per product of the elements, its codes of all systems: products are hashed and looked up once each,
    however many creatives name them."""
    products = elements.select(F.col("element.product_id").alias("_product")).filter(F.col("_product").isNotNull()).distinct()
    asked = F.array(
        *[
            F.struct(F.lit(int(s)).alias("system_id"), keys.product_key(F.col("_product"), s, None).alias("mapping_hash"))
            for s in SYSTEMS.values()
        ]
    )
    found = products.select("_product", F.explode(asked).alias("_r")).select("_product", "_r.*")
    found = found.join(codes.drop("vx2_code"), ["mapping_hash", "system_id"], "left")
    return found.groupBy("_product").agg(F.collect_list(F.struct("system_id", "target_product_id")).alias("_targets"))


def translate_codes(
    base: DataFrame, product_map: DataFrame, entity: Sequence[str], advertiser_map: DataFrame | None = None
) -> DataFrame:
    """Primary and secondary codes per entity, and with ``advertiser_map`` the known competitor codes as
    a JSON array. One missing secondary makes the array NULL.

    The maps are joined as one, as they are: a map too large to broadcast is sort-merge joined, which
    spills, so it need not be cut down first. Secondary products meet their codes by product, one row
    per element; the hashes of the map are only shuffled once per product.
    """
    codes = product_map.select(
        "mapping_hash", F.col("system_id").cast("int").alias("system_id"), "target_product_id", F.lit(None).cast("string").alias("vx2_code")
    )
    secondary = codes
    if advertiser_map is not None:
        codes = codes.unionByName(
            advertiser_map.select(
                F.col("vx0_company_id").cast("string").alias("mapping_hash"), F.lit(COMPETITOR).alias("system_id"),
                F.lit(None).cast(dict(product_map.dtypes)["target_product_id"]).alias("target_product_id"),
                F.col("vx2_code").cast("string").alias("vx2_code"),
            )
        )
    lists = _lists(base, entity, advertiser_map is not None)
    single = _lookups(lists, entity, advertiser_map is not None).join(codes, ["mapping_hash", "system_id"], "left")
    elements = lists.select(*entity, F.explode("_sec").alias("element")).filter(F.col("element").isNotNull())
    several = elements.withColumn("_product", F.col("element.product_id")).join(
        _secondary_codes(elements, secondary), "_product", "left"
    )
    found = single.drop("mapping_hash").unionByName(several.drop("_product"), allowMissingColumns=True)
    e = F.col("element")
    rival = F.when((F.col("system_id") == COMPETITOR) & F.col("vx2_code").isNotNull(), F.struct(F.col("vx2_code").alias("code")))
    # one list per entity; it is split by system afterwards
    gathered = found.groupBy(*entity).agg(
        *[
            F.max(F.when(F.col("system_id") == int(s), F.col("target_product_id"))).alias(f"{name}_product_id")
            for name, s in SYSTEMS.items()
        ],
        F.collect_list(F.when(e.isNotNull(), F.struct(e, F.col("_targets").alias("targets")))).alias("_elements"),
        *([] if advertiser_map is None else [F.array_sort(F.collect_list(rival)).alias("_codes")]),
    )
    # a product without an id has no code in any system
    target = dict(product_map.dtypes)["target_product_id"]
    unknown = F.array(
        *[F.struct(F.lit(int(s)).alias("system_id"), F.lit(None).cast(target).alias("target_product_id")) for s in SYSTEMS.values()]
    )

    def product(e: Column, code: Column) -> Column:
        return F.struct(
            e["sort_order"].alias("sort_order"), e["type"].alias("type"), e["subtype"].alias("subtype"),
            code.alias("product_id"), e["is_dominant"].alias("is_dominant"),
        )

    def array(system: str) -> Column:
        def coded(x: Column) -> Column:
            mine = F.filter(F.coalesce(x["targets"], unknown), lambda c: c["system_id"] == int(system))
            return F.transform(mine, lambda c: product(x["element"], c["target_product_id"]))

        return F.array_sort(F.flatten(F.transform("_elements", coded)))

    split = gathered.withColumns({f"_{name}": array(s) for name, s in SYSTEMS.items()})

    def complete(name: str) -> Column:
        whole = F.forall(f"_{name}", lambda p: p["product_id"].isNotNull())
        json = F.to_json(f"_{name}", {"ignoreNullFields": "false"})
        return F.when((F.size(f"_{name}") > 0) & whole, json)

    return split.select(
        *entity,
        *[f"{name}_product_id" for name in SYSTEMS],
        *[complete(name).alias(f"{name}_secondary_products") for name in SYSTEMS],
        *([] if advertiser_map is None else [F.when(F.size("_codes") > 0, F.to_json("_codes")).alias("attribution_competitor_vx2")]),
    )


def translation_hold(
    classification: Column, vx1: Column, vx1_secondary: Column, secondary: Column
) -> Column:
    """True for an advert whose primary product, or any secondary one, has no code."""
    missing = vx1.isNull() | (vx1_secondary.isNull() & (jsons.array_size(secondary) > 0))
    return F.coalesce((classification == C.ADVERT) & missing, F.lit(False))


def translate_products(
    base: DataFrame, product_map: DataFrame, advertiser_map: DataFrame
) -> DataFrame:
    """Creatives with codes of both systems, competitor codes and the holding flag.

    ``base`` is read twice: its lists for the lookups, and all its columns for the result.
    """
    entity = ["creative_id", "creative_url_hash"]
    return (
        base.join(translate_codes(base, product_map, entity, advertiser_map), entity, "left")
        .withColumn(
            "holding_flag",
            translation_hold(
                F.col("classification_type"),
                F.col("vx1_product_id"),
                F.col("vx1_secondary_products"),
                F.col("secondary_products"),
            ),
        )
    )


# ---- re-translation after the code map changed ---------------------------------------------

CODES = [
    "vx1_product_id", "vx2_product_id", "vx1_secondary_products", "vx2_secondary_products",
]


def affected_creatives(
    creatives: DataFrame,
    product_map: DataFrame,
    hold: DataFrame,
    *,
    since: Column,
    launch: dt.datetime = dt.datetime(1900, 1, 1),
    created_from: dt.datetime = dt.datetime(1900, 1, 1),
) -> DataFrame:
    """Creatives whose primary product changed in the map, or a secondary one with set 0."""
    changed = changes_inclusive(product_map, "change_dt", since).filter(
        F.col("change_dt") > F.lit(launch)
    )
    scoped = creatives.filter(F.col("created_timestamp") >= F.lit(created_from)).join(
        hold.select("creative_id"), "creative_id", "left_anti"
    )
    products = F.transform(
        F.coalesce(
            jsons.parsed(jsons.default_array(F.col("secondary_products")), jsons.SECONDARY_PRODUCT),
            F.expr(f"from_json('[]', '{jsons.SECONDARY_PRODUCT}')"),
        ),
        lambda e: e["product_id"],
    )
    pairs = scoped.select("creative_id", F.explode(products).alias("primary_product_id"))
    touched = pairs.join(
        changed.filter(F.col("set_id") == 0).select("primary_product_id"),
        "primary_product_id",
        "left_semi",
    )
    return in_any(
        scoped,
        (changed, {"primary_product_id": "primary_product_id"}, "is_primary_touched"),
        (touched, {"creative_id": "creative_id"}, "is_secondary_touched"),
    )


def resync_products(affected: DataFrame, product_map: DataFrame) -> DataFrame:
    """Affected creatives with old and new codes, where the primary differs or a secondary was
    touched."""
    # read for the lookups and for the old codes
    affected = materialize(affected, "affected")
    fresh = translate_codes(affected, product_map, ["creative_id"])
    renamed = fresh.select("creative_id", *[F.col(c).alias(f"new_{c}") for c in CODES])
    old = affected.withColumnsRenamed({c: f"old_{c}" for c in CODES})

    def changed(name: str) -> Column:
        new, before = F.col(f"new_{name}"), F.col(f"old_{name}")
        return F.coalesce(new, F.lit(0)) != F.coalesce(before, F.lit(0))

    return old.join(renamed, "creative_id", "left").filter(
        changed("vx1_product_id") | changed("vx2_product_id") | F.col("is_secondary_touched")
    )


def apply_resync(creatives: DataFrame, resynced: DataFrame) -> DataFrame:
    new = resynced.select("creative_id", *[F.col(f"new_{c}").alias(c) for c in CODES])
    return merge(creatives, new, ["creative_id"], update=CODES, insert=False)


def prior_values(resynced: DataFrame, now: Column) -> DataFrame:
    """Log rows with the codes held before the update."""
    return resynced.select(
        "creative_id",
        "legacy_creative_id",
        "primary_product_id",
        F.col("old_vx1_product_id").alias("vx1_product_id"),
        F.col("old_vx2_product_id").alias("vx2_product_id"),
        "mr_company_id",
        "secondary_products",
        F.col("old_vx1_secondary_products").alias("vx1_secondary_products"),
        F.col("old_vx2_secondary_products").alias("vx2_secondary_products"),
        F.lit(None).cast("string").alias("mr_secondary_company_ids"),
        now.alias("created_timestamp"),
    )
