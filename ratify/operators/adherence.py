"""Reference-price adherence per order (C17).

Eligible items: not cancelled, labor in the whitelist, quantity >= 1, unit
price > 0.1 and some reference price known; their order must not be an
automatic approval and must come from a non-dealership merchant (a NULL
merchant type is excluded).  The reference price is the first known of
negotiated-for-customer, negotiated, reference-for-customer, reference.  An
item adheres when reference >= unit price; its approved part price then
counts as adherent.

Items are filtered by their own columns and the (broadcast, whitelist-sized)
labor keys, then partially aggregated per order before any shuffle; the
order-level conditions are applied on the per-order result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.sources import rules as R

REFERENCE_ORDER = ["PartPriceNegociatedCustomer", "PartPriceNegociated",
                   "PartPriceReferenceCustomer", "PartReferencePrice"]


def reference_price():
    return F.coalesce(*[F.col(c) for c in REFERENCE_ORDER])


def item_adherence_columns(labor_ok):
    """(eligible, adherent) boolean columns from the item's own fields."""
    ref = reference_price()
    eligible = (F.col("CancellationTimestamp").isNull() & labor_ok
                & (F.col("PartQuantity") >= F.lit(R.MIN_QUANTITY))
                & (F.col("PartUnitaryPrice") > F.lit(R.MIN_UNIT_PRICE))
                & ref.isNotNull())
    return F.coalesce(eligible, F.lit(False)), F.coalesce(ref >= F.col("PartUnitaryPrice"), F.lit(False))


def eligible_labors(labors: DataFrame, whitelist: DataFrame) -> DataFrame:
    w = whitelist.select(F.col("labor_name").alias("LaborName")).distinct()
    return labors.join(F.broadcast(w), "LaborName", "left_semi").select("Sk_MaintenanceLabor")


def adherence_items(items: DataFrame, labors: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Eligible item rows with PrecoReferencial and Aderente (item-level conditions only)."""
    ref = reference_price()
    it = items.join(eligible_labors(labors, whitelist), "Sk_MaintenanceLabor", "left_semi")
    eligible, _ = item_adherence_columns(F.lit(True))
    it = it.filter(eligible)
    return it.select(
        "Sk_MaintenanceItem", "MaintenanceId", "PartUnitaryPrice", "PartQuantity",
        "PartPriceApproved", ref.alias("PrecoReferencial"),
        F.when(ref >= F.col("PartUnitaryPrice"), F.col("PartPriceApproved")).alias("Aderente"),
    )


def merchant_ok(merchant_type):
    """Non-dealership merchant; NULL type is excluded (SQL ``<>`` on NULL)."""
    return F.coalesce(merchant_type != F.lit(R.DEALERSHIP_MERCHANT_TYPE), F.lit(False))


def eligible_orders(services: DataFrame, merchants: DataFrame) -> DataFrame:
    """Orders that are not automatic approvals, served by a non-dealership."""
    m = merchants.select("Sk_MaintenanceMerchant", "NameMerchantsTypes")
    s = services.filter(F.col("IsAutomaticApproval") == F.lit(False)).select(
        "OrderServiceCode", "Sk_MaintenanceMerchant")
    return (s.join(m, "Sk_MaintenanceMerchant", "inner")
            .filter(merchant_ok(F.col("NameMerchantsTypes")))
            .select("OrderServiceCode"))


def merchant_rows(services: DataFrame, merchants: DataFrame) -> DataFrame:
    """_mr_order, _merchant_rows, NameMerchantsTypes: how many (order row, merchant row) pairs let the order's
    items count, where codes and keys may repeat, and the first merchant type of these; no row without any."""
    m = (merchants.filter(merchant_ok(F.col("NameMerchantsTypes"))).groupBy("Sk_MaintenanceMerchant")
         .agg(F.count(F.lit(1)).alias("_m_rows"), F.min("NameMerchantsTypes").alias("_m_type")))
    s = services.filter(F.col("IsAutomaticApproval") == F.lit(False)).select("OrderServiceCode", "Sk_MaintenanceMerchant")
    return s.join(m, "Sk_MaintenanceMerchant").groupBy(F.col("OrderServiceCode").alias("_mr_order")).agg(
        F.sum("_m_rows").alias("_merchant_rows"), F.min("_m_type").alias("NameMerchantsTypes"))


def price_adherence(items: DataFrame, services: DataFrame, labors: DataFrame,
                    merchants: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Per order: total_aprovado_referencial, total_aprovado_aderente (NULL if none adheres).

    Item rows are partially aggregated per order before the shuffle; the
    order-level conditions are an equi-join on the per-order result.
    """
    per_order = adherence_items(items, labors, whitelist).groupBy("MaintenanceId").agg(
        F.sum("PartPriceApproved").alias("total_aprovado_referencial"),
        F.sum("Aderente").alias("total_aprovado_aderente"),
    )
    orders = eligible_orders(services, merchants)
    return per_order.join(orders, per_order["MaintenanceId"] == orders["OrderServiceCode"],
                          "inner").drop("OrderServiceCode")
