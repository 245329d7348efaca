"""Order-item data: status, payment method, shipment provider and paid price."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import fixed
from tallybook.functions.joins import first_per_key, lookup
from tallybook.sources.schemas import ORDER_COLUMNS

ITEM = "oms_id_sales_order_item"


def _wanted(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    return rows if ids is None else rows.join(ids.select(ITEM), ITEM, "left_semi")


def _items(tables: Mapping[str, DataFrame], ids: DataFrame | None) -> DataFrame:
    """Items of the ids with their status and payment method."""
    items = tables["ims_sales_order_item"].selectExpr(
        f"id_sales_order_item AS {ITEM}",
        "fk_sales_order",
        "fk_sales_order_item_status AS fk_status",
        "paid_price",
    )
    statuses = tables["ims_sales_order_item_status"].selectExpr(
        "id_sales_order_item_status AS id_status", "name AS item_status"
    )
    orders = tables["ims_sales_order"].select("id_sales_order", "payment_method")
    out = lookup(_wanted(items, ids), orders, "fk_sales_order", "id_sales_order", ITEM)
    return lookup(out, statuses, "fk_status", "id_status", ITEM)


def _packages(tables: Mapping[str, DataFrame], ids: DataFrame | None) -> DataFrame:
    """(item, package) pairs of the ids."""
    pairs = tables["oms_package_item"].selectExpr(f"fk_sales_order_item AS {ITEM}", "fk_package")
    return _wanted(pairs, ids)


def _dispatches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(package, provider id) pairs."""
    return tables["oms_package_dispatching"].selectExpr(
        "fk_package AS id_package", "fk_shipment_provider"
    )


def _with_provider(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    providers = tables["oms_shipment_provider"].select(
        "id_shipment_provider", "shipment_provider_name"
    )
    return lookup(rows, providers, "fk_shipment_provider", "id_shipment_provider", ITEM)


def order_extract(
    tables: Mapping[str, DataFrame], ids: DataFrame | None = None, most: bool = False
) -> DataFrame:
    """One row per item id of ``ids`` that the order side knows (all items without ``ids``).

    With ``most`` the ids name most items, so these are not shuffled by item before all lookups, but
    picked where the last join has them by item anyway.

    An item may have many packages and a package many dispatches; the first row by
    (status, method, provider id, paid price) is kept, NULLs last; a NULL id is no item. The chain
    of lookups stands in the plan once: ids that occur twice are settled behind it, by an aggregate
    whose shuffle the join with the packages needs anyway. Packages and dispatches are reduced to
    their lowest provider id, a plain hash aggregate, before they are joined: they multiply no
    rows, and the side that a join looks up always has unique keys.
    """
    early = None if most else ids
    attributes = first_per_key(
        _items(tables, early), ITEM, ["item_status", "payment_method", "paid_price"]
    )
    lowest = F.min("fk_shipment_provider").alias("fk_shipment_provider")
    by_package = _dispatches(tables).groupBy("id_package").agg(lowest)
    packages = lookup(_packages(tables, early), by_package, "fk_package", "id_package", ITEM)
    by_item = packages.groupBy(ITEM).agg(lowest)
    matched = attributes.join(by_item, ITEM, "left")
    if most:
        matched = _wanted(matched, ids)
    return _with_provider(matched, tables).select(*ORDER_COLUMNS)


def shipped_ledger_keys(tables: Mapping[str, DataFrame], ids: DataFrame) -> DataFrame:
    """Distinct status-method-provider keys of the items that were ever shipped."""
    shipped = (
        tables["ims_sales_order_item_status_history"]
        .where(f"fk_sales_order_item_status = {fixed.SHIPPED_STATUS} AND created_at IS NOT NULL")
        .selectExpr(f"fk_sales_order_item AS {ITEM}")
    )
    wanted = ids.select(ITEM).join(shipped, ITEM, "left_semi")
    # Distinct pairs on both sides: what an item can match is bounded by the providers.
    packages = lookup(
        _packages(tables, wanted).distinct(),
        _dispatches(tables).distinct(),
        "fk_package",
        "id_package",
        ITEM,
    )
    providers = packages.select(ITEM, "fk_shipment_provider").distinct()
    items = _items(tables, wanted).select(ITEM, "item_status", "payment_method").distinct()
    key = "item_status || '-' || payment_method || '-' || shipment_provider_name"
    named = _with_provider(items.join(providers, ITEM, "left"), tables)
    return named.selectExpr(f"{key} AS ledger_map_key").distinct()
