"""Silver layer: the typed schema, rules and spelling table of every entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.operators.clean import RAW, arrived_late, conform, standardise_column
from lakeplan.operators.dedupe import first_per_key, latest_per_key, mark_duplicates
from lakeplan.operators.expectations import Counted, Rule, accepted, as_received, keep_valid, rejected, tag
from lakeplan.operators.joins import flag_known, lookup
from lakeplan.session import checkpoint_table

# The zones, order states and standard spellings of the retail model.
ZONES = ["North", "South", "East", "West", "Central", "North-East"]
ORDER_STATES = ["Delivered", "Cancelled"]
STATE_SPELLINGS = {
    "Tamilnadu": "Tamil Nadu", "TN": "Tamil Nadu", "Tamil nadu": "Tamil Nadu",
    "Maharastra": "Maharashtra", "MH": "Maharashtra",
    "NCT of Delhi": "Delhi", "Delhi NCR": "Delhi", "New Delhi": "Delhi",
    "West Bangal": "West Bengal", "WB": "West Bengal",
    "Karnatka": "Karnataka", "KA": "Karnataka", "Orissa": "Odisha",
    "Uttaranchal": "Uttarakhand", "UP": "Uttar Pradesh", "Uttar pradesh": "Uttar Pradesh",
    "Telengana": "Telangana", "Gujrat": "Gujarat",
}

# The column names and types of each silver entity.
SCHEMAS: dict[str, dict[str, str]] = {
    "geography": {
        "city_id": "string", "city": "string", "state": "string", "state_code": "string", "zone": "string",
        "tier": "int", "is_metro": "boolean", "lat": "double", "lon": "double", "population_m": "double"},
    "warehouses": {
        "warehouse_id": "string", "warehouse_name": "string", "city": "string", "state": "string",
        "zone": "string", "lat": "double", "lon": "double", "capacity_tonnes": "int"},
    "channels": {
        "channel_code": "string", "channel_name": "string", "channel_group": "string",
        "partner_margin_pct": "double"},
    "events": {
        "event_name": "string", "event_date": "date", "year": "int", "region_relevance": "string",
        "lead_days": "int", "expected_uplift_pct": "double", "key_products": "string"},
    "products": {
        "sku_id": "string", "product_name": "string", "base_code": "string", "base_product": "string",
        "category": "string", "sub_category": "string", "pack_size": "int", "is_organic": "boolean",
        "mrp": "double", "tax_rate": "double", "shelf_life_days": "int", "launch_date": "date"},
    "product_prices": {
        "sku_id": "string", "effective_from": "date", "effective_to": "date", "mrp": "double"},
    "product_costs": {"sku_id": "string", "month": "date", "unit_cost": "double"},
    "material_prices": {
        "base_code": "string", "month": "date", "price_index": "double", "price_per_kg": "double"},
    "suppliers": {
        "supplier_id": "string", "supplier_name": "string", "origin_town": "string", "origin_state": "string",
        "primary_code": "string", "reliability_score": "double", "lead_time_days": "int",
        "supplier_tier": "string"},
    "stores": {
        "store_id": "string", "store_name": "string", "store_type": "string", "channel_code": "string",
        "city": "string", "state": "string", "warehouse_id": "string", "opened_date": "date",
        "closed_date": "date", "size_band": "string", "sales_rep_id": "string"},
    "promotions": {
        "promo_id": "string", "promo_code": "string", "promo_name": "string", "promo_type": "string",
        "discount_pct": "double", "start_date": "date", "end_date": "date", "channel_code": "string",
        "category_scope": "string", "funded_by": "string", "event_name": "string"},
    "customers": {
        "customer_id": "string", "full_name": "string", "gender": "string", "age_band": "string",
        "city": "string", "state": "string", "signup_date": "date", "loyalty_tier": "string",
        "preferred_language": "string", "customer_type": "string"},
    "orders": {
        "order_id": "string", "order_ts": "timestamp", "store_id": "string", "channel_code": "string",
        "customer_id": "string", "payment_mode": "string", "order_status": "string",
        "delivery_city": "string"},
    "sales_lines": {
        "line_id": "string", "order_id": "string", "line_no": "int", "order_date": "date", "sku_id": "string",
        "quantity": "int", "unit_mrp": "double", "unit_price": "double", "promo_code": "string",
        "discount_pct": "double", "line_amount": "double"},
    "returns": {
        "return_id": "string", "line_id": "string", "order_id": "string", "sku_id": "string",
        "return_date": "date", "return_qty": "int", "return_reason": "string", "refund_amount": "double"},
    "inventory": {
        "warehouse_id": "string", "sku_id": "string", "snapshot_date": "date", "opening_units": "long",
        "receipts_units": "long", "demand_units": "long", "shipped_units": "long", "closing_units": "long",
        "reorder_point_units": "long", "safety_stock_units": "long"},
    "purchase_orders": {
        "po_id": "string", "po_date": "date", "supplier_id": "string", "warehouse_id": "string",
        "sku_id": "string", "ordered_units": "long", "received_units": "long", "ordered_kg": "double",
        "unit_cost": "double", "po_value": "double", "expected_date": "date", "received_date": "date",
        "quality_grade": "string"},
}


def is_one_of(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def zone_rule(zones: list[str]) -> Rule:
    return Rule("valid_zone", is_one_of("zone", zones))


RULES: dict[str, list[Rule]] = {
    "geography": [zone_rule(ZONES)],
    "products": [Rule("sku_present", "sku_id IS NOT NULL"), Rule("positive_mrp", "mrp > 0")],
    "stores": [Rule("store_id_present", "store_id IS NOT NULL"),
               Rule("state_resolved", "zone IS NOT NULL", action="warn")],
    "customers": [Rule("customer_id_present", "customer_id IS NOT NULL")],
    "orders": [Rule("store_id_present", "store_id IS NOT NULL", reason="missing store_id"),
               Rule("valid_status", is_one_of("order_status", ORDER_STATES), reason="invalid status")],
    "sales_lines": [Rule("positive_quantity", "quantity > 0", reason="non-positive quantity"),
                    Rule("known_sku", "sku_known", reason="unknown sku"),
                    Rule("price_present", "unit_price IS NOT NULL", reason="missing price")],
    "returns": [Rule("positive_return_qty", "return_qty > 0")],
    "inventory": [Rule("non_negative_stock", "closing_units >= 0")],
    "purchase_orders": [Rule("positive_order_qty", "ordered_units > 0")],
}
DUPLICATE_LINE = "duplicate line"


def silver(entity: str, raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Cast to the entity's types and drop the rows its rules reject."""
    return keep_valid(conform(raw, SCHEMAS[entity], keep), RULES.get(entity, []))


def silver_stores(raw: DataFrame, geography: DataFrame, spellings: dict[str, str]) -> DataFrame:
    """Located stores that have a key; unresolved states only warn."""
    return keep_valid(located_stores(raw, geography, spellings), RULES["stores"])


def located_stores(raw: DataFrame, geography: DataFrame, spellings: dict[str, str]) -> DataFrame:
    """Standard state names, then zone and tier by city and state."""
    named = standardise_column(raw, "state", spellings, "state_was_corrected")
    places = geography.select("city", "state", "zone", "tier", "city_id")
    return lookup(named, places, ["city", "state"], "left")


def silver_customers(raw: DataFrame, newest: str = "_ingest_ts", ties: list[Column] | None = None) -> DataFrame:
    return keep_valid(latest_per_key(raw, ["customer_id"], newest, *(ties or [])), RULES["customers"])


def silver_orders(raw: DataFrame) -> DataFrame:
    return keep_valid(raw, RULES["orders"])


def orders_quarantine(raw: DataFrame) -> DataFrame:
    return rejected(tag(raw, RULES["orders"]))


def silver_lines(raw: DataFrame, products: DataFrame, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """De-duplicate first, validate the kept copy second."""
    kept = first_per_key(raw, keys or ["line_id"], order)
    known = flag_known(kept, products, "sku_id", "sku_known")
    return keep_valid(known, RULES["sales_lines"]).withColumn("arrived_late", arrived_late())


def lines_quarantine(raw: DataFrame, products: DataFrame, order: list[Column],
                     keys: list[str] | None = None) -> DataFrame:
    """Every line that is not in silver, with the first reason that applies.

    One frame carries the duplicate flag and the rules, so clean and rejected rows always
    add up to the input.
    """
    return rejected(tagged_lines(raw, products, order, keys))


def tagged_lines(raw: DataFrame, products: DataFrame, order: list[Column], keys: list[str] | None = None,
                 mark: Callable[..., DataFrame] = mark_duplicates) -> DataFrame:
    marked = mark(raw, keys or ["line_id"], order)
    known = flag_known(marked, products, "sku_id", "sku_known")
    return tag(known, RULES["sales_lines"], first=[(F.col("is_duplicate"), DUPLICATE_LINE)])


def clean_and_rejected(raw: DataFrame, products: DataFrame, order: list[Column], counted: Counted | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of the lines, ranked and joined once: the tagged frame is written, and its rules counted, before it is split.

    Lines that carry their raw rows are quarantined with them.
    """
    tagged = tagged_lines(raw, products, order)
    tagged = checkpoint_table(counted.watch(tagged) if counted else tagged, "tagged_lines")
    clean = accepted(tagged).drop("is_duplicate", RAW).withColumn("arrived_late", arrived_late())
    return clean, as_received(tagged) if RAW in tagged.columns else rejected(tagged)


