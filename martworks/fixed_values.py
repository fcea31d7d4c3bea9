"""Texts and types that outputs must carry exactly, so that existing tables and queries keep matching."""

# Fixed value: stands for a null part inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Fixed value: default label column of a union of relations.
SOURCE_COLUMN = "_dbt_source_relation"

# Bookkeeping columns of a history table, and the open end of a validity range.
VERSION_ID = "dbt_scd_id"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"
OPEN_END = "9999-12-31"

# Product types behind the food and drink flags, and the two customer types.
FOOD_TYPE = "jaffle"
DRINK_TYPE = "beverage"
NEW_CUSTOMER = "new"
RETURNING_CUSTOMER = "returning"

# Earth radius in miles and the kilometre factor of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# SQL types of money, of summed money and of the generic numeric type.
MONEY = "decimal(16,2)"
MONEY_SUM = "decimal(38,2)"
NUMERIC = "decimal(28,6)"

# Pinned column types of the six raw tables.
RAW_SCHEMAS = {
    "raw_customers": "id string, name string",
    "raw_orders": (
        "id string, customer string, ordered_at timestamp, store_id string, "
        "subtotal int, tax_paid int, order_total int"
    ),
    "raw_items": "id string, order_id string, sku string",
    "raw_products": "sku string, name string, type string, price int, description string",
    "raw_stores": "id string, name string, opened_at timestamp, tax_rate double",
    "raw_supplies": "id string, name string, cost int, perishable boolean, sku string",
}
