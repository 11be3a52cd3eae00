"""The model set: staging models per raw table and the unified models.

Two upstream systems describe the same entities with different schemas:
``a`` (contacts with split names, inventory with stock counts) and ``b``
(customers with full names and a status, products with a cost and an
availability flag).  They unify into ``int_unified_customers`` and
``int_unified_products``.  ``int_unified_activity`` applies the same
machinery to the sales and web systems (orders, lineitem, events) and is the
large, bench-sized model.

Declared data tests follow the models they belong to (27 not_null,
6 unique and 4 accepted_values on the customer/product models, plus the
activity model's own).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from unilake.functions import exprs
from unilake.operators.mapping import StagingModel, cast, derive, keep, rename
from unilake.operators.quality import accepted_values, not_null, unique
from unilake.operators.unify import Branch, UnifiedModel

# --- fixed values -----------------------------------------------------------
STATUS_VALUES = ("active", "inactive", "churned")
DEFAULT_STATUS = "active"
CUSTOMER_PRODUCT_SOURCES = ("a", "b")
ACTIVITY_SOURCES = ("orders", "lineitem", "events")
# ---------------------------------------------------------------------------


def _f(name: str, dtype, comment: str = "", nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable, metadata={"comment": comment} if comment else {})


# --- staging -----------------------------------------------------------------

STG_A_CONTACTS = StagingModel(
    "a", "contacts",
    (
        cast("contact_id", "contact_id", "string", "Number of the contact in system a, as text"),
        keep("first_name"),
        keep("last_name"),
        rename("email_address", "email", "Mail address on file, if any"),
        rename("phone", "phone_number", "Telephone on file, if any"),
        rename("company_name", "organization", "Company the contact works for, if known"),
        cast("created_date", "created_at", "date", "Day the contact was entered"),
    ),
    comment="Staged source a contacts, one row per contact.",
    tests=(unique("contact_id"), not_null("contact_id"), not_null("first_name"),
           not_null("last_name"), not_null("created_at")),
)

STG_A_INVENTORY = StagingModel(
    "a", "inventory",
    (
        cast("item_id", "product_id", "string", "Number of the item in system a, as text"),
        rename("item_name", "product_name", "Label of the item"),
        rename("item_description", "product_description", "Free text about the item"),
        rename("category", "product_category", "Group the item is filed under"),
        rename("price", "retail_price", "List price in system a"),
        rename("stock_qty", "stock_quantity", "Units on hand; may be negative"),
        cast("added_date", "created_at", "date", "Day the item was entered"),
    ),
    comment="Staged source a inventory, one row per item.",
    tests=(unique("product_id"), not_null("product_id"), not_null("product_name"),
           not_null("retail_price"), not_null("created_at")),
)

STG_B_CUSTOMERS = StagingModel(
    "b", "customers",
    (
        cast("cust_id", "customer_id", "string", "Number of the customer in system b, as text"),
        keep("full_name"),
        keep("email", "Mail address on file, if any"),
        rename("mobile_phone", "phone_number", "Mobile number on file, if any"),
        keep("organization", "Organisation the customer belongs to"),
        keep("status", "State of the account (see STATUS_VALUES)"),
        cast("signup_date", "created_at", "date", "Day of the first registration"),
    ),
    comment="Staged source b customers, one row per customer.",
    tests=(unique("customer_id"), not_null("customer_id"), not_null("full_name"),
           not_null("status"), accepted_values("status", STATUS_VALUES),
           not_null("created_at")),
)

STG_B_PRODUCTS = StagingModel(
    "b", "products",
    (
        cast("prod_id", "product_id", "string", "Number of the product in system b, as text"),
        rename("product_title", "product_name", "Label of the product"),
        rename("product_desc", "product_description", "Free text about the product"),
        rename("product_type", "product_category", "Group the product is filed under"),
        keep("unit_cost", "What one unit costs us"),
        keep("retail_price", "List price in system b"),
        derive("is_available", lambda: exprs.one_flag("available"),
               "True when the flag is 1; any other value, or none, is false",
               sql="CASE WHEN available = 1 THEN TRUE ELSE FALSE END"),
        cast("created_at", "created_at", "date", "Day the product was entered"),
    ),
    comment="Staged source b products, one row per product.",
    tests=(unique("product_id"), not_null("product_id"), not_null("product_name"),
           not_null("retail_price"), not_null("is_available"), not_null("created_at")),
)

STG_SALES_ORDERS = StagingModel(
    "sales", "orders",
    (
        cast("o_orderkey", "order_id", "string"),
        cast("o_custkey", "customer_id", "string"),
        rename("o_orderstatus", "order_status"),
        rename("o_totalprice", "total_price"),
        rename("o_orderpriority", "order_priority"),
        cast("o_orderdate", "order_date", "date"),
    ),
    comment="Staged sales orders, one row per order.",
    tests=(unique("order_id"), not_null("order_id"), not_null("order_date")),
)

STG_SALES_LINEITEM = StagingModel(
    "sales", "lineitem",
    (
        cast("l_orderkey", "order_id", "string"),
        cast("l_linenumber", "line_number", "string"),
        cast("l_partkey", "part_id", "string"),
        cast("l_suppkey", "supplier_id", "string"),
        rename("l_quantity", "quantity"),
        rename("l_extendedprice", "extended_price"),
        rename("l_discount", "discount"),
        rename("l_tax", "tax"),
        rename("l_returnflag", "return_flag"),
        rename("l_linestatus", "line_status"),
        cast("l_shipdate", "ship_date", "date"),
    ),
    comment="Staged sales order lines.",
    tests=(not_null("order_id"), not_null("ship_date")),
)

STG_WEB_EVENTS = StagingModel(
    "web", "events",
    (
        cast("event_id", "event_id", "string"),
        cast("user_id", "user_id", "string"),
        keep("event_type"),
        rename("value", "event_value"),
        keep("props"),
        rename("ts", "event_at"),
        cast("ts", "event_date", "date"),
    ),
    comment="Staged web events, one row per event.",
    tests=(unique("event_id"), not_null("event_id"), not_null("event_type")),
)

STAGING: dict[str, StagingModel] = {m.name: m for m in (
    STG_A_CONTACTS, STG_A_INVENTORY, STG_B_CUSTOMERS, STG_B_PRODUCTS,
    STG_SALES_ORDERS, STG_SALES_LINEITEM, STG_WEB_EVENTS)}


# --- unified models ------------------------------------------------------------

CUSTOMER_SCHEMA = StructType([
    _f("customer_sk", StringType(), "md5 key of the system and the number there"),
    _f("source_system", StringType(), "System the row comes from"),
    _f("source_customer_id", StringType(), "Number of the row in its system"),
    _f("first_name", StringType()),
    _f("last_name", StringType()),
    _f("full_name", StringType(), "Whole name, as given or put together"),
    _f("email", StringType(), "Mail address on file, if any"),
    _f("phone_number", StringType()),
    _f("organization", StringType()),
    _f("status", StringType(), "State of the account (see STATUS_VALUES)"),
    _f("created_at", DateType()),
    _f("loaded_at", TimestampType(), "When the row was built (UTC)"),
])

PRODUCT_SCHEMA = StructType([
    _f("product_sk", StringType(), "md5 key of the system and the number there"),
    _f("source_system", StringType(), "System the row comes from"),
    _f("source_product_id", StringType(), "Number of the row in its system"),
    _f("product_name", StringType(), "Label under which the product is sold"),
    _f("product_description", StringType()),
    _f("product_category", StringType()),
    _f("retail_price", DoubleType(), "List price"),
    _f("unit_cost", DoubleType()),
    _f("stock_quantity", LongType()),
    _f("is_available", BooleanType(), "Can be ordered now"),
    _f("created_at", DateType()),
    _f("loaded_at", TimestampType(), "When the row was built (UTC)"),
])

ACTIVITY_SCHEMA = StructType([
    _f("activity_sk", StringType(), "md5 key of the table and the id there"),
    _f("source_system", StringType(), "Table the row comes from"),
    _f("source_activity_id", StringType(), "Id of the row there, composite for order lines"),
    _f("customer_id", StringType(), "Acting customer / user, when the source has one"),
    _f("activity_type", StringType()),
    _f("status", StringType()),
    _f("amount", DoubleType()),
    _f("quantity", DoubleType()),
    _f("activity_date", DateType()),
    _f("loaded_at", TimestampType(), "When the row was built (UTC)"),
])

INT_UNIFIED_CUSTOMERS = UnifiedModel(
    name="int_unified_customers",
    schema=CUSTOMER_SCHEMA,
    key_name="customer_sk",
    key_parts=("source_system", "source_customer_id"),
    branches=(
        Branch("a", STG_A_CONTACTS.name, {
            "source_customer_id": lambda: F.col("contact_id"),
            "full_name": lambda: exprs.full_name("first_name", "last_name"),
            "status": lambda: F.lit(DEFAULT_STATUS),
        }),
        Branch("b", STG_B_CUSTOMERS.name, {
            "source_customer_id": lambda: F.col("customer_id"),
            "first_name": lambda: exprs.first_name("full_name"),
            "last_name": lambda: exprs.last_name("full_name"),
        }),
    ),
    comment="Unified customers from both systems; one row per (source, id).",
    tests=(unique("customer_sk"), not_null("customer_sk"), not_null("source_system"),
           accepted_values("source_system", CUSTOMER_PRODUCT_SOURCES),
           not_null("source_customer_id"), not_null("full_name"),
           accepted_values("status", STATUS_VALUES)),
)

INT_UNIFIED_PRODUCTS = UnifiedModel(
    name="int_unified_products",
    schema=PRODUCT_SCHEMA,
    key_name="product_sk",
    key_parts=("source_system", "source_product_id"),
    branches=(
        Branch("a", STG_A_INVENTORY.name, {
            "source_product_id": lambda: F.col("product_id"),
            "is_available": lambda: exprs.positive_flag("stock_quantity"),
        }),
        Branch("b", STG_B_PRODUCTS.name, {
            "source_product_id": lambda: F.col("product_id"),
        }),
    ),
    comment="Unified products from both systems; one row per (source, id).",
    tests=(unique("product_sk"), not_null("product_sk"), not_null("source_system"),
           accepted_values("source_system", CUSTOMER_PRODUCT_SOURCES),
           not_null("source_product_id"), not_null("product_name"),
           not_null("retail_price"), not_null("is_available")),
)

INT_UNIFIED_ACTIVITY = UnifiedModel(
    name="int_unified_activity",
    schema=ACTIVITY_SCHEMA,
    key_name="activity_sk",
    key_parts=("source_system", "source_activity_id"),
    branches=(
        Branch("orders", STG_SALES_ORDERS.name, {
            "source_activity_id": lambda: F.col("order_id"),
            "activity_type": lambda: F.lit("order"),
            "status": lambda: F.col("order_status"),
            "amount": lambda: F.col("total_price"),
            "activity_date": lambda: F.col("order_date"),
        }),
        Branch("lineitem", STG_SALES_LINEITEM.name, {
            "source_activity_id": lambda: exprs.composite_id(
                "order_id", "line_number", "part_id", "supplier_id"),
            "activity_type": lambda: F.lit("line"),
            "status": lambda: F.col("line_status"),
            "amount": lambda: F.col("extended_price"),
            "activity_date": lambda: F.col("ship_date"),
        }),
        Branch("events", STG_WEB_EVENTS.name, {
            "source_activity_id": lambda: F.col("event_id"),
            "customer_id": lambda: F.col("user_id"),
            "activity_type": lambda: F.col("event_type"),
            "amount": lambda: F.col("event_value"),
            "activity_date": lambda: F.col("event_date"),
        }),
    ),
    comment="Orders, order lines and web events on one activity schema.",
    tests=(unique("activity_sk"), not_null("activity_sk"), not_null("source_system"),
           accepted_values("source_system", ACTIVITY_SOURCES),
           not_null("source_activity_id"), not_null("amount"), not_null("activity_date")),
)

UNIFIED: dict[str, UnifiedModel] = {m.name: m for m in (
    INT_UNIFIED_CUSTOMERS, INT_UNIFIED_PRODUCTS, INT_UNIFIED_ACTIVITY)}

# which staging models feed which unified model
def inputs_of(model: UnifiedModel) -> list[str]:
    return [b.staged for b in model.branches]


# --- source contracts (declared raw schemas) ------------------------------------

_S, _L, _D, _I, _TS = StringType(), LongType(), DoubleType(), IntegerType(), TimestampNTZType()


def _st(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


RAW_CONTRACTS: dict[str, StructType] = {
    "raw_a__contacts": _st(
        ("contact_id", _L), ("first_name", _S), ("last_name", _S), ("email_address", _S),
        ("phone", _S), ("company_name", _S), ("created_date", _S)),
    "raw_a__inventory": _st(
        ("item_id", _L), ("item_name", _S), ("item_description", _S), ("category", _S),
        ("price", _D), ("stock_qty", _L), ("added_date", _S)),
    "raw_b__customers": _st(
        ("cust_id", _L), ("full_name", _S), ("email", _S), ("mobile_phone", _S),
        ("organization", _S), ("status", _S), ("signup_date", _S)),
    "raw_b__products": _st(
        ("prod_id", _L), ("product_title", _S), ("product_desc", _S), ("product_type", _S),
        ("unit_cost", _D), ("retail_price", _D), ("available", _L), ("created_at", _S)),
    "raw_sales__orders": _st(
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "raw_sales__lineitem": _st(
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "raw_web__events": _st(
        ("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
        ("props", _S)),
}


def raw_contracts() -> dict[str, StructType]:
    return dict(RAW_CONTRACTS)


# Columns a consumer of each unified model relies on.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "int_unified_customers": ("customer_sk", "source_system", "source_customer_id",
                              "full_name", "email", "status"),
    "int_unified_products": ("product_sk", "source_system", "source_product_id",
                             "product_name", "retail_price", "is_available"),
    "int_unified_activity": ("activity_sk", "source_system", "source_activity_id",
                             "activity_type", "amount", "activity_date"),
}
