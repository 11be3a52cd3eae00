"""Small raw-shaped tables with the shape facts of the two source systems
(12 contacts, 10 inventory items, 10 customers, 11 products; NULLs where the
source allows them; the same people in both systems)."""

from __future__ import annotations

CONTACTS_DDL = ("contact_id bigint, first_name string, last_name string, email_address string, "
                "phone string, company_name string, created_date string")
INVENTORY_DDL = ("item_id bigint, item_name string, item_description string, category string, "
                 "price double, stock_qty bigint, added_date string")
CUSTOMERS_DDL = ("cust_id bigint, full_name string, email string, mobile_phone string, "
                 "organization string, status string, signup_date string")
PRODUCTS_DDL = ("prod_id bigint, product_title string, product_desc string, product_type string, "
                "unit_cost double, retail_price double, available bigint, created_at string")

_FIRST = ["Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gus", "Hana", "Ivo", "Jo", "Kai", "Lea"]
_LAST = ["Moss", "Nye", "Orr", "Pike", "Quinn", "Rhee", "Shaw", "Toft", "Udo", "Vance", "Wex", "Yu"]


def contacts(spark):
    rows = [(i + 1, _FIRST[i], _LAST[i], f"{_FIRST[i].lower()}@a.example",
             None if i == 3 else f"555-01{i:02d}", None if i == 5 else "Org A",
             f"2024-01-{i + 1:02d}") for i in range(12)]
    return spark.createDataFrame(rows, CONTACTS_DDL)


def inventory(spark):
    rows = [(i + 1, f"item {i}", None if i == 2 else f"desc {i}", "tools", 10.0 + i,
             [5, 0, -1, 3, 7, 0, 2, 9, 1, 4][i], f"2023-06-{i + 1:02d}") for i in range(10)]
    return spark.createDataFrame(rows, INVENTORY_DDL)


def customers(spark):
    names = ["Ada Moss", "Ben Nye", "Cleo", "Dan Pike Jr", "Zed Ray", "Amy Low", "Bo Lin",
             "Cy Ng", "Di Ho", "Ed Ek"]
    statuses = ["active", "inactive", "churned", "active", "active", "inactive", "active",
                "churned", "active", "active"]
    rows = [(i + 1, names[i], f"c{i}@b.example", None if i == 4 else f"+44-{i}", "Org B",
             statuses[i], f"2024-02-{i + 1:02d} 09:30:00") for i in range(10)]
    return spark.createDataFrame(rows, CUSTOMERS_DDL)


def products(spark):
    rows = [(i + 1, f"product {i}", f"pdesc {i}", "gadgets", 3.0 + i, 9.5 + i,
             0 if i == 6 else 1, f"2024-03-{i + 1:02d} 12:00:00") for i in range(11)]
    return spark.createDataFrame(rows, PRODUCTS_DDL)


def raw_tables(spark):
    return {"raw_a__contacts": contacts(spark), "raw_a__inventory": inventory(spark),
            "raw_b__customers": customers(spark), "raw_b__products": products(spark)}


def sources(spark):
    return {"a": {"contacts": contacts(spark), "inventory": inventory(spark)},
            "b": {"customers": customers(spark), "products": products(spark)}}
