"""Raw-shaped source tables derived from the driver's parquet tables.

The test data is a TPC-H-like star schema with no NULLs and no name
variety, so each adapter derives the raw shape of an upstream system from a
whole driver table and injects NULLs / name forms / odd flag values with
arithmetic on the key.  Every row of the driver table is used (nothing is
filtered), so the work grows with the data.  Each adapter has an equivalent
DuckDB SQL text (``ADAPTER_SQL``) used by the oracle comparison; the two
must stay in step.

Sources (name -> tables):
  a     : contacts (from customer), inventory (from part)
  b     : customers (from supplier), products (from part)
  sales : orders, lineitem (landed unchanged)
  web   : events (landed unchanged)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")



def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole driver table with the columns its files have."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(c: str) -> Column:
    return F.col(c)


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def _date_text(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int")).cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def a_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k("c_custkey")
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    return read_table(spark, sf_dir, "customer").select(
        k.alias("contact_id"),
        first.alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        _null_when(k % 7 == 3, F.concat(F.lower(first), F.lit("."), k.cast("string"),
                                        F.lit("@a.example"))).alias("email_address"),
        _null_when(k % 10 == 0, F.concat(F.lit("+1-"), _pad(k, 10))).alias("phone"),
        _null_when(k % 11 == 5, F.col("c_mktsegment")).alias("company_name"),
        _date_text("2020-01-01", k % 1000).alias("created_date"),
    )


def a_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k("p_partkey")
    return read_table(spark, sf_dir, "part").select(
        k.alias("item_id"),
        F.col("p_name").alias("item_name"),
        _null_when(k % 8 == 2, F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type"))
                   ).alias("item_description"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        _null_when(k % 10 == 0, (F.col("p_size") - 25).cast("long")).alias("stock_qty"),
        _date_text("2019-06-01", k % 1200).alias("added_date"),
    )


def b_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k("s_suppkey")
    spaced = F.replace(F.col("s_name"), F.lit("#"), F.lit(" "))
    full = (F.when(k % 3 == 0, F.replace(F.col("s_name"), F.lit("#"), F.lit("")))
            .when(k % 3 == 1, spaced)
            .otherwise(F.concat(spaced, F.lit(" Ltd"))))
    status = (F.when(k % 4 == 0, F.lit("inactive")).when(k % 4 == 1, F.lit("churned"))
              .otherwise(F.lit("active")))
    return read_table(spark, sf_dir, "supplier").select(
        k.alias("cust_id"),
        full.alias("full_name"),
        _null_when(k % 6 == 5, F.concat(F.lit("b"), k.cast("string"), F.lit("@b.example"))
                   ).alias("email"),
        _null_when(k % 10 == 0, F.concat(F.lit("+44-"), _pad(k, 10))).alias("mobile_phone"),
        F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string")).alias("organization"),
        status.alias("status"),
        F.concat(_date_text("2021-01-01", k % 900), F.lit(" "), _pad(k % 24, 2),
                 F.lit(":30:00")).alias("signup_date"),
    )


def b_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k("p_partkey")
    flag = F.expr("p_partkey div 2") % 4
    return read_table(spark, sf_dir, "part").select(
        k.alias("prod_id"),
        F.col("p_name").alias("product_title"),
        _null_when(k % 9 == 4, F.col("p_brand")).alias("product_desc"),
        F.col("p_type").alias("product_type"),
        (F.col("p_retailprice") * 0.5).alias("unit_cost"),
        F.col("p_retailprice").alias("retail_price"),
        _null_when(flag == 3, flag).alias("available"),
        F.concat(_date_text("2022-02-01", k % 700), F.lit(" 12:00:00")).alias("created_at"),
    )


def _passthrough(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_table(spark, sf_dir, name)
    build.__name__ = name
    return build


# (source, table) -> builder(spark, sf_dir) -> raw-shaped DataFrame
ADAPTERS: dict[tuple[str, str], Callable[[SparkSession, str], DataFrame]] = {
    ("a", "contacts"): a_contacts,
    ("a", "inventory"): a_inventory,
    ("b", "customers"): b_customers,
    ("b", "products"): b_products,
    ("sales", "orders"): _passthrough("orders"),
    ("sales", "lineitem"): _passthrough("lineitem"),
    ("web", "events"): _passthrough("events"),
}


def source_registry(spark: SparkSession, sf_dir: str,
                    only: set[str] | None = None) -> dict[str, dict[str, DataFrame]]:
    """The default source registry: source name -> {table: DataFrame}, built
    from a folder of driver tables (pass your own mapping to override)."""
    out: dict[str, dict[str, DataFrame]] = {}
    for (s, t), fn in ADAPTERS.items():
        if only is None or s in only:
            out.setdefault(s, {})[t] = fn(spark, sf_dir)
    return out


def raw_frames(spark: SparkSession, sf_dir: str,
               only: set[str] | None = None) -> dict[str, DataFrame]:
    """``raw_<source>__<table>`` -> DataFrame for every adapter."""
    return {f"raw_{s}__{t}": fn(spark, sf_dir) for (s, t), fn in ADAPTERS.items()
            if only is None or f"raw_{s}__{t}" in only}


# --- DuckDB equivalents (oracle side); keep in step with the builders above --
ADAPTER_SQL: dict[str, str] = {
    "raw_a__contacts": """
        select c_custkey as contact_id,
               split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) as last_name,
               case when c_custkey % 7 = 3 then null
                    else lower(split_part(c_name, '#', 1)) || '.' || cast(c_custkey as varchar)
                         || '@a.example' end as email_address,
               case when c_custkey % 10 = 0 then null
                    else '+1-' || lpad(cast(c_custkey as varchar), 10, '0') end as phone,
               case when c_custkey % 11 = 5 then null else c_mktsegment end as company_name,
               cast(date '2020-01-01' + cast(c_custkey % 1000 as integer) as varchar) as created_date
        from customer""",
    "raw_a__inventory": """
        select p_partkey as item_id,
               p_name as item_name,
               case when p_partkey % 8 = 2 then null else p_brand || ' ' || p_type end
                    as item_description,
               p_type as category,
               p_retailprice as price,
               case when p_partkey % 10 = 0 then null else cast(p_size - 25 as bigint) end
                    as stock_qty,
               cast(date '2019-06-01' + cast(p_partkey % 1200 as integer) as varchar) as added_date
        from part""",
    "raw_b__customers": """
        select s_suppkey as cust_id,
               case s_suppkey % 3 when 0 then replace(s_name, '#', '')
                                  when 1 then replace(s_name, '#', ' ')
                                  else replace(s_name, '#', ' ') || ' Ltd' end as full_name,
               case when s_suppkey % 6 = 5 then null
                    else 'b' || cast(s_suppkey as varchar) || '@b.example' end as email,
               case when s_suppkey % 10 = 0 then null
                    else '+44-' || lpad(cast(s_suppkey as varchar), 10, '0') end as mobile_phone,
               'nation-' || cast(s_nationkey as varchar) as organization,
               case s_suppkey % 4 when 0 then 'inactive' when 1 then 'churned'
                                  else 'active' end as status,
               cast(date '2021-01-01' + cast(s_suppkey % 900 as integer) as varchar) || ' '
                    || lpad(cast(s_suppkey % 24 as varchar), 2, '0') || ':30:00' as signup_date
        from supplier""",
    "raw_b__products": """
        select p_partkey as prod_id,
               p_name as product_title,
               case when p_partkey % 9 = 4 then null else p_brand end as product_desc,
               p_type as product_type,
               p_retailprice * 0.5 as unit_cost,
               p_retailprice as retail_price,
               case when (p_partkey // 2) % 4 = 3 then null else (p_partkey // 2) % 4 end
                    as available,
               cast(date '2022-02-01' + cast(p_partkey % 700 as integer) as varchar)
                    || ' 12:00:00' as created_at
        from part""",
    "raw_sales__orders": "select * from orders",
    "raw_sales__lineitem": "select * from lineitem",
    "raw_web__events": "select * from events",
}
