"""DuckDB SQL texts equivalent to the Spark models (the oracle side).

The staging and unified SELECTs are plain SQL over the adapters' CTEs, built
without the Spark mapping machinery, so a mistake there shows up as a mismatch
instead of being reproduced on both sides.
"""

from __future__ import annotations

from unilake.functions.exprs import SURROGATE_KEY_NULL_MARKER, SURROGATE_KEY_SEPARATOR
from unilake.sources.adapters import ADAPTER_SQL


def composite_sql(*parts: str) -> str:
    """A readable composite id; a NULL part keeps its place."""
    return "(" + f" || '{SURROGATE_KEY_SEPARATOR}' || ".join(
        f"coalesce(cast({p} as varchar), '{SURROGATE_KEY_NULL_MARKER}')" for p in parts) + ")"


def sk_sql(*parts: str) -> str:
    """The surrogate-key expression in SQL (same recipe as exprs.surrogate_key)."""
    sep = f" || '{SURROGATE_KEY_SEPARATOR}' || "
    return "md5(" + sep.join(
        f"coalesce(cast({p} as varchar), '{SURROGATE_KEY_NULL_MARKER}')" for p in parts) + ")"


# The staged columns of the first four sources in model order, and the
# raw column each one holds; ids become text, days are the first ten characters.
STAGED_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "a__contacts": [
        ("contact_id", "contact_id"), ("first_name", "first_name"), ("last_name", "last_name"),
        ("email", "email_address"), ("phone_number", "phone"), ("organization", "company_name"),
        ("created_at", "created_date")],
    "a__inventory": [
        ("product_id", "item_id"), ("product_name", "item_name"), ("product_description", "item_description"),
        ("product_category", "category"), ("retail_price", "price"), ("stock_quantity", "stock_qty"),
        ("created_at", "added_date")],
    "b__customers": [
        ("customer_id", "cust_id"), ("full_name", "full_name"), ("email", "email"), ("phone_number", "mobile_phone"),
        ("organization", "organization"), ("status", "status"), ("created_at", "signup_date")],
    "b__products": [
        ("product_id", "prod_id"), ("product_name", "product_title"), ("product_description", "product_desc"),
        ("product_category", "product_type"), ("unit_cost", "unit_cost"), ("retail_price", "retail_price"),
        ("is_available", "available"), ("created_at", "created_at")],
}


def _staged_sql(name: str) -> str:
    def value(staged: str, raw: str) -> str:
        if staged == "created_at":
            return f"cast({raw}[:10] as date)"
        if staged == "is_available":
            return f"{raw} is not distinct from 1"
        return f"cast({raw} as varchar)" if staged.endswith("_id") else raw

    columns = ", ".join(f"{value(staged, raw)} as {staged}" for staged, raw in STAGED_COLUMNS[name])
    return f"select {columns} from raw_{name}"


STAGE_SQL: dict[str, tuple[str, str]] = {
    # name -> (raw cte it reads, select body)
    **{f"stg_{name}": (f"raw_{name}", _staged_sql(name)) for name in STAGED_COLUMNS},
    "stg_sales__orders": ("raw_sales__orders", """
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
               o_orderstatus as order_status, o_totalprice as total_price,
               o_orderpriority as order_priority, cast(o_orderdate as date) as order_date
        from raw_sales__orders"""),
    "stg_sales__lineitem": ("raw_sales__lineitem", """
        select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as varchar) as line_number,
               cast(l_partkey as varchar) as part_id, cast(l_suppkey as varchar) as supplier_id,
               l_quantity as quantity, l_extendedprice as extended_price, l_discount as discount,
               l_tax as tax, l_returnflag as return_flag, l_linestatus as line_status,
               cast(l_shipdate as date) as ship_date
        from raw_sales__lineitem"""),
    "stg_web__events": ("raw_web__events", """
        select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
               event_type, value as event_value, props, ts as event_at,
               cast(ts as date) as event_date
        from raw_web__events"""),
}

# unified model -> (staging inputs, body over them); loaded_at left out
UNIFIED_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "int_unified_customers": (("stg_a__contacts", "stg_b__customers"), f"""
        with people as (
            select * rename (contact_id as source_customer_id), 'a' as source_system,
                   concat(first_name, ' ', last_name) as full_name, 'active' as status
            from stg_a__contacts
            union all by name
            select * rename (customer_id as source_customer_id), 'b' as source_system,
                   string_split(full_name, ' ')[1] as first_name,
                   nullif(list_aggregate(string_split(full_name, ' ')[2:], 'string_agg', ' '), '') as last_name
            from stg_b__customers)
        select {sk_sql('source_system', 'source_customer_id')} as customer_sk, source_system,
               source_customer_id, first_name, last_name, full_name, email, phone_number,
               organization, status, created_at
        from people"""),
    "int_unified_products": (("stg_a__inventory", "stg_b__products"), f"""
        with goods as (
            select *, 'a' as source_system, coalesce(stock_quantity > 0, false) as is_available
            from stg_a__inventory
            union all by name
            select *, 'b' as source_system from stg_b__products)
        select {sk_sql('source_system', 'product_id')} as product_sk, source_system,
               product_id as source_product_id, product_name, product_description, product_category,
               retail_price, unit_cost, stock_quantity, is_available, created_at
        from goods"""),
    "int_unified_activity": (("stg_sales__orders", "stg_sales__lineitem", "stg_web__events"), f"""
        select {sk_sql('source_system', 'source_activity_id')} as activity_sk, *
        from (
            select 'orders' as source_system, order_id as source_activity_id, customer_id,
                   'order' as activity_type, order_status as status, total_price as amount,
                   cast(null as double) as quantity, order_date as activity_date
            from stg_sales__orders
            union all
            select 'lineitem', {composite_sql('order_id', 'line_number', 'part_id', 'supplier_id')},
                   cast(null as varchar), 'line', line_status, extended_price, quantity, ship_date
            from stg_sales__lineitem
            union all
            select 'events', event_id, user_id, event_type, cast(null as varchar), event_value,
                   cast(null as double), event_date
            from stg_web__events
        )"""),
}


def with_models(final: str, models: tuple[str, ...] | list[str],
                extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``final`` with the CTEs for the given staging / unified models
    (and, transitively, the raw adapters they read), then ``extra`` CTEs
    (name, body) in order."""
    ctes: dict[str, str] = {}

    def need(name: str) -> None:
        if name in ctes:
            return
        if name in UNIFIED_SQL:
            deps, body = UNIFIED_SQL[name]
            for d in deps:
                need(d)
        elif name in STAGE_SQL:
            raw, body = STAGE_SQL[name]
            need(raw)
        elif name in ADAPTER_SQL:
            body = ADAPTER_SQL[name]
        else:
            raise KeyError(name)
        ctes[name] = body

    for m in models:
        need(m)
    for n, b in extra or []:
        ctes[n] = b
    return "with " + ",\n".join(f"{n} as ({b})" for n, b in ctes.items()) + "\n" + final
