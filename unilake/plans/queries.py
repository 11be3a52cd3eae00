"""Registered queries: (spark, sf_dir) -> DataFrame, with their DuckDB oracles.

Every query reads the driver tables (through the adapters) over their whole
extent.  ``loaded_at`` is left out of every compared result because it is
the build time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unilake.plans import build
from unilake.plans.models import STAGING, UNIFIED
from unilake.plans.oracle import with_models
from unilake.sources.adapters import ADAPTER_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- staging (P1-P5, F1, F2, F10) ---------------------------------------------

def _stage_query(stg: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build.staging_from_tables(spark, sf_dir, stg)
    return q


for _key, _stg in (("stage_contacts", "stg_a__contacts"),
                   ("stage_inventory", "stg_a__inventory"),
                   ("stage_customers", "stg_b__customers"),
                   ("stage_products", "stg_b__products"),
                   ("stage_orders", "stg_sales__orders"),
                   ("stage_lineitem", "stg_sales__lineitem"),
                   ("stage_events", "stg_web__events")):
    register(_key, with_models(f"select * from {_stg}", [_stg]))(_stage_query(_stg))


# --- unified models (U1, M1-M4, P6-P8, K1) ------------------------------------

def _unified_query(model: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build.unified_from_tables(spark, sf_dir, model, loaded_at=False)
    return q


for _key, _model in (("unified_customers", "int_unified_customers"),
                     ("unified_products", "int_unified_products"),
                     ("unified_activity", "int_unified_activity")):
    register(_key, with_models(f"select * from {_model}", [_model]))(_unified_query(_model))


# --- scalar functions (F2-F11, P7, K1) ---------------------------------------

@register("name_forms", with_models(
    "select source_system, source_customer_id, first_name, last_name, full_name "
    "from int_unified_customers", ["int_unified_customers"]))
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full name from split names (a) and split names from a full name (b)."""
    return build.unified_from_tables(spark, sf_dir, "int_unified_customers", loaded_at=False) \
        .select("source_system", "source_customer_id", "first_name", "last_name", "full_name")


_AVAIL_SQL = with_models("""
    select source_system, input_value, is_available, count(*) as row_count
    from (
        select 'a' as source_system,
               case when stock_quantity is null then 'null'
                    when stock_quantity < 0 then 'negative'
                    when stock_quantity = 0 then 'zero' else 'positive' end as input_value,
               case when stock_quantity > 0 then true else false end as is_available
        from stg_a__inventory
        union all
        select 'b', coalesce(cast(available as varchar), 'null'),
               case when available = 1 then true else false end
        from raw_b__products
    )
    group by all""", ["stg_a__inventory", "raw_b__products"])


@register("availability", _AVAIL_SQL)
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth tables of the two availability rules over every product row."""
    from unilake.functions import exprs
    from unilake.sources import adapters
    q = F.col("stock_quantity")
    a = build.staging_from_tables(spark, sf_dir, "stg_a__inventory").select(
        F.lit("a").alias("source_system"),
        F.when(q.isNull(), "null").when(q < 0, "negative").when(q == 0, "zero")
         .otherwise("positive").alias("input_value"),
        exprs.positive_flag(q).alias("is_available"))
    flag = F.col("available")
    b = adapters.b_products(spark, sf_dir).select(
        F.lit("b").alias("source_system"),
        F.coalesce(flag.cast("string"), F.lit("null")).alias("input_value"),
        exprs.one_flag(flag).alias("is_available"))
    return a.unionByName(b).groupBy("source_system", "input_value", "is_available") \
        .agg(F.count(F.lit(1)).alias("row_count"))


_DATE_INPUTS = (("raw_a__contacts", "contact_id", "created_date"),
                ("raw_a__inventory", "item_id", "added_date"),
                ("raw_b__customers", "cust_id", "signup_date"),
                ("raw_b__products", "prod_id", "created_at"))


@register("iso_dates", with_models(" union all ".join(
    f"select '{t}' as raw_table, cast({k} as varchar) as source_id, {c} as date_text, "
    f"cast({c} as date) as created_at from {t}" for t, k, c in _DATE_INPUTS),
    [t for t, _, _ in _DATE_INPUTS]))
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO date and datetime text -> date (time dropped), every raw row."""
    from unilake.functions import exprs
    from unilake.sources import adapters
    raws = adapters.raw_frames(spark, sf_dir, {t for t, _, _ in _DATE_INPUTS})
    parts = [raws[t].select(F.lit(t).alias("raw_table"), exprs.to_text(k).alias("source_id"),
                            F.col(c).alias("date_text"), exprs.iso_date(c).alias("created_at"))
             for t, k, c in _DATE_INPUTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("align_missing", with_models(
    "select source_system, source_product_id, unit_cost, stock_quantity "
    "from int_unified_products", ["int_unified_products"]))
def align_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed NULL columns for fields a source lacks (cost in a, stock in b)."""
    return build.unified_from_tables(spark, sf_dir, "int_unified_products", loaded_at=False) \
        .select("source_system", "source_product_id", "unit_cost", "stock_quantity")


_SK = (("int_unified_customers", "customer_sk", "source_customer_id"),
       ("int_unified_products", "product_sk", "source_product_id"),
       ("int_unified_activity", "activity_sk", "source_activity_id"))


@register("surrogate_key", with_models(" union all ".join(
    f"select '{m}' as model, source_system, {i} as source_id, {k} as surrogate_key from {m}"
    for m, k, i in _SK), [m for m, _, _ in _SK]))
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 surrogate keys of every unified row, across all three models."""
    parts = [build.unified_from_tables(spark, sf_dir, m, loaded_at=False).select(
        F.lit(m).alias("model"), "source_system", F.col(i).alias("source_id"),
        F.col(k).alias("surrogate_key")) for m, k, i in _SK]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- data tests (T1-T5, G5) -----------------------------------------------------

def checked_models(spark: SparkSession, sf_dir: str):
    """(model name, frame, declared tests) for every staging and unified model."""
    staged = build.staged_from_tables(spark, sf_dir)
    out = [(n, staged[n], STAGING[n].tests) for n in STAGING]
    from unilake.operators.unify import unify
    for n, m in UNIFIED.items():
        out.append((n, unify(m, staged, loaded_at=False), m.tests))
    return out


def _declared():
    for n, m in STAGING.items():
        yield n, m.tests
    for n, m in UNIFIED.items():
        yield n, m.tests


def _check_sql(kinds: tuple[str, ...], with_passed: bool = False) -> str:
    parts = []
    for name, tests in _declared():
        for t in tests:
            if t.kind not in kinds:
                continue
            head = f"select '{name}' as model, '{t.column}' as column_name, '{t.kind}' as check_name"
            if t.kind == "not_null":
                parts.append(f"{head}, count(*) filter (where {t.column} is null) as failures "
                             f"from {name}")
            elif t.kind == "accepted_values":
                vals = ", ".join(f"'{v}'" for v in t.values)
                parts.append(f"{head}, count(*) filter (where {t.column} is not null and "
                             f"{t.column} not in ({vals})) as failures from {name}")
            else:
                parts.append(f"{head}, (select count(*) from (select {t.column} from {name} "
                             f"where {t.column} is not null group by {t.column} "
                             f"having count(*) > 1)) as failures")
    body = " union all ".join(parts)
    if with_passed:
        body = f"select *, failures = 0 as passed from ({body})"
    return with_models(body, [n for n, _ in _declared()])


def _checks_query(kinds: tuple[str, ...], with_passed: bool = False) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from unilake.operators.quality import run_checks
        rep = run_checks(spark, checked_models(spark, sf_dir), kinds)
        return rep if with_passed else rep.drop("passed")
    return q


register("check_not_null", _check_sql(("not_null",)))(_checks_query(("not_null",)))
register("check_unique", _check_sql(("unique",)))(_checks_query(("unique",)))
register("check_accepted", _check_sql(("accepted_values",)))(
    _checks_query(("accepted_values",)))
_ALL_KINDS = ("not_null", "unique", "accepted_values")
register("quality_report", _check_sql(_ALL_KINDS, with_passed=True))(
    _checks_query(_ALL_KINDS, with_passed=True))


# --- readouts (G1-G3, S12) ------------------------------------------------------

def _layer_tables():
    from unilake.sources.adapters import ADAPTERS
    raw = [("raw", f"raw_{s}__{t}") for s, t in ADAPTERS]
    return raw + [("staging", n) for n in STAGING] + [("intermediate", n) for n in UNIFIED]


@register("layer_summary", with_models(" union all ".join(
    f"select '{layer}' as layer, '{n}' as table_name, count(*) as row_count from {n}"
    for layer, n in _layer_tables()), [n for _, n in _layer_tables()]))
def layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every raw, staging and intermediate table (one job)."""
    from unilake.operators.report import layer_summary as summary
    from unilake.sources import adapters
    raw = adapters.raw_frames(spark, sf_dir)
    staged = build.staged_frames(raw)
    from unilake.operators.unify import unify
    frames = {**raw, **staged, **{n: unify(m, staged, loaded_at=False) for n, m in UNIFIED.items()}}
    return summary((layer, n, frames[n]) for layer, n in _layer_tables())


@register("preview", with_models(
    "select * from int_unified_customers order by customer_sk limit 5",
    ["int_unified_customers"]))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five unified customers in key order (a top-n, not a sort)."""
    from unilake.operators.report import preview as top
    return top(build.unified_from_tables(spark, sf_dir, "int_unified_customers",
                                         loaded_at=False), ["customer_sk"], 5)


@register("preview_products", with_models(
    "select * from int_unified_products order by product_sk limit 5",
    ["int_unified_products"]))
def preview_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five unified products in key order."""
    from unilake.operators.report import preview as top
    return top(build.unified_from_tables(spark, sf_dir, "int_unified_products",
                                         loaded_at=False), ["product_sk"], 5)


def _describe_sql() -> str:
    from unilake.plans.models import REQUIRED_COLUMNS
    parts = []
    for m, model in UNIFIED.items():
        names = [f.name for f in model.schema.fields]
        nulls = ", ".join(f"count(*) - count({c}) as {c}" for c in names)
        need = ", ".join(f"'{c}'" for c in REQUIRED_COLUMNS[m])
        parts.append("(" + with_models(f"""
            select '{m}' as model, cast(d.ordinal as integer) as ordinal, d.column_name, d.column_type as data_type,
                   n.null_count, d.column_name in ({need}) as required
            from (select row_number() over () as ordinal, column_name, column_type
                  from (describe select *, current_timestamp as loaded_at from {m})) d
            join (unpivot (select {nulls} from (select *, current_timestamp as loaded_at from {m}))
                  on columns(*) into name column_name value null_count) n using (column_name)""", [m]) + ")")
    return " union all ".join(parts)


@register("describe_model", _describe_sql())
def describe_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land and publish every model, then describe what was published: types,
    NULLs per column, and the columns that consumers require."""
    from unilake.operators.report import describe
    from unilake.plans.layers import Publisher
    from unilake.plans.models import REQUIRED_COLUMNS
    lake = _new_lake(spark)
    lake.land_many(_raw_sources(spark, sf_dir))
    pub = Publisher(lake)
    for n in UNIFIED:
        pub.publish(n)
    return describe(spark, [(n, pub.read(n)) for n in UNIFIED], REQUIRED_COLUMNS).drop("comment")


def _contract_sql() -> str:
    from unilake.operators.report import sql_type
    from unilake.plans.models import RAW_CONTRACTS
    contracts = RAW_CONTRACTS | {n: m.schema for n, m in UNIFIED.items()}
    expected, actual, nulls = [], [], []
    for t, schema in contracts.items():
        expected += [f"('{t}', '{f.name}', '{sql_type(f.dataType)}')" for f in schema.fields]
        rows = f"select * from {t}" if t in RAW_CONTRACTS else f"select *, current_timestamp as loaded_at from {t}"
        actual.append(f"select '{t}' as table_name, column_name, column_type from (describe {rows})")
        # NULLs are observed on landings only
        nulls += [f"select '{t}' as table_name, '{f.name}' as column_name, count(*) - count({f.name}) as null_count "
                  f"from {t}" for f in schema.fields if t in RAW_CONTRACTS]
    final = """
        select coalesce(e.table_name, a.table_name) as table_name,
               coalesce(e.column_name, a.column_name) as column_name,
               e.expected_type, a.column_type as actual_type,
               case when a.column_name is null then 'missing'
                    when e.column_name is null then 'extra'
                    when a.column_type = e.expected_type then 'ok'
                    else 'type_mismatch' end as status, n.null_count
        from expected e full outer join actual a
          on e.table_name = a.table_name and e.column_name = a.column_name
        left join nulls n on n.table_name = a.table_name and n.column_name = a.column_name"""
    return with_models(final, list(contracts), extra=[
        ("expected", f"select * from (values {', '.join(expected)}) "
                     f"v(table_name, column_name, expected_type)"),
        ("actual", " union all ".join(actual)), ("nulls", " union all ".join(nulls)),
    ])


@register("contract_check", _contract_sql())
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every source and publish every model, then hold the landed files'
    and the published versions' schemas against the declared contracts, with
    the landed NULLs per column observed on the writes."""
    from unilake.operators.report import contract_check as check
    from unilake.plans.layers import Publisher
    from unilake.plans.models import RAW_CONTRACTS
    lake = _new_lake(spark)
    lake.land_many(_raw_sources(spark, sf_dir))
    pub = Publisher(lake)
    for n in UNIFIED:
        pub.publish(n)
    return check(spark, [(t, lake.read_raw(t).schema, schema, lake.null_counts(t))
                         for t, schema in RAW_CONTRACTS.items()]
                 + [(n, pub.read(n).schema, m.schema) for n, m in UNIFIED.items()])


# --- landing (S2, S5, S7-S9) -------------------------------------------------------

def _raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    from unilake.sources.adapters import source_registry
    return source_registry(spark, sf_dir)


def _new_lake(spark: SparkSession):
    from unilake.session import fresh_dir
    from unilake.sources.landing import Lake
    root = fresh_dir(spark, "lake")
    return Lake(spark, root, namespace=f"lake_{root.rsplit('-', 1)[1]}_")


@register("load_audit", " union all ".join(
    f"select 'raw.{n}' as raw_table, cast(1 as bigint) as load_id, count(*) as row_count, "
    f"'loaded' as status from ({sql})"
    for n, sql in ADAPTER_SQL.items()))
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all seven raw tables as load 1; the audit counts come from the
    writes themselves (observed metrics, no second scan)."""
    lake = _new_lake(spark)
    lake.land_many(_raw_sources(spark, sf_dir))
    return lake.audit().select("raw_table", "load_id", "row_count", "status")


@register("full_replace", "select * from lineitem")
def full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land lineitem twice -- first with an extra column, then as it is -- and
    read the raw table: only the second load, with its schema, remains."""
    from unilake.sources import adapters
    lake = _new_lake(spark)
    li = adapters.read_table(spark, sf_dir, "lineitem")
    lake.land("sales", {"lineitem": li.withColumn("obsolete", F.lit("x"))})
    lake.land("sales", {"lineitem": li})
    return lake.read_raw("raw_sales__lineitem")


def _race_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from unilake.sources import adapters
    li = adapters.read_table(spark, sf_dir, "lineitem")
    return {"all": li, "open": li.where("l_linestatus = 'O'"), "returned": li.where("l_returnflag = 'R'")}


_RACE = " union all ".join(
    f"""select '{tag}' as lander, cast(1 as bigint) as loads, count(*) as audited_rows, count(*) as stored_rows,
               coalesce(sum(l_orderkey), 0) as key_sum, cast(0 as bigint) as foreign_rows
        from lineitem where {cond}"""
    for tag, cond in (("all", "true"), ("open", "l_linestatus = 'O'"), ("returned", "l_returnflag = 'R'")))


@register("land_race", _RACE)
def land_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landers land snapshots of one table at once: each keeps one load id
    and exactly its own rows, and the newest id's lander is what readers see."""
    import threading
    from concurrent.futures import ThreadPoolExecutor
    from unilake.sources.landing import Lake
    lake = _new_lake(spark)
    snapshots = _race_snapshots(spark, sf_dir)
    together = threading.Barrier(len(snapshots))

    def land(tag: str) -> None:
        own = Lake(spark, lake.root, namespace=lake.namespace)
        rows = snapshots[tag].withColumn("lander", F.lit(tag))
        together.wait()
        own.land("sales", {"lineitem": rows})

    with ThreadPoolExecutor(len(snapshots)) as pool:
        list(pool.map(land, snapshots))
    parts = []
    for r in lake.audit().collect():   # one row per lander
        rows = lake.read_raw("raw_sales__lineitem", r["load_id"])
        parts.append(rows.agg(
            F.min("lander").alias("lander"), F.lit(1).cast("long").alias("loads"), F.lit(r["row_count"]).alias("audited_rows"),
            F.count(F.lit(1)).alias("stored_rows"), F.coalesce(F.sum("l_orderkey"), F.lit(0)).alias("key_sum"),
            F.count_if(F.col("lander") != F.lit(rows.first()["lander"])).alias("foreign_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("schema_drift", """
    select * from (values
        ('as_landed', 'loaded', 'extra:note', 'bigint,bigint,string,double,timestamp_ntz,string,string'),
        ('widened', 'loaded', 'widened:o_orderkey bigint -> decimal(24,2)',
         'decimal(24,2),bigint,string,double,timestamp_ntz,string'),
        ('missing', 'loaded', 'missing:o_orderpriority', 'bigint,bigint,string,double,timestamp_ntz,string'),
        ('clash_text', 'loaded', 'clash:o_totalprice double -> string', 'bigint,bigint,string,string,timestamp_ntz,string'),
        ('clash_rejected', 'rejected', 'clash:o_totalprice double -> string',
         'bigint,bigint,string,double,timestamp_ntz,string')) v(drift_case, status, drift, current_types)
    cross join (select count(*) as current_rows, sum(o_orderkey) as key_sum from orders)""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land orders, then a drifted copy, under each policy: the audited status and
    drift, and the types and rows of the load that is current afterwards."""
    from unilake.sources import adapters
    from unilake.sources.drift import AS_LANDED, RECONCILE, DriftPolicy
    raw = adapters.raw_frames(spark, sf_dir, {"raw_sales__orders"})["raw_sales__orders"]
    text = raw.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    cases = {
        "as_landed": (AS_LANDED, raw.withColumn("note", F.lit("x"))),
        "widened": (RECONCILE, raw.withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(24,2)"))),
        "missing": (RECONCILE, raw.drop("o_orderpriority")),
        "clash_text": (DriftPolicy(clash="text"), text),
        "clash_rejected": (RECONCILE, text)}
    parts = []
    for case, (policy, second) in cases.items():
        lake = _new_lake(spark)
        lake.land("sales", {"orders": raw})
        lake.land("sales", {"orders": second}, drift=policy)
        last = lake.audit().where("load_id = 2").first()
        now = lake.read_raw("raw_sales__orders")
        parts.append(now.agg(F.count(F.lit(1)).alias("current_rows"), F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"))
                     .select(F.lit(case).alias("drift_case"), F.lit(last["status"]).alias("status"),
                             F.lit(last["drift"]).alias("drift"), F.lit(",".join(t for _, t in now.dtypes)).alias("current_types"),
                             "current_rows", "key_sum"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- refresh (R1-R4) -----------------------------------------------------------------

@register("snapshot_refresh", with_models("select * from int_unified_customers",
                                          ["int_unified_customers"]))
def snapshot_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish customers from a stale snapshot of source b, land b's current
    snapshot, refresh: only b is rebuilt and the pointer swaps to it."""
    from unilake.plans.layers import Publisher
    from unilake.sources import adapters
    from unilake.streaming.refresh import snapshot_refresh as refresh
    lake = _new_lake(spark)
    b_now = adapters.b_customers(spark, sf_dir)
    lake.land_many({"a": {"contacts": adapters.a_contacts(spark, sf_dir)},
                    "b": {"customers": b_now.withColumn("status", F.lit("active"))}})
    pub = Publisher(lake)
    pub.publish("int_unified_customers")
    lake.land("b", {"customers": b_now})
    res = refresh(pub, "int_unified_customers")
    if res.rebuilt != ["b"]:
        raise RuntimeError(f"expected only source b to be rebuilt, got {res.rebuilt}")
    return pub.read("int_unified_customers").drop("loaded_at")


@register("stream_refresh", with_models("select * from int_unified_activity",
                                        ["int_unified_activity"]))
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the sales and web sources, let the refresh stream publish the
    activity model (available-now trigger), read what it published."""
    from unilake.plans.layers import Publisher
    from unilake.streaming.refresh import start_stream_refresh
    from unilake.sources.adapters import source_registry
    lake = _new_lake(spark)
    lake.land_many(source_registry(spark, sf_dir, only={"sales", "web"}))
    q = start_stream_refresh(lake, ["int_unified_activity"], available_now=True,
                             on_gate_failure="raise")
    q.awaitTermination()   # raises what the stream raised
    return Publisher(lake).read("int_unified_activity").drop("loaded_at")


# fixed values: seconds at which loads land, and how long a refresh takes
_LANDINGS, _BUILD_SECONDS = (0, 20, 200), 5.0


@register("refresh_schedule", with_models("""
    select v.build, v.loads, v.waited, false as late, p.published_rows, p.active_rows
    from (values (1, cast(2 as bigint), true), (2, cast(1 as bigint), true)) v(build, loads, waited)
    cross join (select count(*) as published_rows, count(*) filter (where status = 'active') as active_rows
                from int_unified_customers) p""", ["int_unified_customers"]))
def refresh_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of the customer sources under a clock of the query's own, 0, 20
    and 200 seconds after the start: the first two are published together
    shortly before the first one's deadline, the third one by itself."""
    import datetime as dt
    from unilake.plans.layers import Publisher
    from unilake.sources import adapters
    from unilake.streaming.schedule import Scheduler, Waiting, waiting_models
    begin = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    now = [0.0]
    lake = _new_lake(spark)
    lake.clock = lambda: begin + dt.timedelta(seconds=now[0])
    a, b = adapters.a_contacts(spark, sf_dir), adapters.b_customers(spark, sf_dir)
    todo = [(_LANDINGS[0], {"a": {"contacts": a}, "b": {"customers": b.withColumn("status", F.lit("active"))}}),
            (_LANDINGS[1], {"b": {"customers": b}}), (_LANDINGS[2], {"a": {"contacts": a}, "b": {"customers": b}})]
    model = UNIFIED["int_unified_customers"]
    pub, published, known = Publisher(lake), [], {}

    def land() -> None:
        while todo and todo[0][0] <= now[0]:
            lake.land_many(todo.pop(0)[1])

    def waiting() -> list[Waiting]:
        state = (len(todo), len(published))
        if state not in known:   # the audit has not changed since
            known[state] = [Waiting(w.model, w.since, w.lag, _BUILD_SECONDS, w.loads, w.newest)
                            for w in waiting_models(pub, [model])]
        return known[state]

    def refresh(name: str) -> None:
        published.append(pub.publish(name).epoch)

    class Simulated:   # a refresh ends _BUILD_SECONDS after its start
        def start(self, work):
            work()
            return now[0] + _BUILD_SECONDS

        done = staticmethod(lambda end: now[0] >= end)
        error = staticmethod(lambda end: None)

    def sleep(seconds: float) -> None:
        now[0] += seconds
        land()

    land()
    schedule = Scheduler(waiting, refresh, 1, 1.0, lake.clock, sleep, Simulated())
    schedule.run()
    sleep(_LANDINGS[2] - now[0])
    schedule.run()
    parts = []
    for epoch, r in zip(published, schedule.done, strict=True):
        rows = pub.read_versions(model, pub.pointer(model, epoch).versions)
        waited = r.deadline - r.started <= dt.timedelta(seconds=_BUILD_SECONDS + 2)
        parts.append(rows.agg(F.count(F.lit(1)).alias("published_rows"), F.count_if(F.col("status") == "active").alias("active_rows"))
                     .select(F.lit(epoch).alias("build"), F.lit(r.loads).cast("long").alias("loads"), F.lit(waited).alias("waited"),
                             F.lit(r.late).alias("late"), "published_rows", "active_rows"))
    return parts[0].unionByName(parts[1])


@register("freshness_ledger", with_models(" union all ".join(
    f"select '{m}' as model, cast({e} as bigint) as epoch, '{s}' as source, cast({e} as bigint) as load_id, "
    f"count(*) as row_count, true as within_lag, true as measured from {t}"
    for m, s, t, epochs in (("int_unified_activity", "orders", "raw_sales__orders", (1, 2)),
                            ("int_unified_activity", "lineitem", "raw_sales__lineitem", (1,)),
                            ("int_unified_activity", "events", "raw_web__events", (1,)))
    for e in epochs), ["raw_sales__orders", "raw_sales__lineitem", "raw_web__events"]))
def freshness_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the activity sources, then orders once more; the refresh stream
    publishes each load and its listener enters the seconds from landing to
    publication.  A load that was published past the model's target lag is an
    entry like any other, with ``within_lag`` false: the query measures."""
    from unilake.plans.layers import Publisher
    from unilake.sources.adapters import source_registry
    from unilake.streaming.freshness import freshness_ledger as ledger
    from unilake.streaming.freshness import record_freshness
    from unilake.streaming.refresh import start_stream_refresh
    lake = _new_lake(spark)
    sources = source_registry(spark, sf_dir, only={"sales", "web"})
    for load in (sources, {"sales": {"orders": sources["sales"]["orders"]}}):
        lake.land_many(load)
        start_stream_refresh(lake, ["int_unified_activity"], available_now=True, on_gate_failure="raise",
                             ledger=True).awaitTermination()
    # the listener is told of a batch some time after it; an epoch is entered once
    record_freshness(Publisher(lake), [UNIFIED["int_unified_activity"]])
    return ledger(lake).select("model", "epoch", "source", "load_id", "row_count", "within_lag",
                               (F.col("seconds") > 0).alias("measured"))


# --- change set (R3b) ----------------------------------------------------------------

# fixed values: the earlier snapshot ends before these dates (per source family)
_SALES_CUTOFF = "2001-01-01"
_WEB_CUTOFF = "2024-01-25"

_CHANGED = """
    select {key}, case when min(was) is null then 'insert' when max(now) is null then 'delete'
                       else 'update' end as change_type
    from (select * exclude (sign), sum(sign) as left_over, max(case when sign > 0 then 1 end) as now,
                 min(case when sign < 0 then 1 end) as was
          from (select *, 1 as sign from new_s union all select *, -1 as sign from old_s)
          group by all)
    group by {key}
    having bool_or(left_over <> 0)"""

_CHANGE_SQL = with_models(_CHANGED.format(key="source_system, activity_sk"), ["int_unified_activity"], extra=[
    ("new_s", """
        select * from int_unified_activity
        where not (source_system = 'events' and activity_type = 'error')"""),
    ("old_s", f"""
        select activity_sk, source_system, source_activity_id, customer_id, activity_type,
               case when source_system = 'orders' and status = 'F' then 'O' else status end
                   as status,
               amount, quantity, activity_date
        from int_unified_activity
        where (source_system in ('orders', 'lineitem') and activity_date < date '{_SALES_CUTOFF}')
           or (source_system = 'events' and activity_date < date '{_WEB_CUTOFF}')"""),
])


def activity_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the activity model derived from the whole tables:
    the earlier one ends at a cutoff date and still shows fulfilled orders
    as open; the later one has purged the error events."""
    cur = build.unified_from_tables(spark, sf_dir, "int_unified_activity", loaded_at=False)
    src, day = F.col("source_system"), F.col("activity_date")
    old = cur.where((src.isin("orders", "lineitem") & (day < F.lit(_SALES_CUTOFF).cast("date")))
                    | ((src == "events") & (day < F.lit(_WEB_CUTOFF).cast("date")))) \
        .withColumn("status", F.when((src == "orders") & (F.col("status") == "F"), F.lit("O"))
                    .otherwise(F.col("status")))
    new = cur.where(~((src == "events") & (F.col("activity_type") == "error")))
    return old, new


@register("change_set", _CHANGE_SQL)
def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates and deletes between two activity snapshots (one
    grouping shuffle of key + hash; no join)."""
    from unilake.operators.change_set import change_set as diff
    old, new = activity_snapshots(spark, sf_dir)
    compare = [c for c in new.columns if c not in ("activity_sk", "source_system")]
    return diff(old, new, ["source_system", "activity_sk"], compare)


# fixed values: what differs between the two line snapshots
_DUP_KEY = ["l_orderkey", "l_linenumber"]


@register("change_set_duplicates", f"""
    with old_s as (select * replace (case when l_linestatus = 'O' and l_discount < 0.03 then l_quantity + 1
                                          else l_quantity end as l_quantity)
                   from lineitem where l_returnflag <> 'A' or l_tax < 0.05),
         new_s as (select * from lineitem where l_returnflag <> 'R' or l_tax >= 0.02)
    {_CHANGED.format(key=', '.join(_DUP_KEY))}""")
def change_set_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between two snapshots under a key that repeats: a key's rows
    compare as multisets."""
    from unilake.operators.change_set import change_set as diff
    from unilake.sources.adapters import read_table
    rows = read_table(spark, sf_dir, "lineitem")
    old = rows.where("l_returnflag <> 'A' or l_tax < 0.05").withColumn("l_quantity", F.expr(
        "if(l_linestatus = 'O' and l_discount < 0.03, l_quantity + 1, l_quantity)"))
    new = rows.where("l_returnflag <> 'R' or l_tax >= 0.02")
    return diff(old, new, _DUP_KEY)


# --- the gate over staging and unified tests (T5) ------------------------------------

def _gate_sql() -> str:
    broken = {"raw_b__customers": ADAPTER_SQL["raw_b__customers"], "raw_a__inventory": ADAPTER_SQL["raw_a__inventory"]}
    return f"""
    with c as (select * replace (case when cust_id % 5 = 0 then null else signup_date end as signup_date,
                                 case when cust_id % 7 = 0 then 'gone' else status end as status)
               from ({broken['raw_b__customers']})),
         i as (select * replace (case when item_id % 3 = 0 then null else item_name end as item_name)
               from ({broken['raw_a__inventory']})),
         bad as (select count(*) filter (where cust_id % 5 = 0) as days, count(*) filter (where status = 'gone') as states from c),
         worse as (select count(*) filter (where item_name is null) as names from i)
    select 'int_unified_customers' as published_model, 'stg_b__customers' as model, 'created_at' as column_name,
           'not_null' as check_name, days as failures, false as published from bad
    union all select 'int_unified_customers', 'stg_b__customers', 'status', 'accepted_values', states, false from bad
    union all select 'int_unified_customers', 'int_unified_customers', 'status', 'accepted_values', states, false from bad
    union all select 'int_unified_products', 'stg_a__inventory', 'product_name', 'not_null', names, false from worse
    union all select 'int_unified_products', 'int_unified_products', 'product_name', 'not_null', names, false from worse
    union all select 'int_unified_activity', null, null, null, 0, true"""


@register("gate_outcomes", _gate_sql())
def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land sources with planted violations and publish: failing tests of the
    staging and unified models, and which models were published all the same."""
    from unilake.operators.quality import QualityGateError
    from unilake.plans.layers import Publisher
    lake = _new_lake(spark)
    sources = _raw_sources(spark, sf_dir)
    sources["b"]["customers"] = sources["b"]["customers"] \
        .withColumn("signup_date", F.expr("if(cust_id % 5 = 0, null, signup_date)")) \
        .withColumn("status", F.expr("if(cust_id % 7 = 0, 'gone', status)"))
    sources["a"]["inventory"] = sources["a"]["inventory"].withColumn(
        "item_name", F.expr("if(item_id % 3 = 0, null, item_name)"))
    lake.land_many(sources)
    pub, rows = Publisher(lake), []
    for name in UNIFIED:
        try:
            pub.publish(name)
            rows.append((name, None, None, None, 0, True))
        except QualityGateError as exc:
            rows += [(name, *failed, pub.pointer(UNIFIED[name]).epoch > 0) for failed in exc.failed]
    return spark.createDataFrame(rows, "published_model string, model string, column_name string, "
                                       "check_name string, failures long, published boolean")


@register("staging_view_after_land", with_models("select * from stg_b__customers", ["stg_b__customers"]))
def staging_view_after_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging view, registered over a first load, shows a second one."""
    from unilake.plans.layers import register_staging_views
    from unilake.sources import adapters
    lake = _new_lake(spark)
    now = adapters.b_customers(spark, sf_dir)
    lake.land("b", {"customers": now.where("status = 'active'")})
    register_staging_views(lake, persistent=True)
    lake.land("b", {"customers": now})
    return spark.table(f"{lake.namespace}staging.stg_b__customers")


# --- end to end (land -> publish -> summarise) -----------------------------------------

@register("build_summary", " union all ".join(
    [f"select 'raw' as layer, '{n}' as table_name, count(*) as row_count, 'ok' as status "
     f"from ({sql})" for n, sql in ADAPTER_SQL.items()]
    + [f"select 'intermediate', '{m}', count(*), 'ok' from ("
       + with_models(f"select * from {m}", [m]) + ")" for m in UNIFIED]))
def build_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all sources, publish all unified models through the quality gate,
    and count every raw and published table."""
    from unilake.plans.run import build_all
    return build_all(_new_lake(spark), _raw_sources(spark, sf_dir),
                     on_gate_failure="report").drop("error")


@register("published_changes", with_models(
    "select source_system, customer_sk, "
    "case when organization = 'nation-0' then 'insert' else 'update' end as change_type "
    "from int_unified_customers "
    "where source_system = 'b' and (organization = 'nation-0' or status <> 'active')",
    ["int_unified_customers"]))
def published_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between two published epochs of the customer model: epoch 1
    from a stale snapshot of b (every status 'active', nation 0 not yet
    there), epoch 2 after b's current snapshot.  Source a kept its version,
    so it is not read by the diff."""
    from unilake.plans.layers import Publisher
    from unilake.plans.layers import published_changes as diff
    from unilake.sources import adapters
    lake = _new_lake(spark)
    b_now = adapters.b_customers(spark, sf_dir)
    stale = b_now.where(F.col("organization") != "nation-0").withColumn("status", F.lit("active"))
    lake.land_many({"a": {"contacts": adapters.a_contacts(spark, sf_dir)},
                    "b": {"customers": stale}})
    pub = Publisher(lake)
    first = pub.publish("int_unified_customers").epoch
    lake.land("b", {"customers": b_now})
    second = pub.publish("int_unified_customers").epoch
    return diff(pub, "int_unified_customers", first, second)


@register("change_feed", with_models(
    "select *, cast(3 as bigint) as epochs from int_unified_customers", ["int_unified_customers"]))
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish three epochs of the customer model (b short and stale, b without
    one nation, everything) and rebuild the model from the change feed alone."""
    from unilake.plans.layers import Publisher
    from unilake.session import fresh_dir
    from unilake.sources import adapters
    from unilake.streaming.feed import read_change_log, read_copy, start_change_log, start_copy
    lake = _new_lake(spark)
    a, b = adapters.a_contacts(spark, sf_dir), adapters.b_customers(spark, sf_dir)
    model, pub = "int_unified_customers", Publisher(lake)
    copy, log = fresh_dir(spark, "copy"), fresh_dir(spark, "changes")
    lake.land_many({"a": {"contacts": a}, "b": {"customers": b.where("organization <> 'nation-0'")
                                                .withColumn("status", F.lit("active"))}})
    pub.publish(model)
    start_copy(pub, model, copy, available_now=True).awaitTermination()
    for rows in (b.where("organization <> 'nation-1'"), b):
        lake.land("b", {"customers": rows})
        pub.publish(model)
    start_copy(pub, model, copy, available_now=True).awaitTermination()   # goes on after epoch 1
    start_change_log(pub, model, log, available_now=True).awaitTermination()
    epochs = read_change_log(pub, log).agg(F.count_distinct("epoch")).first()[0]
    return read_copy(pub, copy).drop("loaded_at").withColumn("epochs", F.lit(epochs).cast("long"))


# --- keys that don't alias (K1) -------------------------------------------------------

_PARTS = """
    select p_brand || '-' || p_size as a, p_type as b from part
    union all select p_brand, p_size || '-' || p_type from part
    union all select p_type, case when p_size % 4 = 0 then null when p_size % 4 = 1 then '{marker}' else p_name end
    from part"""


def _collisions_sql() -> str:
    from unilake.functions.exprs import SURROGATE_KEY_NULL_MARKER
    from unilake.plans.oracle import sk_sql
    framed = " || ".join(f"coalesce(length({c}) || ':' || {c}, 'n;')" for c in ("a", "b"))
    return " union all ".join(f"""
        select '{framing}' as framing, count(*) as keys, sum(n)::bigint as tuples,
               count(*) filter (where n > 1) as colliding_keys
        from (select k, count(*) as n
              from (select distinct a, b, {key} as k from ({_PARTS.format(marker=SURROGATE_KEY_NULL_MARKER)}))
              group by k)"""
                              for framing, key in (("separator", sk_sql("a", "b")), ("length", f"md5({framed})")))


@register("key_collisions", _collisions_sql())
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key parts of all parts that hold the separator and the NULL marker: how many
    part tuples each framing of the surrogate key folds into one key."""
    from unilake.functions import exprs
    from unilake.operators.quality import key_collisions as audit
    from unilake.sources.adapters import read_table
    part = read_table(spark, sf_dir, "part")
    size, sep = F.col("p_size").cast("string"), F.lit("-")
    marker = F.lit(exprs.SURROGATE_KEY_NULL_MARKER)
    rows = part.select(F.concat("p_brand", sep, size).alias("a"), F.col("p_type").alias("b")) \
        .unionByName(part.select(F.col("p_brand").alias("a"), F.concat(size, sep, F.col("p_type")).alias("b"))) \
        .unionByName(part.select(F.col("p_type").alias("a"), F.when(F.col("p_size") % 4 == 0, F.lit(None)).when(
            F.col("p_size") % 4 == 1, marker).otherwise(F.col("p_name")).alias("b")))
    out = None
    for framing in ("separator", "length"):
        keyed = rows.withColumn("k", exprs.surrogate_key("a", "b", framing=framing))
        per = keyed.select("k", "a", "b").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(
            audit(keyed, "k", ["a", "b"]), "k", "left")
        one = per.agg(F.lit(framing).alias("framing"), F.count(F.lit(1)).alias("keys"), F.sum("n").alias("tuples"),
                      F.count_if(F.col("tuples") > 1).alias("colliding_keys"))
        out = one if out is None else out.unionByName(one)
    return out


@register("staging_view_widened", with_models(
    "select * replace (cast(stock_quantity + 4294967296 as bigint) as stock_quantity) from stg_a__inventory",
    ["stg_a__inventory"]))
def staging_view_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging view registered by the landing of narrow stock counts shows a later
    load whose counts need a wider type."""
    from unilake.sources import adapters
    lake = _new_lake(spark)
    items = adapters.raw_frames(spark, sf_dir, {"raw_a__inventory"})["raw_a__inventory"]
    lake.land("a", {"inventory": items.withColumn("stock_qty", F.col("stock_qty").cast("int"))})
    lake.land("a", {"inventory": items.withColumn("stock_qty", F.col("stock_qty").cast("long") + F.lit(1 << 32))})
    return spark.table(f"{lake.namespace}staging.stg_a__inventory")


# --- offending rows kept beside the version (T1, T3) ------------------------------------

def _rejected_sql() -> str:
    broken = f"""
        select source_customer_id, created_at, case when cast(source_customer_id as bigint) % 7 = 0 then 'gone' else status end as status,
               case when cast(source_customer_id as bigint) % 5 = 0 then null else created_at end as day, customer_sk
        from ({with_models("select * from int_unified_customers where source_system = 'b'", ["int_unified_customers"])})"""
    ok = "day is not null and status <> 'gone'"
    return f"""
        with c as ({broken})
        select customer_sk, 'stg_b__customers' as model, 'not_null' as check_name, 'created_at' as column_name, n.published
        from c, (select count(*) as published from c where {ok}) n where day is null
        union all select customer_sk, m.model, 'accepted_values', 'status', n.published
        from c, (select count(*) as published from c where {ok}) n,
             (values ('stg_b__customers'), ('int_unified_customers')) m(model) where status = 'gone'"""


@register("rejected_rows", _rejected_sql())
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish customers of source b with planted NULL days and unknown states: the
    keys of the offending rows by failed test, and how many rows were published."""
    from unilake.plans.layers import Publisher
    from unilake.plans.layers import rejected_rows as rejects
    from unilake.sources import adapters
    lake = _new_lake(spark)
    b = adapters.b_customers(spark, sf_dir) \
        .withColumn("signup_date", F.expr("if(cust_id % 5 = 0, null, signup_date)")) \
        .withColumn("status", F.expr("if(cust_id % 7 = 0, 'gone', status)"))
    lake.land("b", {"customers": b})
    pub = Publisher(lake, keep_rejects=True)
    pub.publish("int_unified_customers")
    published = pub.read("int_unified_customers").count()
    return rejects(pub, "int_unified_customers").select(
        "customer_sk", "model", "check_name", "column_name", F.lit(published).cast("long").alias("published"))
