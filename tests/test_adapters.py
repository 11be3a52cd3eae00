"""The adapters cover the cases the models must handle, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from unilake.sources import adapters


def test_adapters_use_every_driver_row(spark):
    for (_s, t), fn in adapters.ADAPTERS.items():
        source = {"contacts": "customer", "inventory": "part", "customers": "supplier",
                  "products": "part"}.get(t, t)
        assert fn(spark, SF_ORACLE).count() == \
            adapters.read_table(spark, SF_ORACLE, source).count()


def test_injected_variety(spark):
    c = adapters.a_contacts(spark, SF_ORACLE)
    assert c.where("phone is null").count() > 0 and c.where("company_name is null").count() > 0
    b = adapters.b_customers(spark, SF_ORACLE)
    words = {r[0] for r in b.select(F.size(F.split("full_name", " "))).distinct().collect()}
    assert words == {1, 2, 3}                       # single word, two, three words
    assert {r[0] for r in b.select("status").distinct().collect()} == \
        {"active", "inactive", "churned"}
    p = adapters.b_products(spark, SF_ORACLE)
    assert {r[0] for r in p.select("available").distinct().collect()} == {0, 1, 2, None}
    inv = adapters.a_inventory(spark, SF_ORACLE)
    signs = {r[0] for r in inv.select(F.signum("stock_qty")).distinct().collect()}
    assert signs == {-1.0, 0.0, 1.0, None}
