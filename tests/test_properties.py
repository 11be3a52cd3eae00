"""Property tests: Spark operators against plain-Python brute force."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from unilake.functions import exprs
from unilake.operators import quality
from unilake.operators.change_set import change_set

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

names = st.lists(st.text(alphabet="ab ", max_size=6) | st.none(), min_size=1, max_size=25)


@SETTINGS
@given(names)
def test_name_forms_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [(r[0], r[1]) for r in df.select(exprs.first_name("s"), exprs.last_name("s")).collect()]
    want = [(None, None) if v is None else
            (v.split(" ")[0], v[v.index(" ") + 1:] if " " in v else None) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(["k1", "k2", "k3", "k4", "k5", None]), max_size=40))
def test_unique_failures_match_counter(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    want = sum(1 for k, n in Counter(k for k in keys if k is not None).items() if n > 1)
    assert quality.unique_failures(df, "k") == want
    assert quality.unique_failures(df, "k", two_phase=False) == want


rows = st.dictionaries(st.integers(0, 15), st.tuples(st.sampled_from(["x", "y", None]),
                                                    st.sampled_from([1.0, 2.5, None])),
                       max_size=12)


@SETTINGS
@given(rows, rows)
def test_change_set_matches_dict_diff(spark, old, new):
    schema = "k long, v string, x double"
    o = spark.createDataFrame([(k, *v) for k, v in old.items()], schema)
    n = spark.createDataFrame([(k, *v) for k, v in new.items()], schema)
    got = {r["k"]: r["change_type"] for r in change_set(o, n, ["k"]).collect()}
    want = {}
    for k in old.keys() | new.keys():
        if k not in old:
            want[k] = "insert"
        elif k not in new:
            want[k] = "delete"
        elif old[k] != new[k]:
            want[k] = "update"
    assert got == want
