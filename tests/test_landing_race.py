"""Landers side by side, reservations, and the count check of written files."""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from unilake.session import fresh_dir, list_dir, path_exists, write_text_atomic
from unilake.sources import landing
from unilake.sources.landing import Lake, LoadCountError


def _rows(spark, tag, n):
    return spark.range(n).selectExpr("id", f"'{tag}' AS tag")


def test_two_landers_keep_their_own_rows(spark, lake):
    """Both read the audit before either commits; each keeps one id of its own."""
    start = threading.Barrier(3)

    def land(tag, n):
        own = Lake(spark, lake.root)
        start.wait()
        for _ in range(3):
            own.land("a", {"t": _rows(spark, tag, n), "u": _rows(spark, tag, n + 1)})

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(land, ("x", "y", "z"), (10, 13, 17)))
    audit = lake.audit().collect()
    assert sorted(r["load_id"] for r in audit if r["table_name"] == "t") == list(range(1, 10))
    for r in audit:
        got = lake.read_raw(f"raw_a__{r['table_name']}", r["load_id"]).groupBy("tag").count().collect()
        assert [g["count"] for g in got] == [r["row_count"]]   # one lander's rows, all of them
    newest = lake.read_raw("raw_a__t", 9)
    assert sorted(map(tuple, spark.table("raw.raw_a__t").collect())) == sorted(map(tuple, newest.collect()))


def test_reservation_is_exclusive(spark, lake):
    lake.ensure_namespace("raw")
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: lake.reserve()[0], range(8)))
    assert sorted(ids) == list(range(1, 9))
    with pytest.raises(FileExistsError):
        lake.land("a", {"t": _rows(spark, "x", 1)}, load_id=3)
    assert not path_exists(spark, lake.raw_path("raw_a__t", 3))   # refused before any data
    assert lake.land("a", {"t": _rows(spark, "x", 1)}) == {"raw.raw_a__t": 1}
    assert lake.current_loads()["raw_a__t"][0] == 9
    lake.land("a", {"t": _rows(spark, "x", 2)}, load_id=10, take_over=True)
    assert lake.current_loads()["raw_a__t"][0] == 10


def test_control_files_have_one_writer(spark):
    path = f"{fresh_dir(spark, 'race')}/pointer.json"

    def write(i):
        try:
            write_text_atomic(spark, path, str(i))
            return i
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(write, range(16)) if i is not None]
    assert len(won) == 1
    folder = path.rsplit("/", 1)[0]
    assert [n for n, _ in list_dir(spark, folder) if not n.endswith(".crc")] == ["pointer.json"]


def test_failed_load_gives_its_id_back(spark, lake):
    bad = spark.createDataFrame([("x",)], "v string").selectExpr("cast(v as int) as v")
    with pytest.raises(Exception):
        lake.land("a", {"t": bad})
    assert lake.reserved_ids() == []
    lake.land("a", {"t": _rows(spark, "x", 2)})
    assert lake.current_loads()["raw_a__t"][0] == 1


@pytest.mark.parametrize("how", ["file lost", "file added"])
def test_tampered_files_are_not_audited(spark, lake, monkeypatch, how):
    write = Lake._write

    def tampered(self, name, df, load_id):
        n = write(self, name, df, load_id)
        path = self.raw_path(name, load_id)
        if how == "file lost":
            part = next(p for p, _ in list_dir(spark, path) if p.startswith("part-"))
            landing.delete_path(spark, f"{path}/{part}")
        else:
            df.write.mode("append").parquet(path)
        return n

    lake.land("a", {"t": _rows(spark, "first", 5)})
    monkeypatch.setattr(Lake, "_write", tampered)
    with pytest.raises(LoadCountError):
        lake.land("a", {"t": _rows(spark, "second", 8).repartition(2)})
    assert lake.audit().count() == 1 and lake.read_raw("raw_a__t").count() == 5


def test_footer_count_reads_no_column(spark, lake):
    lake.land("a", {"t": _rows(spark, "x", 7)})
    path = lake.raw_path("raw_a__t", 1)
    assert lake.footer_rows(path) == 7
    df = lake._footers.read.schema("x int").parquet(path).groupBy().count()
    assert "PushedAggregation: [COUNT(*)]" in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_vacuum_leaves_a_load_being_written(spark, lake):
    now = [dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)]
    lake.clock = lambda: now[0]
    lake.ensure_namespace("raw")
    slow, token = lake.reserve()
    lake._write("raw_a__t", _rows(spark, "slow", 4), slow)
    lake.land("a", {"t": _rows(spark, "fast", 2)})
    assert lake.vacuum_raw(keep_loads=1) == []
    # the slow lander commits late: it keeps its rows, the newer load stays current
    lake._commit(slow, token, [("raw.raw_a__t", "a", "t", slow, 4, "loaded", now[0], lake.raw_path("raw_a__t", slow), None)])
    assert lake.read_raw("raw_a__t", slow).count() == 4 and lake.current_loads()["raw_a__t"][0] == 2
    # one that never comes back is cleared away, and may not commit any more
    dead, token = lake.reserve()
    lake._write("raw_a__t", _rows(spark, "dead", 4), dead)
    lake.land("a", {"t": _rows(spark, "next", 3)})
    now[0] += dt.timedelta(days=2)
    assert any(p.endswith(f"load_id={dead}") for p in lake.vacuum_raw(keep_loads=1))
    with pytest.raises(FileExistsError):
        lake._commit(dead, token, [("raw.raw_a__t", "a", "t", dead, 4, "loaded", now[0], None, None)])
    assert lake.current_loads()["raw_a__t"][0] == 4
