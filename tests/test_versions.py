"""Bucketed feature tables in versions."""

import re

import pytest

from conftest import SF001
from featuremill.plans import q_features as Q
from featuremill.sources.versions import VersionedTables


def _tables(spark, shift=0, n=500):
    return {"entity": spark.range(n).selectExpr("id AS k", f"id + {shift} AS a"),
            "more": spark.range(0, n, 2).selectExpr("id AS k", f"id * 2 + {shift} AS b")}


def _state(table):
    """What a reader sees of both tables."""
    e, m = table("entity"), table("more")
    return e.selectExpr("min(a - k)").first()[0], m.selectExpr("min(b - 2 * k)").first()[0], e.count(), m.count()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_base_table_chain_has_no_exchange(spark, no_broadcast, tmp_path):
    store = VersionedTables(str(tmp_path / "store"))
    rollup = Q.rollup(spark, SF001)
    store.refresh({"entity": Q.entity(spark, SF001), "checkin": Q.checkin_features(spark, SF001),
                   "tip": Q.tip_features(spark, SF001), "rollup": rollup,
                   "label": Q.label_table(Q.role(spark, SF001, "label"), "business_id", "delivery_or_takeout")},
                  "business_id", 4)
    bt = Q.flagship_of_version(store.open(spark))
    p = bt._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("SortMergeJoin", p)) == 4 and "Exchange" not in p, p
    want = Q.flagship(spark, SF001)
    assert bt.columns == want.columns
    assert sorted(map(str, bt.collect())) == sorted(map(str, want.collect()))


def test_reader_sees_one_whole_version(spark, tmp_path):
    store = VersionedTables(str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.open(spark)
    first = store.refresh(_tables(spark), "k", 3)
    reader = store.open(spark)
    assert _state(reader) == (0, 0, 500, 250)
    second = store.write(_tables(spark, 7, 600), "k", 3)  # written, not switched to
    assert second.number == 2 and store.current(spark).version == first.version
    assert _state(reader) == _state(store.open(spark)) == (0, 0, 500, 250)
    store.switch(spark, second)
    assert _state(store.open(spark)) == (7, 7, 600, 300)
    assert _state(reader) == (0, 0, 500, 250)  # the reader stays with its version
    assert store.open(spark, first)("entity").count() == 500


def test_failed_refresh_changes_nothing(spark, tmp_path):
    store = VersionedTables(str(tmp_path / "store"))
    store.refresh(_tables(spark), "k", 3)
    broken = _tables(spark, 9)
    broken["more"] = broken["more"].selectExpr("k", "raise_error('stop') AS b")
    with pytest.raises(Exception):
        store.refresh(broken, "k", 3)
    assert _state(store.open(spark)) == (0, 0, 500, 250)
    assert store.refresh(_tables(spark, 5), "k", 3).number == 2
    assert _state(store.open(spark)) == (5, 5, 500, 250)


def test_another_session_reads_buckets(spark, no_broadcast, tmp_path):
    store = VersionedTables(str(tmp_path / "store"))
    at = store.refresh(_tables(spark), "k", 3)
    for name in at.tables:  # forget what the writer registered; the files stay
        spark.sql(f"DROP TABLE {store._name(at.version, name)}")
    table = store.open(spark)
    joined = table("entity").join(table("more"), "k", "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 500 and joined.where("b is not null").count() == 250


