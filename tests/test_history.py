"""SCD-2 history and versioned tables."""

import datetime as dt

from pyspark.sql import functions as F

from wardline.operators import history as N
from wardline.sources import tables as TB

KEY = "k"
CHECKS = ["a", "b"]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k string, a long, b long, carried long")


def test_check_strategy_cases(spark):
    h0 = N.scd2_initial(_snap(spark, [("null_null", None, 1, 0), ("null_one", None, 1, 0),
                                      ("carry", 1, 1, 0), ("gone", 1, 1, 0), ("same", 2, 2, 0)]),
                        KEY, dt.date(2024, 1, 1))
    now = _snap(spark, [("null_null", None, 1, 9), ("null_one", 1, 1, 0), ("carry", 1, 1, 5),
                        ("same", 2, 2, 0), ("fresh", 3, 3, 3)])
    h1 = N.scd2_check(h0, now, KEY, CHECKS, dt.date(2024, 2, 1))
    rows = h1.collect()
    by = {}
    for r in rows:
        by.setdefault(r.k, []).append(r)
    assert len(by["null_null"]) == 1 and by["null_null"][0].carried == 0      # NULL → NULL unchanged
    assert len(by["null_one"]) == 2                                            # NULL → 1 new version
    assert len(by["carry"]) == 1 and by["carry"][0].carried == 0              # only carried column changed
    assert len(by["gone"]) == 1 and by["gone"][0].valid_to is None            # vanished key stays open
    assert len(by["fresh"]) == 1 and by["fresh"][0].valid_from == dt.datetime(2024, 2, 1)
    # invariants: one open row per key, no overlapping ranges
    opens = h1.where(F.col("valid_to").isNull()).groupBy(KEY).count().where("count > 1").count()
    assert opens == 0
    closed = [r for r in rows if r.valid_to is not None]
    assert all(r.valid_from < r.valid_to for r in closed)
    # re-applying the same snapshot changes nothing
    h2 = N.scd2_check(h1, now, KEY, CHECKS, dt.date(2024, 3, 1))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(h2.collect(), key=key) == sorted(rows, key=key)


def test_as_of_view(spark):
    h0 = N.scd2_initial(_snap(spark, [("x", 1, 1, 0)]), KEY, dt.date(2024, 1, 1))
    h1 = N.scd2_check(h0, _snap(spark, [("x", 2, 1, 0)]), KEY, CHECKS, dt.date(2024, 2, 1))
    assert [r.a for r in N.as_of_view(h1, dt.date(2024, 1, 15)).collect()] == [1]
    assert [r.a for r in N.as_of_view(h1, dt.date(2024, 2, 1)).collect()] == [2]
    assert N.as_of_view(h1, dt.date(2023, 12, 31)).count() == 0


def test_versioned_commit_reads_old_while_writing_new(spark):
    name = "hist_versions"
    v1 = TB.commit_version(spark.createDataFrame([("a", 1)], "k string, v long"), name)
    cur = spark.table(name)
    v2 = TB.commit_version(cur.union(spark.createDataFrame([("b", 2)], "k string, v long")), name)
    assert (v1, v2) == (1, 2)
    assert sorted(r.k for r in spark.table(name).collect()) == ["a", "b"]
    assert [r.k for r in spark.table(f"{name}__v1").collect()] == ["a"]


def test_upsert_table_versions_and_bucketed_layout(spark):
    from wardline.sources.tables import upsert_table
    name = "upsert_tbl"
    a = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    b = spark.createDataFrame([("b", 3), ("c", 4), ("c", 5)], "k string, v long")
    assert upsert_table(spark, name, a, "k", buckets=4) == 1
    assert upsert_table(spark, name, b, "k", dedupe_order=["v"], buckets=4) == 2
    assert upsert_table(spark, name, b, "k", dedupe_order=["v"], buckets=4) == 3
    assert {r.k: r.v for r in spark.table(name).collect()} == {"a": 1, "b": 3, "c": 5}
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}__v3").collect()}
    assert desc.get("Num Buckets") == "4"


def test_snapshot_rejects_duplicate_keys(spark):
    import datetime as _dt

    import pytest

    from wardline.operators.quality import ContractError
    from wardline.plans.cycle import _snapshot
    dup = spark.createDataFrame([("x", 1), ("x", 2)], "k string, a long")
    with pytest.raises(ContractError):
        _snapshot(spark, "dup_hist", dup, "k", ["a"], _dt.datetime(2024, 1, 1))


def test_key_states_counts_on_orders(spark):
    import datetime as _dt

    from wardline.sources import adapters as A
    from .conftest import SF_MID
    first = A.customer_order_stats(spark, SF_MID, A.HISTORY_FIRST_AS_OF)
    h0 = N.scd2_initial(first, "custkey", A.HISTORY_FIRST_AS_OF)
    now = A.customer_order_stats(spark, SF_MID, None)
    counts = {r.state: r["count"] for r in N.key_states(h0, now, "custkey", ["order_count", "max_price"])
              .groupBy("state").count().collect()}
    assert counts == {"changed": 882, "new": 3, "unchanged": 615}


def test_upsert_table_empty_source_is_noop(spark):
    from wardline.sources.tables import current_version, upsert_table
    name = "upsert_empty_probe"
    upsert_table(spark, name, spark.createDataFrame([("a", 1)], "k string, v long"), "k", buckets=2)
    v = current_version(spark, name)
    assert upsert_table(spark, name, spark.createDataFrame([], "k string, v long"), "k", buckets=2) == v
    assert current_version(spark, name) == v


def test_failed_validation_keeps_previous_version(spark):
    import pytest

    from wardline.operators.quality import HEALTH_CONTRACT, ContractError, check_not_null
    from wardline.sources.tables import current_version, materialize
    good = spark.createDataFrame([("t", 1)], "source_table string, n long")
    materialize(good, "monitoring", "validate_probe")
    v = current_version(spark, "monitoring.validate_probe")
    bad = spark.createDataFrame([(None, 2)], "source_table string, n long")
    with pytest.raises(ContractError):
        materialize(bad, "monitoring", "validate_probe",
                    validate=lambda t: check_not_null(t, HEALTH_CONTRACT.__class__(
                        [f for f in HEALTH_CONTRACT.fields if f.name == "source_table"]), "probe"))
    assert current_version(spark, "monitoring.validate_probe") == v
    assert [r.source_table for r in spark.table("monitoring.validate_probe").collect()] == ["t"]
