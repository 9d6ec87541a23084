"""Tables in parts: what a change leaves alone, what an interrupted one leaves behind; contracts checked by the write."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import history as N
from wardline.operators import quality as K
from wardline.sources import parts as P
from wardline.sources import tables as TB

ROWS = "k string, v long, note string"
BY = [P.KEY_PART]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and P.STAGED not in d}


def stored(spark, path):
    schema = T.StructType.fromDDL(ROWS).add(P.KEY_PART, T.IntegerType())
    return sorted((r.k or "", r.v, r.note) for r in P.read_parts(spark, path, schema, BY).collect())


def test_upsert_leaves_untouched_parts_alone(spark, scratch):
    path = os.path.join(scratch, "t")
    table = lambda rows: spark.createDataFrame(rows, ROWS)
    P.upsert_parts(spark, path, table([(f"k{i}", i, "old") for i in range(200)] + [(None, -1, "x")]), "k", parts=32)
    before = files(path)
    touched = P.upsert_parts(spark, path, table([("k7", 700, "new"), ("k9", 900, "new"), ("n1", 1, "new")]), "k", parts=32)
    after = files(path)
    assert 1 <= len(touched) <= 3
    gone = {f for f in before - after}
    assert {int(f.split(f"{P.KEY_PART}=")[1].split("/")[0]) for f in gone} <= set(touched) and len(before & after) >= 29
    got = dict((k, v) for k, v, _ in stored(spark, path))
    assert got["k7"] == 700 and got["k9"] == 900 and got["n1"] == 1 and got["k8"] == 8 and len(got) == 202
    assert P.upsert_parts(spark, path, table([]), "k", parts=32) == [] and files(path) == after
    again = stored(spark, path)
    P.upsert_parts(spark, path, table([("k7", 700, "new")]), "k", parts=32)
    assert stored(spark, path) == again


def test_upsert_repeated_and_missing_keys(spark, scratch):
    path = os.path.join(scratch, "t")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 3, "z")], ROWS)
    with pytest.raises(Exception, match="several source rows"):
        P.upsert_parts(spark, path, rows, "k", parts=4)
    P.upsert_parts(spark, path, rows, "k", parts=4, dedupe_order=["v"])
    assert stored(spark, path) == [("", 3, "z"), ("", 3, "z"), ("a", 2, "y")]


def test_interrupted_changes(spark, scratch):
    """Whole staged changes are put in place by the next read, unfinished ones vanish."""
    path = os.path.join(scratch, "t")
    P.upsert_parts(spark, path, spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], ROWS), "k", parts=1)
    whole = spark.createDataFrame([("a", 2, "new", 0)], ROWS + f", {P.KEY_PART} int")
    whole.write.partitionBy(*BY).parquet(f"{path}/{P.STAGED}/one")
    half = f"{path}/{P.STAGED}/two"
    whole.withColumn("v", F.lit(3).cast("long")).write.partitionBy(*BY).parquet(half)
    os.remove(f"{half}/_SUCCESS")
    assert stored(spark, path) == [("a", 2, "new")]
    assert os.listdir(f"{path}/{P.STAGED}") == []


def test_history_grows_by_its_changes(spark, scratch):
    path = os.path.join(scratch, "h")
    snaps = [(dt.datetime(2024, 1, 10), [("a", 1), ("b", 1), ("c", 1)]), (dt.datetime(2024, 1, 20), [("a", 2), ("b", 1), ("d", 1)]),
             (dt.datetime(2024, 2, 5), [("a", 3), ("b", 1), ("d", 2)]), (dt.datetime(2024, 3, 1), [("a", 3), ("b", 1), ("d", 2)])]
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    plain, closed = None, set()
    for at, rows in snaps:
        for _ in range(2):                                     # repeating a snapshot repeats nothing
            P.snapshot_parts(spark, path, frame(rows), "k", ["v"], at)
        plain = N.scd2_initial(frame(rows), "k", at) if plain is None else N.scd2_check(plain, frame(rows), "k", ["v"], at)
        got = P.history_parts(spark, path, plain.schema)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.select(*got.columns).collect()), key=str)
        now = {f for f in files(path) if f"{P.CLOSED_MONTH}={P.OPEN}" not in f}
        assert closed <= now                                   # files of closed rows keep their names
        closed = now
    assert {f.split(f"{P.CLOSED_MONTH}=")[1].split("/")[0] for f in closed} == {"m2024-01", "m2024-02"}


def test_contract_is_checked_by_the_write(spark):
    contract = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("v", T.LongType(), True)])
    good = spark.createDataFrame([("a", None)], "v2 string, v long").select(F.col("v2").alias("k"), "v")
    TB.materialize(good, "marts", "observed_probe", contract=K.ObservedContract(contract, "probe"))
    before = TB.current_version(spark, "marts.observed_probe")
    bad = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v long").repartition(3)
    watched = K.ObservedContract(contract, "probe")
    with pytest.raises(K.ContractError, match=r"k \(2\)"):
        TB.materialize(bad, "marts", "observed_probe", contract=watched)
    assert watched.nulls() == {"k": 2} and TB.current_version(spark, "marts.observed_probe") == before
    assert [r.k for r in spark.table("marts.observed_probe").collect()] == ["a"]
    with pytest.raises(K.ContractError, match="column v"):
        K.ObservedContract(contract, "probe").watch(good.withColumn("v", F.lit("x")))
    empty = K.ObservedContract(contract, "probe")
    TB.materialize(good.where("false"), "marts", "observed_empty", contract=empty)
    assert empty.nulls() == {"k": 0}


def test_landing_parses_once_and_rejects_what_is_no_object(spark):
    import json

    from wardline.operators.landing import land_advisories
    from wardline.sources import landing as L
    doc = lambda **f: json.dumps({"severity": "HIGH", "updated_at": "2024-01-02T00:00:00Z", **f})
    texts = [doc(ghsa_id="A", cvss={"score": 9.1}), doc(ghsa_id="A", updated_at="2024-01-02T05:00:00+04:00", summary="newest"),
             doc(ghsa_id="B", updated_at="no time"), doc(), doc(), doc(ghsa_id="C", severity="low"), doc(ghsa_id=7, cwes=None, credits=[1, 2]),
             "5", "[1, 2]", '"text"', "null", "true", "{broken", "", None, "  \t{}", doc(ghsa_id={"x": 1}, cvss=3)]
    typed, rejects = land_advisories(spark.createDataFrame([(t,) for t in texts], "json string"), dt.datetime(2024, 2, 1), ["high"])
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in L.RAW_ADVISORY]
    rows = typed.collect()
    assert sorted((r.ghsa_id or "", r.summary) for r in rows) == [
        ("", ""), ("", ""), ("7", ""), ("A", "newest"), ("B", ""), ('{"x":1}', "")]
    seven = next(r for r in rows if r.ghsa_id == "7")
    assert seven.credits_count == 2 and str(seven.cwes) == "[]"
    got = sorted((r.raw_json or "", r.reject_reason) for r in rejects.collect())
    assert got == sorted([(t, "no object in raw_json") for t in ("5", "[1, 2]", '"text"', "null", "true")]
                         + [(t or "", "invalid JSON in raw_json") for t in ("{broken", "", None)])
    both = L.parse_documents(spark.createDataFrame([(t,) for t in texts[:4]], "json string"))
    plan = L.typed_advisories(both, dt.datetime(2024, 2, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(json#") == 1


def test_landing_the_same_documents_again_changes_no_row(spark, scratch, monkeypatch):
    import wardline.__main__ as command
    from wardline.__main__ import land
    from wardline.sources import adapters as A

    from .conftest import SF_SMALL
    RAW_TABLE = "raw.landed_twice"
    monkeypatch.setattr(command, "RAW_TABLE", RAW_TABLE)
    folder = os.path.join(scratch, "docs")
    A.advisory_json(spark, SF_SMALL).select(F.col("json").alias("value")).write.text(folder)
    at = dt.datetime(2001, 8, 15)
    land(spark, folder, at, None, ["critical", "high"])
    columns = ["ghsa_id", "severity", "updated_at", "ingested_at"]
    first = sorted(map(str, spark.table(RAW_TABLE).select(*columns).collect()))
    assert first and len(land(spark, folder, at, None, ["critical", "high"])) > 0
    assert sorted(map(str, spark.table(RAW_TABLE).select(*columns).collect())) == first
    before = files(TB.parts_path(spark, RAW_TABLE))
    assert land(spark, folder, at, None, ["none such"]) == [] and files(TB.parts_path(spark, RAW_TABLE)) == before


def test_first_positions_of_any_number(spark):
    from wardline.operators.ingest import first_per_group
    rows = [("a", i * 7919 % 5000 - 100, f"r{i}") for i in range(3000)] + [("b", 5, f"same{i}") for i in range(50)]
    rows += [("c", None, "none"), ("c", 2**62, "far"), ("c", -2**62, "near"), (None, 1, "x"), (None, 2, "y"), ("d", 9, "twin"), ("d", 9, "twin")]
    df = spark.createDataFrame(rows, "g string, position long, note string").repartition(6)
    for n, bins in ((1, 1024), (40, 1024), (2500, 64), (10_000, 1024)):
        got = first_per_group(df, "g", "position", n, bins).collect()
        by = {}
        for r in got:
            by.setdefault(r.g, []).append(r)
        for g in {r[0] for r in rows}:
            mine = sorted(((-2**63 if p is None else p) for k, p, _ in rows if k == g))[:n]
            assert sorted(-2**63 if r.position is None else r.position for r in by[g])[:n] == mine
            if g != "d":                                # equal rows are not told apart
                assert len(by[g]) == len(mine)
    plan = first_per_group(df, "g", "position", 40)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert first_per_group(df.where("false"), "g", "position", 3).count() == 0


def test_third_decimals_count(spark):
    from wardline.operators.outliers import group_value_outliers
    rows = [("p", k, 1.0) for k in range(30)] + [("p", 99, 1.004), ("p", 99, 1.005)]
    got = group_value_outliers(spark.createDataFrame(rows, "part string, k long, value double"), "part", "k", "value").collect()
    assert [(r.k, round(r.avg_value, 6)) for r in got] == [(99, 1.0045)]


def test_plan_output_files_become_drift_records(spark, scratch):
    from wardline.operators.drift import drift_records
    from wardline.sources import landing as L
    outputs = {"prod/run-1.txt": "  # aws_s3_bucket.logs will be updated in-place\n\x1b[1mPlan:\x1b[0m 1 to add, 2 to change, 0 to destroy.\n",
               "prod/run 2.txt": "No changes. Your infrastructure matches the configuration.\n", "dev/run-3": "╷ Error: no credentials\n",
               "dev/run.4.log": "# x.y will be destroyed\nPlan: 0 to add, 0 to change, 1 to destroy.\n"}
    for name, text in outputs.items():
        os.makedirs(os.path.join(scratch, os.path.dirname(name)), exist_ok=True)
        with open(os.path.join(scratch, name), "w", encoding="utf-8") as f:
            f.write(text)
    files = L.plan_files(spark, scratch)
    assert sorted((r.environment, r.run_id, r.exit_code) for r in files.collect()) == [
        ("dev", "run-3", 1), ("dev", "run.4", 2), ("prod", "run 2", 0), ("prod", "run-1", 2)]
    found = {r.run_id: r for r in drift_records(files).collect()}
    assert set(found) == {"run-1", "run 2", "run.4"}
    assert found["run-1"].drift_detected and not found["run 2"].drift_detected and found["run.4"].drift_detected
    assert all(r.checked_at is not None for r in found.values())
