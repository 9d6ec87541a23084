"""Nothing is lost on the way in: landing, upsert, commit, package elements, long texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardline.operators import drift as D
from wardline.operators import ingest as I
from wardline.operators import marts as M
from wardline.operators import upsert as U
from wardline.operators.landing import land_advisories
from wardline.sources import landing as L
from wardline.sources import tables as TB

AS_OF = dt.datetime(2024, 2, 1)


def _doc(ident, updated, severity="HIGH", summary="x"):
    ident = f'"{ident}"' if ident else "null"
    return (f'{{"ghsa_id": {ident}, "severity": "{severity}", "summary": "{summary}", "updated_at": "{updated}", '
            f'"published_at": "2024-01-01T00:00:00Z"}}')


def test_landing_keeps_every_readable_document_and_lists_the_rest(spark):
    docs = [_doc("G1", "2024-01-05T00:00:00Z"), "{not json", _doc("G3", "2024-01-04T00:00:00Z"), _doc("G3", "unknown"),
            _doc("G4", "2024-01-01T00:30:00+05:30", summary="older"), _doc("G4", "2023-12-31T23:00:00Z", summary="newer"),
            _doc(None, "2024-01-03T00:00:00Z"), _doc(None, "2024-01-03T00:00:00Z"), _doc("G5", "2024-01-02T00:00:00Z", "low")]
    frame = spark.createDataFrame([(d,) for d in docs], "json string")
    typed, rejects = land_advisories(frame, AS_OF, ["critical", "high"])
    got = [(r["ghsa_id"], r["summary"], r["updated_at"]) for r in typed.collect()]
    assert sorted(g[0] or "" for g in got) == ["", "", "G1", "G3", "G4"]
    assert ("G3", "x", dt.datetime(2024, 1, 4)) in got and ("G4", "newer", dt.datetime(2023, 12, 31, 23)) in got
    assert [(r["raw_json"], r["reject_reason"]) for r in rejects.collect()] == [("{not json", "invalid JSON in raw_json")]
    late, _ = land_advisories(frame, AS_OF, ["critical", "high"], dt.date(2024, 1, 4))
    assert sorted(r["ghsa_id"] for r in late.collect()) == ["G1", "G3"]


def test_upsert_fails_on_repeated_keys_and_keeps_rows_without_key(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    twice = spark.createDataFrame([("a", 5), ("a", 6)], "k string, v long")
    with pytest.raises(Exception, match="several source rows"):
        U.upsert(target, twice, "k").collect()
    assert sorted(r["v"] for r in U.upsert(target, twice, "k", dedupe_order=["v"]).collect()) == [2, 6]
    keyless = spark.createDataFrame([(None, 7), (None, 8), ("b", 9)], "k string, v long")
    assert sorted(r["v"] for r in U.upsert(target, keyless, "k").collect()) == [1, 2, 7, 8, 9]


def test_records_without_id_are_all_kept(spark):
    target = spark.createDataFrame([], "cve_id string, record string, fetched_at timestamp_ntz, loaded_at timestamp_ntz")
    records = spark.createDataFrame([('{"x": 1}', AS_OF), ('{"x": 2}', AS_OF), ('{"id": "C1"}', AS_OF)],
                                    "record string, fetched_at timestamp_ntz")
    got = U.upsert_records(target, records, "cve_id", AS_OF)
    assert sorted(r["cve_id"] for r in got.collect()) == ["C1", "UNKNOWN", "UNKNOWN"]


def test_interrupted_commit_loses_nothing(spark):
    name = "switch_probe"
    one = spark.createDataFrame([("a", 1)], "k string, v long")
    TB.upsert_table(spark, name, one, "k", buckets=3)
    spark.createDataFrame([("z", 26)], "k string, v long").write.saveAsTable(f"{name}__v2")    # written, not switched
    assert TB.current_version(spark, name) == 1 and spark.table(name).count() == 1
    TB.upsert_table(spark, name, spark.createDataFrame([("b", 2)], "k string, v long"), "k", buckets=3)
    assert TB.current_version(spark, name) == 3
    assert sorted(r["k"] for r in spark.table(name).collect()) == ["a", "b"]
    assert len(spark.table(name).inputFiles()) <= 3
    assert {t for t, in TB.column_inventory(spark).select("table_name").where("table_name like 'switch_probe%'").distinct().collect()} == {name}


def test_odd_package_elements_cost_nothing_else(spark):
    text = '[{"package": {"ecosystem": "go", "name": "n"}}, 5, null, {"package": "odd"}, {"package": {"ecosystem": "pip"}}]'
    raw = spark.createDataFrame([("A", text), ("B", "null"), ("C", None), ("D", "[]")], "ghsa_id string, affected_packages string")
    kind = "array<struct<package:struct<ecosystem:string,name:string>>>"
    typed = spark.createDataFrame([("A", [(("go", "n"),), None, None, ((None, None),), (("pip", None),)])],
                                  f"ghsa_id string, affected_packages {kind}")
    for form in (raw, raw.withColumn("affected_packages", F.parse_json("affected_packages")), typed):
        got = [(r["ghsa_id"], r["ecosystem"], r["package_name"]) for r in M.explode_packages(form).collect()]
        assert len(got) == 5 and {g for g in got if g[1]} == {("A", "go", "n"), ("A", "pip", None)}


def test_long_texts_stay_whole(spark):
    summary = "word " * 500 + "remote code"
    doc = spark.createDataFrame([(_doc("G", "2024-01-01T00:00:00Z", summary=summary),)], "json string")
    assert L.flatten_advisories(doc, AS_OF).first()["summary"] == summary
    plan = "x" * 20_000 + "\nPlan: 1 to add, 2 to change, 3 to destroy"
    logs = spark.createDataFrame([("r", 2, plan, AS_OF)], "run_id string, exit_code int, stdout string, checked_at timestamp_ntz")
    got = D.drift_records(logs).first()
    assert got["raw_plan_output"] == plan and got["resources_to_destroy"] == 3


def test_fetch_reads_the_whole_listing(spark):
    rows = [("pip", i, f"G{i}", "high") for i in range(700)]
    listing = spark.createDataFrame(rows, "ecosystem string, position int, ghsa_id string, severity string")
    assert I.fetch_advisories(listing, ["pip"], ["high"]).count() == 700
    assert I.fetch_advisories(listing, ["pip"], ["high"], limit=200).count() == 200


def test_pages_are_landed_and_upserted_record_by_record(spark, scratch):
    import os

    from wardline.__main__ import land_pages

    def page(name, *lines):
        path = os.path.join(scratch, name)
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
        return path

    item = '{"cve": {"id": "%s", "published": "%s", "n": %d}}'
    first = page("cves1", '{"vulnerabilities": [' + item % ("C1", "2024-01-01T00:00:00.000", 1) + ", "
                 + item % ("C2", "2023-01-01T00:00:00.000", 1) + ', {"n": 9}]}', "{broken")
    later = page("cves2", '{"vulnerabilities": [' + item % ("C1", "2024-01-01T00:00:00.000", 2) + ", "
                 + item % ("C3", "2020-01-01T00:00:00.000", 2) + "]}")
    table = "raw.page_probe"
    land_pages(spark, first, table, "cve_id", AS_OF, L.unwrap_cves)
    land_pages(spark, later, table, "cve_id", dt.datetime(2024, 2, 2), L.unwrap_cves,
               bounds={"published": (dt.date(2023, 1, 1), None), "lastModified": (None, None)})
    got = {(r["cve_id"], r["n"], r["loaded_at"].day)
           for r in spark.table(table).withColumn("n", F.get_json_object("record", "$.n")).collect()}
    assert got == {("C1", "2", 2), ("C2", "1", 1), ("UNKNOWN", "9", 1)}
    assert [r["json"] for r in spark.table(table + "_rejects").collect()] == ["{broken"]
    nodes = page("nodes", '{"nodes": [{"ghsaId": "G1", "severity": "LOW"}, {"ghsaId": "G2"}]}')
    land_pages(spark, nodes, "raw.node_probe", "ghsa_id", AS_OF, L.unwrap_nodes, id_field="ghsaId")
    assert {r["ghsa_id"] for r in spark.table("raw.node_probe").collect()} == {"G1", "G2"}


def test_an_older_version_does_not_stand_in_for_a_newer_one(spark):
    docs = [_doc("G1", "2024-01-01T00:00:00Z", "CRITICAL"), _doc("G1", "2024-01-02T00:00:00Z", "low")]
    typed, _ = land_advisories(spark.createDataFrame([(d,) for d in docs], "json string"), AS_OF, ["critical"])
    assert typed.count() == 0
